"""The reports in DuckDB SQL."""

from __future__ import annotations

from checks.domain import NOW, big, day, days, local, local_text, on_domain, rounded, step, total
from fieldledger.functions.text import LABEL_FILLER, LABEL_START
from fieldledger.plans.next_service import CANCELED_SINCE, STATES_V2, STATES_V3

OWED = "total_price - coalesce(total_paid_amount, 0)"
PARKED = 1041379200  # 18 months after NOW, same day of month


def year_in(ts: str, *years: int) -> str:
    return f"year(epoch_ms({ts} * 1000)) IN ({', '.join(map(str, years))})"


def ar_aging() -> str:
    late = days(f"{NOW} - i.due_date")
    bucket = lambda test: f"coalesce({rounded(f'SUM({OWED}) FILTER (WHERE {late} {test})')}, 0)"
    return f"""
        SELECT any_value(c.name) AS customer, COUNT(*) AS invoice_count, {total(OWED)} AS total_outstanding,
               {bucket('<= 0')} AS current_due, {bucket('BETWEEN 1 AND 30')} AS days_1_30,
               {bucket('BETWEEN 31 AND 60')} AS days_31_60, {bucket('BETWEEN 61 AND 90')} AS days_61_90,
               {bucket('> 90')} AS days_90_plus
        FROM company c, invoice i
        WHERE c.id = i.customer_id AND i.type = 'invoice' AND i.status <> 'void' AND NOT i.is_paid::BOOLEAN
        GROUP BY c.id HAVING {total(OWED)} > 0"""


def avg_days_to_payment() -> str:
    span = days("updated_at - transaction_date")
    return f"""
        , paid AS (SELECT customer_id, {span} AS n FROM invoice
                   WHERE is_paid = 1 AND type = 'invoice' AND transaction_date IS NOT NULL)
        SELECT any_value(name) AS customer, COUNT(*) AS paid_invoices, {rounded('AVG(n)', 1)} AS avg_days_to_payment,
               MIN(n) AS min_days, MAX(n) AS max_days
        FROM paid, company WHERE company.id = customer_id GROUP BY company.id"""


def overdue_invoices() -> str:
    return f"""
        SELECT i.id, i.invoice_number, (SELECT name FROM company c WHERE c.id = i.customer_id) AS customer_name,
               i.total_price, i.total_paid_amount, {OWED} AS balance_due, i.status,
               {day('i.due_date')} AS due_date, {days(f'{NOW} - i.due_date')} AS days_overdue
        FROM invoice i
        WHERE i.due_date < {NOW} AND i.type = 'invoice' AND i.is_paid = 0 AND i.status NOT IN ('paid', 'void')"""


def revenue_by_customer() -> str:
    return f"""
        SELECT any_value(c.name) AS customer, any_value(c.status) AS customer_status, COUNT(*) AS invoice_count,
               {total('total_price')} AS total_invoiced, {total('total_paid_amount')} AS total_paid,
               {total(OWED)} AS total_outstanding
        FROM company c, invoice i
        WHERE c.id = i.customer_id AND i.type = 'invoice' AND i.status <> 'void' GROUP BY c.id"""


def revenue_monthly() -> str:
    return f"""
        , lines AS (
          SELECT left({day('i.transaction_date')}, 7) AS ym, i.id, x.subtotal,
                 coalesce((SELECT sl.name FROM service_line sl WHERE sl.id = x.service_line_id), 'Unassigned') AS line
          FROM invoice_item x, invoice i
          WHERE x.invoice_id = i.id AND i.type = 'invoice' AND i.status <> 'void' AND i.transaction_date IS NOT NULL)
        SELECT ym AS year_month, left(ym, 4) AS year, right(ym, 2) AS month, line AS service_line,
               COUNT(DISTINCT id) AS invoice_count, {total('subtotal')} AS revenue
        FROM lines GROUP BY ym, line"""


def quote_acceptance() -> str:
    n = lambda test: f"COUNT(*) FILTER (WHERE q.status {test})"
    rate = rounded("CAST(100 * accepted AS DOUBLE) / nullif(accepted + rejected, 0)", 1)
    return f"""
        , tally AS (
          SELECT c.name AS customer, COUNT(*) AS total_quotes, {n("= 'accepted'")} AS accepted,
                 {n("= 'rejected'")} AS rejected, {n("= 'submitted'")} AS pending, {n("IN ('new', 'draft')")} AS draft,
                 {n("= 'canceled'")} AS canceled,
                 {rounded("SUM(if(q.status = 'accepted', q.total_price, 0))")} AS accepted_value
          FROM quote q, company c WHERE c.id = q.customer_id GROUP BY c.id, c.name)
        SELECT *, {rate} AS acceptance_rate_pct
        FROM tally"""


def stale_quotes() -> str:
    age = days(f"{NOW} - coalesce(q.latest_submission, q.created_at)")
    return f"""
        SELECT c.name AS customer, l.name AS location, l.address_city AS city, q.name AS quote_name, q.status,
               q.substatus, {rounded('q.total_price')} AS quote_value, {day('q.latest_submission')} AS last_submitted,
               {day('q.created_at')} AS created_on, {age} AS days_stale, {day('q.expires_on')} AS expires_on
        FROM company c, quote q LEFT JOIN location l ON q.location_id = l.id
        WHERE c.id = q.customer_id AND {age} >= 30 AND q.status IN ('draft', 'new', 'submitted')"""


def unbilled(where: str, status: str) -> str:
    return f"""
        SELECT c.name AS customer, l.name AS location, l.address_city AS city, j.number AS job_number,
               j.name AS job_name, j.type AS job_type, {status} j.service_line, {day('j.completed_on')} AS completed_on,
               {days(f'{NOW} - j.completed_on')} AS days_since_completed, {rounded('j.estimated_price')} AS estimated_price
        FROM company c, job j LEFT JOIN location l ON l.id = j.location_id
        WHERE c.id = j.customer_id AND {where}"""


def jobs_pending_invoice() -> str:
    return unbilled("j.status IN ('sending_invoice', 'pending_invoice')", "j.status,")


def jobs_without_invoice() -> str:
    return unbilled(
        "j.status = 'completed' AND j.completed_on IS NOT NULL AND NOT EXISTS"
        " (SELECT 1 FROM invoice i WHERE i.job_id = j.id AND i.type = 'invoice' AND i.status <> 'void')",
        "",
    )


def visits() -> str:
    done = "j.completed_on"
    return f"""
        SELECT j.id AS job_id, j.number AS job_number, c.name AS customer_name, l.name AS location_name,
               l.address_city AS city, j.type AS job_type, left({day(done)}, 4) AS year, {day(done)} AS completed_on
        FROM company c, job j LEFT JOIN location l ON l.id = j.location_id
        WHERE c.id = j.customer_id AND j.status = 'completed' AND {year_in(done, 2000, 2001)}"""


def appointment_cancellations() -> str:
    return f"""
        SELECT any_value(c.name) AS customer, any_value(l.name) AS location, any_value(l.address_city) AS city,
               a.status AS cancellation_type, COUNT(*) AS cancellation_count,
               {day('MIN(a.window_start)')} AS earliest, {day('MAX(a.window_start)')} AS most_recent
        FROM job j, company c, appointment a LEFT JOIN location l ON l.id = a.location_id
        WHERE j.id = a.job_id AND c.id = j.customer_id AND a.status LIKE 'canceled_by_%'
        GROUP BY c.id, l.id, a.status"""


def asset_inventory() -> str:
    return """
        SELECT any_value(c.name) AS customer, any_value(l.name) AS location, any_value(l.address_city) AS city,
               s.name AS service_line, a.display AS asset_type, MIN(a.name) AS asset_name,
               'active' AS asset_status, COUNT(*) AS asset_count
        FROM location l, company c, asset a LEFT JOIN service_line s ON s.id = a.service_line_id
        WHERE l.id = a.location_id AND c.id = l.company_id AND a.status = 'active' AND a.is_abstract_group = 0
        GROUP BY l.id, s.name, a.display"""


def findings(columns: str, more: str, where: str) -> str:
    return f"""
        SELECT c.name AS customer, l.name AS location, l.address_city AS city, d.severity, d.resolution,
               d.status AS deficiency_status, {day('d.reported_on')} AS reported_on,
               {days(f'{NOW} - d.reported_on')} AS days_open, {columns}
        FROM deficiency d, location l, company c {more}
        WHERE l.id = d.location_id AND c.id = l.company_id AND d.status NOT IN ('invalid', 'fixed') {where}"""


def assets_with_deficiencies() -> str:
    return findings(
        "a.display AS asset_type, a.name AS asset_name, d.title AS deficiency_title",
        ", asset a",
        "AND a.id = d.asset_id",
    )


def open_deficiencies() -> str:
    return findings("d.title, d.description", "", "")


def deficiency_severity_by_customer() -> str:
    n = lambda test: f"COUNT(*) FILTER (WHERE {test})"
    return f"""
        SELECT any_value(c.name) AS customer, COUNT(*) AS total_deficiencies,
               {n("severity = 'inoperable'")} AS inoperable, {n("severity = 'deficient'")} AS deficient,
               {n("severity = 'suggested'")} AS suggested, {n("d.status NOT IN ('invalid', 'fixed')")} AS still_open,
               {n("d.status = 'fixed'")} AS fixed
        FROM deficiency d, location l, company c
        WHERE l.id = d.location_id AND c.id = l.company_id GROUP BY c.id"""


def compliance_overdue() -> str:
    return f"""
        , seen AS (
          SELECT location_id, MAX(completed_on) AS ts FROM job
          WHERE status = 'completed' AND completed_on > 820454400 GROUP BY location_id),
        dated AS (
          SELECT c.name AS customer, l.name AS location, r.frequency, {big('r."interval"')} AS "interval",
                 {big('''r."interval" * CASE r.frequency WHEN 'weekly' THEN 7 WHEN 'monthly' THEN 30
                      WHEN 'yearly' THEN 365 END''')} AS interval_days,
                 {day('seen.ts')} AS last_completed, {days(f'{NOW} - seen.ts')} AS days_since_service
          FROM service_recurrence r, location l, company c, seen
          WHERE l.id = r.location_id AND c.id = l.company_id AND seen.location_id = l.id
            AND coalesce(r.ends_on, {NOW} + 1) > {NOW})
        SELECT *, days_since_service - interval_days AS days_overdue FROM dated
        WHERE days_since_service > interval_days"""


def customer_churn_risk() -> str:
    return f"""
        SELECT any_value(c.name) AS customer, any_value(c.status) AS customer_status,
               {day('MAX(j.completed_on)')} AS last_completed_job, COUNT(DISTINCT j.id) AS jobs_1999_2000
        FROM company c, job j
        WHERE j.customer_id = c.id AND j.status = 'completed' AND {year_in('j.completed_on', 1999, 2000)}
          AND c.is_customer = 1 AND c.id NOT IN (
            SELECT k.customer_id FROM job k WHERE k.customer_id IS NOT NULL
              AND k.status IN ('new', 'scheduled', 'completed')
              AND {year_in('coalesce(k.completed_on, k.scheduled_date)', 2001)})
        GROUP BY c.id"""


def locations_no_recurrence() -> str:
    return f"""
        SELECT c.name AS customer, c.status AS customer_status, l.name AS location, l.address_city AS city,
               l.address_state AS state, l.status AS location_status,
               {day('''(SELECT MAX(j.completed_on) FROM job j
                        WHERE j.location_id = l.id AND j.status = 'completed')''')} AS last_service_date
        FROM location l, company c
        WHERE c.id = l.company_id AND l.status = 'active' AND c.status = 'active' AND c.is_customer = 1
          AND NOT EXISTS (SELECT 1 FROM service_recurrence r WHERE r.location_id = l.id
                          AND (r.ends_on IS NULL OR r.ends_on > {NOW}))"""


def locations_on_hold_with_recurrence() -> str:
    return f"""
        SELECT any_value(c.name) AS customer, any_value(c.status) AS customer_status, any_value(l.name) AS location,
               any_value(l.address_city) AS city, any_value(l.status) AS location_status,
               COUNT(*) AS active_recurrences, MIN(r.frequency || ' / every ' || r."interval") AS sample_schedule,
               {day('MAX(r.first_start)')} AS latest_recurrence_start
        FROM service_recurrence r, location l, company c
        WHERE l.id = r.location_id AND c.id = l.company_id AND (r.ends_on IS NULL OR r.ends_on > {NOW})
          AND (l.status IN ('inactive', 'on_hold') OR c.status IN ('inactive', 'on_hold'))
        GROUP BY l.id"""


def active_locations_cleaning() -> str:
    return f"""
        , top AS (
          SELECT r.* FROM service_recurrence r, service_line s WHERE s.id = r.service_line_id AND s.abbr = 'KEC'
          QUALIFY row_number() OVER (PARTITION BY r.location_id ORDER BY r.created_at DESC, r.id DESC) = 1),
        cleaned AS (
          SELECT location_id, MAX(scheduled_date) FILTER (WHERE status = 'completed') AS last_ts,
                 MIN(scheduled_date) FILTER (WHERE scheduled_date > {NOW} AND status <> 'canceled') AS next_ts
          FROM job WHERE type = 'cleaning' GROUP BY location_id)
        SELECT l.name AS location_name, c.name AS company_name, l.address_street, l.address_city, l.address_state,
               l.address_postal, {day('last_ts')} AS last_cleaning_date, {day('next_ts')} AS next_cleaning_date,
               CASE WHEN top.frequency IN ('daily', 'weekly', 'monthly', 'yearly')
                    THEN 'Every ' || top."interval" || ' '
                         || CASE top.frequency WHEN 'daily' THEN 'day' ELSE replace(top.frequency, 'ly', '') END || '(s)'
                    ELSE top.frequency_category END AS service_interval
        FROM company c, location l
        LEFT JOIN cleaned ON cleaned.location_id = l.id LEFT JOIN top ON top.location_id = l.id
        WHERE c.id = l.company_id AND l.status = 'active'"""


def technician_workload() -> str:
    return f"""
        SELECT any_value(u.name) AS technician, any_value(u.email) AS email, COUNT(DISTINCT j.id) AS completed_jobs,
               COUNT(DISTINCT a.id) AS total_appointments, {day('MIN(j.completed_on)')} AS first_job,
               {day('MAX(j.completed_on)')} AS last_job,
               {rounded('AVG((a.window_end - a.window_start) / 3600.0::DOUBLE)', 1)} AS avg_appointment_hours
        FROM "user" u
        LEFT JOIN (SELECT * FROM job WHERE status = 'completed') j ON j.owner_id = u.id
        LEFT JOIN (SELECT * FROM appointment WHERE status = 'completed') a ON a.job_id = j.id
        WHERE u.is_tech = 1 AND u.status = 'active' GROUP BY u.id"""


# One CTE chain for the hood reports: active recurrences, their sites, their visits.
HOODS = """
    , hood AS (
      SELECT r.id, r.description, r.estimated_price, r.frequency, CAST(r."interval" AS BIGINT) AS n, r.currently_due,
             l.id AS place, l.name AS location_name, c.name AS company_name
      FROM service_recurrence r, location l, company c
      WHERE l.id = r.location_id AND c.id = l.company_id AND l.status = 'active' AND c.status = 'active'
        AND starts_with(lower(r.description), '{prefix}') AND r.service_line_id = 10
        AND r.current_service_recurrence_id = r.id AND r.ends_on IS NULL)"""
VISITS = """,
    visit AS (
      SELECT v.current_service_recurrence_id AS rid, q.id AS request_id, q.status AS service_status,
             j.status AS job_status, j.scheduled_date AS ts
      FROM service_recurrence v, service_request q, job j
      WHERE q.service_recurrence_id = v.id AND j.id = q.job_id
        AND v.current_service_recurrence_id IN (SELECT id FROM hood)),
    closed AS (SELECT rid, MAX(ts) AS closed_ts FROM visit WHERE service_status = 'closed' GROUP BY rid),
    canceled AS (SELECT rid, MAX(ts) AS canceled_ts FROM visit WHERE service_status = 'canceled' GROUP BY rid),
    lead_visit AS (
      SELECT * FROM visit WHERE {lead}
      QUALIFY row_number() OVER (PARTITION BY rid ORDER BY ts DESC NULLS LAST, request_id DESC) = 1),
    h AS (
      SELECT hood.*, closed_ts, canceled_ts, service_status, job_status, ts
      FROM hood LEFT JOIN closed ON closed.rid = hood.id LEFT JOIN canceled ON canceled.rid = hood.id
      LEFT JOIN lead_visit ON lead_visit.rid = hood.id)"""
TYPE = f"substr(description, {LABEL_START}, instr(substr(description, {LABEL_START}), '{LABEL_FILLER}') - 1)"

TESTS = {
    "parked": f"currently_due > {PARKED}",
    "new": "ts IS NULL",
    "canceled": "service_status = 'canceled'",
    "new (unscheduled)": "coalesce(closed_ts, ts) IS NULL",
    "new (scheduled)": "closed_ts IS NULL AND ts IS NOT NULL",
    "scheduled": f"service_status = 'open' AND ts > {NOW}",
    "field incompletion": f"service_status = 'open' AND ts <= {NOW}",
    "pending close *": f"service_status = 'closed' AND job_status <> 'completed' AND ts < {NOW} - 604800",
    "pending close": "service_status = 'closed' AND job_status <> 'completed'",
    "closed": "service_status = 'closed' AND job_status = 'completed'",
}


def sentence(template: str) -> str:
    sql = "'" + template + "'"
    for slot, value in (
        ("due", local_text("currently_due")),
        ("job", local_text("ts")),
        ("days", days(f"{NOW} - ts")),
    ):
        sql = sql.replace("{" + slot + "}", f"' || {value} || '")
    return sql


def cases(states) -> tuple[str, str]:
    names = " ".join(f"WHEN {TESTS[n]} THEN '{n}'" for n, _ in states)
    reasons = " ".join(f"WHEN {TESTS[n]} THEN {sentence(x)}" for n, x in states)
    return f"CASE {names} ELSE 'unknown' END", f"CASE {reasons} END"


def primary_hood_v1() -> str:
    calc = step(local("ts"), "frequency", "n")
    return (
        HOODS.format(prefix="primaryxxxxmainhoodxxxxxx")
        + f""",
        h AS (SELECT hood.*, (SELECT MAX(scheduled_date) FROM job
                              WHERE job.location_id = hood.place AND job.status = 'completed') AS ts FROM hood)
        SELECT company_name, location_name, estimated_price AS primary_hood_price, frequency, n AS "interval",
               {local_text('ts')} AS last_completed_job_pacific, {local_text('currently_due')} AS next_due_pacific,
               CAST({calc} AS VARCHAR) AS calculated_next_due_pacific,
               {big(f"day({local('ts')})")} AS last_completed_job_day_of_month,
               {big(f"{local('currently_due')} - ({calc})")} AS next_due_vs_calc_due_days
        FROM h"""
    )


def primary_hood_v2() -> str:
    calc = step(local("closed_ts"), "frequency", "n")
    state, reason = cases(STATES_V2)
    return (
        HOODS.format(prefix="primary")
        + VISITS.format(lead="true")
        + f"""
        SELECT company_name, location_name, {TYPE} AS hood_type, estimated_price AS primary_hood_price, frequency,
               n AS "interval", {local_text('closed_ts')} AS "last_completed_job_PT",
               {local_text('ts')} AS "last_scheduled_job_PT", service_status AS last_service_status,
               job_status AS last_job_status, {local_text('currently_due')} AS "next_due_PT",
               CAST({calc} AS VARCHAR) AS "calculated_next_due_PT",
               {big(f"{local('currently_due')} - ({calc})")} AS next_due_vs_calc_due_days,
               {state} AS state, {reason} AS state_reason
        FROM h"""
    )


def primary_hood_v3() -> str:
    anchor = "coalesce(ts, closed_ts)"
    calc = step(local(anchor), "frequency", "n")
    state, reason = cases(STATES_V3)
    return (
        HOODS.format(prefix="primary")
        + VISITS.format(lead="service_status <> 'canceled'")
        + f""",
        named AS (SELECT *, {state} AS state, {reason} AS reason FROM h)
        SELECT company_name AS "Company Name", location_name AS "Location Name", {TYPE} AS "Primary Type",
               estimated_price AS "Primary Price", frequency AS "Frequency", n AS "Interval",
               {local_text('closed_ts')} AS "Last Compl Job", {local_text('ts')} AS "Last Sched Job",
               {local_text('currently_due')} AS "ST Next Due Date",
               CAST(CASE WHEN {anchor} IS NULL THEN {local('currently_due')} ELSE {calc} END AS VARCHAR) AS "Calc Next Due Date",
               {big(f"{local('currently_due')} - ({calc})")} AS "ST vs Calc Next Due Days Diff",
               {big(f"day({local('closed_ts')})")} AS "Last Compl Job DOM", state AS "Row Status",
               reason || CASE WHEN state = 'closed' AND canceled_ts IS NOT NULL AND (ts IS NULL OR canceled_ts > ts)
                              THEN '{CANCELED_SINCE}' ELSE '' END AS "Row Status Reason"
        FROM named"""
    )


def primary_hood_duplicates() -> str:
    return (
        HOODS.format(prefix="primaryxxxxmainhoodxxxxxx")
        + """
        SELECT company_name, location_name, COUNT(*) AS active_primary_hood_count,
               string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS recurrence_ids,
               string_agg(CAST(estimated_price AS VARCHAR), ',' ORDER BY id) AS prices
        FROM hood GROUP BY company_name, location_name HAVING COUNT(*) > 1"""
    )


REPORT_SQL = {
    "r01_primary_hood_v1": primary_hood_v1,
    "r02_primary_hood_v2": primary_hood_v2,
    "r03_primary_hood_v3": primary_hood_v3,
    "r04_primary_hood_duplicates": primary_hood_duplicates,
    "r05_active_locations_cleaning": active_locations_cleaning,
    "r06_appointment_cancellations": appointment_cancellations,
    "r07_ar_aging": ar_aging,
    "r08_asset_inventory": asset_inventory,
    "r09_assets_with_deficiencies": assets_with_deficiencies,
    "r10_avg_days_to_payment": avg_days_to_payment,
    "r11_compliance_overdue": compliance_overdue,
    "r12_customer_churn_risk": customer_churn_risk,
    "r13_deficiency_severity_by_customer": deficiency_severity_by_customer,
    "r14_jobs_pending_invoice": jobs_pending_invoice,
    "r15_jobs_without_invoice": jobs_without_invoice,
    "r16_locations_no_recurrence": locations_no_recurrence,
    "r17_locations_on_hold_with_recurrence": locations_on_hold_with_recurrence,
    "r18_open_deficiencies": open_deficiencies,
    "r19_overdue_invoices": overdue_invoices,
    "r20_quote_acceptance": quote_acceptance,
    "r21_revenue_by_customer": revenue_by_customer,
    "r22_revenue_monthly": revenue_monthly,
    "r23_stale_quotes": stale_quotes,
    "r24_technician_workload": technician_workload,
    "r25_visits": visits,
}


def report_oracles() -> dict[str, str]:
    return {name: on_domain(build()) for name, build in REPORT_SQL.items()}
