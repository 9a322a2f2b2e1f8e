"""DuckDB statements of the single-operator queries."""

from __future__ import annotations

from checks.domain import NOW, big, day, days, local, local_text, on_domain, rounded, step
from checks.feeds import MARK, PAGE, SMALL_PAGE
from checks.reports import HOODS, report_oracles

SYNC_LOG = """
    , runs AS (
      SELECT event_type AS resource, MIN(epoch_us(ts) // 1000000)::BIGINT AS started_at, MAX(epoch_us(ts) // 1000000)::BIGINT AS finished_at,
             COUNT(*) AS n, COUNT(*) FILTER (WHERE value >= 1) AS u, MAX(event_id) AS id
      FROM events GROUP BY event_type, CAST(ts AS DATE)),
    sync_log AS (
      SELECT id, resource, started_at, finished_at, CASE WHEN id % 4 = 0 THEN 'failed' ELSE 'success' END AS status,
             CASE WHEN id % 4 = 0 THEN 0 ELSE n END AS records_fetched,
             CASE WHEN id % 4 = 0 THEN 0 ELSE u END AS records_upserted,
             CASE WHEN id % 4 = 0 THEN 'API error 500 on GET ' || resource END AS error_message
      FROM runs)"""


def clock(ts: str) -> str:
    return f"strftime(epoch_ms(CAST({ts} AS BIGINT) * 1000), '%Y-%m-%d %H:%M:%S')"


def local_clock(ts: str) -> str:
    return f"strftime(timezone('America/Los_Angeles', to_timestamp({ts})), '%Y-%m-%d %H:%M:%S')"


#: Settled rules: feed, fields, what leaves them out, what spreads them, column, its source, type, its source, key, its source.
#: A column of ``*`` is the field in snake case; ``+`` before a feed marks fields that only its overrides know.
SETTLED = """
company|name status||||name||||
company|refNumber|||ref_number|name||||
company|customer|||is_customer|flag|integer|flag||
company|vendor|||is_vendor|flag|integer|flag||
company|address||address||||||
company|phoneNumber|||phone|rename||||
company|defaultBrand|||default_brand_id|object id|integer|object id|id|object id
company|tags|everywhere|||||||
company|shareId|override|||||||
company|created|||created_at|rename|timestamp|rename||
company|externalIds|||external_ids|rename|text|rename||
+company|managingAccount serviceLinesProvided logo|override|||||||
invoice|invoiceNumber|||invoice_number|name||||
invoice|type status job||||name||||
invoice|customer|||customer_id|object id|integer|object id|id|object id
invoice|totalPrice|||total_price|name||||
invoice|totalPaidAmount|||total_paid_amount|name|real|override||
invoice|paid|||is_paid|flag|integer|flag||
invoice|transactionDate|||transaction_date|name|timestamp|timestamp||
invoice|items|override|||||||
+invoice|terms tags|override|||||||
+invoice|assignedUser|||assigned_user_id|override|integer|override|id|override
+invoice|paymentTerms|||payment_terms_id|override|integer|override|id|override
+invoice|visibility substatus||||name|text|override||
quote|name||||name||||
quote|subtotal||||name|real|correction||
quote|totalPrice|||total_price|name|real|override||
quote|visibility||||name|text|override||
quote|sales|||sales_id|override|integer|override|id|override
+quote|serviceLines jobs items tags serviceRequests|override|||||||
+quote|terms|||terms_id|override|integer|override|id|override
+quote|taxAmount|||tax_amount|name|real|override||
+quote|deficiencyJobs|||deficiency_jobs|name|text|override||
+quote|substatus||||name|text|override||
+quote|sectionVisibilities|||section_visibilities|name|text|override||
+quote|taskingDetailLevel|||tasking_detail_level|override||||
servicerecurrence|description frequency interval||||name||||
servicerecurrence|location|||location_id|object id|integer|object id|id|object id
servicerecurrence|currentServiceRecurrence|||current_service_recurrence_id|override|integer|override||
servicerecurrence|endsOn|||ends_on|name|timestamp|timestamp||
+servicerecurrence|preferredTechs items taskingDuration tasks taskLists|override|||||||
+servicerecurrence|parent|||parent_id|override|integer|override|id|override
+servicerecurrence|contract|||contract_id|override|integer|override|id|override
+servicerecurrence|preferredVendor|||preferred_vendor_id|override|integer|override|id|override
+servicerecurrence|frequencyCategory|||frequency_category|name|text|override||
+servicerecurrence|currently_due||||name|timestamp|override||
+servicerecurrence|repeatWeekday|||repeat_weekday|override||||
+servicerecurrence|preferredStartTime|||preferred_start_time|override||||
event|eventType|||event_type|name||||
event|value sales frequency duration||||name||||
event|user|||user_id|object id|integer|object id|id|object id
event|isTest|||is_test|name|integer|flag||
event|labels||||name|text|text||
event|parts|array of objects|||||||
event|dueDate|||due_date|name|timestamp|timestamp||
"""


def settled_values() -> str:
    text = lambda x: f"'{x}'" if x else "NULL"
    rows = []
    for line in SETTLED.split("\n")[1:-1]:
        feed, names, skip, spread, column, *rest = line.split("|")
        for name in names.split():
            own = column or (name if rest[0] else "")
            rows.append(f"({', '.join(text(x) for x in (feed.lstrip('+'), name, skip, spread, own, *rest))}, {str(not line.startswith('+')).upper()})")
    return ", ".join(rows)


SYNC_STATUS = (
    SYNC_LOG
    + f""",
    sync_status AS (
      SELECT resource, MAX(started_at) FILTER (WHERE status = 'success') AS last_synced_at,
             {clock("MAX(started_at) FILTER (WHERE status = 'success')")} AS last_synced_at_dt,
             MAX(finished_at) FILTER (WHERE status = 'success') AS last_run_at,
             {clock("MAX(finished_at) FILTER (WHERE status = 'success')")} AS last_run_at_dt,
             {big('SUM(records_upserted)')} AS record_count
      FROM sync_log GROUP BY resource HAVING COUNT(*) FILTER (WHERE status = 'success') > 0)"""
)

CHAIN = """
    , visit AS (
      SELECT v.current_service_recurrence_id AS recurrence_id, q.id AS request_id, q.status AS service_status,
             j.status AS job_status, j.scheduled_date AS visit_ts
      FROM service_recurrence v, service_request q, job j, service_recurrence a
      WHERE q.service_recurrence_id = v.id AND j.id = q.job_id AND a.id = v.current_service_recurrence_id
        AND a.id = a.current_service_recurrence_id AND a.ends_on IS NULL AND a.service_line_id = 10
        AND a.description LIKE 'Primary%')"""

CENTS = "CAST(CAST(id * 12345 % 1000000000 AS DOUBLE) / 100 AS DOUBLE)"
DUE = f"CASE WHEN id % 11 <> 0 THEN {MARK} + id * 86400 END"
SIDE = f"""
    , side AS (
      SELECT id AS k, CASE WHEN id % 3 = 2 AND id % 2 = 1 THEN -id ELSE id + 1000000000 END AS id,
             CASE WHEN id % 3 = 1 THEN id WHEN id % 2 = 0 THEN id - 1 END AS recurrence_id,
             {DUE} AS window_start
      FROM service_recurrence WHERE id % 3 <> 0),
    due AS (
      SELECT coalesce(recurrence_id, -id) AS parent, arg_max_null(window_start, k) AS currently_due
      FROM side GROUP BY parent)"""

ITEMS = """
    , items AS (
        SELECT i.id AS invoice_id, i.id * 10 + k.k AS id, 'item ' || k.k AS description, CAST(k.k AS DOUBLE) AS quantity,
               CAST(k.k * 1.5 AS DOUBLE) AS price, CAST(k.k * k.k * 1.5 AS DOUBLE) AS subtotal, k.k % 3 AS service_line_id
        FROM invoice i, (SELECT unnest(range(1, 4)) AS k) k WHERE k.k <= i.id % 4)"""

def child_feed(embedded: str, detail: str, key: str = "id") -> str:
    """Where children are taken from, by the keys of the first embedded and the first detailed one."""
    first = lambda rows: f"(SELECT json_keys(to_json(r)) FROM {rows} r ORDER BY {key} LIMIT 1)"
    return f"""
        , keys AS (SELECT {first(embedded)} AS shown, {first(detail)} AS known)
        SELECT CASE WHEN list_has_all(known, shown) AND len(shown) < len(known) THEN 'parent_endpoint' ELSE 'inline' END AS fetch_mode FROM keys"""


EVENTS = "SELECT event_id, event_type, value, props, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS updated_at FROM events"

NULL_TEXT = "CAST(NULL AS VARCHAR)"
NULL_INT = "CAST(NULL AS BIGINT)"
ADDRESS = """CASE WHEN id % 5 <> 0 THEN id || ' Main St' END AS address_street,
             CASE WHEN id % 5 <> 0 THEN 'Town' END AS address_city, CASE WHEN id % 5 <> 0 THEN 'WA' END AS address_state,
             CASE WHEN id % 5 <> 0 THEN lpad(CAST(id AS VARCHAR), 5, '0') END AS address_postal"""

COMPANY_FIELDS = (
    "id:id uri:uri name:name status:status refNumber:ref_number customer:customer vendor:vendor address:address"
    " phoneNumber:phone_number defaultBrand:default_brand tags:tags shareId:share_id created:created"
    " externalIds:external_ids"
)
EVENT_TYPES = (
    "id:integer eventType:text value:real user:object isTest:boolean labels:array parts:array sales:unknown"
    " dueDate:unknown frequency:unknown duration:unknown"
)


def pairs(text: str) -> str:
    return ", ".join("('{}', '{}')".format(*p.split(":")) for p in text.split())


def steps() -> str:
    at, n = "CAST(epoch_ms(scheduled_date * 1000) AS DATE)", "(id % 40 - 3)"
    kinds = ("daily", "weekly", "monthly", "yearly")
    return ", ".join(
        f"CASE WHEN {n} >= 0 THEN CAST({step(at, chr(39) + k + chr(39), n)} AS VARCHAR) END AS next_{k}" for k in kinds
    )


DOMAIN_SQL = {
    "s1_extract_records": f"""
        SELECT id // {PAGE} + 1 AS page, id % {PAGE} AS pos, id, name FROM company""",
    "s2_page_union": f"""
        SELECT id // {PAGE} + 1 AS page, COUNT(*) AS records, MIN(id) AS first_id, MAX(id) AS last_id
        FROM invoice GROUP BY page""",
    "s3_sideload_scan": SIDE + " SELECT id, recurrence_id, window_start FROM side",
    "s3_side_sections": SIDE + " SELECT 'serviceRequests' AS section, COUNT(*) AS records FROM side",
    "s5_incremental_read": f"SELECT id, status, updated_at FROM invoice WHERE updated_at > {NOW} - 365 * 86400",
    "s6_default_floor": f"SELECT id, {big('scheduled_date + id % 2 * 86400')} AS updated_at FROM job WHERE scheduled_date + id % 2 * 86400 > {MARK}",
    "s1_repeated_keys": f"""
        SELECT id // {SMALL_PAGE} + 1 AS page, CASE WHEN id % 10 <> 7 THEN id END AS id, name FROM company WHERE id // {SMALL_PAGE} <> 1""",
    "s2_stream_pull": """
        SELECT 'first' AS moment, 'company' AS name, COUNT(*) FILTER (WHERE id % 2 = 1) AS records FROM company
        UNION ALL SELECT 'first', 'sync_status', -1 UNION ALL SELECT 'second', 'company', COUNT(*) FROM company
        UNION ALL SELECT 'second', 'sync_status', 1""",
    "m5_typed_rejects": f"""
        SELECT id, 'created' AS field, 'day ' || id AS raw, 'not timestamp' AS reason, {NULL_INT} AS created_at
        FROM company WHERE id % 10 = 3 AND id // {SMALL_PAGE} <> 1""",
    "m5_dead_letter": f"""
        , read AS (SELECT id FROM company WHERE id // {SMALL_PAGE} <> 1)
        SELECT 'fetched' AS what, COUNT(*) AS records FROM read UNION ALL SELECT 'upserted', COUNT(*) FROM read WHERE id % 10 <> 7
        UNION ALL SELECT 'no id', COUNT(*) FROM read WHERE id % 10 = 7 UNION ALL SELECT 'partial runs', 1
        UNION ALL SELECT 'page cannot be read', COUNT(DISTINCT id // {SMALL_PAGE}) FROM company WHERE id // {SMALL_PAGE} = 1 UNION ALL SELECT 'marks', -1""",
    "p17_mixed_children": ITEMS
    + """, detailed AS (SELECT id AS invoice_id, id * 10 + k AS id FROM invoice, (VALUES (2), (9)) d(k) WHERE id % 3 <> 0)
          SELECT invoice_id, id, description, quantity, subtotal FROM items ANTI JOIN detailed USING (invoice_id, id)
          UNION ALL SELECT invoice_id, id, 'detailed', CAST(7.5 AS DOUBLE), CAST(NULL AS DOUBLE) FROM detailed""",
    "s8_load_feed": ITEMS + " SELECT * FROM items",
    "s12_reset": ITEMS
    + """ SELECT 'before' AS moment, 'invoice' AS name, COUNT(*) AS records FROM invoice
          UNION ALL SELECT 'before', 'invoice_item', COUNT(*) FROM items UNION ALL SELECT 'before', 'sync_status', 2
          UNION ALL SELECT 'after', name, 0 FROM (VALUES ('invoice'), ('invoice_item'), ('sync_status')) v(name)""",
    "s5_since_mark": f"SELECT id, status, updated_at FROM invoice WHERE updated_at > {NOW} - 365 * 86400",
    "s9_loaded_status": ITEMS
    + f""" SELECT resource, {NOW}::BIGINT AS last_synced_at, {clock(NOW)} AS last_synced_at_dt, {NOW}::BIGINT AS last_run_at,
                  {clock(NOW)} AS last_run_at_dt, record_count
           FROM (SELECT 'invoice' AS resource, COUNT(*) AS record_count FROM invoice UNION ALL SELECT 'invoice_item', COUNT(*) FROM items)""",
    "m9_loaded_summary": ITEMS
    + """ SELECT resource, CAST(1 AS BIGINT) AS runs, n AS fetched, n AS upserted, CAST(0 AS BIGINT) AS failed
          FROM (SELECT 'invoice' AS resource, COUNT(*) AS n FROM invoice UNION ALL SELECT 'invoice_item', COUNT(*) FROM items)""",
    "s17_dependent_views": "SELECT customer_id, COUNT(*) AS jobs FROM job WHERE status = 'new' GROUP BY customer_id",
    "s15_list_views": """
        SELECT v.name, v.description, status, COUNT(*) AS jobs
        FROM job JOIN (VALUES ('report_zz_open', 'Jobs under way', 'completed'), ('report_mm_new', 'New jobs', 'new')) v(name, description, s) ON status = s
        GROUP BY v.name, v.description, status""",
    "s16_drop_view": """
        SELECT 'report_aa_count' AS name, NULL AS jobs UNION ALL SELECT 'report_zz_open', COUNT(*) FROM job""",
    "s17_restored_view": "SELECT id, status, customer_id FROM job WHERE NOT (status = 'completed')",
    "o7_set_operations": """
        SELECT DISTINCT customer_id FROM invoice WHERE customer_id IN (SELECT customer_id FROM quote)
          AND customer_id NOT IN (SELECT customer_id FROM job WHERE status = 'new') ORDER BY customer_id""",
    "s9_sync_status": SYNC_STATUS + " SELECT * FROM sync_status",
    "s10_sync_log": SYNC_LOG
    + f""" SELECT *, {clock('started_at')} AS started_at_dt, {clock('finished_at')} AS finished_at_dt FROM sync_log""",
    "s11_row_counts": ITEMS
    + """ SELECT 'invoice' AS name, COUNT(*) AS records FROM invoice UNION ALL SELECT 'invoice_item', COUNT(*) FROM items
          UNION ALL SELECT 'sync_log', 2 UNION ALL SELECT 'quote', -1 UNION ALL SELECT 'region', -1""",
    "s13_bounded_query": "SELECT id, status, estimated_price FROM job ORDER BY estimated_price DESC, id LIMIT 1000",
    "s13_cut_query": """
        SELECT id, status, (SELECT COUNT(*) FROM invoice) > 1000 AS truncated FROM invoice ORDER BY id DESC LIMIT 1000""",
    "s18_timestamp_view": f"""
        SELECT id, job_id, window_start, {local_clock('window_start')} AS window_start_dt,
               {local_clock('window_end')} AS window_end_dt, {NULL_TEXT} AS due_by_dt FROM appointment""",
    "s19_freshness": SYNC_STATUS + " SELECT resource, last_synced_at_dt, record_count FROM sync_status",
    "p15_schema_filter": f"""
        SELECT id, name, status, CASE WHEN id % 3 <> 0 THEN 'R-' || id END AS ref_number, {big('is_customer')} AS is_customer,
               CASE WHEN id % 4 <> 0 THEN {big('1 - id % 2')} END AS is_vendor, {NULL_INT} AS is_parts_vendor,
               {NULL_INT} AS is_prime_contractor, {ADDRESS}, '555-' || id AS phone, id % 7 AS default_brand_id,
               {MARK} + id * 3600 AS created_at, {NULL_INT} AS updated_at, '{{"books":"' || id || '"}}' AS external_ids
        FROM company""",
    "p14_rule_provenance": f"""
        SELECT feed, field, CASE WHEN NOT seen THEN 0 ELSE CASE feed WHEN 'company' THEN (SELECT COUNT(*) FROM company)
                 WHEN 'invoice' THEN (SELECT COUNT(*) FROM invoice) WHEN 'quote' THEN (SELECT COUNT(*) FROM quote)
                 WHEN 'event' THEN (SELECT COUNT(*) FROM events) ELSE (SELECT COUNT(*) FROM service_recurrence) END END AS records,
               skip_by, spread_by, column_name, column_by, column_type, type_by, taken_key, key_by
        FROM (VALUES {settled_values()})
          AS v(feed, field, skip_by, spread_by, column_name, column_by, column_type, type_by, taken_key, key_by, seen)""",
    "p3_flatten": f"SELECT id, {ADDRESS} FROM company",
    "p4_extract_key": "SELECT id, customer_id, job_id FROM invoice",
    "p6_rename": f"""
        SELECT f AS field, c AS column_name, (SELECT COUNT(*) FROM company) AS records
        FROM (VALUES {pairs(COMPANY_FIELDS)}) AS names(f, c)""",
    "p8_flags": f"""
        SELECT id, {big('is_customer')} AS is_customer, CASE WHEN id % 4 <> 0 THEN {big('1 - id % 2')} END AS is_vendor
        FROM company""",
    "p9_money": f"SELECT id, CASE WHEN id % 12 <> 0 THEN {CENTS} END AS subtotal, {CENTS} AS total_price FROM quote",
    "p10_timestamps": f"""
        SELECT id, {MARK} + id * 3600 AS created_at, {clock(f'{MARK} + id * 3600')} AS created_at_dt FROM company""",
    "p11_json_text": """SELECT id, '["tech","é' || id || '"]' AS visibility FROM quote""",
    "p16_children": ITEMS + " SELECT * EXCLUDE (price) FROM items",
    "p17_inline_choice": ITEMS
    + " SELECT len(json_keys(to_json(r))) > 4 AS inline FROM (SELECT * EXCLUDE (invoice_id) FROM items) r ORDER BY id LIMIT 1",
    "q3_child_feed_mode": ITEMS
    + ", embedded AS (SELECT * EXCLUDE (invoice_id) FROM items), records AS (SELECT event_id AS id, event_type, value, user_id FROM events)"
    + child_feed("embedded", "records"),
    "q3_detail_feed_mode": """
        , sparse AS (SELECT id * 10 + 1 AS id, 'item 1' AS description FROM invoice),
        detailed AS (SELECT id * 10 + 2 AS id, 'detailed' AS description, 7.5 AS quantity FROM invoice WHERE id % 3 <> 0)"""
    + child_feed("sparse", "detailed"),
    "s7_static_feed": """
        , every_tag AS (SELECT COUNT(*) AS n FROM asset), even_tag AS (SELECT COUNT(*) AS n FROM asset WHERE id % 2 = 0)
        SELECT 'first' AS moment, 'success' AS status, n AS fetched, n AS records FROM even_tag
        UNION ALL SELECT 'again', 'skipped', 0, n FROM even_tag UNION ALL SELECT 'full', 'success', n, n FROM every_tag""",
    "m8_load_order": """
        SELECT 0::BIGINT AS place, 'tag' AS resource, 'success' AS status, COUNT(*) AS records_fetched, NULL::VARCHAR AS error_message FROM asset
        UNION ALL SELECT 2, 'company', 'success', COUNT(*), NULL FROM company UNION ALL SELECT 4, 'quote', 'success', COUNT(*), NULL FROM quote
        UNION ALL SELECT 4, 'quote_item', 'success', 0, NULL UNION ALL SELECT 7, 'servicerequestitem', 'skipped', 0, 'no table for this feed'""",
    "m6_missing_ids": f"""
        , odd AS (SELECT COUNT(*) AS n FROM company WHERE id % 10 = 7 AND id // {SMALL_PAGE} <> 1)
        SELECT '{NOW}' AS what, n AS records FROM odd UNION ALL SELECT '{NOW + 20}', n FROM odd
        UNION ALL SELECT 'company', COUNT(*) FROM company WHERE id % 10 <> 7 AND id // {SMALL_PAGE} <> 1""",
    "m9_loaded_outcomes": """
        SELECT 'quote' AS resource, 1::BIGINT AS runs, COUNT(*) AS fetched, COUNT(*) AS upserted, 0::BIGINT AS failed FROM quote
        UNION ALL SELECT 'company', 2, COUNT(*), COUNT(*), 1 FROM company UNION ALL SELECT 'quote_item', 1, 0, 0, 0 UNION ALL SELECT 'servicerequestitem', 1, 0, 0, 0""",
    "x10_loaded_failures": f"""
        SELECT 'company' AS resource, {NOW}::BIGINT AS started_at, '1 pulls have fewer pages than they announce' AS error_message
        WHERE EXISTS (FROM company)""",
    "x4_loaded_stale": f"""
        , status AS (SELECT 'quote' AS resource, {NOW - 259200}::BIGINT AS mark, COUNT(*) AS record_count FROM quote
                     UNION ALL SELECT 'quote_item', {NOW - 259200}, 0 UNION ALL SELECT 'company', {NOW + 3600}, COUNT(*) FROM company),
        late AS (SELECT *, (SELECT MAX(mark) FROM status) - mark AS behind FROM status)
        SELECT resource, {clock("mark")} AS last_synced_at_dt, record_count, CASE WHEN behind > 86400 THEN mark END AS last_synced_at,
               CASE WHEN behind > 86400 THEN behind END AS behind_seconds FROM late""",
    "p20_sideload_enrich": SIDE
    + f""" SELECT r.id, {big('r.current_service_recurrence_id')} AS current_service_recurrence_id,
                  {big('r.ends_on')} AS ends_on, {big('due.currently_due')} AS currently_due
           FROM service_recurrence r LEFT JOIN due ON due.parent = r.id""",
    "q7_match_ratio": SIDE
    + """ SELECT COUNT(due.parent) AS matched, COUNT(*) AS records
          FROM service_recurrence r LEFT JOIN due ON due.parent = r.id""",
    "q4_paging_summary": f"""
        SELECT '' AS pull, MAX(id) // {PAGE} + 1 AS total_pages, {NULL_INT} AS total_count, CAST({PAGE} AS BIGINT) AS page_size,
               COUNT(DISTINCT id // {PAGE}) AS pages_landed, COUNT(DISTINCT id // {PAGE}) = MAX(id) // {PAGE} + 1 AS complete
        FROM company HAVING total_pages > 1""",
    "m9_run_summary": SYNC_LOG
    + f""" SELECT resource, COUNT(*) AS runs, {big('SUM(records_fetched)')} AS fetched,
                  {big('SUM(records_upserted)')} AS upserted, COUNT(*) FILTER (WHERE status = 'failed') AS failed
           FROM sync_log GROUP BY resource""",
    "d3_calendar_add": f"SELECT id, {steps()} FROM job",
    "d2_local_date": f"""
        , starts AS (SELECT id, window_start + (id % 24) * 3600 AS ts FROM appointment)
        SELECT id, {local_text('ts')} AS day, {big(f"day({local('ts')})")} AS dom, {local_clock('ts')} AS clock,
               {big(f"epoch(CAST({local('ts')} AS TIMESTAMP))")} AS day_epoch, left({day('ts')}, 7) AS utc_month FROM starts""",
    "d7_day_drift": f"SELECT id, {big(local('expires_on') + ' - ' + local('created_at'))} AS drift FROM quote",
    "d10_whole_days": f"""
        SELECT id, {days(f'{NOW} - due_date - id % 86400')} AS late_days, id % 5 * 30 AS cadence FROM invoice""",
    "d17_label": """
        , noted AS (SELECT id, CASE WHEN id % 4 = 0 THEN description || 'x' || id ELSE description END AS d
                    FROM service_recurrence)
        SELECT id, CASE WHEN instr(substr(d, 12), 'x') > 0 THEN split_part(substr(d, 12), 'x', 1) ELSE substr(d, 11, 1) END AS label
        FROM noted""",
    "f5_prefix": "SELECT id FROM service_recurrence WHERE description ILIKE 'primary%'",
    "j6_chain": """
        SELECT a.id AS recurrence_id, q.id AS service_id, q.service_recurrence_id, q.job_id, q.status
        FROM service_recurrence a, service_recurrence v, service_request q
        WHERE a.id = a.current_service_recurrence_id AND v.current_service_recurrence_id = a.id
          AND q.service_recurrence_id = v.id""",
    "w1_latest": f"""
        SELECT location_id, frequency, {big('"interval"')} AS "interval", frequency_category FROM service_recurrence
        WHERE service_line_id = 10
        QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY created_at DESC, id DESC) = 1""",
    "a11_group_concat": """
        SELECT address_city, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids, COUNT(*) AS places
        FROM location GROUP BY address_city""",
    "a2_distinct_counts": """
        SELECT owner_id, COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT location_id) AS places
        FROM job GROUP BY owner_id""",
    "o4_mixed_sort": f"""
        SELECT id, {big('CASE id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END')} AS rank,
               CASE WHEN id % 3 = 0 THEN scheduled_date END AS number,
               CASE WHEN id % 3 = 1 THEN CAST(scheduled_date AS VARCHAR) END AS text FROM job""",
    "x2_last_open_visit": CHAIN
    + """ SELECT * FROM visit WHERE service_status <> 'canceled'
          QUALIFY row_number() OVER (PARTITION BY recurrence_id ORDER BY visit_ts DESC, request_id DESC) = 1""",
    "x2_last_closed_visit": CHAIN
    + """ SELECT recurrence_id, MAX(visit_ts) AS last_closed_ts FROM visit
          WHERE service_status = 'closed' GROUP BY recurrence_id""",
    "x3_freshness": SYNC_STATUS + " SELECT resource, last_synced_at_dt, record_count FROM sync_status",
    "x4_stale_resources": SYNC_STATUS
    + """ SELECT resource, last_synced_at, (SELECT MAX(last_synced_at) FROM sync_status) - last_synced_at AS behind_seconds
          FROM sync_status WHERE behind_seconds > 86400""",
    "x5_fully_canceled_jobs": """
        SELECT job_id, COUNT(*) AS appointments FROM appointment GROUP BY job_id HAVING bool_and(status LIKE 'canceled%')""",
    "x6_job_date_agreement": f"""
        , live AS (SELECT job_id, MAX(window_start) FILTER (WHERE status NOT LIKE 'canceled%') AS ts
                   FROM appointment GROUP BY job_id)
        SELECT COUNT(*) AS jobs, COUNT(*) FILTER (WHERE j.scheduled_date = live.ts) AS agreeing,
               {rounded('100.0 * COUNT(*) FILTER (WHERE j.scheduled_date = live.ts)::DOUBLE / COUNT(*)')} AS agree_pct
        FROM job j, live WHERE live.job_id = j.id""",
    "x7_retired_pointers": f"""
        SELECT COUNT(*) AS services, {big('SUM(CAST(v.id <> v.current_service_recurrence_id AS INTEGER))')} AS on_retired,
               {rounded('100.0 * AVG(CAST(v.id <> v.current_service_recurrence_id AS INTEGER))')} AS retired_pct
        FROM service_request q, service_recurrence v
        WHERE v.id = q.service_recurrence_id AND v.description LIKE 'Primary%'""",
    "x8_duplicates_by_description": HOODS.format(prefix="primary")
    + """ SELECT id AS recurrence_id, company_name, location_name, description,
                 COUNT(*) OVER (PARTITION BY company_name, location_name, description) AS copies
          FROM (SELECT * FROM hood UNION ALL SELECT * REPLACE (-id AS id) FROM hood WHERE id % 3 = 0) QUALIFY copies > 1""",
    "x9_closed_on_open_job": """
        SELECT q.id AS service_id, q.job_id, j.status AS job_status, j.scheduled_date
        FROM service_request q, job j WHERE j.id = q.job_id AND q.status = 'closed' AND j.status <> 'completed'""",
    "x10_failed_loads": SYNC_LOG + " SELECT id, resource, started_at, error_message FROM sync_log WHERE status = 'failed'",
    "x10_latest_loads": SYNC_LOG
    + " SELECT id, resource, status, records_fetched FROM sync_log ORDER BY started_at DESC, id DESC LIMIT 20",
}

PLAIN_SQL = {
    "q1_field_profile": f"SELECT f AS field, t AS api_type FROM (VALUES {pairs(EVENT_TYPES)}) AS v(f, t) WHERE EXISTS (FROM events)",
    "q1_profile_in_batches": """
        SELECT 'id' AS field, 'integer' AS api_type WHERE EXISTS (FROM events) UNION ALL
        SELECT event_type, CASE WHEN MIN(event_id) % 2 = 0 THEN 'text' ELSE 'integer' END FROM events GROUP BY event_type""",
    "q2_nested_keys": """
        SELECT f AS field, t AS api_type, k AS key_list
        FROM (VALUES ('user', 'object', 'id'), ('parts', 'array', 'id,name')) AS v(f, t, k) WHERE EXISTS (FROM events)""",
    "q5_rule_warnings": """
        SELECT * FROM (VALUES ('event', 'sales', 'type unknown, may need an override'),
          ('event', 'frequency', 'type unknown, may need an override'),
          ('event', 'duration', 'type unknown, may need an override'), ('event', NULL, 'no description'),
          ('servicerecurrence', 'sales', 'type unknown, may need an override'),
          ('servicerecurrence', 'frequency', 'type unknown, may need an override'),
          ('servicerecurrence', 'duration', 'type unknown, override has no type or key')) AS v(feed, field, warning)""",
    "q6_catalogue_stats": "SELECT 2::BIGINT AS feeds, 20::BIGINT AS fields, 2::BIGINT AS skipped",
    "m1_upsert": f"""
        SELECT event_id, event_type, CASE WHEN event_id % 7 = 0 THEN value * 3 ELSE value END AS value,
               CASE WHEN event_id % 7 <> 0 THEN props END AS props, updated_at FROM ({EVENTS})""",
    "m3_upsert_by_updated": f"""
        SELECT event_id, event_type, CASE WHEN event_id % 10 = 0 THEN -1.0::DOUBLE ELSE value END AS value, props,
               updated_at + CASE WHEN event_id % 10 = 0 THEN 60 ELSE 0 END AS updated_at FROM ({EVENTS})""",
    "m4_deleted_rows": "SELECT event_id, event_type FROM events WHERE event_id % 9 = 4",
    "m5_rejects": """
        SELECT event_type, COUNT(*) AS fetched, COUNT(*) FILTER (WHERE event_id % 10 <> 3) AS upserted,
               COUNT(*) FILTER (WHERE event_id % 10 = 3) AS rejected FROM events GROUP BY event_type""",
}


def placed(report: str, order: str, columns: str) -> str:
    """A report with the place of each row: by its display order, then by its columns."""
    ties = ", ".join(f"{c} ASC NULLS FIRST" for c in columns.split())
    return f"SELECT {', '.join(columns.split())}, row_number() OVER (ORDER BY {order}, {ties}) AS position FROM ({report_oracles()[report]})"


PLAIN_SQL["o1_quote_positions"] = placed(
    "r20_quote_acceptance",
    "total_quotes DESC NULLS LAST",
    "customer total_quotes accepted rejected pending draft canceled acceptance_rate_pct accepted_value",
)
PLAIN_SQL["o2_deficiency_positions"] = placed(
    "r18_open_deficiencies",
    "CASE severity WHEN 'inoperable' THEN 1 WHEN 'deficient' THEN 2 ELSE 3 END, days_open DESC NULLS LAST",
    "customer location city severity title deficiency_status resolution reported_on days_open description",
)
PLAIN_SQL["o3_visit_positions"] = placed(
    "r25_visits",
    "customer_name ASC NULLS FIRST, completed_on ASC NULLS FIRST",
    "job_id job_number customer_name location_name city job_type year completed_on",
)
PLAIN_SQL["m1_upsert_stream"] = PLAIN_SQL["m1_upsert"]


def operator_oracles() -> dict[str, str]:
    return {**{n: on_domain(body) for n, body in DOMAIN_SQL.items()}, **PLAIN_SQL}
