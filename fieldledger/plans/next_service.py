"""When each recurring hood service is due next, in three report versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldledger.functions import dates, text
from fieldledger.operators.joins import chain, lookup
from fieldledger.operators.latest import newest_where
from fieldledger.operators.mixed_order import mixed_rank
from fieldledger.plans.field_work import last_per_location
from fieldledger.plans.report import report

C = F.col

# Which recurrences count, and the thresholds.
PRIMARY_PREFIX = "Primary"
MAIN_HOOD_PREFIX = "PrimaryxxxxMainHoodxxxxxx"
HOOD_SERVICE_LINE = 10
PARKED_MONTHS = 18
SLIPPED_SECONDS = 7 * dates.DAY

# States of version 2 with their reasons, first match wins.
STATES_V2 = (
    ("parked", "next_due_PT ({due}) is more than 18 months out — parked"),
    ("new", "No job history yet; recurrence first due {due}"),
    ("canceled", "Most recent service ({job}) was canceled"),
    ("scheduled", "Future job booked for {job}, service still open"),
    ("field incompletion", "Past job ({job}) still has open service — tech did not mark closed in field"),
    (
        "pending close *",
        "Service closed on {job} ({days} days ago); job not yet marked completed (>7 day threshold)",
    ),
    ("pending close", "Service closed {job}; job not yet marked completed"),
    ("closed", "Last visit {job} fully closed; awaiting next cadence cycle"),
)

# Row statuses of version 3 with their reasons, first match wins.
STATES_V3 = (
    ("parked", "Next Due {due} > 18m out — parked"),
    ("new (unscheduled)", "No job history and no job scheduled yet. Next Due {due}."),
    ("new (scheduled)", "No job history. First job scheduled for {job}."),
    ("scheduled", "Future job scheduled for {job} (primary service open)"),
    (
        "field incompletion",
        "Past job {job} still has open primary service — tech did not mark closed in field",
    ),
    (
        "pending close *",
        "Primary service for {job} job marked closed ({days}d ago), but job not yet marked complete",
    ),
    (
        "pending close",
        "Primary service for {job} job marked closed ({days}d ago), but job not yet marked complete",
    ),
    ("closed", "Last scheduled job {job} closed; awaiting release of next job"),
)
CANCELED_SINCE = " (a more recent attempt was cancelled)"
UNKNOWN = "unknown"


def active_recurrences(t, prefix: str) -> DataFrame:
    """Current, unretired versions whose description starts with ``prefix``."""
    return t["service_recurrence"].where(
        text.has_prefix(C("description"), prefix)
        & (C("service_line_id") == HOOD_SERVICE_LINE)
        & (C("id") == C("current_service_recurrence_id"))
        & C("ends_on").isNull()
    )


def at_active_sites(df: DataFrame, t, last: DataFrame | None = None) -> DataFrame:
    """Rows at active locations of active companies, with their names.

    ``last`` adds a ``last_ts`` per location. Sites are put together first, so
    the recurrences meet them in a single join.
    """
    places = t["location"].where(C("status") == "active").select("id", "company_id", C("name").alias("location_name"))
    columns = ["location_name", "company_name"]
    if last is not None:
        places = lookup(places, last, "id", {"last_ts": "last_ts"}, "left")
        columns.append("last_ts")
    firms = t["company"].where(C("status") == "active")
    owned = lookup(places, firms, "company_id", {"name": "company_name"})
    return lookup(df, owned, "location_id", {c: c for c in columns})


def services_of(t, active: DataFrame) -> DataFrame:
    """All services of the active recurrences, retired versions included, with their jobs."""
    links = chain(t["service_recurrence"], active)
    requests = t["service_request"].select(
        C("id").alias("request_id"), "service_recurrence_id", "job_id", C("status").alias("service_status")
    )
    linked = requests.join(links, requests["service_recurrence_id"] == links["version_id"]).drop("version_id")
    return lookup(linked, t["job"], "job_id", {"status": "job_status", "scheduled_date": "visit_ts"})


def last_visits(services: DataFrame) -> DataFrame:
    """Per active recurrence: the last visit of each kind, in a single grouping.

    Ties on the visit time go to the larger request id.
    """
    status = C("service_status")
    visit = F.struct("service_status", "job_status", "visit_ts")
    order = [C("visit_ts"), C("request_id")]
    return services.groupBy(C("active_id").alias("id")).agg(
        F.max(F.when(status == "closed", C("visit_ts"))).alias("closed_ts"),
        F.max(F.when(status == "canceled", C("visit_ts"))).alias("canceled_ts"),
        newest_where(F.lit(True), visit, order).alias("any_visit"),
        newest_where(status != "canceled", visit, order).alias("kept_visit"),
    )


def with_history(t, visit: str) -> DataFrame:
    """Active primary recurrences with their last visits; ``visit`` picks which one leads."""
    active = active_recurrences(t, PRIMARY_PREFIX)
    history = last_visits(services_of(t, active)).select(
        "id",
        "closed_ts",
        "canceled_ts",
        C(f"{visit}.service_status").alias("service_status"),
        C(f"{visit}.job_status").alias("job_status"),
        C(f"{visit}.visit_ts").alias("visit_ts"),
    )
    columns = ["closed_ts", "canceled_ts", "service_status", "job_status", "visit_ts"]
    wanted = active.select(
        "id", "location_id", "description", "estimated_price", "frequency", "interval", "currently_due"
    )
    return at_active_sites(lookup(wanted, history, "id", {c: c for c in columns}, "left"), t)


def visit_states(s) -> dict[str, Column]:
    """Conditions shared by both state lists."""
    status, job, at = C("service_status"), C("job_status"), C("visit_ts")
    closed_open_job = (status == "closed") & (job != "completed")
    return {
        "parked": C("currently_due") > dates.shift_months(s.as_of, PARKED_MONTHS),
        "new": at.isNull(),
        "canceled": status == "canceled",
        "new (unscheduled)": C("closed_ts").isNull() & at.isNull(),
        "new (scheduled)": C("closed_ts").isNull() & at.isNotNull(),
        "scheduled": (status == "open") & (at > s.as_of),
        "field incompletion": (status == "open") & (at <= s.as_of),
        "pending close *": closed_open_job & (at < s.as_of - SLIPPED_SECONDS),
        "pending close": closed_open_job,
        "closed": (status == "closed") & (job == "completed"),
    }


def classify(states, s) -> tuple[Column, Column]:
    """State and reason columns of an ordered state list."""
    tests = visit_states(s)
    slots = {
        "due": dates.iso(dates.local_date(C("currently_due"), s.tz)),
        "job": dates.iso(dates.local_date(C("visit_ts"), s.tz)),
        "days": dates.whole_days(s.now - C("visit_ts")),
    }
    state, reason = F.lit(UNKNOWN), F.lit(None).cast("string")
    for name, template in reversed(states):
        state = F.when(tests[name], name).otherwise(state)
        reason = F.when(tests[name], text.fill(template, slots)).otherwise(reason)
    return state, reason


def local_text(column: str, s) -> Column:
    return dates.iso(dates.local_date(C(column), s.tz))


@report(
    "primary_hood_next_service",
    "Main hood services: last visit of the place against the due date",
    "_sort_due",
    "company_name",
    "location_name",
)
def primary_hood_v1(t, s) -> DataFrame:
    last = last_per_location(t["job"].where(C("status") == "completed"), "scheduled_date")
    dated = (
        at_active_sites(active_recurrences(t, MAIN_HOOD_PREFIX), t, last)
        .withColumn("last_day", dates.local_date(C("last_ts"), s.tz))
        .withColumn("due_day", dates.local_date(C("currently_due"), s.tz))
        .withColumn("calc_day", dates.cadence_add(C("last_day"), C("frequency"), C("interval")))
    )
    return dated.select(
        "company_name",
        "location_name",
        C("estimated_price").alias("primary_hood_price"),
        "frequency",
        "interval",
        dates.iso(C("last_day")).alias("last_completed_job_pacific"),
        dates.iso(C("due_day")).alias("next_due_pacific"),
        dates.iso(C("calc_day")).alias("calculated_next_due_pacific"),
        F.dayofmonth("last_day").cast("bigint").alias("last_completed_job_day_of_month"),
        dates.days_between(C("due_day"), C("calc_day")).alias("next_due_vs_calc_due_days"),
        C("currently_due").alias("_sort_due"),
    )


@report(
    "primary_hood_next_service_v2",
    "Every primary recurrence with its history and state",
    "_sort_due",
    "company_name",
    "location_name",
    "_sort_description",
)
def primary_hood_v2(t, s) -> DataFrame:
    state, reason = classify(STATES_V2, s)
    dated = (
        with_history(t, "any_visit")
        .withColumn("due_day", dates.local_date(C("currently_due"), s.tz))
        .withColumn("closed_day", dates.local_date(C("closed_ts"), s.tz))
        .withColumn("calc_day", dates.cadence_add(C("closed_day"), C("frequency"), C("interval")))
    )
    return dated.select(
        "company_name",
        "location_name",
        text.label(C("description")).alias("hood_type"),
        C("estimated_price").alias("primary_hood_price"),
        "frequency",
        "interval",
        dates.iso(C("closed_day")).alias("last_completed_job_PT"),
        local_text("visit_ts", s).alias("last_scheduled_job_PT"),
        C("service_status").alias("last_service_status"),
        C("job_status").alias("last_job_status"),
        dates.iso(C("due_day")).alias("next_due_PT"),
        dates.iso(C("calc_day")).alias("calculated_next_due_PT"),
        dates.days_between(C("due_day"), C("calc_day")).alias("next_due_vs_calc_due_days"),
        state.alias("state"),
        reason.alias("state_reason"),
        C("currently_due").alias("_sort_due"),
        C("description").alias("_sort_description"),
    )


@report(
    "primary_hood_next_service_v3",
    "Every primary recurrence with calculated due date and row status",
    "_sort_rank",
    "_sort_number",
    "_sort_text",
    "Company Name",
    "Location Name",
    "_sort_description",
)
def primary_hood_v3(t, s) -> DataFrame:
    state, reason = classify(STATES_V3, s)
    canceled_since = C("canceled_ts").isNotNull() & (
        C("visit_ts").isNull() | (C("canceled_ts") > C("visit_ts"))
    )
    reason = F.when(
        (state == "closed") & canceled_since, F.concat(reason, F.lit(CANCELED_SINCE))
    ).otherwise(reason)
    dated = (
        with_history(t, "kept_visit")
        .withColumn("anchor_ts", F.coalesce("visit_ts", "closed_ts"))
        .withColumn("due_day", dates.local_date(C("currently_due"), s.tz))
        .withColumn("anchor_day", dates.local_date(C("anchor_ts"), s.tz))
        .withColumn("step_day", dates.cadence_add(C("anchor_day"), C("frequency"), C("interval")))
        .withColumn("_sort_number", F.when(C("anchor_ts").isNull(), C("currently_due")))
        .withColumn("_sort_text", dates.day_start_epoch(C("step_day")).cast("string"))
    )
    calc_day = F.when(C("anchor_ts").isNull(), C("due_day")).otherwise(C("step_day"))
    return dated.select(
        C("company_name").alias("Company Name"),
        C("location_name").alias("Location Name"),
        text.label(C("description")).alias("Primary Type"),
        C("estimated_price").alias("Primary Price"),
        C("frequency").alias("Frequency"),
        C("interval").alias("Interval"),
        local_text("closed_ts", s).alias("Last Compl Job"),
        local_text("visit_ts", s).alias("Last Sched Job"),
        dates.iso(C("due_day")).alias("ST Next Due Date"),
        dates.iso(calc_day).alias("Calc Next Due Date"),
        dates.days_between(C("due_day"), C("step_day")).alias("ST vs Calc Next Due Days Diff"),
        F.dayofmonth(dates.local_date(C("closed_ts"), s.tz)).cast("bigint").alias("Last Compl Job DOM"),
        state.alias("Row Status"),
        reason.alias("Row Status Reason"),
        mixed_rank(C("_sort_number"), C("_sort_text")).alias("_sort_rank"),
        "_sort_number",
        "_sort_text",
        C("description").alias("_sort_description"),
    )
