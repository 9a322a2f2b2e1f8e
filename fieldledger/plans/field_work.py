"""Jobs, appointments, assets, findings and recurring services."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldledger.functions import dates
from fieldledger.operators.joins import lookup, without
from fieldledger.operators.latest import newest
from fieldledger.plans.billing import cents, count_where
from fieldledger.plans.report import report

C = F.col

# Order of severities in the finding lists, and interval texts.
SEVERITY_RANK = {"inoperable": 1, "deficient": 2}
INTERVAL_UNITS = {"weekly": "week(s)", "monthly": "month(s)", "yearly": "year(s)", "daily": "day(s)"}


def severity_rank() -> Column:
    rank = F.lit(3)
    for severity, place in SEVERITY_RANK.items():
        rank = F.when(C("severity") == severity, place).otherwise(rank)
    return rank


def not_ended(s) -> Column:
    return C("ends_on").isNull() | (C("ends_on") > s.as_of)


def sites(t, extra: dict[str, str] | None = None, last: DataFrame | None = None, how: str = "left") -> DataFrame:
    """One row per location, with its company and, if given, its ``last_ts``.

    Everything that hangs on a location is put together here, among small
    tables, so that a fact table is shuffled once to meet all of it. The company
    comes last: the result then has a shuffle of its own on the way to the fact,
    which is what lets AQE split a hot location.
    """
    columns = {"id": "id", "company_id": "company_id", "name": "location", "address_city": "city", **(extra or {})}
    places = t["location"].select(*[C(c).alias(n) for c, n in columns.items()])
    if last is not None:
        places = lookup(places, last, "id", {"last_ts": "last_ts"}, how)
    return lookup(places, t["company"], "company_id", {"name": "customer", "status": "customer_status"})


def with_site(df: DataFrame, t, **choice) -> DataFrame:
    """Location and company columns for rows that have a ``location_id``."""
    places = sites(t, **choice)
    return lookup(df, places, "location_id", {c: c for c in places.columns if c != "id"})


def last_per_location(jobs: DataFrame, ts: str) -> DataFrame:
    """Latest ``ts`` per location as ``(id, last_ts)``."""
    known = jobs.where(C("location_id").isNotNull())
    return known.groupBy(C("location_id").alias("id")).agg(F.max(ts).alias("last_ts"))


@report("visits", "Completed jobs of the chosen years", "customer_name", "_sort_completed")
def visits(t, s) -> DataFrame:
    done = t["job"].where((C("status") == "completed") & dates.in_years(C("completed_on"), s.visit_years))
    named = lookup(done, t["company"], "customer_id", {"name": "customer_name"})
    placed = lookup(named, t["location"], "location_id", {"name": "location_name", "address_city": "city"}, "left")
    return placed.select(
        C("id").alias("job_id"),
        C("number").alias("job_number"),
        "customer_name",
        "location_name",
        "city",
        C("type").alias("job_type"),
        dates.year_text(C("completed_on")).alias("year"),
        dates.utc_day(C("completed_on")).alias("completed_on"),
        C("completed_on").alias("_sort_completed"),
    )


@report("appointment_cancellations", "Canceled appointments by customer, place and who canceled", "-cancellation_count")
def appointment_cancellations(t, s) -> DataFrame:
    start = C("window_start")
    # Appointments move once, to their job, and shrink to bare keys; names are looked up for
    # the few groups. Unknown locations then fall into one group.
    canceled = (
        t["appointment"]
        .where(C("status").isin("canceled_by_customer", "canceled_by_vendor"))
        .select("id", "job_id", "location_id", C("status").alias("cancellation_type"), start)
    )
    per_place = (
        lookup(canceled, t["job"], "job_id", {"customer_id": "customer_id"})
        .groupBy("customer_id", "location_id", "cancellation_type")
        .agg(F.count("id").alias("n"), F.min(start).alias("first"), F.max(start).alias("last"))
    )
    placed = lookup(
        per_place,
        t["location"].withColumn("place_id", C("id")),
        "location_id",
        {"place_id": "place_id", "name": "location", "address_city": "city"},
        "left",
    )
    grouped = (
        placed.groupBy("customer_id", "place_id", "location", "city", "cancellation_type")
        .agg(F.sum("n").alias("cancellation_count"), F.min("first").alias("first"), F.max("last").alias("last"))
    )
    return lookup(grouped, t["company"], "customer_id", {"name": "customer"}).select(
        "customer",
        "location",
        "city",
        "cancellation_type",
        "cancellation_count",
        dates.utc_day(C("first")).alias("earliest"),
        dates.utc_day(C("last")).alias("most_recent"),
    )


@report("asset_inventory", "Active equipment by place, service line and type", "customer", "location", "service_line", "asset_type")
def asset_inventory(t, s) -> DataFrame:
    active = t["asset"].where((C("status") == "active") & (C("is_abstract_group") == 0))
    lined = lookup(active, t["service_line"], "service_line_id", {"name": "service_line"}, "left")
    grouped = lined.groupBy("location_id", "service_line", C("display").alias("asset_type")).agg(
        F.min("name").alias("asset_name"), F.count("id").alias("asset_count")
    )
    return with_site(grouped, t).select(
        "customer",
        "location",
        "city",
        "service_line",
        "asset_type",
        "asset_name",
        F.lit("active").alias("asset_status"),
        "asset_count",
    )


def unresolved(t) -> DataFrame:
    return t["deficiency"].where(~C("status").isin("fixed", "invalid"))


@report("assets_with_deficiencies", "Unresolved findings with their equipment", "_sort_severity", "-days_open")
def assets_with_deficiencies(t, s) -> DataFrame:
    on_asset = lookup(unresolved(t), t["asset"], "asset_id", {"display": "asset_type", "name": "asset_name"})
    return with_site(on_asset, t).select(
        "customer",
        "location",
        "city",
        "asset_type",
        "asset_name",
        "severity",
        C("title").alias("deficiency_title"),
        C("status").alias("deficiency_status"),
        "resolution",
        dates.utc_day(C("reported_on")).alias("reported_on"),
        dates.whole_days(s.now - C("reported_on")).alias("days_open"),
        severity_rank().alias("_sort_severity"),
    )


@report("open_deficiencies", "Unresolved findings with days open", "_sort_severity", "-days_open")
def open_deficiencies(t, s) -> DataFrame:
    return with_site(unresolved(t), t).select(
        "customer",
        "location",
        "city",
        "severity",
        "title",
        C("status").alias("deficiency_status"),
        "resolution",
        dates.utc_day(C("reported_on")).alias("reported_on"),
        dates.whole_days(s.now - C("reported_on")).alias("days_open"),
        "description",
        severity_rank().alias("_sort_severity"),
    )


@report(
    "deficiency_severity_by_customer",
    "Findings per customer by severity and state",
    "-inoperable",
    "-deficient",
    "-total_deficiencies",
)
def deficiency_severity_by_customer(t, s) -> DataFrame:
    severity, status = C("severity"), C("status")
    names = ["total_deficiencies", "inoperable", "deficient", "suggested", "still_open", "fixed"]
    per_place = (
        t["deficiency"]
        .groupBy("location_id")
        .agg(
            F.count("id").alias("total_deficiencies"),
            *[count_where(severity == name).alias(name) for name in names[1:4]],
            count_where(~status.isin("fixed", "invalid")).alias("still_open"),
            count_where(status == "fixed").alias("fixed"),
        )
    )
    per_customer = (
        lookup(per_place, t["location"], "location_id", {"company_id": "company_id"})
        .groupBy("company_id")
        .agg(*[F.sum(n).alias(n) for n in names])
    )
    return lookup(per_customer, t["company"], "company_id", {"name": "customer"}).select("customer", *names)


@report("compliance_overdue", "Recurrences whose last visit is older than their cadence", "-days_overdue")
def compliance_overdue(t, s) -> DataFrame:
    jobs = t["job"].where((C("status") == "completed") & (C("completed_on") > s.completed_since))
    places = sites(t, last=last_per_location(jobs, "completed_on"), how="inner")
    columns = {c: c for c in ("customer", "location", "last_ts")}
    due = lookup(t["service_recurrence"].where(not_ended(s)), places, "location_id", columns)
    return (
        due.select(
            "customer",
            "location",
            "frequency",
            "interval",
            dates.cadence_days(C("frequency"), C("interval")).alias("interval_days"),
            dates.utc_day(C("last_ts")).alias("last_completed"),
            dates.whole_days(s.now - C("last_ts")).alias("days_since_service"),
        )
        .where(C("days_since_service") > C("interval_days"))
        .withColumn("days_overdue", C("days_since_service") - C("interval_days"))
    )


@report("customer_churn_risk", "Customers with past jobs and nothing this year", "-last_completed_job")
def customer_churn_risk(t, s) -> DataFrame:
    # Join and anti join answered by one pass over the jobs.
    done = C("completed_on")
    was_past = (C("status") == "completed") & dates.in_years(done, s.churn_past)
    is_current = C("status").isin("completed", "scheduled", "new") & dates.in_years(
        F.coalesce(done, C("scheduled_date")), s.churn_current
    )
    per_customer = (
        t["job"]
        .where(was_past | is_current)
        .groupBy("customer_id")
        .agg(
            F.count_if(was_past).alias("past_jobs"),
            F.count_if(is_current).alias("current_jobs"),
            F.max(F.when(was_past, done)).alias("last"),
        )
        .where((C("past_jobs") > 0) & (C("current_jobs") == 0))
    )
    customers = t["company"].where(C("is_customer") == 1)
    named = lookup(per_customer, customers, "customer_id", {"name": "customer", "status": "customer_status"})
    years = "_".join(str(y) for y in s.churn_past)
    return named.select(
        "customer",
        "customer_status",
        dates.utc_day(C("last")).alias("last_completed_job"),
        C("past_jobs").alias(f"jobs_{years}"),
    )


@report("locations_no_recurrence", "Active places without a live recurrence", "customer", "location")
def locations_no_recurrence(t, s) -> DataFrame:
    bare = without(
        t["location"].where(C("status") == "active"),
        t["service_recurrence"].where(not_ended(s)),
        "id",
        "location_id",
    )
    customers = t["company"].where((C("is_customer") == 1) & (C("status") == "active"))
    owned = lookup(bare, customers, "company_id", {"name": "customer", "status": "customer_status"})
    last = last_per_location(t["job"].where(C("status") == "completed"), "completed_on")
    return lookup(owned, last, "id", {"last_ts": "last_ts"}, "left").select(
        "customer",
        "customer_status",
        C("name").alias("location"),
        C("address_city").alias("city"),
        C("address_state").alias("state"),
        C("status").alias("location_status"),
        dates.utc_day(C("last_ts")).alias("last_service_date"),
    )


@report("locations_on_hold_with_recurrence", "Paused places that still have live recurrences", "customer", "location")
def locations_on_hold_with_recurrence(t, s) -> DataFrame:
    per_place = (
        t["service_recurrence"]
        .where(not_ended(s) & C("location_id").isNotNull())
        .groupBy("location_id")
        .agg(
            F.count("id").alias("active_recurrences"),
            F.min(F.concat("frequency", F.lit(" / every "), C("interval").cast("string"))).alias("sample_schedule"),
            F.max("first_start").alias("latest"),
        )
    )
    placed = with_site(per_place, t, extra={"status": "location_status"})
    return placed.where(
        C("location_status").isin("on_hold", "inactive") | C("customer_status").isin("on_hold", "inactive")
    ).select(
        "customer",
        "customer_status",
        "location",
        "city",
        "location_status",
        "active_recurrences",
        "sample_schedule",
        dates.utc_day(C("latest")).alias("latest_recurrence_start"),
    )


def latest_recurrence_of_line(t, abbr: str) -> DataFrame:
    """Newest recurrence per place within a service line; ``id`` is the place."""
    line = t["service_line"].where(C("abbr") == abbr)
    of_line = lookup(t["service_recurrence"], line, "service_line_id", {"abbr": "abbr"})
    top = newest(
        of_line.where(C("location_id").isNotNull()),
        ["location_id"],
        [C("created_at"), C("id")],
        ["frequency", "interval", "frequency_category"],
    )
    return top.withColumnRenamed("location_id", "id")


def interval_text() -> Column:
    text = C("frequency_category")
    for frequency, unit in INTERVAL_UNITS.items():
        named = F.concat(F.lit("Every "), C("interval").cast("string"), F.lit(f" {unit}"))
        text = F.when(C("frequency") == frequency, named).otherwise(text)
    return text


@report("active_locations_cleaning", "Active places with last and next cleaning and their interval", "location_name")
def active_locations_cleaning(t, s) -> DataFrame:
    at, status = C("scheduled_date"), C("status")
    cleanings = (
        t["job"]
        .where((C("type") == "cleaning") & C("location_id").isNotNull())
        .groupBy(C("location_id").alias("id"))
        .agg(
            F.max(F.when(status == "completed", at)).alias("last_ts"),
            F.min(F.when((at > s.as_of) & (status != "canceled"), at)).alias("next_ts"),
        )
    )
    places = lookup(t["location"].where(C("status") == "active"), t["company"], "company_id", {"name": "company_name"})
    cleaned = lookup(places, cleanings, "id", {"last_ts": "last_ts", "next_ts": "next_ts"}, "left")
    columns = {c: c for c in ("frequency", "interval", "frequency_category")}
    return lookup(cleaned, latest_recurrence_of_line(t, "KEC"), "id", columns, "left").select(
        C("name").alias("location_name"),
        "company_name",
        "address_street",
        "address_city",
        "address_state",
        "address_postal",
        dates.utc_day(C("last_ts")).alias("last_cleaning_date"),
        dates.utc_day(C("next_ts")).alias("next_cleaning_date"),
        interval_text().alias("service_interval"),
    )


@report("technician_workload", "Jobs, appointments and hours per active technician", "-completed_jobs")
def technician_workload(t, s) -> DataFrame:
    # Appointments shrink to one row per job, jobs to one row per owner: the
    # two distinct counts of the fanned-out join are plain sums here.
    per_job = (
        t["appointment"]
        .where((C("status") == "completed") & C("job_id").isNotNull())
        .withColumn("hours", (C("window_end") - C("window_start")) / 3600.0)
        .groupBy(C("job_id").alias("id"))
        .agg(F.count("id").alias("visits"), F.sum("hours").alias("hours"), F.count("hours").alias("timed"))
    )
    done = t["job"].where((C("status") == "completed") & C("owner_id").isNotNull())
    per_owner = (
        lookup(done, per_job, "id", {"visits": "visits", "hours": "hours", "timed": "timed"}, "left")
        .groupBy(C("owner_id").alias("id"))
        .agg(
            F.count("id").alias("jobs"),
            F.sum("visits").alias("visits"),
            F.sum("hours").alias("hours"),
            F.sum("timed").alias("timed"),
            F.min("completed_on").alias("first"),
            F.max("completed_on").alias("last"),
        )
    )
    techs = t["user"].where((C("is_tech") == 1) & (C("status") == "active"))
    columns = {c: c for c in ("jobs", "visits", "hours", "timed", "first", "last")}
    return lookup(techs, per_owner, "id", columns, "left").select(
        C("name").alias("technician"),
        "email",
        F.coalesce("jobs", F.lit(0)).cast("bigint").alias("completed_jobs"),
        F.coalesce("visits", F.lit(0)).cast("bigint").alias("total_appointments"),
        dates.utc_day(C("first")).alias("first_job"),
        dates.utc_day(C("last")).alias("last_job"),
        cents(F.try_divide(C("hours"), C("timed")), 1).alias("avg_appointment_hours"),
    )
