"""Data-quality checks and the documented helper queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldledger.functions import dates, text
from fieldledger.operators.joins import attach_groups, chain, lookup
from fieldledger.operators.latest import newest
from fieldledger.plans.next_service import (
    MAIN_HOOD_PREFIX,
    PRIMARY_PREFIX,
    active_recurrences,
    at_active_sites,
    services_of,
)
from fieldledger.plans.report import report

C = F.col


@report(
    "primary_hood_duplicates",
    "Places with more than one active main hood recurrence; expected empty",
    "company_name",
    "location_name",
)
def primary_hood_duplicates(t, s) -> DataFrame:
    keys = ["company_name", "location_name"]
    return repeated(t, MAIN_HOOD_PREFIX, keys, "active_primary_hood_count").groupBy(*keys).agg(
        F.first("active_primary_hood_count").alias("active_primary_hood_count"),
        listed("CAST(id AS STRING)").alias("recurrence_ids"),
        listed("price_text").alias("prices"),
    )


def repeated(t, prefix: str, keys: list[str], count: str) -> DataFrame:
    """Active recurrences that share their keys with another one; one row each.

    Counting comes first and collapses on the map side, so unique recurrences,
    nearly all of them, never travel to be listed.
    """
    sites = at_active_sites(active_recurrences(t, prefix), t).select(
        "id", text.number_text(C("estimated_price")).alias("price_text"), "company_name", "location_name", "description"
    )
    sizes = sites.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).where(C(count) > 1)
    return attach_groups(sites, sizes, keys, "id")


def listed(value: str):
    """Comma-joined texts by ``id``, NULLs left out. The text is one value by
    definition; ``duplicates_by_description`` gives the same rows unjoined."""
    return F.expr(f"listagg({value}, ',') WITHIN GROUP (ORDER BY id)")


def duplicates_by_description(t) -> DataFrame:
    """Same check for any primary description, one row per recurrence involved."""
    keys = ["company_name", "location_name", "description"]
    return repeated(t, PRIMARY_PREFIX, keys, "copies").select(C("id").alias("recurrence_id"), *keys, "copies")


def services_per_recurrence(t) -> DataFrame:
    """Services that ever pointed at an active recurrence or a retired version of it."""
    active = t["service_recurrence"].where(C("id") == C("current_service_recurrence_id"))
    links = chain(t["service_recurrence"], active)
    requests = t["service_request"].select(C("id").alias("service_id"), "service_recurrence_id", "job_id", "status")
    return requests.join(links, requests["service_recurrence_id"] == links["version_id"]).select(
        C("active_id").alias("recurrence_id"), "service_id", "service_recurrence_id", "job_id", "status"
    )


def last_open_visit(t) -> DataFrame:
    """Per primary recurrence: the last service that was not canceled."""
    kept = services_of(t, active_recurrences(t, PRIMARY_PREFIX)).where(C("service_status") != "canceled")
    return newest(
        kept.withColumnRenamed("active_id", "recurrence_id"),
        ["recurrence_id"],
        [C("visit_ts"), C("request_id")],
        ["request_id", "service_status", "job_status", "visit_ts"],
    )


def last_closed_visit(t) -> DataFrame:
    closed = services_of(t, active_recurrences(t, PRIMARY_PREFIX)).where(C("service_status") == "closed")
    return closed.groupBy(C("active_id").alias("recurrence_id")).agg(F.max("visit_ts").alias("last_closed_ts"))


def freshness(status: DataFrame) -> DataFrame:
    return status.select("resource", "last_synced_at_dt", "record_count")


def stale_resources(status: DataFrame, lag_seconds: int = dates.DAY) -> DataFrame:
    """Resources whose mark lags the newest one by more than the limit."""
    newest_mark = status.agg(F.max("last_synced_at")).scalar()
    return (
        status.select("resource", "last_synced_at", (newest_mark - C("last_synced_at")).alias("behind_seconds"))
        .where(C("behind_seconds") > lag_seconds)
    )


def fully_canceled_jobs(t) -> DataFrame:
    """Jobs none of whose appointments is alive."""
    gone = C("status").startswith("canceled")
    return (
        t["appointment"]
        .where(C("job_id").isNotNull())
        .groupBy("job_id")
        .agg(F.count(F.lit(1)).alias("appointments"), F.count_if(gone).alias("canceled"))
        .where(C("appointments") == C("canceled"))
        .select("job_id", "appointments")
    )


def job_date_agreement(t) -> DataFrame:
    """How often the job date equals the start of its latest live appointment."""
    live = (
        t["appointment"]
        .where(C("job_id").isNotNull())
        .groupBy(C("job_id").alias("id"))
        .agg(F.max(F.when(~C("status").startswith("canceled"), C("window_start"))).alias("start"))
    )
    both = lookup(t["job"].select("id", "scheduled_date"), live, "id", {"start": "start"})
    same = F.count_if(C("scheduled_date") == C("start"))
    return both.agg(
        F.count(F.lit(1)).alias("jobs"),
        same.alias("agreeing"),
        F.round(F.try_divide(100.0 * same, F.count(F.lit(1))), 2).alias("agree_pct"),
    )


def retired_pointers(t) -> DataFrame:
    """Share of primary services that point at a retired version."""
    versions = t["service_recurrence"].where(text.has_prefix(C("description"), PRIMARY_PREFIX))
    pointed = lookup(
        t["service_request"].select("service_recurrence_id"),
        versions.withColumn("retired", (C("id") != C("current_service_recurrence_id")).cast("int")),
        "service_recurrence_id",
        {"retired": "retired"},
    )
    return pointed.agg(
        F.count(F.lit(1)).alias("services"),
        F.sum("retired").alias("on_retired"),
        F.round(100.0 * F.avg("retired"), 2).alias("retired_pct"),
    )


def closed_on_open_job(t) -> DataFrame:
    """Services closed in the field while their job is unfinished."""
    closed = t["service_request"].where(C("status") == "closed")
    return (
        lookup(
            closed.select(C("id").alias("service_id"), "job_id"),
            t["job"].where(C("status") != "completed"),
            "job_id",
            {"status": "job_status", "scheduled_date": "scheduled_date"},
        )
        .select("service_id", "job_id", "job_status", "scheduled_date")
    )


def failed_loads(log: DataFrame) -> DataFrame:
    return log.where(C("status") == "failed").select("id", "resource", "started_at", "error_message")


def latest_loads(log: DataFrame, n: int = 20) -> DataFrame:
    """The last n log rows by start; a sort with a limit keeps n rows per task."""
    return log.orderBy(C("started_at").desc(), C("id").desc()).limit(n)


def run_summary(log: DataFrame) -> DataFrame:
    """Fetched, upserted and failures per resource."""
    return log.groupBy("resource").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("records_fetched").alias("fetched"),
        F.sum("records_upserted").alias("upserted"),
        F.count_if(C("status") == "failed").alias("failed"),
    )
