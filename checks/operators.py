"""Registered queries for single operators."""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import feeds
from checks.settings import SETTINGS
from fieldledger import schema
from fieldledger.functions import dates, text
from fieldledger.operators import merge, normalize, profile, provenance, rules
from fieldledger.operators.mixed_order import mixed_rank
from fieldledger.operators.rules import Field
from fieldledger.plans import billing, catalog, field_work, quality  # noqa: F401  (fill the report list)
from fieldledger.plans.report import REPORTS
from fieldledger.session import work_dir
from fieldledger.sources import pages
from fieldledger.sources.adapter import AS_OF, domain_tables
from fieldledger.sources.store import TableStore
from fieldledger.streaming import load

C = F.col
OPERATORS: dict = {}

EVENT_LAYOUT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
        T.StructField("updated_at", T.LongType()),
    ]
)
ARRIVALS = 4


def operator(build):
    OPERATORS[build.__name__] = build
    return build


def on_tables(build):
    """Registers a query that only needs the domain tables."""
    OPERATORS[build.__name__] = lambda spark, sf_dir: build(domain_tables(spark, sf_dir))
    return build


# Scans and sources -----------------------------------------------------------


@operator
def s1_extract_records(spark, sf_dir):
    found = pages.records(feeds.company_pages(spark, sf_dir), "company")
    record = C("record")
    return found.select(
        "page", C("pos").cast("bigint").alias("pos"), normalize.integer(record, "id").alias("id"), normalize.raw_text(record, "name").alias("name")
    )


@operator
def s2_page_union(spark, sf_dir):
    found = pages.records(feeds.invoice_pages(spark, sf_dir), "invoice")
    number = normalize.integer(C("record"), "id")
    return found.groupBy("page").agg(
        F.count(F.lit(1)).alias("records"), F.min(number).alias("first_id"), F.max(number).alias("last_id")
    )


@operator
def s3_sideload_scan(spark, sf_dir):
    side = pages.section(feeds.recurrence_pages(spark, sf_dir), "serviceRequests")
    record = C("record")
    return side.select(
        normalize.integer(record, "id").alias("id"),
        normalize.integer(record, "serviceRecurrence").alias("recurrence_id"),
        normalize.integer(record, "windowStart").alias("window_start"),
    )


@operator
def s3_side_sections(spark, sf_dir):
    side = pages.side_sections(feeds.recurrence_pages(spark, sf_dir), "servicerecurrence")
    return side.groupBy("section").agg(F.count(F.lit(1)).alias("records"))


@on_tables
def s5_incremental_read(t):
    return load.incremental(t["invoice"].select("id", "status", "updated_at"), AS_OF - 365 * dates.DAY)


@operator
def s6_default_floor(spark, sf_dir):
    """The first read of a feed that never was loaded starts at its floor: jobs stand in for updates around it."""
    floor = load.Loader(TableStore(spark, work_dir(spark, "floor"), 8)).since("service_recurrence")
    job = domain_tables(spark, sf_dir)["job"].select("id", (C("scheduled_date") + C("id") % 2 * 86400).alias("updated_at"))
    return load.incremental(job, floor)


@operator
def s8_load_feed(spark, sf_dir):
    """Invoice pages through rules and upsert into stored tables; the embedded items are read back."""
    return loaded(spark, sf_dir).store.read("invoice_item").select(
        "invoice_id", "id", "description", "quantity", "price", "subtotal", "service_line_id"
    )


@operator
def s1_repeated_keys(spark, sf_dir):
    """Records that repeat a key give all their values, the last one of the key; a page that was cut off gives none."""
    record = C("record")
    found = pages.records(feeds.poisoned_company_pages(spark, sf_dir), "company")
    return found.select("page", normalize.integer(record, "id").alias("id"), normalize.raw_text(record, "name").alias("name"))


@operator
def s2_stream_pull(spark, sf_dir):
    """A pull whose last page lands later, and a whole one of the odd companies: counts after either landing."""
    base = work_dir(spark, "pulls")
    landed, odd = feeds.company_pulls(spark, sf_dir)
    last = F.get_json_object("body", "$.data.page") == F.get_json_object("body", "$.data.totalPages")
    odd = odd.withColumn("pull", F.lit("2"))
    first = landed.withColumn("pull", F.lit("1"))
    loader = load.Loader(TableStore(spark, f"{base}/store", 8), clock=lambda: AS_OF)
    moments = []
    for moment, arriving in (("first", odd.unionByName(first.where(~last))), ("second", first.where(last))):
        feeds.land(arriving, f"{base}/landing")
        loader.stream("company", f"{base}/landing", f"{base}/checkpoint", files_per_batch=1000)
        counts = [(moment, n, loader.store.count(n)) for n in ("company", "sync_status")]
        moments.append(spark.createDataFrame(counts, "moment string, name string, records long"))
    return reduce(DataFrame.unionByName, moments)


def poisoned(spark, sf_dir) -> load.Loader:
    plan = [Field("name"), Field("created", "created_at", "timestamp")]
    loader = load.Loader(TableStore(spark, work_dir(spark, "poisoned"), 8), clock=lambda: AS_OF, plans={"company": plan})
    loader.load("company", feeds.poisoned_company_pages(spark, sf_dir))
    return loader


@operator
def m5_typed_rejects(spark, sf_dir):
    """Values that do not fit their column, as a load put them aside; their records are loaded without them."""
    loader = poisoned(spark, sf_dir)
    lost = loader.rejects().where(C("field").isNotNull()).select("id", "field", "raw", "reason")
    return lost.join(loader.store.read("company").select("id", "created_at"), "id")


@operator
def m5_dead_letter(spark, sf_dir):
    """Fetched, upserted and rejected of a load with a page that was cut off and records without id; it moves no mark."""
    loader = poisoned(spark, sf_dir)
    log = loader.store.read("sync_log").select(
        F.explode(F.create_map(F.lit("fetched"), "records_fetched", F.lit("upserted"), "records_upserted", F.lit(status_key), (C("status") == "partial").cast("long")))
    )
    turned = loader.rejects().where(C("field").isNull()).groupBy(C("reason").alias("key")).agg(F.count(F.lit(1)).alias("value"))
    marks = loader.row_counts(["sync_status"]).select(F.lit("marks").alias("key"), C("records").alias("value"))
    return log.unionByName(turned).unionByName(marks).select(C("key").alias("what"), C("value").alias("records"))


status_key = "partial runs"


@operator
def s12_reset(spark, sf_dir):
    loader = loaded(spark, sf_dir)
    before = stored_counts(loader, "before")
    loader.reset("invoice")
    return before.unionByName(stored_counts(loader, "after"))


@operator
def s5_since_mark(spark, sf_dir):
    """Invoices changed after the mark that a load of a year ago left."""
    mark = loaded(spark, sf_dir, AS_OF - 365 * dates.DAY).since("invoice")
    return load.incremental(domain_tables(spark, sf_dir)["invoice"].select("id", "status", "updated_at"), mark)


@operator
def s9_loaded_status(spark, sf_dir):
    return loaded(spark, sf_dir, AS_OF).store.read("sync_status")


@operator
def m9_loaded_summary(spark, sf_dir):
    return quality.run_summary(loaded(spark, sf_dir, AS_OF).store.read("sync_log"))


@operator
def s7_static_feed(spark, sf_dir):
    """Tags are loaded once: what later loads find is left alone unless a full load asks for it."""
    loader = load.Loader(TableStore(spark, work_dir(spark, "static"), 8), clock=count(AS_OF).__next__, plans=SHORT_PLANS)
    moments = []
    for moment, every, full in (("first", 2, False), ("again", 1, False), ("full", 1, True)):
        run = loader.load("tag", feeds.tag_pages(spark, sf_dir, every), full)[0]
        moments.append((moment, run.status, run.fetched, loader.store.count("tag")))
    return spark.createDataFrame(moments, "moment string, status string, fetched long, records long")


SHORT_PLANS = {
    "tag": [Field("name")],
    "company": [Field("name"), Field("status")],
    "quote": [Field("name"), Field("subtotal", type="real")],
}


@operator
def m8_load_order(spark, sf_dir):
    """Feeds named in any order: the static one first, then the core list, and last a feed that has no table."""
    loader = load.Loader(TableStore(spark, work_dir(spark, "order"), 8), clock=count(AS_OF).__next__, plans=SHORT_PLANS)
    company, quote = feeds.company_pages(spark, sf_dir), feeds.quote_pages(spark, sf_dir)
    loader.load_all({"servicerequestitem": quote, "quote": quote, "company": company, "tag": feeds.tag_pages(spark, sf_dir)})
    place = (C("started_at") - AS_OF).alias("place")
    return loader.store.read("sync_log").select(place, "resource", "status", "records_fetched", "error_message")


@operator
def m6_missing_ids(spark, sf_dir):
    """Records without id are put aside by each load that meets them and never become rows, however often they come."""
    plan = {"company": [Field("name")]}
    loader = load.Loader(TableStore(spark, work_dir(spark, "missing"), 8), clock=count(AS_OF, 10).__next__, plans=plan)
    for _ in range(2):
        loader.load("company", feeds.poisoned_company_pages(spark, sf_dir))
    turned = loader.rejects().where(C("reason") == "no id").groupBy(C("run").alias("what")).agg(F.count(F.lit(1)).alias("records"))
    return turned.unionByName(loader.row_counts(["company"]).withColumnRenamed("name", "what"))


def history(spark, sf_dir) -> load.Loader:
    """Quotes and a feed without table three days ago; today companies without their last page, an hour later all of them."""
    now = [AS_OF - 3 * dates.DAY]
    loader = load.Loader(TableStore(spark, work_dir(spark, "history"), 8), clock=lambda: now[0], plans=SHORT_PLANS)
    quote, company = feeds.quote_pages(spark, sf_dir), feeds.company_pulls(spark, sf_dir)[0]
    loader.load_all({"quote": quote, "servicerequestitem": quote})
    for at, arriving in ((AS_OF, feeds.without_last_page(company)), (AS_OF + 3600, company)):
        now[0] = at
        loader.load("company", arriving)
    return loader


@operator
def m9_loaded_outcomes(spark, sf_dir):
    return quality.run_summary(history(spark, sf_dir).store.read("sync_log"))


@operator
def x10_loaded_failures(spark, sf_dir):
    return quality.failed_loads(history(spark, sf_dir).store.read("sync_log")).drop("id")


@operator
def x4_loaded_stale(spark, sf_dir):
    """Marks far behind the newest one, beside the freshness of every resource."""
    status = history(spark, sf_dir).store.read("sync_status")
    return quality.freshness(status).join(quality.stale_resources(status), "resource", "left")


def saved_views(spark, sf_dir) -> catalog.ReportCatalog:
    """A catalogue over views that another one saved: two of them read views with later names."""
    domain_tables(spark, sf_dir)["job"].createOrReplaceTempView("job")
    folder = work_dir(spark, "saved")
    other = catalog.ReportCatalog(spark, folder)
    other.save("report_zz_open", "Jobs under way", "SELECT id, status, customer_id FROM job WHERE status <> 'completed'")
    other.save("report_mm_new", "New jobs", "SELECT id, customer_id FROM report_zz_open WHERE status = 'new' -- report_aa_count")
    other.save("report_aa_count", "New jobs by customer", "SELECT customer_id, count(*) AS jobs FROM report_mm_new GROUP BY customer_id")
    for name in ("report_zz_open", "report_mm_new", "report_aa_count"):
        spark.catalog.dropTempView(name)
    return catalog.ReportCatalog(spark, folder)


@operator
def s17_dependent_views(spark, sf_dir):
    """Views that build on each other, brought back whatever their names."""
    views = saved_views(spark, sf_dir)
    done, errors = views.restore()
    if done != ["report_zz_open", "report_mm_new", "report_aa_count"] or errors:
        raise RuntimeError(f"{done} {errors}")
    return spark.table("report_aa_count")


@operator
def s15_list_views(spark, sf_dir):
    """Names and texts that another session saved, with how often each status of a job is in a view."""
    listed = saved_views(spark, sf_dir).listing().where(C("created_at").isNotNull())
    spoken = domain_tables(spark, sf_dir)["job"].groupBy("status").agg(F.count(F.lit(1)).alias("jobs"))
    return listed.join(spoken, F.contains("sql", F.concat(F.lit("'"), "status", F.lit("'")))).select("name", "description", "status", "jobs")


@operator
def s16_drop_view(spark, sf_dir):
    """What is left of saved views after one is dropped that this session never registered."""
    views = saved_views(spark, sf_dir)
    if not views.drop("report_mm_new"):
        raise RuntimeError("a saved view was not found")
    jobs = domain_tables(spark, sf_dir)["job"].agg(F.count(F.lit(1)).alias("jobs"))
    left = views.listing().where(C("created_at").isNotNull()).select("name")
    return left.join(F.broadcast(jobs).withColumn("name", F.lit("report_zz_open")), "name", "left")


def placed(spark, sf_dir, name):
    return REPORTS[name].positioned(domain_tables(spark, sf_dir), SETTINGS)


@operator
def o1_quote_positions(spark, sf_dir):
    return placed(spark, sf_dir, "quote_acceptance")


@operator
def o2_deficiency_positions(spark, sf_dir):
    return placed(spark, sf_dir, "open_deficiencies")


@operator
def o3_visit_positions(spark, sf_dir):
    return placed(spark, sf_dir, "visits")


@operator
def s17_restored_view(spark, sf_dir):
    """A view saved by one catalogue and brought back by another one over the same folder."""
    domain_tables(spark, sf_dir)["job"].createOrReplaceTempView("job")
    folder, name = work_dir(spark, "views"), "report_started_jobs"
    catalog.ReportCatalog(spark, folder).save(name, "Jobs under way", "SELECT id, status, customer_id FROM job WHERE status <> 'completed'")
    spark.catalog.dropTempView(name)
    done, errors = catalog.ReportCatalog(spark, folder).restore()
    if done != [name]:
        raise RuntimeError(errors)
    return spark.table(name)


def loaded(spark, sf_dir, at: int | None = None) -> load.Loader:
    store = TableStore(spark, work_dir(spark, "load"), 8)
    loader = load.Loader(store) if at is None else load.Loader(store, clock=lambda: at)
    failed = [r.error for r in loader.load("invoice", feeds.invoice_pages(spark, sf_dir)) if r.error]
    if failed:
        raise RuntimeError(failed[0])
    return loader


def stored_counts(loader, moment: str) -> DataFrame:
    counts = loader.row_counts(["invoice", "invoice_item", "sync_status"])
    return counts.select(F.lit(moment).alias("moment"), "name", "records")


@on_tables
def s9_sync_status(t):
    return sync_status(t)


def sync_status(t) -> DataFrame:
    log = t["sync_log"]
    counts = log.groupBy("resource").agg(F.sum("records_upserted").alias("record_count"))
    return load.status_from_log(log, counts)


@on_tables
def s10_sync_log(t):
    shown = ("started_at_dt", "finished_at_dt")
    filled = {c: dates.clock_text(C(c.removesuffix("_dt"))) for c in shown}
    return t["sync_log"].withColumns(filled)


@operator
def s11_row_counts(spark, sf_dir):
    """Rows of stored tables, -1 of those that no load has made."""
    return loaded(spark, sf_dir).row_counts(["invoice", "invoice_item", "sync_log", "quote", "region"])


@operator
def s13_bounded_query(spark, sf_dir):
    domain_tables(spark, sf_dir)["job"].createOrReplaceTempView("job")
    return catalog.bounded_query(spark, "SELECT id, status, estimated_price FROM job ORDER BY estimated_price DESC, id;")


@operator
def s13_cut_query(spark, sf_dir):
    """A bounded query that says whether rows are missing."""
    domain_tables(spark, sf_dir)["invoice"].createOrReplaceTempView("invoice")
    return catalog.bounded_query(spark, "SELECT id, status FROM invoice ORDER BY id DESC", marked=True)


@on_tables
def s18_timestamp_view(t):
    rows = catalog.timestamp_view(t["appointment"], "appointment")
    return rows.select("id", "job_id", "window_start", "window_start_dt", "window_end_dt", "due_by_dt")


@on_tables
def s19_freshness(t):
    return quality.freshness(sync_status(t))


# Normalising -----------------------------------------------------------------


def company_records(spark, sf_dir):
    return pages.records(feeds.company_pages(spark, sf_dir), "company")


def planned(records: DataFrame, feed: str) -> list[Field]:
    return rules.resource_plan(profile.profiles_of(profile.nested_keys(records)), feed)


@operator
def p15_schema_filter(spark, sf_dir):
    records = company_records(spark, sf_dir)
    return normalize.to_table(records, planned(records, "company"), "company")


@operator
def p3_flatten(spark, sf_dir):
    return normalize.normalize(company_records(spark, sf_dir), [Field("address", spread=rules.ADDRESS_COLUMNS)])


@operator
def p4_extract_key(spark, sf_dir):
    records = pages.records(feeds.invoice_pages(spark, sf_dir), "invoice")
    plan = [Field("customer", key="id", column="customer_id"), Field("job", key="id", column="job_id")]
    return normalize.normalize(records, plan)


@operator
def p6_rename(spark, sf_dir):
    fields = profile.exploded(company_records(spark, sf_dir))
    return fields.groupBy("field").agg(F.count(F.lit(1)).alias("records")).select(
        "field", text.snake_column(C("field")).alias("column_name"), "records"
    )


@operator
def p8_flags(spark, sf_dir):
    plan = [Field("customer", "is_customer", "integer"), Field("vendor", "is_vendor", "integer")]
    return normalize.normalize(company_records(spark, sf_dir), plan)


@operator
def p9_money(spark, sf_dir):
    records = pages.records(feeds.quote_pages(spark, sf_dir), "quote")
    return normalize.normalize(records, [Field("subtotal", type="real"), Field("totalPrice", type="real")])


@operator
def p10_timestamps(spark, sf_dir):
    plan = [Field("created", "created_at", "timestamp")]
    return normalize.normalize(company_records(spark, sf_dir), plan, companions=True)


@operator
def p11_json_text(spark, sf_dir):
    records = pages.records(feeds.quote_pages(spark, sf_dir), "quote")
    return normalize.normalize(records, [Field("visibility", type="text")])


@operator
def p16_children(spark, sf_dir):
    records = pages.records(feeds.invoice_pages(spark, sf_dir), "invoice")
    plan = [
        Field("description"),
        Field("quantity", type="real"),
        Field("subtotal", type="real"),
        Field("serviceLine", "service_line_id", key="id"),
    ]
    return normalize.normalize(normalize.children(records, "invoice_id"), plan, ["invoice_id"])


@operator
def p17_inline_choice(spark, sf_dir):
    records = pages.records(feeds.invoice_pages(spark, sf_dir), "invoice")
    return normalize.embedded_is_complete(records)


@operator
def p17_mixed_children(spark, sf_dir):
    """Items of invoices with embedded and detailed ones: detailed where the feed has the item, else as embedded."""
    records = pages.records(feeds.invoice_pages(spark, sf_dir), "invoice")
    chosen = normalize.choose_children(records, "invoice_id", feeds.invoice_details(spark, sf_dir))
    plan = [Field("description"), Field("quantity", type="real"), Field("subtotal", type="real")]
    return normalize.normalize(chosen, plan, ["invoice_id"])


def due_records(spark, sf_dir):
    landed = feeds.recurrence_pages(spark, sf_dir)
    return normalize.enrich_due(
        pages.records(landed, "servicerecurrence"), pages.section(landed, load.DUE_SECTION)
    )


@operator
def p20_sideload_enrich(spark, sf_dir):
    plan = [Field("currentServiceRecurrence", "current_service_recurrence_id", "integer"), Field("endsOn", type="timestamp")]
    return normalize.normalize(due_records(spark, sf_dir), plan, ["currently_due"])


@operator
def q7_match_ratio(spark, sf_dir):
    return normalize.match_ratio(due_records(spark, sf_dir))


# Profiling -------------------------------------------------------------------


@operator
def q1_field_profile(spark, sf_dir):
    return profile.field_profile(feeds.event_records(spark, sf_dir))


@operator
def q1_profile_in_batches(spark, sf_dir):
    """Profiles of three batches, taken out of order and merged two by two."""
    records = feeds.mixed_records(spark, sf_dir)
    parts = [profile.stored_profile(records.where(C("page") % 3 == k), "event") for k in (2, 0, 1)]
    merged = profile.merged_profile(profile.merged_profile(parts[0].unionByName(parts[1])).unionByName(parts[2]))
    return profile.settled_profile(merged).select("field", "api_type")


@operator
def q2_nested_keys(spark, sf_dir):
    seen = profile.nested_keys(feeds.event_records(spark, sf_dir))
    return seen.where(C("keys").isNotNull()).select("field", "api_type", F.array_join(F.array_sort("keys"), ",").alias("key_list"))


@operator
def q3_child_feed_mode(spark, sf_dir):
    parents = pages.records(feeds.invoice_pages(spark, sf_dir), "invoice")
    return profile.child_feed_mode(parents, feeds.event_records(spark, sf_dir))


@operator
def q3_detail_feed_mode(spark, sf_dir):
    """The other answer: every embedded key is known to the detail feed, which has more."""
    return profile.child_feed_mode(feeds.sparse_invoices(spark, sf_dir), feeds.invoice_details(spark, sf_dir).withColumns({"page": F.lit(1), "pos": C("invoice_id")}))


@operator
def q4_paging_summary(spark, sf_dir):
    return pages.paging_summary(feeds.company_pages(spark, sf_dir))


def field_catalogue(spark, sf_dir):
    seen = profile.nested_keys(feeds.event_records(spark, sf_dir))
    return seen.select(F.explode(F.array(F.lit("event"), F.lit("servicerecurrence"))).alias("feed"), "field", "api_type", "keys")


@operator
def q5_rule_warnings(spark, sf_dir):
    return profile.rule_warnings(field_catalogue(spark, sf_dir))


@operator
def q6_catalogue_stats(spark, sf_dir):
    return profile.catalogue_stats(field_catalogue(spark, sf_dir))


@operator
def p14_rule_provenance(spark, sf_dir):
    """What becomes of every field of five feeds and who says so, with the records that have the field; a skipped feed gives no row."""
    page = pages.records
    landed = {
        "company": company_records(spark, sf_dir),
        "invoice": page(feeds.invoice_pages(spark, sf_dir), "invoice"),
        "quote": page(feeds.quote_pages(spark, sf_dir), "quote"),
        "servicerecurrence": page(feeds.recurrence_pages(spark, sf_dir), "servicerecurrence"),
        "event": feeds.event_records(spark, sf_dir),
    }
    seen = reduce(DataFrame.unionByName, [profile.nested_keys(r).withColumn("feed", F.lit(feed)) for feed, r in landed.items()])
    # one row for each feed and field, the size of table headers, settled from more than one side
    held = spark.createDataFrame(seen.collect(), seen.schema)
    skipped = held.where(C("feed") == "event").withColumn("feed", F.lit("servicerequestitem"))
    counts = [profile.exploded(r).groupBy(F.lit(feed).alias("feed"), "field").agg(F.count(F.lit(1)).alias("records")) for feed, r in landed.items()]
    settled = provenance.settled_rules(held.unionByName(skipped))
    told = settled.join(reduce(DataFrame.unionByName, counts), ["feed", "field"], "left")
    shown = [C("column").alias("column_name"), "column_by", C("type").alias("column_type"), "type_by", C("key").alias("taken_key"), "key_by"]
    return told.select("feed", "field", F.coalesce("records", F.lit(0)).alias("records"), "skip_by", "spread_by", *shown)


# Loading ---------------------------------------------------------------------


def event_rows(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "event_type", "value", "props", dates.epoch_of_ntz(C("ts")).alias("updated_at")
    )


def arrivals(spark, sf_dir) -> list[DataFrame]:
    """Three first deliveries and one that sends a seventh again, twice, without props."""
    rows = event_rows(spark, sf_dir)
    first = [rows.where(C("event_id") % 3 == k).withColumn("pos", F.lit(0)) for k in range(ARRIVALS - 1)]
    again = (
        rows.where(C("event_id") % 7 == 0)
        .withColumn("pos", F.explode(F.array(F.lit(1), F.lit(2))))
        .withColumn("value", C("value") * (C("pos") + 1))
        .drop("props")
    )
    return [*first, again]


@operator
def m1_upsert(spark, sf_dir):
    stored = spark.createDataFrame([], EVENT_LAYOUT)
    for batch in arrivals(spark, sf_dir):
        stored = merge.upsert(stored, schema.fit(merge.last_arrivals(batch, "event_id", [C("pos")]), EVENT_LAYOUT), "event_id")
    return stored


@operator
def m1_upsert_stream(spark, sf_dir):
    base = work_dir(spark, "upsert-stream")
    for number, batch in enumerate(arrivals(spark, sf_dir)):
        layout = T.StructType([*EVENT_LAYOUT.fields, T.StructField("pos", T.IntegerType())])
        schema.fit(batch, layout).write.parquet(f"{base}/landing/arrival={number}")
    store = TableStore(spark, f"{base}/store", 8, {"event": (EVENT_LAYOUT, "event_id")})
    layout = "event_id long, event_type string, value double, props string, updated_at long, pos int, arrival int"
    load.stream_upserts(store, "event", f"{base}/landing", layout, ["arrival", "pos"], f"{base}/checkpoint")
    return store.read("event")


@operator
def m3_upsert_by_updated(spark, sf_dir):
    stored = event_rows(spark, sf_dir)
    shifted = stored.where(C("event_id") % 5 == 0).withColumns(
        {"updated_at": C("updated_at") + F.when(C("event_id") % 2 == 0, 60).otherwise(-60), "value": F.lit(-1.0)}
    )
    return merge.upsert(stored, shifted, "event_id", newer_by="updated_at")


@operator
def m4_deleted_rows(spark, sf_dir):
    stored = event_rows(spark, sf_dir).select("event_id", "event_type")
    return merge.deleted(stored, stored.where(C("event_id") % 9 != 4), "event_id")


@operator
def m5_rejects(spark, sf_dir):
    rows = event_rows(spark, sf_dir).withColumn("event_id", F.when(C("event_id") % 10 != 3, C("event_id")))
    kept = normalize.accepted(rows, "event_id").select("event_type", F.lit(True).alias("kept"))
    lost = normalize.rejects(rows, "event_id").select("event_type", F.lit(False).alias("kept"))
    return kept.unionByName(lost).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("fetched"), F.count_if("kept").alias("upserted"), F.count_if(~C("kept")).alias("rejected")
    )


@on_tables
def m9_run_summary(t):
    return quality.run_summary(t["sync_log"])


# Functions -------------------------------------------------------------------


@on_tables
def d3_calendar_add(t):
    day = dates.utc_date(C("scheduled_date"))
    n = C("id") % 40 - 3
    out = {f"next_{f}": dates.iso(dates.cadence_add(day, F.lit(f), n)) for f in ("daily", "weekly", "monthly", "yearly")}
    return t["job"].select("id", *[v.alias(k) for k, v in out.items()])


@on_tables
def d2_local_date(t):
    at = C("window_start") + (C("id") % 24) * 3600
    local, tz = dates.local_date(at, SETTINGS.tz), SETTINGS.tz
    return t["appointment"].select(
        "id",
        dates.iso(local).alias("day"),
        F.dayofmonth(local).cast("bigint").alias("dom"),
        dates.clock_text(at, tz).alias("clock"),
        dates.day_start_epoch(local).alias("day_epoch"),
        dates.year_month_text(at).alias("utc_month"),
    )


@on_tables
def d7_day_drift(t):
    tz = SETTINGS.tz
    return t["quote"].select(
        "id", dates.days_between(dates.local_date(C("expires_on"), tz), dates.local_date(C("created_at"), tz)).alias("drift")
    )


@on_tables
def d10_whole_days(t):
    return t["invoice"].select(
        "id",
        dates.whole_days(SETTINGS.now - C("due_date") - C("id") % 86400).alias("late_days"),
        dates.cadence_days(F.lit("monthly"), C("id") % 5).alias("cadence"),
    )


@on_tables
def d17_label(t):
    noted = F.when(C("id") % 4 == 0, F.concat(C("description"), F.lit("x"), C("id").cast("string"))).otherwise(C("description"))
    return t["service_recurrence"].select("id", text.label(noted).alias("label"))


@on_tables
def f5_prefix(t):
    changed = F.when(C("id") % 2 == 0, F.upper("description")).otherwise(C("description"))
    return t["service_recurrence"].where(text.has_prefix(changed, "Primary")).select("id")


@on_tables
def j6_chain(t):
    return quality.services_per_recurrence(t)


@on_tables
def w1_latest(t):
    return field_work.latest_recurrence_of_line(t, "KEC").withColumnRenamed("id", "location_id")


@on_tables
def a11_group_concat(t):
    return t["location"].groupBy("address_city").agg(
        F.expr("listagg(CAST(id AS STRING), ',') WITHIN GROUP (ORDER BY id)").alias("ids"),
        F.count(F.lit(1)).alias("places"),
    )


@on_tables
def a2_distinct_counts(t):
    return t["job"].groupBy("owner_id").agg(
        F.count_distinct("customer_id").alias("customers"), F.count_distinct("location_id").alias("places")
    )


@on_tables
def o4_mixed_sort(t):
    number = F.when(C("id") % 3 == 0, C("scheduled_date"))
    as_text = F.when(C("id") % 3 == 1, C("scheduled_date").cast("string"))
    return t["job"].select("id", mixed_rank(number, as_text).cast("bigint").alias("rank"), number.alias("number"), as_text.alias("text"))


@operator
def o7_set_operations(spark, sf_dir):
    tables = domain_tables(spark, sf_dir)
    for name in ("invoice", "quote", "job"):
        tables[name].createOrReplaceTempView(name)
    statement = (
        "SELECT customer_id FROM invoice INTERSECT SELECT customer_id FROM quote"
        " EXCEPT SELECT customer_id FROM job WHERE status = 'new' ORDER BY customer_id"
    )
    return spark.sql(catalog.select_only(spark, statement))


# Documented queries ----------------------------------------------------------


@on_tables
def x2_last_open_visit(t):
    return quality.last_open_visit(t)


@on_tables
def x2_last_closed_visit(t):
    return quality.last_closed_visit(t)


@on_tables
def x3_freshness(t):
    return quality.freshness(sync_status(t)).orderBy("last_synced_at_dt")


@on_tables
def x4_stale_resources(t):
    return quality.stale_resources(sync_status(t))


@on_tables
def x5_fully_canceled_jobs(t):
    return quality.fully_canceled_jobs(t)


@on_tables
def x6_job_date_agreement(t):
    return quality.job_date_agreement(t)


@on_tables
def x7_retired_pointers(t):
    return quality.retired_pointers(t)


@on_tables
def x8_duplicates_by_description(t):
    return quality.duplicates_by_description(shared_descriptions(t))


def shared_descriptions(t):
    """The tables with every third recurrence entered once more under a new id."""
    stored = t["service_recurrence"]
    again = stored.where(C("id") % 3 == 0).withColumns(
        {"id": -C("id"), "current_service_recurrence_id": -C("current_service_recurrence_id")}
    )
    return t.with_table("service_recurrence", stored.unionByName(again))


@on_tables
def x9_closed_on_open_job(t):
    return quality.closed_on_open_job(t)


@on_tables
def x10_failed_loads(t):
    return quality.failed_loads(t["sync_log"])


@on_tables
def x10_latest_loads(t):
    return quality.latest_loads(t["sync_log"]).select("id", "resource", "status", "records_fetched")
