"""JSON feeds derived from the tables, as a service would deliver them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldledger.functions import dates
from fieldledger.sources.adapter import domain_tables

PAGE, SMALL_PAGE = 200, 60
MARK = 946684800


def make_pages(rows: DataFrame, key: str, name: str, size: int, side: dict[str, Column] | None = None) -> DataFrame:
    """Pages of records taken ``size`` keys at a time, for feeds derived from tables.

    A page holds the rows of one key range, so with unique keys its size is
    bounded. ``side`` adds further lists, one element per row where not NULL.
    """
    page_of = lambda k: F.call_function("div", k, F.lit(size))
    fields = F.struct(*[F.col(f"`{c}`") for c in rows.columns if not c.startswith("_")])
    by_key = lambda c: F.transform(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), c.alias("v")))), lambda e: e["v"])
    lists = [by_key(fields).alias(name)]
    for section_name, element in (side or {}).items():
        lists.append(F.filter(by_key(element), lambda e: e.isNotNull()).alias(section_name))
    last = rows.agg(page_of(F.max(key)) + 1).scalar()
    grouped = rows.groupBy(page_of(F.col(key)).alias("page_no")).agg(*lists)
    names = [name, *(side or {})]
    data = F.struct(
        *[F.col(f"`{n}`") for n in names], (F.col("page_no") + 1).alias("page"), F.lit(last).alias("totalPages"), F.lit(size).alias("pageSize")
    )
    meta = F.struct(F.struct(F.lit(60000).alias("resourceBalanceMs")).alias("stats"))
    body = F.to_json(F.struct(data.alias("data"), meta.alias("meta")), {"ignoreNullFields": "false"})
    return grouped.select(F.lit("").alias("pull"), body.alias("body"))


def company_pages(spark, sf_dir: str) -> DataFrame:
    return pages_of_companies(domain_tables(spark, sf_dir)["company"], PAGE)


def company_pulls(spark, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Small pages of all companies, and of the odd ones."""
    c = domain_tables(spark, sf_dir)["company"]
    return pages_of_companies(c, SMALL_PAGE), pages_of_companies(c.where(F.col("id") % 2 == 1), SMALL_PAGE)


def pages_of_companies(c: DataFrame, size: int) -> DataFrame:
    rows = c.select(
        "id",
        F.concat(F.lit("/company/"), F.col("id")).alias("uri"),
        "name",
        "status",
        F.when(F.col("id") % 3 != 0, F.concat(F.lit("R-"), F.col("id"))).alias("refNumber"),
        (F.col("is_customer") == 1).alias("customer"),
        F.when(F.col("id") % 4 != 0, F.col("id") % 2 == 0).alias("vendor"),
        F.when(
            F.col("id") % 5 != 0,
            F.struct(
                F.concat(F.col("id"), F.lit(" Main St")).alias("street"),
                F.lit("Town").alias("city"),
                F.lit("WA").alias("state"),
                F.lpad(F.col("id").cast("string"), 5, "0").alias("postalCode"),
            ),
        ).alias("address"),
        F.concat(F.lit("555-"), F.col("id")).alias("phoneNumber"),
        F.struct((F.col("id") % 7).alias("id"), F.lit("brand").alias("name")).alias("defaultBrand"),
        F.array(F.struct(F.col("id").alias("id"), F.lit("t").alias("name"))).alias("tags"),
        F.lit(None).cast("string").alias("shareId"),
        (F.lit(MARK) + F.col("id") * 3600).alias("created"),
        F.struct(F.col("id").cast("string").alias("books")).alias("externalIds"),
    )
    return make_pages(rows, "id", "companies", size)


def invoice_pages(spark, sf_dir: str) -> DataFrame:
    i = domain_tables(spark, sf_dir)["invoice"]
    items = F.transform(
        F.sequence(F.lit(1), (F.col("id") % 4).cast("int")),
        lambda k: F.struct(
            (F.col("id") * 10 + k).alias("id"),
            F.concat(F.lit("item "), k.cast("string")).alias("description"),
            k.cast("double").alias("quantity"),
            (k * 1.5).cast("double").alias("price"),
            (k * k * 1.5).cast("double").alias("subtotal"),
            F.struct((k % 3).cast("bigint").alias("id")).alias("serviceLine"),
        ),
    )
    rows = i.select(
        "id",
        F.col("invoice_number").alias("invoiceNumber"),
        "type",
        "status",
        F.struct(F.col("customer_id").alias("id")).alias("customer"),
        F.col("job_id").alias("job"),
        F.col("total_price").alias("totalPrice"),
        F.col("total_paid_amount").alias("totalPaidAmount"),
        (F.col("is_paid") == 1).alias("paid"),
        F.col("transaction_date").alias("transactionDate"),
        F.when(F.col("id") % 4 != 0, items).alias("items"),
    )
    return make_pages(rows, "id", "invoices", PAGE)


def quote_pages(spark, sf_dir: str) -> DataFrame:
    q = domain_tables(spark, sf_dir)["quote"]
    amount = (F.col("id") * 12345 % 1000000000 / 100).cast("decimal(12,2)")
    rows = q.select(
        "id",
        "name",
        F.when(F.col("id") % 12 == 0, "n/a").otherwise(F.format_number(amount, 2)).alias("subtotal"),
        F.format_number(amount, 2).alias("totalPrice"),
        F.array(F.lit("tech"), F.concat(F.lit("é"), F.col("id"))).alias("visibility"),
        F.lit(None).cast("bigint").alias("sales"),
    )
    return make_pages(rows, "id", "quotes", PAGE)


def side_record(key: Column) -> Column:
    """Next-due record beside a recurrence: real, projected, for the previous one, or none."""
    start = F.when(key % 11 != 0, F.lit(MARK) + key * dates.DAY)
    none = F.lit(None).cast("bigint")
    return (
        F.when(key % 3 == 1, F.struct((key + 10**9).alias("id"), key.alias("serviceRecurrence"), start.alias("windowStart")))
        .when((key % 3 == 2) & (key % 2 == 1), F.struct((-key).alias("id"), none.alias("serviceRecurrence"), start.alias("windowStart")))
        .when(key % 3 == 2, F.struct((key + 10**9).alias("id"), (key - 1).alias("serviceRecurrence"), start.alias("windowStart")))
    )


def recurrence_pages(spark, sf_dir: str) -> DataFrame:
    r = domain_tables(spark, sf_dir)["service_recurrence"]
    rows = r.select(
        "id",
        "description",
        F.struct(F.col("location_id").alias("id")).alias("location"),
        F.col("current_service_recurrence_id").alias("currentServiceRecurrence"),
        "frequency",
        "interval",
        F.col("ends_on").alias("endsOn"),
    )
    side = {"serviceRequests": side_record(F.col("id"))}
    return make_pages(rows, "id", "serviceRecurrences", PAGE, side)


def event_records(spark, sf_dir: str) -> DataFrame:
    """Events as landed records: their JSON props merged with typed fields."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    body = F.struct(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("eventType"),
        "value",
        F.struct(F.col("user_id").alias("id")).alias("user"),
        F.when(F.col("event_id") % 3 == 0, F.col("event_id") % 2 == 0).alias("isTest"),
        F.array(F.col("event_type")).alias("labels"),
        F.array(F.struct(F.col("event_id").alias("id"), F.lit("p").alias("name"))).alias("parts"),
        F.lit(None).cast("string").alias("sales"),
        F.lit(None).cast("string").alias("dueDate"),
        F.lit(None).cast("string").alias("frequency"),
        F.lit(None).cast("string").alias("duration"),
    )
    text = F.to_json(body, {"ignoreNullFields": "false"})
    return e.select(
        F.lit("").alias("pull"),
        F.floor(F.col("event_id") / PAGE).cast("bigint").alias("page"),
        (F.col("event_id") % PAGE).alias("pos"),
        F.parse_json(text).alias("record"),
    )


def poisoned_company_pages(spark, sf_dir: str) -> DataFrame:
    """Company pages with records without id, dates that are words, keys that come twice, and a second page that was cut off."""
    c = domain_tables(spark, sf_dir)["company"]
    rows = c.select(
        F.when(F.col("id") % 10 != 7, F.col("id")).alias("id"),
        "name",
        F.when(F.col("id") % 10 == 3, F.concat(F.lit("day "), F.col("id"))).otherwise((F.lit(MARK) + F.col("id")).cast("string")).alias("created"),
        F.col("id").alias("_key"),
    )
    pages = make_pages(rows, "_key", "companies", SMALL_PAGE)
    second = F.get_json_object("body", "$.data.page") == "2"
    twice = F.regexp_replace("body", r'"id":(\d*5),', r'"id":-1,"id":$1,')
    return pages.select("pull", F.when(second, F.substring("body", 1, 500)).otherwise(twice).alias("body"))


def land(pages: DataFrame, folder: str) -> None:
    """One text file for each page, pulls in folders ``pull=<id>``."""
    spread = pages.repartition("pull", F.xxhash64("body"))
    # files that lie side by side: a folder for each would have to be made, listed and, one by one, moved by the driver
    in_tasks = spread.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    in_tasks.partitionBy("pull").mode("append").text(folder)


def invoice_details(spark, sf_dir: str) -> DataFrame:
    """A detail feed of invoice items: for two of three invoices, with their second item, and with one that is nowhere embedded."""
    i = domain_tables(spark, sf_dir)["invoice"].where(F.col("id") % 3 != 0)
    each = F.explode(F.array(F.lit(2), F.lit(9))).alias("k")
    item = F.struct((F.col("id") * 10 + F.col("k")).alias("id"), F.lit("detailed").alias("description"), F.lit(7.5).alias("quantity"))
    return i.select("id", each).select(F.col("id").alias("invoice_id"), F.parse_json(F.to_json(item)).alias("record"))


def mixed_records(spark, sf_dir: str) -> DataFrame:
    """A record per event with one field named by its type, whose values are numbers and texts by turns."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    value = F.when(F.col("event_id") % 2 == 0, F.lit('"x"')).otherwise(F.lit("5"))
    text = F.concat(F.lit('{"id":'), F.col("event_id"), F.lit(',"'), F.col("event_type"), F.lit('":'), value, F.lit("}"))
    return e.select(
        F.lit("").alias("pull"),
        F.floor(F.col("event_id") / PAGE).cast("bigint").alias("page"),
        (F.col("event_id") % PAGE).alias("pos"),
        F.parse_json(text).alias("record"),
    )


def tag_pages(spark, sf_dir: str, every: int = 1) -> DataFrame:
    """Tags, one for each asset whose id divides by ``every``."""
    rows = domain_tables(spark, sf_dir)["asset"].where(F.col("id") % every == 0).select("id", "name")
    return make_pages(rows, "id", "tags", PAGE)


def without_last_page(pages: DataFrame) -> DataFrame:
    return pages.where(F.get_json_object("body", "$.data.page") != F.get_json_object("body", "$.data.totalPages"))


def sparse_invoices(spark, sf_dir: str) -> DataFrame:
    """Landed invoices that embed no more than the number and the description of one item."""
    i = domain_tables(spark, sf_dir)["invoice"]
    item = F.struct((F.col("id") * 10 + 1).alias("id"), F.lit("item 1").alias("description"))
    text = F.to_json(F.struct("id", F.array(item).alias("items")))
    return i.select(F.call_function("div", F.col("id"), F.lit(PAGE)).alias("page"), (F.col("id") % PAGE).alias("pos"), F.parse_json(text).alias("record"))
