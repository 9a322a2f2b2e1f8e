"""Landed JSON pages: an envelope with a record list, paging keys and side lists.

A page is text. The record list is found by name or, failing that, as the
first list that is no paging key. Order inside the text decides then, which is
why these keys are read from the text and not from the parsed (sorted) value.
Columns of a page frame: ``pull`` (which download) and ``body``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Keys of an envelope that never hold records.
PAGING_KEYS = ("page", "totalPages", "totalCount", "pageSize")


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of a folder, one file each, pulls in subfolders ``pull=<id>``."""
    return numbered(spark.read.option("recursiveFileLookup", "true").text(folder, wholetext=True))


def stream_pages(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """The same as a stream of newly landed files."""
    source = spark.readStream.option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch)
    return numbered(source.format("text").option("wholetext", "true").load(folder))


def numbered(files: DataFrame) -> DataFrame:
    return files.select(
        F.regexp_extract(F.col("_metadata.file_path"), "pull=([^/]+)", 1).alias("pull"),
        F.col("value").alias("body"),
    )


#: Repeated keys are allowed in JSON: the last one holds. Spark's parser takes this from the session.
REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"


def opened(pages: DataFrame) -> DataFrame:
    """Pages with their payload parsed once: ``(pull, page, body, data)``.

    The payload is the ``data`` member when there is one, else the whole text. A text that is no JSON or
    too large for one value gives a NULL payload; ``landed`` then reads it record by record.
    """
    pages.sparkSession.conf.set(REPEATED_KEYS, "true")
    whole = F.try_parse_json(F.col("body"))
    read = pages.select("pull", "body", F.coalesce(F.try_variant_get(whole, "$.data", "variant"), whole).alias("data"))
    data = F.col("data")
    number = F.coalesce(F.try_variant_get(data, "$.page", "bigint"), F.when(data.isNull(), paging(F.col("body"), "page")))
    return read.select("pull", F.coalesce(number, F.lit(1).cast("bigint")).alias("page"), "body", "data")


TEXTS, LIST = "map<string,string>", "array<string>"


def members(body: Column) -> Column:
    """Members of a payload as JSON texts, in text order, without building values: it may be of any size."""
    top = F.from_json(body, TEXTS)
    return F.coalesce(F.from_json(top["data"], TEXTS), top)


def paging(body: Column, key: str) -> Column:
    return members(body)[key].try_cast("bigint")


def record_texts(body: Column, feed: str) -> Column:
    """Texts of the records of a page: its list, its data list, a named list, or the first other one."""
    own, data = members(body), F.from_json(body, TEXTS)["data"]
    known = [F.from_json(own[name], LIST) for name in candidates(feed)]
    other = F.filter(F.map_entries(own), lambda e: e["value"].startswith("[") & ~e["key"].isin(*PAGING_KEYS))
    return F.coalesce(F.from_json(body, LIST), F.from_json(data, LIST), *known, F.from_json(F.get(other, 0)["value"], LIST))


def landed(pages: DataFrame, feed: str) -> DataFrame:
    """``(pull, page, total_pages, bad, pos, record, text)``: a row per record, or one without ``pos`` for a page without any.

    ``bad`` is the text of a page that is no JSON. A page that is too large for one value is read
    record by record, so that limit holds for a record; one that cannot be read has no ``record`` but its ``text``.
    """
    data, body, whole = F.col("data"), F.col("body"), F.col("data").isNotNull()
    known = [list_of(data, name) for name in candidates(feed)]
    found = F.coalesce(list_of(data), *known, F.get(named_lists(body, data), 0)["items"])
    parsed = F.transform(found, lambda r: F.struct(r.alias("record"), F.lit(None).cast("string").alias("text")))

    def one(text: Column) -> Column:
        record = F.try_parse_json(text)
        return F.struct(record.alias("record"), F.when(record.isNull(), text).alias("text"))

    texts = F.when(~whole, record_texts(body, feed))
    readable = whole | (F.trim("body") == "") | F.from_json(body, TEXTS).isNotNull() | F.from_json(body, LIST).isNotNull()
    total = F.coalesce(F.try_variant_get(data, "$.totalPages", "bigint"), F.when(~whole, paging(body, "totalPages")))
    # what is said of a page is found before it is taken apart, or every record would carry the text and the value of its page
    heads = opened(pages).select(
        "pull",
        "page",
        total.alias("total_pages"),
        F.when(~F.coalesce(readable, F.lit(False)), body).alias("bad"),
        F.when(whole, parsed).otherwise(F.transform(texts, one)).alias("all"),
    )
    rows = heads.select("pull", "page", "total_pages", "bad", F.posexplode_outer("all").alias("pos", "found"))
    return rows.select("pull", "page", "total_pages", "bad", "pos", "found.record", "found.text")


def page_heads(pages: DataFrame) -> DataFrame:
    """``(pull, page, total_pages, readable, body)`` of every page, for keeping those that wait for others."""
    body = F.col("body")
    read = F.col("data").isNotNull() | (F.trim("body") == "") | F.from_json(body, TEXTS).isNotNull() | F.from_json(body, LIST).isNotNull()
    data = F.col("data")
    total = F.coalesce(F.try_variant_get(data, "$.totalPages", "bigint"), F.when(data.isNull(), paging(body, "totalPages")))
    return opened(pages).select(F.coalesce("pull", F.lit("")).alias("pull"), "page", total.alias("total_pages"), F.coalesce(read, F.lit(False)).alias("readable"), "body")


def list_of(data: Column, name: str | None = None) -> Column:
    """Elements of a member (or of the payload itself); NULL when it is no list."""
    return F.try_variant_get(data, "$" if name is None else f"$['{name}']", "array<variant>")


def candidates(feed: str) -> list[str]:
    names = [feed, f"{feed}s", "items"]
    if feed.endswith("y"):
        names.insert(1, f"{feed[:-1]}ies")
    return names


def named_lists(body: Column, data: Column) -> Column:
    """Lists of a page outside paging, in text order: ``array<(name, items)>``."""
    keys = F.json_object_keys(F.coalesce(F.get_json_object(body, "$.data"), body))
    members = F.try_variant_get(data, "$", "map<string,variant>")
    pairs = F.transform(
        F.filter(keys, lambda k: ~k.isin(*PAGING_KEYS)),
        lambda k: F.struct(k.alias("name"), F.try_variant_get(members[k], "$", "array<variant>").alias("items")),
    )
    return F.filter(pairs, lambda p: p["items"].isNotNull())


def records(pages: DataFrame, feed: str) -> DataFrame:
    """``(pull, page, pos, record)`` of all records that can be read, which is also the arrival order.

    Known names are tried first; only a page without any of them pays for
    looking through its keys.
    """
    return landed(pages, feed).where(F.col("record").isNotNull()).select("pull", "page", "pos", "record")


def section(pages: DataFrame, name: str) -> DataFrame:
    """``(pull, page, pos, record)`` of a named side list."""
    return opened(pages).select("pull", "page", F.posexplode(list_of(F.col("data"), name)).alias("pos", "record"))


def side_sections(pages: DataFrame, feed: str) -> DataFrame:
    """Every list beside the records: ``(section, pull, page, pos, record)``."""
    lists = opened(pages).select("pull", "page", named_lists(F.col("body"), F.col("data")).alias("lists"))
    names = F.transform("lists", lambda p: p["name"])
    known = [F.when(F.array_contains(names, name), F.lit(name)) for name in candidates(feed)]
    primary = F.coalesce(*known, F.get(names, 0))
    sides = lists.select("pull", "page", F.explode(F.filter("lists", lambda p: p["name"] != primary)).alias("side"))
    return sides.select(
        F.col("side.name").alias("section"), "pull", "page", F.posexplode("side.items").alias("pos", "record")
    )


def pull_states(heads: DataFrame) -> DataFrame:
    """``(pull, total_pages, pages_landed, unread)`` of a frame with ``pull, page, total_pages, readable``: a row for each pull."""
    return heads.groupBy("pull").agg(
        F.max("total_pages").alias("total_pages"),
        F.count_distinct(F.when(F.col("readable"), F.col("page"))).alias("pages_landed"),
        F.count_if(~F.col("readable")).alias("unread"),
    )


def incomplete_pulls(pages: DataFrame) -> DataFrame:
    """Pulls that announce more pages than have landed, those that cannot be read counted in."""
    return pull_states(page_heads(pages)).where(F.col("total_pages") > F.col("pages_landed") + F.col("unread"))


def paging_summary(pages: DataFrame) -> DataFrame:
    """Pages, records and page size that each pull announces; only for pulls of several pages."""

    def number(key: str) -> Column:
        return F.max(F.try_variant_get(F.col("data"), f"$.{key}", "bigint"))

    return (
        opened(pages)
        .groupBy("pull")
        .agg(
            number("totalPages").alias("total_pages"),
            number("totalCount").alias("total_count"),
            number("pageSize").alias("page_size"),
            F.count_distinct("page").alias("pages_landed"),
        )
        .withColumn("complete", F.col("pages_landed") == F.col("total_pages"))
        .where(F.col("total_pages") > 1)
    )
