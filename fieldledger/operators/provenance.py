"""Rules as rows: who says what about a field, and whose word counts.

Stated rules and those that follow from what a field looks like become offers ``(attribute, value, source, rank)``.
Each attribute of a field is settled by itself: the offer of the least rank wins and its source is kept.
``rules.field_plan`` settles the same fields for the loader; tests hold both against each other.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldledger.functions.text import snake_column
from fieldledger.operators import rules

#: Sources, strongest first.
SOURCES = ("override", "everywhere", "rename", "timestamp", "correction", "address", "object id", "array of objects", "flag", "text", "name")
ATTRIBUTES = ("skip", "spread", "column", "type", "key")
OFFER = "array<struct<attribute:string,value:string,source:string,rank:int>>"


def stated_rules(spark: SparkSession, feeds: Mapping[str, rules.Overrides] = rules.FEEDS) -> DataFrame:
    """``(feed, field, attribute, value, source)`` of all written rules; a NULL feed stands for every feed.

    The attribute ``literal`` marks objects that are never read by their id.
    """
    rows = []
    for feed, known in feeds.items():
        for name, f in known.fields().items():
            told = {"skip": "true" if f.skip else None, "column": f.column, "type": f.type, "key": f.key}
            rows += [(feed, name, a, v, "override") for a, v in told.items() if v]
        rows += [(feed, name, "literal", "true", "override") for name in known.literal.split()]
    for name, (column, kind) in rules.COMMON_NAMES.items():
        rows += [(None, name, a, v, "rename") for a, v in (("column", column), ("type", kind)) if v]
    rows += [(None, name, "type", "timestamp", "timestamp") for name in sorted(rules.TIMESTAMP_FIELDS)]
    rows += [(None, name, "type", kind, "correction") for name, kind in rules.CORRECTED_TYPES.items()]
    rows += [(None, name, "skip", "true", "everywhere") for name in sorted(rules.SKIPPED_EVERYWHERE)]
    return spark.createDataFrame(rows, "feed string, field string, attribute string, value string, source string")


def rank_of(source: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SOURCES]), source).cast("int")


def seen_offers() -> Column:
    """Offers of one field by its observed type and keys; an override that takes a key, or an address, leaves no room for them."""
    kind, field = F.col("api_type"), F.col("field")

    def offer(when: Column, attribute: str, value: Column, source: str, rank: int | None = None) -> Column:
        place = SOURCES.index(source) + 1 if rank is None else rank
        made = F.struct(F.lit(attribute).alias("attribute"), value.alias("value"), F.lit(source).alias("source"), F.lit(place).alias("rank"))
        return F.when(when, made)

    free = ~F.col("keyed")
    address = free & (field == "address") & (kind == "object")
    by_id = free & ~address & (kind == "object") & F.array_contains("keys", "id") & ~F.col("literal")
    objects = free & (kind == "array") & (F.size("keys") > 0)
    flag = free & (kind == "boolean")
    snake = snake_column(field)
    names = F.create_map(*[F.lit(x) for pair in rules.FLAG_NAMES.items() for x in pair])
    spread = F.lit(",".join(f"{key}={column}" for key, column in rules.ADDRESS_COLUMNS.items()))
    return F.array_compact(
        F.array(
            offer(address, "spread", spread, "address"),
            offer(by_id, "key", F.lit("id"), "object id"),
            offer(by_id, "type", F.lit("integer"), "object id", 0),  # an id is a number, whatever else is said
            offer(by_id, "column", F.when(snake.endswith("_id"), snake).otherwise(F.concat(snake, F.lit("_id"))), "object id"),
            offer(objects, "skip", F.lit("true"), "array of objects"),
            offer(flag, "type", F.lit("integer"), "flag"),
            offer(flag & names[field].isNotNull(), "column", names[field], "flag"),
            offer(free & ~address & kind.isin("array", "object"), "type", F.lit("text"), "text"),
            offer(F.lit(True), "column", snake, "name"),
        )
    ).cast(OFFER)


def catalogued(catalogue: DataFrame, stated: DataFrame, feeds: Mapping[str, rules.Overrides]) -> DataFrame:
    """Fields of a catalogue ``(feed, field, api_type, keys)`` and those that only overrides of its feeds know.

    Feeds that are skipped as a whole, keys and fields dropped everywhere are left out; ``observed`` tells the two kinds apart.
    """
    gone = [name for name, known in feeds.items() if known.skip_feed]
    live = catalogue.where(~F.col("feed").isin(*gone)) if gone else catalogue
    own = stated.where(F.col("feed").isNotNull())
    marks = own.groupBy("feed", "field").agg(
        F.bool_or(F.col("attribute") == "literal").alias("literal"), F.bool_or(F.col("attribute") == "key").alias("keyed")
    )
    declared = own.where(F.col("attribute") != "literal").select("feed", "field").distinct()
    extra = declared.join(live.select("feed").distinct(), "feed", "left_semi").join(live, ["feed", "field"], "left_anti")
    fields = live.select("feed", "field", "api_type", "keys", F.lit(True).alias("observed")).unionByName(
        extra.withColumn("observed", F.lit(False)), allowMissingColumns=True
    )
    kept = fields.where(~F.col("observed") | ~F.col("field").isin("id", *sorted(rules.DROPPED_EVERYWHERE)))
    flags = {c: F.coalesce(c, F.lit(False)) for c in ("literal", "keyed")}
    return kept.join(marks, ["feed", "field"], "left").withColumns(flags)


def settled_rules(catalogue: DataFrame, feeds: Mapping[str, rules.Overrides] = rules.FEEDS) -> DataFrame:
    """One row for each field: ``feed, field, observed``, and every attribute with the source that settled it (``<attribute>_by``).

    A field that is left out or spread has no other attribute. Fields that were not observed follow their overrides alone.
    """
    stated = stated_rules(catalogue.sparkSession, feeds)
    fields = catalogued(catalogue, stated, feeds)
    written = stated.where(F.col("attribute") != "literal").withColumn("rank", rank_of(F.col("source")))
    one = F.struct("attribute", "value", "source", "rank").alias("offer")
    own = fields.select("feed", "field", "observed").join(written.where(F.col("feed").isNotNull()), ["feed", "field"]).select("feed", "field", "observed", one)
    general = fields.where("observed").select("feed", "field", "observed").join(written.where(F.col("feed").isNull()).drop("feed"), "field")
    seen = fields.select("feed", "field", "observed", F.explode(seen_offers()).alias("offer"))
    offers = own.unionByName(general.select("feed", "field", "observed", one)).unionByName(seen)

    def winner(attribute: str) -> Column:
        return F.min_by(F.struct("offer.value", "offer.source"), F.when(F.col("offer.attribute") == attribute, F.col("offer.rank"))).alias(attribute)

    won = offers.groupBy("feed", "field", "observed").agg(*[winner(a) for a in ATTRIBUTES])
    free = F.col("skip").isNull() & F.col("spread").isNull()
    open_to = {"skip": F.lit(True), "spread": F.col("skip").isNull(), "column": free, "type": free, "key": free}
    shown = [F.when(open_to[a], F.col(a)[part]).alias(name) for a in ATTRIBUTES for part, name in (("value", a), ("source", f"{a}_by"))]
    return won.select("feed", "field", "observed", *shown)
