"""What landed records look like, and whether the rules cover it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldledger.operators import rules
from fieldledger.operators.normalize import arrival, first_child_keys, pull_order


def type_name(kind: Column) -> Column:
    """Simple type of a variant's schema text, cut at its first ``<``.

    Whole numbers come as BIGINT or a wide decimal; a short decimal without
    places is a number that was written as 1.0.
    """
    places = F.regexp_extract(kind, r"^DECIMAL\((\d+),0\)$", 1).try_cast("int")
    return (
        F.when(kind == "STRING", "text")
        .when(kind == "BIGINT", "integer")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind == "OBJECT", "object")
        .when(kind == "ARRAY", "array")
        .when(kind == "DOUBLE", "real")
        .when(places > 18, "integer")
        .when(kind.startswith("DECIMAL"), "real")
        .otherwise("unknown")
    )


def exploded(records: DataFrame) -> DataFrame:
    """``(at, field, value)`` for every key of every record."""
    placed = records.select(arrival(F.col("page"), F.col("pos")).alias("at"), "record")
    members = records.sparkSession.tvf.variant_explode(F.col("record").outer())
    return placed.lateralJoin(members).select("at", F.col("key").alias("field"), "value")


def kinds(records: DataFrame) -> DataFrame:
    """``(at, field, kind, value)``; the type of a value is looked up once."""
    raw = exploded(records).withColumn("raw", F.schema_of_variant("value"))
    return raw.select("at", "field", F.substring_index("raw", "<", 1).alias("kind"), "value")


def first_positions(records: DataFrame) -> DataFrame:
    """``(field, kind, at)``: where each kind of value of a field comes first.

    Field names are few and hot; every task reduces them to one row per field
    and kind, in hash aggregation, before anything moves.
    """
    return kinds(records).groupBy("field", "kind").agg(F.min("at").alias("at"))


def field_profile(records: DataFrame) -> DataFrame:
    """``(field, api_type)``: the type of each key's first value that is not null."""
    named = first_positions(records).withColumn("api_type", type_name(F.col("kind")))
    known = F.when(F.col("api_type") != "unknown", F.col("at"))
    return named.groupBy("field").agg(F.coalesce(F.min_by("api_type", known), F.lit("unknown")).alias("api_type"))


def nested_keys(records: DataFrame) -> DataFrame:
    """``(field, api_type, keys)``: the profile, with the keys of the first object
    or of the first item of the first array; NULL where there are none.

    A first pass finds the positions that matter, a handful per field; only the
    records at these positions are looked into. Of an array only the head is
    kept, so a sample stays one object.
    """
    places = first_positions(records).agg(F.collect_set("at")).scalar()
    here = arrival(F.col("page"), F.col("pos"))
    samples = kinds(records.where(F.array_contains(places, here)))
    value, kind = F.col("value"), F.col("kind")
    head = F.when(kind == "OBJECT", value).when(kind == "ARRAY", F.try_variant_get(value, "$[0]", "variant"))
    named = samples.select("field", "at", type_name(kind).alias("api_type"), F.to_json(head).alias("text"))
    known = F.when(F.col("api_type") != "unknown", F.col("at"))
    seen = named.groupBy("field").agg(F.min_by(F.struct("api_type", "text"), known).alias("first"))
    return seen.select(
        "field",
        F.coalesce("first.api_type", F.lit("unknown")).alias("api_type"),
        F.json_object_keys(F.col("first.text")).alias("keys"),
    )


#: A profile that can be stored and merged: where a field first had a type, and the keys of that first value.
STORED = "name string, feed string, field string, api_type string, pull string, at long, keys array<string>"


def with_shape(records: DataFrame) -> DataFrame:
    """Adds ``shape``, a text that records have in common only if each of their fields is of the same type in all of them."""
    # in two steps, so that a record is looked through once
    kind = F.col("shape")
    typed = records.withColumn("shape", F.schema_of_variant("record"))
    # the type of a list says little of its elements, which are looked through like fields
    return typed.withColumn("shape", F.when(kind.startswith("ARRAY"), F.to_json("record")).otherwise(kind))


def _placed(records: DataFrame) -> DataFrame:
    known = records if "shape" in records.columns else with_shape(records)
    return known.select(F.coalesce("pull", F.lit("")).alias("pull"), arrival(F.col("page"), F.col("pos")).alias("at"), "shape", "record")


def first_of_shapes(records: DataFrame) -> DataFrame:
    """``(pull, at)``: where each shape of a record comes first. Every first value of a field and type is in one of these records."""
    in_pull = _placed(records).groupBy("shape", "pull").agg(F.min("at").alias("at"))
    firsts = in_pull.groupBy("shape").agg(F.min(F.struct(pull_order(F.col("pull")).alias("pull"), "at")).alias("first"))
    return firsts.select(F.col("first.pull.name").alias("pull"), "first.at").distinct()


def stored_profile(records: DataFrame, feed: str, spots: DataFrame | None = None) -> DataFrame:
    """Rows of ``STORED`` for one batch of records ``(pull, page, pos, record)``, and their ``shape`` if it is known.

    The least position of each type of a field is associative: profiles of batches merged in any way are that of the whole.
    Only the first record of each shape is looked into; ``spots`` says where these are, when that was written aside.
    """
    placed, spots = _placed(records), first_of_shapes(records) if spots is None else spots
    spots = spots.select(F.col("pull").alias("_pull"), F.col("at").alias("_at"))
    here = placed.join(spots, (F.col("pull") == F.col("_pull")) & F.col("at").eqNullSafe(F.col("_at")), "left_semi")
    members = records.sparkSession.tvf.variant_explode(F.col("record").outer())
    seen = here.lateralJoin(members).select("pull", "at", F.col("key").alias("field"), "value")
    raw = F.substring_index(F.schema_of_variant("value"), "<", 1)
    head = F.when(raw == "OBJECT", F.col("value")).when(raw == "ARRAY", F.try_variant_get("value", "$[0]", "variant"))
    typed = seen.select("pull", "at", "field", type_name(raw).alias("api_type"), F.json_object_keys(F.to_json(head)).alias("keys"))
    rank = F.struct(pull_order(F.col("pull")).alias("pull"), F.col("at"), F.col("keys").isNull().alias("bare"))
    firsts = typed.groupBy("field", "api_type").agg(F.min_by(F.struct("pull", "at", "keys"), rank).alias("p"))
    return firsts.select(F.concat_ws("/", F.lit(feed), "field", "api_type").alias("name"), F.lit(feed).alias("feed"), "field", "api_type", "p.*")


def merged_profile(profiles: DataFrame) -> DataFrame:
    """The least position of each name."""
    first = F.struct(pull_order(F.col("pull")).alias("pull"), F.col("at").alias("at"))
    whole = F.struct("feed", "field", "api_type", "pull", "at", "keys")
    return profiles.groupBy("name").agg(F.min_by(whole, first).alias("p")).select("name", "p.*")


def settled_profile(profiles: DataFrame) -> DataFrame:
    """``(feed, field, api_type, keys)``: the type that a field had first, ``unknown`` if it never had one."""
    first = F.struct(pull_order(F.col("pull")).alias("pull"), F.col("at").alias("at"))
    known = F.when(F.col("api_type") != "unknown", first)
    seen = profiles.groupBy("feed", "field").agg(F.min_by(F.struct("api_type", "keys"), known).alias("p"))
    return seen.select("feed", "field", F.coalesce("p.api_type", F.lit("unknown")).alias("api_type"), F.col("p.keys").alias("keys"))


def child_feed_mode(parents: DataFrame, detail: DataFrame) -> DataFrame:
    """``parent_endpoint`` when the detail records know strictly more keys, else ``inline``.

    ``detail`` holds ``(page, pos, record)`` of the child's own feed; one row comes back.
    """
    shown = first_child_keys(parents)
    record = F.col("record")
    full = detail.agg(F.min_by(F.to_json(record), arrival(F.col("page"), F.col("pos"))).alias("r")).select(
        F.json_object_keys("r").alias("keys")
    )
    known = full.scalar()
    more = (F.size(F.array_except("keys", known)) == 0) & (F.size("keys") < F.size(known))
    return shown.select(F.when(more, "parent_endpoint").otherwise("inline").alias("fetch_mode"))


def override_rows(spark, feeds: Mapping[str, rules.Overrides] = rules.FEEDS) -> DataFrame:
    """``(feed, field, settled)``: overrides, and whether one fixes type, key or skipping."""
    rows = []
    for feed, known in feeds.items():
        settled = {n for n, f in known.fields().items() if f.skip or f.key or f.type}
        rows += [(feed, name, name in settled) for name in sorted(known.known())]
    return spark.createDataFrame(rows, "feed string, field string, settled boolean")


def rule_warnings(catalogue: DataFrame, feeds: Mapping[str, rules.Overrides] = rules.FEEDS) -> DataFrame:
    """``(feed, field, warning)`` for a catalogue ``(feed, field, api_type)``.

    Feeds without description give one row with a NULL field.
    """
    spark = catalogue.sparkSession
    skipped = [n for n, f in feeds.items() if f.skip_feed]
    described = [n for n, f in feeds.items() if f.description]
    general = [*rules.TIMESTAMP_FIELDS, *rules.CORRECTED_TYPES, *rules.COMMON_NAMES, *rules.SKIPPED_EVERYWHERE]
    live = catalogue.where(~F.col("feed").isin(*skipped)) if skipped else catalogue
    undescribed = (
        live.where(~F.col("feed").isin(*described))
        .select("feed").distinct()
        .select("feed", F.lit(None).cast("string").alias("field"), F.lit("no description").alias("warning"))
    )
    field = F.col("field")
    warning = F.when(
        F.col("settled").isNull() & ~field.isin(*general), "type unknown, may need an override"
    ).when(~F.col("settled"), "type unknown, override has no type or key")
    unknown = live.where((F.col("api_type") == "unknown") & ~field.isin("id", "uri"))
    return (
        unknown.join(override_rows(spark, feeds), ["feed", "field"], "left")
        .select("feed", "field", warning.alias("warning"))
        .where(F.col("warning").isNotNull())
        .unionByName(undescribed)
    )


def catalogue_stats(catalogue: DataFrame, feeds: Mapping[str, rules.Overrides] = rules.FEEDS) -> DataFrame:
    """Feeds, fields and skipped fields of a catalogue ``(feed, field, api_type, keys)``."""
    spark = catalogue.sparkSession
    rows = [(n, f.source) for n, o in feeds.items() for f in o.fields().values() if f.skip]
    skips = spark.createDataFrame(rows, "feed string, field string").withColumn("named", F.lit(True))
    field = F.col("field")
    objects = (F.col("api_type") == "array") & F.col("keys").isNotNull()
    stored = catalogue.where(~field.isin("id", *rules.DROPPED_EVERYWHERE)).join(skips, ["feed", "field"], "left")
    skip = F.coalesce("named", F.lit(False)) | field.isin(*rules.SKIPPED_EVERYWHERE) | F.coalesce(objects, F.lit(False))
    return stored.agg(
        F.count_distinct("feed").alias("feeds"), F.count(F.lit(1)).alias("fields"), F.count_if(skip).alias("skipped")
    )


def profiles_of(profile: DataFrame) -> dict[str, rules.Profile]:
    """A profile on the driver: one row per field name, the size of a table header."""
    return {r["field"]: rules.Profile(r["api_type"], tuple(r["keys"] or ())) for r in profile.collect()}
