"""Nested records to flat typed rows: a rule list becomes one ``select``.

Records are VARIANT values, so a field may be an object in one record and a
bare value in the next. Nothing here is a UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldledger import schema
from fieldledger.functions import dates, text
from fieldledger.operators.rules import Field

def arrival(page: Column, pos: Column) -> Column:
    """Position of a record in its pull as one sortable long: page first, then place on it.

    A long keeps the per-key "first"/"last" aggregates in hash aggregation."""
    return F.shiftleft(page.cast("bigint"), 31) + pos.cast("bigint")


def path(*names: str) -> str:
    return "$" + "".join(f"['{n}']" for n in names)


def get(record: Column, kind: str, *names: str) -> Column:
    return F.try_variant_get(record, path(*names), kind)


def raw_text(record: Column, *names: str) -> Column:
    """Text of a value: plain for scalars, JSON for objects and arrays, 0/1 for flags."""
    shown = get(record, "string", *names)
    # Only these two texts can come from a flag, so the type is looked up for no others.
    flag = shown.isin("true", "false") & (F.schema_of_variant(get(record, "variant", *names)) == "BOOLEAN")
    return F.when(flag, F.when(shown == "true", "1").otherwise("0")).otherwise(shown)


def integer(record: Column, *names: str) -> Column:
    """Whole number; true and false count as 1 and 0."""
    return get(record, "bigint", *names)


def real(record: Column, *names: str) -> Column:
    """Number, or money text such as ``9,250.00``."""
    return F.coalesce(get(record, "double", *names), text.money(get(record, "string", *names)))


def value_of(record: Column, rule: Field) -> Column:
    """The column a rule makes of a record."""
    name = rule.source
    if rule.key:
        # A bare value has no such key, an object is no number: one of the two is NULL.
        return F.coalesce(integer(record, name, rule.key), integer(record, name))
    if rule.type in ("integer", "timestamp"):
        return integer(record, name)
    if rule.type == "real":
        return real(record, name)
    return raw_text(record, name)


def columns_of(
    record: Column, rules: Iterable[Field], companions: bool = False, given: dict[str, Column] | None = None
) -> list[Column]:
    """All columns of a record: its id first, then one per rule in rule order.

    ``companions`` adds the UTC clock text next to every timestamp; ``given``
    holds columns that do not come from the record.
    """
    out = [integer(record, "id").alias("id")]
    for rule in rules:
        if rule.skip:
            continue
        if rule.spread:
            out += [raw_text(record, rule.source, key).alias(column) for key, column in rule.spread.items()]
            continue
        value = (given or {}).get(rule.target)
        value = value_of(record, rule) if value is None else value
        out.append(value.alias(rule.target))
        if companions and rule.type == "timestamp":
            out.append(dates.clock_text(value).alias(f"{rule.target}_dt"))
    return out


def normalize(
    records: DataFrame,
    rules: Iterable[Field],
    keep: Iterable[str] = (),
    companions: bool = False,
    given: dict[str, Column] | None = None,
) -> DataFrame:
    """Flat rows of a frame with a variant column ``record``; ``keep`` names pass-through columns."""
    return records.select(*keep, *columns_of(F.col("record"), list(rules), companions, given))


#: What a value that a rule cannot take becomes.
LOST = "array<struct<field:string,raw:string,reason:string>>"


def lost_values(record: Column, rules: Iterable[Field]) -> Column:
    """``(field, raw, reason)`` of the values that are there and come out NULL: they do not fit their column."""
    found = []
    for rule in rules:
        if rule.skip or rule.spread or (rule.type not in ("integer", "timestamp", "real") and not rule.key):
            continue
        raw = get(record, "string", rule.source)
        reason = f"no {rule.key}" if rule.key else f"not {rule.type}"
        what = F.struct(F.lit(rule.source).alias("field"), raw.alias("raw"), F.lit(reason).alias("reason"))
        found.append(F.when(raw.isNotNull() & value_of(record, rule).isNull(), what))
    return F.array_compact(F.array(*found)).cast(LOST) if found else F.array().cast(LOST)


def to_table(records: DataFrame, rules: Iterable[Field], table: str) -> DataFrame:
    """Flat rows with exactly the columns of a stored table."""
    return schema.conform(normalize(records, rules), table)


def pull_order(pull: Column) -> Column:
    """Pulls in order: numbers by value, other names by text, which holds for ISO dates."""
    return F.struct(pull.try_cast("decimal(38,0)").alias("number"), pull.alias("name"))


def children(parents: DataFrame, parent_column: str, items: str = "items") -> DataFrame:
    """One record per embedded child: ``(parent id, page, pos, item, record)``.

    Pull, page and position are the parent's, ``item`` counts within it. Empty and
    missing lists give none.
    """
    record = F.col("record")
    place = [parent_column, *[c for c in ("pull",) if c in parents.columns], "page", "pos"]
    # the parent's id is found before its list is taken apart, or every child would carry its parent
    heads = parents.withColumns({parent_column: integer(record, "id"), "_items": get(record, "array<variant>", items)}).select(*place, "_items")
    return heads.where(F.col(parent_column).isNotNull()).select(*place, F.posexplode("_items").alias("item", "record"))


def first_child_keys(parents: DataFrame, items: str = "items") -> DataFrame:
    """Keys of the first child of the first parent that has one; at most one row."""
    kids = get(F.col("record"), "array<variant>", items)
    return (
        parents.where(F.size(kids) > 0)
        .agg(F.min_by(F.to_json(F.element_at(kids, 1)), arrival(F.col("page"), F.col("pos"))).alias("child"))
        .where(F.col("child").isNotNull())
        .select(F.json_object_keys("child").alias("keys"))
    )


def embedded_is_complete(parents: DataFrame, items: str = "items") -> DataFrame:
    """One row ``inline``: embedded children with more than four keys carry all their fields."""
    return first_child_keys(parents, items).select((F.size("keys") > 4).alias("inline"))


def choose_children(parents: DataFrame, parent_column: str, detail: DataFrame | None, items: str = "items") -> DataFrame:
    """One row for each child: from the landed detail feed where that has it, embedded where it has not.

    ``detail`` has the parent id and the record, and ``page`` and ``pos`` if known. Every child is chosen by itself, by its
    parent's id and its own, so neither other parents nor batches have a say. Embedded children without id
    stay as they are.
    """
    embedded = children(parents, parent_column, items)
    if detail is None:
        return embedded
    own = integer(F.col("record"), "id")
    known = detail.select(F.col(parent_column).cast("bigint").alias("_parent"), own.alias("_child")).where(F.col("_child").isNotNull()).distinct()
    keyed = embedded.withColumn("_own", own)
    alone = keyed.join(known, (keyed[parent_column] == known["_parent"]) & (keyed["_own"] == known["_child"]), "left_anti").drop("_own")
    return alone.unionByName(detail, allowMissingColumns=True)


def enrich_due(recurrences: DataFrame, side: DataFrame) -> DataFrame:
    """Adds ``currently_due``: the window start of the side record that names the recurrence.

    A side record names its parent in ``serviceRecurrence``; a projected one also
    by its negated id. The last one in arrival order wins, even with a NULL start.
    """
    record, at = F.col("record"), arrival(F.col("page"), F.col("pos"))
    if "pull" in side.columns:
        at = F.struct(pull_order(F.col("pull")).alias("pull"), at.alias("place"))
    own = integer(record, "id")
    named = F.array_compact(F.array(integer(record, "serviceRecurrence"), F.when(own < 0, -own)))
    due = (
        side.select(F.explode(named).alias("parent"), integer(record, "windowStart").alias("start"), at.alias("at"))
        .groupBy("parent")
        .agg(F.max_by("start", "at").alias("currently_due"), F.lit(True).alias("matched"))
    )
    keyed = recurrences.withColumn("_id", integer(record, "id"))
    return (
        keyed.join(due, keyed["_id"] == due["parent"], "left")
        .withColumn("matched", F.coalesce("matched", F.lit(False)))
        .drop("_id", "parent")
    )


def match_ratio(enriched: DataFrame) -> DataFrame:
    return enriched.agg(
        F.count_if("matched").alias("matched"), F.count(F.lit(1)).alias("records")
    )


def rejects(rows: DataFrame, key: str = "id") -> DataFrame:
    """Rows a keyed table cannot take: their key is missing."""
    return rows.where(F.col(key).isNull())


def accepted(rows: DataFrame, key: str = "id") -> DataFrame:
    return rows.where(F.col(key).isNotNull())
