"""Mixing sources to target weights along a time-varying curriculum.

Sources sorted by code point (null last) get the given weights in turn and share ``share`` of all
words; a target stops at ``repeat`` times its source's words and the excess is dealt again by weight
until none is above (water filling, solved in closed form). Each source has a weight schedule over
training time; the integral of the schedule up to ``t`` is the share of its target due by ``t``. A
document's place in its source's cumulative demand is inverted to the position at which it is read,
and documents are range-sorted by position.

Within a source, documents stand in the order of a hash; whole passes come first and the document at
the border of the last pass gives the words that are still missing, so ``taken`` meets the target to
one word. Null text counts 0 words and takes none; a null source is a source of its own, sorted last;
repeated rows are separate documents; an empty table gives an empty mix; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldledger.llm.common import WORD_PATTERN, cut, shuffle_width

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
REPEAT = 2.0
#: Weight at the start and at the end of training, relative to the mean, by source in turn.
SCHEDULES = ((1.5, 0.5), (0.5, 1.5), (1.0, 1.0))
#: Documents for each slice in which a source's running total is kept.
SLICE_DOCS = 5_000
#: Up to so many sources, their one-row-each table is broadcast; beyond, it is joined by shuffle.
MANY_SOURCES = 10_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def _turn(values: Sequence[float], rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.pmod(rank, F.lit(len(values))) + 1).cast("int"))


def targets(sizes: DataFrame, weights: Sequence[float], share: float, repeat: float) -> DataFrame:
    """source, source_size, n_docs, rank, target from one row per source (``source_size``, ``n_docs``).

    A source is capped exactly if its ``repeat * size / weight`` is below the level at which the
    uncapped ones share what the capped ones leave. Sorted by that ratio, the capped sources are a
    prefix. The windows run over one row per source, never over documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1).withColumn("weight", _turn(weights, F.col("rank")))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(repeat)))
    everything = Window.partitionBy(F.lit(1))
    before = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    leveled = ranked.withColumn("level", left / open_weight)
    ratio = (F.col("cap") / F.col("weight")).alias("ratio")
    free = F.col("level") * F.col("weight") < F.col("cap")
    found = F.min(F.when(free, F.struct(ratio, "rank", "level"))).over(everything)  # the first free source
    return leveled.withColumn(
        "target",
        F.when(found.isNull() | (F.struct(ratio, "rank") < F.struct(found["ratio"].alias("ratio"), found["rank"].alias("rank"))), F.col("cap")).otherwise(
            F.least(F.col("cap"), found["level"] * F.col("weight"))
        ),
    ).select("source", "source_size", "n_docs", "rank", "target")


def position(done: Column, rank: Column, schedules: Sequence[tuple[float, float]]) -> Column:
    """Inverse of the share due by time t, ``(a t + (b - a) t^2 / 2) / ((a + b) / 2)`` for a line from a to b."""
    a, b = _turn([s[0] for s in schedules], rank), _turn([s[1] for s in schedules], rank)
    half = (b - a) / 2
    due = done * (a + b) / 2
    # the root without cancellation, which also holds for a level schedule
    return F.least(F.lit(1.0), 2 * due / (a + F.sqrt(F.greatest(F.lit(0.0), a * a + 4 * half * due))))


def plan(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    repeat: float = REPEAT,
    schedules: Sequence[tuple[float, float]] = SCHEDULES,
    carry: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """``carry`` columns plus size, source_size, target, taken and reads: array of (words, position).

    A running total over a source that holds a third of all rows is taken in slices of its hash
    order: slice totals first (one row per slice), then a window inside each slice.
    """
    keep = list(dict.fromkeys(carry))  # carried inside a struct, so their names meet no others
    rows = docs.select(F.struct(*keep).alias("_row"), F.col("source").alias("_source"), word_count(F.col("text")).alias("_size"), F.xxhash64("doc_id", "text").alias("_hash"))
    if not {"text"} & set(keep):
        rows = cut(rows)  # the words are counted once
    sizes = rows.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    goals = cut(targets(sizes, weights, share, repeat).withColumn("slices", F.ceil(F.col("n_docs") / F.lit(SLICE_DOCS))))
    # as unsigned, a hash is cut into equal slices; the order inside does not depend on their number
    place = F.col("_hash") / F.lit(2.0**64) + F.lit(0.5)
    small = goals if goals.count() > MANY_SOURCES else F.broadcast(goals)
    placed = rows.join(small, F.col("_source").eqNullSafe(F.col("source")))
    placed = placed.withColumn("_slice", F.least(F.floor(place * F.col("slices")), F.col("slices") - 1))
    slices = placed.groupBy("rank", "_slice").agg(F.sum("_size").alias("slice_size"))
    earlier = Window.partitionBy("rank").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.select("rank", "_slice", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("rank", "_slice").orderBy("_hash", "_size").rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumn("_before", F.coalesce(F.sum("_size").over(inside), F.lit(0))).join(starts, ["rank", "_slice"])
    begin = F.col("start") + F.col("_before")
    size, whole, goal = F.col("_size"), F.col("source_size"), F.col("target")

    def read(number: Column) -> Column:
        at = number * whole + begin  # in the source's cumulative demand
        words = F.greatest(F.lit(0), F.least(size, (F.round(goal) - at).cast("long")))
        middle = F.least(F.lit(1.0), (at + words / 2) / F.greatest(goal, F.lit(1.0)))
        return F.struct(words.alias("words"), position(middle, F.col("rank"), schedules).alias("position"))

    passes = F.sequence(F.lit(0), F.lit(int(-(-repeat // 1))))
    reads = F.filter(F.transform(passes, read), lambda r: r["words"] > 0)
    taken = F.aggregate("reads", F.lit(0).cast("long"), lambda total, r: total + r["words"])
    return running.withColumn("reads", reads).select(
        "_row.*", size.alias("size"), whole.alias("source_size"), goal.alias("target"), taken.alias("taken"), "reads"
    )


def in_order(planned: DataFrame) -> DataFrame:
    """One row per document in the order of its first reading, range-sorted; those never read come last."""
    first = F.coalesce(F.get("reads", F.lit(0))["position"], F.lit(2.0))
    n = shuffle_width(planned.sparkSession)
    return planned.withColumn("first_position", first).repartitionByRange(n, "first_position", "doc_id").sortWithinPartitions("first_position", "doc_id")
