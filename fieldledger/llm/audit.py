"""Filter interaction audit: what each of five filters removes in every order of applying them.

Conditions of failure (words: runs of characters other than blanks; null text: empty):
A  under 200 words                              B  under 50 % distinct words
C  over 2 % of the code points are in A-Z       D  holds one of # $ % & * |
E  the text is that of a smaller doc_id, anywhere in the table, removed or not

A to D follow from the text alone and become a bit mask. E takes a prepass: every text adds one to ``HASHES``
counters of a Bloom sketch; the sketches of the tasks are added up, and a text with a counter below two is
surely unique. Only the others, the possible repeats, shuffle with their whole text, and the least doc_id of
each text is found by exact comparison. Masks, labels and E then meet in one small row per document, are
counted by part and mask, and every number of the report is a sum of such counts.

The sketch has 16 counters a row, at most 2**``MAX_LOG2``. Beyond 2**(``MAX_LOG2`` - 4) rows it clears fewer texts, so
more of them are shuffled; the result stays exact.

Rows without doc_id neither fail E nor make others fail it, and have no labels. Repeated rows of one doc_id and
text count each and fail E together or not at all. A doc_id with several label rows is good (toxic) if one of them
says so. A null source is the part of the empty string. Empty texts are equal to each other. An empty table gives an
empty result; an empty labels table gives zeros. Other columns are not looked at. A very long text needs memory for its
own words only.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldledger.llm.common import bitmap, cut, in_bitmap, mixed, signed, written

FILTERS = "ABCDE"
E_BIT = 16
LEAST_WORDS, DISTINCT_SHARE, CAPITAL_SHARE = 200, 50, 2
HASHES = 4
MAX_LOG2 = 30
_CAPITALS = bytes(range(65, 91))
_SIGNS = b"#$%&*|"


def mask_of(text: bytes) -> int:
    """Bits 1, 2, 4, 8 for the failed filters A, B, C, D."""
    words = text.split()
    chars = len(text) - int(np.count_nonzero(np.frombuffer(text, np.uint8) & 0xC0 == 0x80))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (
        (len(words) < LEAST_WORDS)
        + 2 * (100 * len(set(words)) < DISTINCT_SHARE * len(words))
        + 4 * (100 * capitals > CAPITAL_SHARE * chars)
        + 8 * (len(text.translate(None, _SIGNS)) < len(text))
    )


def _digests(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each text."""
    both = [xxhash.xxh3_128_intdigest(x.as_py()) for x in texts]
    low = np.array([x & 0xFFFFFFFFFFFFFFFF for x in both], np.uint64)
    return low, np.array([x >> 64 for x in both], np.uint64)


def _counters(low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
    """Of each text the hashes whose leading bits number its counters."""
    return [mixed(low + np.uint64(i) * (high | np.uint64(1))) for i in range(HASHES)]


def masks(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask (of A to D), low, high (hashes of the text) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = _digests(batch.column(2))
            mask = pa.array([mask_of(x.as_py()) for x in batch.column(2)], pa.int32())
            columns = [batch.column(0), batch.column(1), mask, pa.array(signed(low)), pa.array(signed(high))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "mask", "low", "high"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("source", F.lit("")).alias("part"), _text(docs))
    return rows.mapInArrow(run, "doc_id long, part string, mask int, low long, high long")


def _text(docs: DataFrame):
    return F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary").alias("text")


def sketch(hashed: DataFrame, log2: int) -> np.ndarray:
    """The merged counting sketch of all rows (low, high), as a bitmap of its counters of two or more.

    A task emits its own counters sparsely; equal ones are added up by Spark, and only counters of two or more
    reach the bitmap of 2**log2 bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = (c.to_numpy().view(np.uint64) for c in batch.columns)
            numbers = np.concatenate([h >> np.uint64(64 - log2) for h in _counters(low, high)])
            number, count = np.unique(numbers, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(number)), pa.array(count.astype(np.int64))], ["number", "count"])

    counters = hashed.select("low", "high").mapInArrow(run, "number long, count long").groupBy("number").agg(F.sum("count").alias("count"))
    return bitmap(counters.where("count > 1").select(F.shiftleft("number", 64 - log2).alias("h")), "h", log2)


def _possible(bits: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([in_bitmap(bits, h) for h in _counters(low, high)])


def sketch_size(rows: int) -> int:
    """log2 of the number of counters for so many rows: sixteen a row, within bounds."""
    return min(MAX_LOG2, max(16, (16 * rows - 1).bit_length() if rows else 16))


def repeats(docs: DataFrame, hashed: DataFrame) -> DataFrame:
    """``hashed`` (doc_id, part, mask, low, high) counted as doc_id, part, mask, n, with the bit of E in the mask."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch(hashed, sketch_size(hashed.count())))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = _digests(batch.column(1))
            keep = pa.array(np.flatnonzero(_possible(shared.value, low, high)))
            columns = [batch.column(0), pa.array(signed(low)), pa.array(signed(high)), batch.column(1)]
            yield pa.RecordBatch.from_arrays([c.take(keep) for c in columns], ["doc_id", "low", "high", "text"])

    def cleared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = (batch.column(i).to_numpy().view(np.uint64) for i in (3, 4))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_possible(shared.value, low, high))], [*batch.schema.names, "possible"])

    known = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), _text(docs))
    suspects = known.mapInArrow(texts, "doc_id long, low long, high long, text binary")
    # copies of a text shrink to one row in each task before they move
    least = suspects.groupBy("low", "high", "text").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "low", "high", F.lit(True).alias("first"))

    rows = hashed.mapInArrow(cleared, "doc_id long, part string, mask int, low long, high long, possible boolean")
    open_ = F.col("possible") & F.col("doc_id").isNotNull()
    rows = rows.select("doc_id", "part", "mask", *[F.when(open_, F.col(c)).alias(c) for c in ("low", "high")])
    rows = rows.groupBy("doc_id", "part", "mask", "low", "high").agg(F.count(F.lit(1)).alias("n"))
    repeated = F.col("low").isNotNull() & F.col("first").isNull()
    joined = rows.join(least.distinct(), ["doc_id", "low", "high"], "left")
    return joined.select("doc_id", "part", F.when(repeated, F.col("mask") + E_BIT).otherwise(F.col("mask")).alias("mask"), "n")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (of A to E), n, good, toxic: the additive counts from which the report is made."""
    marked = repeats(docs, written(masks(docs)))
    known = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(*[F.max(F.coalesce((F.col(a) == 1).cast("int"), F.lit(0))).alias(b) for a, b in (("quality", "good"), ("toxic", "bad"))])
    )
    joined = marked.join(known, "doc_id", "left")
    return joined.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("bad", F.lit(0))).alias("toxic"),
    )


def orders() -> list[tuple[str, int, int, int]]:
    """(filter_order, step, bit of the step's filter, bits of the filters before it)."""
    found = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            found.append(("".join(order), step, bit, before))
            before |= bit
    return found


def _orders_with(before: int) -> int:
    """In how many orders a filter comes right after exactly these ones."""
    return factorial(before.bit_count()) * factorial(len(FILTERS) - 1 - before.bit_count())


def report(counts: DataFrame) -> DataFrame:
    """The counts of every part, order and step, from part, mask, n, good, toxic."""
    spark = counts.sparkSession
    settings = sorted({(bit, before) for _, _, bit, before in orders()})
    each = F.explode(F.array(*[F.struct(F.lit(b).alias("bit"), F.lit(s).alias("before"), F.lit(_orders_with(s)).alias("orders")) for b, s in settings]))
    spread = counts.select("part", "mask", "n", "good", "toxic", each.alias("at")).select("part", "mask", "n", "good", "toxic", "at.*")
    hit = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0
    sums = {
        "kept": ("n", ~hit & ~gone),
        "removed": ("n", hit & ~gone),
        "redundant": ("n", hit & gone),
        "unique_fails": ("n", F.col("mask") == F.col("bit")),
        "good_lost": ("good", hit & ~gone),
        "toxic_lost": ("toxic", hit & ~gone),
    }
    by = spread.groupBy("part", "bit", "before", "orders").agg(*[F.sum(F.when(c, F.col(v)).otherwise(0)).alias(k) for k, (v, c) in sums.items()])
    every = Window.partitionBy("part", "bit")  # sixteen rows
    by = by.withColumn("shapley", F.sum(F.col("removed") * F.col("orders")).over(every))
    steps = spark.createDataFrame(orders(), "filter_order string, step int, bit int, before int")
    return by.join(steps, ["bit", "before"]).select("part", "filter_order", "step", *sums, "shapley")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    return report(cut(mask_counts(docs, labels)))
