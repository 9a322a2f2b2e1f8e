"""Document fingerprints by context-triggered piecewise hashing, compared by edit distance.

A rolling hash over seven bytes triggers a chunk end wherever it is -1 modulo the block size; each
chunk gives one letter of the signature. A block size is 3 * 2**k; it starts where 64 chunks are
expected and is halved until the signature has 32 letters. A fingerprint is ``block:signature:
signature at the doubled block``. After the 63rd trigger the rest of the text is one chunk, so the
whole text counts however long it is. Two fingerprints are compared at a block size they share:
likeness is 1 - edits / longer length, and 0 where no run of letters is common.

Null counts as the empty text, whose fingerprint is ``3::``. Equal texts have equal fingerprints and
likeness 1. Rows are ordered by doc_id (null first), then by a hash of the text; rows that repeat a
doc_id follow each other; the row after the last is the first, also for a single row. An empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldledger.llm.common import mixed, shuffle_width

WINDOW = 7
LETTERS = 64
LEAST_BLOCK = 3
#: Letters that two signatures must share in a row (half of the shorter one, if that is less).
COMMON = 7
#: Ranges of doc_id for each partition: several, so that partitions get even shares of them.
RANGES = 8
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_PART = 1 << 18  # bytes hashed at a time
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string"
)


def _triggers(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Ends of possible chunks (after the byte), their rolling hash + 1, content sums up to there, and the whole sum."""
    ends, rolls, sums, total = [], [], [], 0
    whole = np.frombuffer(data, np.uint8)
    for at in range(0, len(whole), _PART):
        lead = min(at, WINDOW - 1)
        part = whole[at - lead : at + _PART].astype(np.uint32)
        part = np.concatenate([np.zeros(WINDOW - 1 - lead, np.uint32), part]) + np.uint32(1)
        n = len(part) - WINDOW + 1
        h = np.zeros(n, np.uint32)
        for i in range(WINDOW):
            h = h * np.uint32(0x01000193) + part[i : i + n]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        content = np.cumsum(mixed(h.astype(np.uint64))) + np.uint64(total)
        roll = h + np.uint32(1)
        hit = np.flatnonzero(roll % np.uint32(LEAST_BLOCK) == 0)
        ends.append(hit + at + 1)
        rolls.append(roll[hit] // np.uint32(LEAST_BLOCK))
        sums.append(content[hit])
        total = int(content[-1])
    if not ends:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.uint64), 0
    return np.concatenate(ends), np.concatenate(rolls), np.concatenate(sums), total


def fingerprint(text: str | None) -> str:
    data = (text or "").encode("utf-8", "surrogatepass")
    ends, rolls, sums, total = _triggers(data)

    def chosen(level: int) -> np.ndarray:
        return np.flatnonzero(rolls & np.uint32((1 << level) - 1) == 0)[: LETTERS - 1]

    def signature(at: np.ndarray) -> str:
        bounds = np.concatenate([np.zeros(1, np.uint64), sums[at]])
        if len(at) == 0 or ends[at[-1]] < len(data):
            bounds = np.append(bounds, np.uint64(total))
        return _ALPHABET[(mixed(np.diff(bounds)) >> np.uint64(58)).astype(np.int64)].tobytes().decode()

    if not data:
        return f"{LEAST_BLOCK}::"
    level = 0
    while (LEAST_BLOCK << level) * LETTERS < len(data):
        level += 1
    while level and len(chosen(level)) + 1 < LETTERS // 2:
        level -= 1
    return f"{LEAST_BLOCK << level}:{signature(chosen(level))}:{signature(chosen(level + 1))}"


def _alike(x: Column, y: Column) -> Column:
    shorter, longer = F.least(F.length(x), F.length(y)), F.greatest(F.length(x), F.length(y))
    run = F.least(F.lit(COMMON), F.ceil(shorter / 2)).cast("int")

    def runs(s: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(s) - run + 1), lambda i: F.substring(s, i, run))

    close = (1 - F.levenshtein(x, y) / longer).cast("double")
    return F.when((shorter > 0) & F.arrays_overlap(runs(x), runs(y)), close).otherwise(F.lit(0.0))


def likeness(x: Column, y: Column) -> Column:
    """0 to 1 for two fingerprints; null if either is null."""
    (p, q) = (F.split(c, ":") for c in (x, y))
    block_x, block_y = p[0].cast("long"), q[0].cast("long")
    return (
        F.when(x == y, F.lit(1.0))
        .when(block_x == block_y, F.greatest(_alike(p[1], q[1]), _alike(p[2], q[2])))
        .when(block_x == 2 * block_y, _alike(p[1], q[2]))
        .when(block_y == 2 * block_x, _alike(p[2], q[1]))
        .when(x.isNotNull() & y.isNotNull(), F.lit(0.0))
    )


def _under(value: Column, bounds: list) -> Column:
    """How many of the sorted bounds are less than ``value``, looked up in two short steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]

    def less(array: Column) -> Column:
        return F.size(F.filter(array, lambda b: b < value))

    whole = F.lit([g[-1] for g in groups])
    group = less(whole)
    inside = F.when(group < len(groups), less(F.get(F.array(*[F.lit(g) for g in groups]), group))).otherwise(0)
    return F.when(value.isNull(), 0).otherwise(group * step + inside).cast("int")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows dealt by ranges of doc_id and sorted; each range ends with the first row of the range after it.

    Only range bounds and the first id of each range (a few numbers per partition) reach the driver.
    """
    n = shuffle_width(docs.sparkSession)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shares = [i / (RANGES * n) for i in range(1, RANGES * n)]
    bounds = ids.agg(F.percentile_approx("doc_id", shares, 10 * RANGES * n)).first()[0]
    dealt = ids.withColumn("range", _under(F.col("doc_id"), sorted(set(bounds or []))))
    heads = {r[0]: r[1] for r in dealt.groupBy("range").agg(F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id"))).collect()}
    known = sorted(heads)
    before = {r: known[i - 1] for i, r in enumerate(known)}
    last = max(known, default=0)
    first_id = F.get(F.array(*[F.lit(heads[r][1] if r in heads else None).cast("long") for r in range(last + 1)]), F.col("range"))
    previous = F.get(F.array(*[F.lit(before.get(r, 0)) for r in range(last + 1)]), F.col("range"))
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("tail"))
    copy = F.struct(previous.alias("range"), F.lit(True).alias("tail"))
    both = F.when(F.col("doc_id").eqNullSafe(first_id), F.array(own, copy)).otherwise(F.array(own))
    return (
        dealt.select(F.explode(both).alias("place"), "doc_id", "text")
        .select("place.range", "place.tail", "doc_id", "text")
        .repartition(n, "range")
        .sortWithinPartitions("range", "tail", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    )


def edited(text: str, after: str) -> str:
    """The last quarter of the code points replaced by the first as many of the next text."""
    n = len(text) // 4
    return text[: len(text) - n] + after[:n]


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text and of the next text, with likenesses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (range, tail, doc_id, text, fingerprint) of the row whose next row is awaited
        for batch in batches:
            out = []
            for place, tail, doc_id, text in zip(*(c for c in batch.columns), strict=True):
                text = text.as_py() or ""
                row = (place.as_py(), tail.as_py(), doc_id.as_py(), text, fingerprint(text))
                if held is not None and held[0] == row[0] and not held[1]:
                    changed = edited(held[3], text)
                    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((held[2], len(held[3]), digest, held[4], fingerprint(changed), row[4]))
                held = row
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 4]
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    made = with_next(docs).mapInArrow(run, SCHEMA)
    return made.withColumn("near_edited", likeness(F.col("fingerprint"), F.col("edited_fingerprint"))).withColumn(
        "near_next", likeness(F.col("fingerprint"), F.col("next_fingerprint"))
    )
