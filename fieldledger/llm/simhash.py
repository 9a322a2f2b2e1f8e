"""SimHash near-duplicates with pivot distance tables.

A fingerprint bit is 1 if it is set in over half of the XXH64 hashes of the word shingles. Documents
whose fingerprints differ in at most ``radius`` bits are linked; components of links are groups.

1. Documents with one fingerprint collapse to a class (map-side combine), so exact copies never pair.
2. The 64 bits are cut into ``blocks`` blocks. Fingerprints within ``radius`` bits agree on at least
   ``blocks - radius`` of them, so every combination of that many blocks is a join key that no link
   can miss. Keys held by more than ``CELL`` classes are dealt into square cells, so no task gets an
   unbounded group; a cell holds at most two slices.
3. Inside a cell the distances of each fingerprint to the reference fingerprints (pivots) are laid
   out in a table. By the triangle inequality two fingerprints whose coordinates differ by more than
   ``radius`` for any pivot are no link: such pairs are discarded, survivors are verified bit by bit.
4. A cell gives a spanning forest of its links, never all pairs, and components are found by stars.

Null and empty texts have no shingle: fingerprint zero, linked like any other. Texts with fewer words
than a shingle are one shingle. A row without doc_id gets its group's component, null if no row of the group has one.
Of each group ``keep_one`` keeps the row of the smallest doc_id, or one without doc_id if there is no other; rows that repeat
both doc_id and text are one document and stay together. Empty tables give empty results; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldledger.llm.common import cut, shuffle_width
from fieldledger.llm.components import components

RADIUS = 3
BLOCKS = 5
WIDTH = 3
#: Classes in one slice of a key's group; a cell compares two slices.
CELL = 1024
#: Reference fingerprints: zero (the bit count), half masks and fixed random words.
PIVOTS = np.concatenate(
    [
        np.array([0, 0xFFFFFFFF, 0xFFFF0000FFFF0000, 0xAAAAAAAAAAAAAAAA], np.uint64),
        np.random.default_rng(64).integers(0, 1 << 64, 12, dtype=np.uint64),
    ]
)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes | None, width: int = WIDTH) -> int:
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    line = b" ".join(words)
    last = ends[width - 1 :].tolist() or [len(line)]
    first = [0, *(ends[: len(last) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], 42) for a, b in zip(first, last, strict=True)), np.uint64, len(last))
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def row_key() -> Column:
    """What tells rows apart: doc_id and text."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("binary"), F.col("doc_id").isNull())


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, row (its ``row_key``), fp (the 64 bits as a bigint)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(x.as_py(), width) for x in batch.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.int64())], ["doc_id", "row", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), row_key(), F.col("text").cast("binary"))
    return rows.mapInArrow(run, "doc_id long, row long, fp long")


def block_keys(fp: Column, blocks: int = BLOCKS, radius: int = RADIUS) -> Column:
    """One bigint for each combination of ``blocks - radius`` blocks: a hash of their number and bits."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    part = [F.shiftrightunsigned(F.shiftleft(fp, 64 - hi), 64 - hi + lo) for lo, hi in zip(edges, edges[1:], strict=False)]
    return F.array(*[F.xxhash64(F.lit(n), *[part[i] for i in c]) for n, c in enumerate(combinations(range(blocks), blocks - radius))])


def pivot_table(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps[:, None] ^ PIVOTS[None, :]).astype(np.int8)


def linked_pairs(left: np.ndarray, right: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within ``radius``, in blocks of rows of ``left``. ``left`` is sorted by the first pivot's distance."""
    a, b = pivot_table(left), pivot_table(right)
    order = np.argsort(b[:, 0], kind="stable")
    b, right = b[order], right[order]
    for at in range(0, len(left), 64):
        rows = slice(at, at + 64)
        own = a[rows, 0]
        lo, hi = np.searchsorted(b[:, 0], own.min() - radius, "left"), np.searchsorted(b[:, 0], own.max() + radius, "right")
        near = np.ones((len(own), hi - lo), bool)
        for k in range(len(PIVOTS)):
            near &= np.abs(a[rows, k][:, None] - b[None, lo:hi, k]) <= radius
            if not near.any():
                break
        i, j = np.nonzero(near)
        i, j = i + at, j + lo
        sure = np.bitwise_count(left[i] ^ right[j]) <= radius
        yield i[sure], order[j[sure]]


def _forest(ids: np.ndarray, fps: np.ndarray, sides: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links that connect what is connected inside one cell; ids are distinct."""
    root = list(range(len(ids)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    order = np.argsort(np.bitwise_count(fps ^ PIVOTS[0]), kind="stable")
    left, right = (order, order) if sides.min() == sides.max() else (order[sides[order] == 0], order[sides[order] == 1])
    for i, j in linked_pairs(fps[left], fps[right], radius):
        for x, y in zip(left[i].tolist(), right[j].tolist(), strict=True):
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
                yield int(ids[x]), int(ids[y])


def links(classes: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, cell: int = CELL) -> DataFrame:
    """Edges (a, b) between class representatives; their components are those of all links.

    ``classes``: rep (distinct bigint), fp (distinct).
    """
    n = shuffle_width(classes.sparkSession)
    keyed = classes.select("rep", "fp", F.explode(block_keys(F.col("fp"), blocks, radius)).alias("key"))
    dealt = in_cells(keyed, "rep", cell).repartition(n, "cell").sortWithinPartitions("cell", "rep")
    return dealt.mapInArrow(_by_cell(lambda sides, reps, fps: _forest(reps, fps.view(np.uint64), sides, radius)), "a long, b long")


def in_cells(keyed: DataFrame, by: str, cell: int) -> DataFrame:
    """cell, side and the columns of ``keyed`` but ``key``: rows whose key others have too, large groups in cells."""
    held = keyed.groupBy("key").count().where("count > 1").withColumnRenamed("count", "_held")
    slices = F.ceil(F.col("_held") / F.lit(cell)).cast("int")
    own = F.pmod(F.xxhash64(by), slices).cast("int")
    rest = [c for c in keyed.columns if c != "key"]
    shared = keyed.join(held, "key").select("key", *rest, own.alias("_own"), F.explode(F.sequence(F.lit(0), slices - 1)).alias("_other"))
    return shared.select(
        F.xxhash64("key", F.least("_own", "_other"), F.greatest("_own", "_other")).alias("cell"),
        (F.col("_own") > F.col("_other")).cast("byte").alias("side"),
        *rest,
    )


def _by_cell(forest: Callable[..., Iterator[tuple[int, int]]]) -> Callable:
    """A map over partitions sorted by cell: ``forest`` gets the other columns of one cell and gives its edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None

        def edges(columns: list[np.ndarray], bounds: np.ndarray) -> pa.RecordBatch:
            found = [
                e
                for lo, hi in zip(bounds, bounds[1:], strict=False)
                if hi - lo > 1
                for e in forest(*[c[lo:hi] for c in columns[1:]])
            ]
            a, b = (list(x) for x in zip(*found, strict=True)) if found else ([], [])
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:  # a cell may go on in the next batch
            new = [np.array(c.to_numpy(zero_copy_only=False)) for c in batch.columns]
            columns = new if rest is None else [np.concatenate(x) for x in zip(rest, new, strict=True)]
            starts = np.flatnonzero(np.diff(columns[0], prepend=columns[0][:1] - 1)) if len(columns[0]) else np.array([0])
            yield edges(columns, starts)
            rest = [c[starts[-1] :] for c in columns]
        if rest is not None and len(rest[0]):
            yield edges(rest, np.array([0, len(rest[0])]))

    return run


def near_duplicates(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, row, fp, component_id (smallest doc_id reachable over links) for every row of ``docs``."""
    prints = cut(fingerprints(docs, width))
    classes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    # rows without any doc_id form classes without representative: they keep a null component
    found = components(links(classes.where(F.col("rep").isNotNull()), radius, blocks))
    labelled = classes.join(found, classes["rep"] == found["node"], "left").select(
        F.col("fp").alias("_fp"), F.coalesce("component", "rep").alias("component_id")
    )
    return prints.join(labelled, prints["fp"] == labelled["_fp"], "left").select("doc_id", "row", "fp", "component_id")


def keep_one(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """One document of ``docs`` for each group of ``groups`` (doc_id, row, fp, component_id)."""
    nameless = F.when(F.col("component_id").isNull(), F.col("fp"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    kept = groups.groupBy("component_id", nameless.alias("nameless")).agg(first).select(F.col("first.row").alias("_row"))
    return docs.join(kept, row_key() == kept["_row"], "left_semi")
