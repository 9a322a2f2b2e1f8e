"""Substring dedup by De Bruijn compaction over word k-mers.

A window is ``k`` consecutive words of one document. Every word is removed that a window covers
whose word sequence also starts anywhere else, in the same document too. Windows are judged on the
input. The graph's edges are word k-mers; only the parts of it that repeat are ever built:

1. The least 8-gram (by hash) of a window is its anchor. Equal windows have equal anchors at equal
   offsets, so a window can repeat only where its anchor does. Anchors are about a fourteenth of the
   words; their counts (map-side combine) give those held at least twice.
2. The edge through an anchor is the k-mer of all words that its windows can reach, on both sides.
   Where an edge repeats, every window on it repeats: the path does not branch there and is compacted
   to one row for each occurrence, by a join of edges with their counts.
3. Anchors with more than one edge are the branching nodes. Only windows through these are written
   out and joined, by two independent 64-bit hashes, with the windows that start at least twice.
4. The source coordinates (document and word number) of both kinds meet the whole texts again; the
   windows are laid out there once more and their union is cut from the text.

Null texts have no words; texts of under ``k`` words lose none. A document is the pair of doc_id and
text: rows that repeat both get one answer, and each such row counts as a place of its own. Null doc_ids
are documents too. An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldledger.llm.common import RangeHash, bitmap, in_bitmap, mixed, signed, word_hashes, written

K = 35
GRAM = 8
#: Size of the bitmaps that narrow what is shuffled: 2**26 bits are 8 MB, at any size of the input.
BITS = 26
_SECOND_BASE = 0xD1B54A32D192ED03


class Windows:
    """Windows and anchors of one document."""

    def __init__(self, text: bytes | None, k: int = K) -> None:
        self.k, self.codes = k, word_hashes(text or b"")
        self.n = max(0, len(self.codes) - k + 1)
        if not self.n:
            self.anchor_of = self.anchors = np.zeros(0, np.int64)
            return
        self.ranges = RangeHash(self.codes)
        at = np.arange(len(self.codes) - GRAM + 1)
        self.grams = self.ranges.of(at, at + GRAM)
        # leftmost least gram of each window: doubling steps over the least of 1, 2, 4 ... grams
        rank, best, width, span = mixed(self.grams), at, 1, k - GRAM + 1
        while width < span:
            step = min(width, span - width)
            a, b = best[:-step], best[step:]
            best = np.where(rank[b] < rank[a], b, a)
            width += step
        self.anchor_of = best
        self.anchors = best[np.flatnonzero(np.diff(best, prepend=-1))]

    def edges(self, anchors: np.ndarray) -> np.ndarray:
        """Hash of all words the anchor's windows can reach, cut at the document's ends."""
        reach = self.k - GRAM
        lo, hi = np.maximum(anchors - reach, 0), np.minimum(anchors + self.k, len(self.codes))
        ends = (anchors - lo).astype(np.uint64) * np.uint64(1 << 20) + (hi - anchors).astype(np.uint64)
        return mixed(self.ranges.of(lo, hi) ^ mixed(ends))

    def hashes(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.ranges.of(at, at + self.k), RangeHash(mixed(self.codes), _SECOND_BASE).of(at, at + self.k)


def _rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def _scan(docs: DataFrame, schema: str, k: int, emit) -> DataFrame:
    """``emit(windows)`` gives the columns after doc_id and text_hash for one document, as arrays."""
    names = ["doc_id", "text_hash", *[x.split()[0] for x in schema.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, found, keys = batch.slice(at, 256), [], []
                for i, text in enumerate(part.column(2)):
                    columns = emit(Windows(text.as_py(), k))
                    found.append(columns)
                    keys.append(np.full(len(columns[0]), i))
                take = pa.array(np.concatenate(keys))
                made = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), *made], names)

    return _rows(docs).mapInArrow(run, f"doc_id long, text_hash long, {schema}")


def _twice(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def repeated_places(docs: DataFrame, k: int = K, bits: int = BITS) -> DataFrame:
    """doc_id, text_hash, anchors, windows: word numbers of the anchors all of whose windows repeat, and of other windows that do."""
    shared = docs.sparkSession.sparkContext.broadcast

    def anchor_hashes(w: Windows) -> list[np.ndarray]:
        return [signed(w.grams[w.anchors])] if w.n else [np.zeros(0, np.int64)]

    first = shared(bitmap(_twice(_scan(docs, "anchor long", k, anchor_hashes), "anchor"), "anchor", bits))

    def edge_rows(w: Windows) -> list[np.ndarray]:
        if not w.n:
            return [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)]
        at = w.anchors[in_bitmap(first.value, w.grams[w.anchors])]
        return [signed(w.grams[at]), signed(w.edges(at)), at.astype(np.int32)]

    places = written(_scan(docs, "anchor long, edge long, at int", k, edge_rows))
    edges = written(places.groupBy("anchor", "edge").agg(F.count(F.lit(1)).alias("n")))
    solid = places.join(edges.where("n > 1").drop("n"), ["anchor", "edge"]).select("doc_id", "text_hash", "at", F.lit(True).alias("solid"))

    branching = _twice(edges.select("anchor"), "anchor").select("anchor")
    second = shared(bitmap(branching, "anchor", bits))
    # windows on an edge that is surely none of these are known to repeat: they only count as the others' equals
    third = shared(bitmap(edges.where("n = 1").join(branching, "anchor"), "edge", bits))

    def window_rows(w: Windows) -> list[np.ndarray]:
        if not w.n:
            return [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, bool)]
        at = np.flatnonzero(in_bitmap(second.value, w.grams[w.anchor_of]))
        one, two = w.hashes(at)
        return [signed(one), signed(two), at.astype(np.int32), in_bitmap(third.value, w.edges(w.anchor_of[at]))]

    windows = written(_scan(docs, "one long, two long, at int, asked boolean", k, window_rows))
    asked = windows.where("asked").drop("asked")
    same = asked.join(_twice(windows, "one", "two").drop("n"), ["one", "two"]).select("doc_id", "text_hash", "at", F.lit(False).alias("solid"))
    at = F.col("at")
    return (
        solid.unionByName(same)
        .groupBy("doc_id", "text_hash")
        .agg(
            F.collect_set(F.when(F.col("solid"), at)).alias("anchors"),  # at most as many as the document has words
            F.collect_set(F.when(~F.col("solid"), at)).alias("windows"),
        )
    )


def without_repeats(docs: DataFrame, k: int = K, bits: int = BITS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text for every row of ``docs``."""
    places = repeated_places(docs, k, bits).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "anchors", "windows")
    rows = _rows(docs)
    met = rows.join(places, rows["doc_id"].eqNullSafe(places["_id"]) & (rows["text_hash"] == places["_hash"]), "left")
    schema = "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                out = []
                for doc_id, text, anchors, windows in zip(*batch.slice(begin, 256).columns, strict=True):
                    words = (text.as_py() or b"").split()
                    removed = 0
                    kept = words
                    if anchors.is_valid:
                        w = Windows(text.as_py(), k)
                        hit = np.isin(w.anchor_of, np.array(anchors.as_py(), np.int64))
                        hit[np.array(windows.as_py(), np.int64)] = True
                        steps = np.zeros(len(words) + 1, np.int64)
                        starts = np.flatnonzero(hit)
                        np.add.at(steps, starts, 1)
                        np.add.at(steps, starts + k, -1)
                        gone = np.cumsum(steps[:-1]) > 0
                        removed = int(gone.sum())
                        kept = [x for x, g in zip(words, gone.tolist(), strict=True) if not g]
                    line = b" ".join(kept)
                    out.append((doc_id.as_py(), len(words), removed, line.decode("utf-8", "replace"), hashlib.sha256(line).hexdigest()))
                columns = list(zip(*out, strict=True)) or [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                names = [x.split()[0] for x in schema.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return met.select("doc_id", "text", "anchors", "windows").mapInArrow(run, schema)
