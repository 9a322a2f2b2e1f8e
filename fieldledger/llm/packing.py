"""Token ids packed into rows of fixed length by best fit decreasing.

Texts become token ids with an end token each. A document of more ids than a row is split, without
loss, into full pieces and a rest. Pieces are packed in blocks: in each, by decreasing length, a piece
goes to the open row whose free space fits it best, found in a segment tree over the capacities.
A block is a run of documents of one input partition, so nothing is shuffled, memory is bounded by
``BLOCK`` ids and a lost task is simply done again.

A row has ``input_ids`` (little-endian int32, padded with the end token), ``used``, ``cu_seqlens``
(cumulative segment lengths from 0), ``position_resets`` (where a new segment starts counting from its
``offset`` in the document) and ``segments`` (doc_id, piece, offset, length), which give every document back.

Null and empty texts are a lone end token. Repeated rows are packed each. Null doc_ids stay null in
``segments``. An empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW = 2048
BLOCK = 1 << 21
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50256
#: Fixed value: how byte-level vocabularies of this family cut a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_PIECES = 400_000
SCHEMA = (
    "pack_id long, input_ids binary, used int, cu_seqlens array<int>, position_resets array<int>, "
    "segments array<struct<doc_id: long, piece: int, offset: int, length: int>>"
)


class Tokenizer(dict):
    """Ids (as little-endian int32 bytes) of the pieces between spaces, kept until the cache is full.

    A text is cut before each single space that a character follows; the vocabulary's own cuts fall
    there too, so the ids are those of the whole text. Texts with runs of spaces are encoded whole.
    """

    def __init__(self, vocabulary: bytes) -> None:
        import tiktoken

        super().__init__()
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
        self._encoding = tiktoken.Encoding("packing", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})

    def whole(self, text: str) -> np.ndarray:
        return np.array(self._encoding.encode_ordinary(text), np.int32)

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_PIECES:
            self.clear()
        value = self.whole(piece).tobytes()
        if len(piece) <= 64:
            self[piece] = value
        return value

    def ids(self, text: str) -> np.ndarray:
        if "  " in text:
            return self.whole(text)
        first, *rest = text.split(" ")
        if rest and not rest[-1]:
            return self.whole(text)
        return np.frombuffer(b"".join([self[first], *[self[" " + x] for x in rest]]), np.int32)


class Capacities:
    """Open rows by free space; a segment tree finds the least free space that is enough."""

    def __init__(self, row: int) -> None:
        self._leaves = 1 << row.bit_length()
        self._open = bytearray(2 * self._leaves)
        self._rows: dict[int, list[int]] = defaultdict(list)

    def put(self, free: int, row: int) -> None:
        self._rows[free].append(row)
        node = free + self._leaves
        while node and not self._open[node]:
            self._open[node] = 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(free, row) of the fullest open row with at least ``need`` free, now closed."""
        node = need + self._leaves
        if not self._open[node]:
            while node > 1 and (node & 1 or not self._open[node + 1]):  # up, until something open is to the right
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self._leaves:
                node = 2 * node if self._open[2 * node] else 2 * node + 1
        free = node - self._leaves
        row = self._rows[free].pop()
        if not self._rows[free]:
            self._open[node] = 0
            node >>= 1
            while node and not (self._open[2 * node] or self._open[2 * node + 1]):
                self._open[node] = 0
                node >>= 1
        return free, row


def best_fit_decreasing(lengths: list[int], row: int) -> list[list[int]]:
    """Pieces (by number, each of 1 to ``row``) of each row."""
    rows: list[list[int]] = []
    capacities = Capacities(row)
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        free, at = capacities.take(lengths[piece]) or (row, len(rows))
        if at == len(rows):
            rows.append([])
        rows[at].append(piece)
        if free > lengths[piece]:
            capacities.put(free - lengths[piece], at)
    return rows


def pack(docs: DataFrame, row: int = ROW, tokenizer: str = TOKENIZER, block: int = BLOCK) -> DataFrame:
    """Packed rows of every whole text of ``docs``. ``tokenizer`` is read on the driver and sent along."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tokenizer(vocabulary.value)
        number = TaskContext.get().partitionId() << 33
        pieces: list[tuple[int | None, int, int, np.ndarray]] = []
        held = 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal number, held
            rows = best_fit_decreasing([len(p[3]) for p in pieces], row)
            for begin in range(0, len(rows), 512):
                ids, used, ends, resets, segments, numbers = [], [], [], [], [], []
                for members in rows[begin : begin + 512]:
                    chosen = [pieces[i] for i in members]
                    bounds = np.cumsum([0, *[len(p[3]) for p in chosen]])
                    filled = np.full(row, END, "<i4")
                    filled[: bounds[-1]] = np.concatenate([p[3] for p in chosen])
                    ids.append(filled.tobytes())
                    used.append(int(bounds[-1]))
                    ends.append(bounds.tolist())
                    resets.append(bounds[:-1].tolist())
                    segments.append([dict(doc_id=p[0], piece=p[1], offset=p[2], length=len(p[3])) for p in chosen])
                    numbers.append(number)
                    number += 1
                segment = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("offset", pa.int32()), ("length", pa.int32())])
                kinds = [pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(segment)]
                names = ["pack_id", "input_ids", "used", "cu_seqlens", "position_resets", "segments"]
                columns = [numbers, ids, used, ends, resets, segments]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
            pieces.clear()
            held = 0

        for batch in batches:
            for doc_id, text in zip(*batch.columns, strict=True):
                ids = np.append(known.ids(text.as_py() or ""), np.int32(END))
                for piece, offset in enumerate(range(0, len(ids), row)):
                    pieces.append((doc_id.as_py(), piece, offset, ids[offset : offset + row]))
                held += len(ids)
                if held >= block:
                    yield from packed()
        if pieces:
            yield from packed()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)
