"""Helpers shared by the corpus operators: words, word hashes, checkpoints, membership bitmaps."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldledger.session import work_dir

#: Words as the contracts define them. ``bytes.split()`` cuts UTF-8 at exactly these six characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Word caches of a Python worker are emptied at this many entries (about 40 MB).
CACHE_WORDS = 300_000
_BITMAP_BITS = 32_768  # bits in one value of bitmap_construct_agg


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there.

    The folder is ``spark.checkpoint.dir``. Only where that is unset (tests) is one made.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(named or work_dir(spark, "checkpoint"))
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Like ``cut``, as a Parquet table beside the checkpoints: columns compressed and read as needed."""
    path = work_dir(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class WordCodes(dict):
    """word -> code, filled on first use and emptied when full, so that memory stays bounded."""

    def __init__(self, code: Callable[[bytes], int], limit: int = CACHE_WORDS) -> None:
        super().__init__()
        self._code, self._limit = code, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self._limit:
            self.clear()
        value = self[word] = self._code(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads uint64 values, so that comparing them is an arbitrary but fixed order."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BLANKS = re.compile(rb"[\x09-\x0d\x20]")
_PART = 1 << 18


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, from its bytes and without making the words."""
    if len(text) <= _PART:
        return _hashes(np.frombuffer(text, np.uint8))
    found, at = [], 0
    while at < len(text):  # parts end at a blank
        blank = _BLANKS.search(text, min(len(text), at + _PART))
        end = blank.end() if blank else len(text)
        found.append(_hashes(np.frombuffer(text[at:end], np.uint8)))
        at = end
    return np.concatenate(found)


def _hashes(data: np.ndarray) -> np.ndarray:
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(_BLANK[data], out=inside[1:-1])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = turns[::2], turns[1::2]
    sums = RangeHash(data.astype(np.uint64) + np.uint64(1), 0xC2B2AE3D27D4EB4F)
    return mixed(sums.of(start, end) ^ ((end - start).astype(np.uint64) << np.uint64(40)))


class RangeHash:
    """Polynomial hashes of any word range of one sequence in constant time each.

    Prefix sums of ``code * base**i`` modulo 2**64; an odd base has an inverse, so the
    difference of two prefixes is brought back to exponent zero.
    """

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, codes: np.ndarray, base: int = 0x9E3779B97F4A7C15) -> None:
        up, self._down = self._tables(base, len(codes) + 1)
        self._sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * up[: len(codes)], out=self._sums[1:])

    @classmethod
    def _tables(cls, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if base not in cls._powers or len(cls._powers[base][0]) < n:
            size = max(4096, 1 << (n - 1).bit_length())
            made = []
            for value in (base, pow(base, -1, 1 << 64)):
                steps = np.full(size, value, np.uint64)
                steps[0] = 1
                made.append(np.cumprod(steps, dtype=np.uint64))
            cls._powers[base] = (made[0], made[1])
        return cls._powers[base]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self._sums[end] - self._sums[start]) * self._down[start]


def bitmap(df: DataFrame, hash_column: str, log2_bits: int) -> np.ndarray:
    """Bits set for the top ``log2_bits`` of each hash: 2**log2_bits / 8 bytes, whatever the input.

    A hash whose bit is not set is certainly absent, so the bitmap only narrows what is
    shuffled to an exact join; its size is a parameter and does not grow with the data.
    """
    bit = F.shiftrightunsigned(hash_column, 64 - log2_bits) + 1
    parts = (
        df.select(bit.alias("bit"))
        .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    )
    out = np.zeros((1 << log2_bits) // 8, np.uint8)
    width = _BITMAP_BITS // 8
    for bucket, bits in parts.collect():  # at most 2**log2_bits / 32768 rows
        at = (bucket - 1) * width
        out[at : at + width] = np.frombuffer(bits, np.uint8)[: len(out) - at]
    return out


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    log2_bits = (len(bits) * 8).bit_length() - 1
    at = hashes >> np.uint64(64 - log2_bits)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
