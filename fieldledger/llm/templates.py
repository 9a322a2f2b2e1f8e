"""Benchmark decontamination by template canonicalisation.

Numbers, names and units of benchmark items and documents become typed placeholders, other words are
lower-cased without outer marks, so a question with other numbers or people keeps its template.
Windows of ``WIDTH`` template words are hashed and equi-joined. Window and item meet on a diagonal
(document position less item position); on it, the slots must be filled consistently: one item value
always stands for one document value and the other way round. Windows that hold a slot which contradicts
another one of the diagonal are taken away, the others are added up, and a document is contaminated by an item if at least ``MIN_SHARE`` of its windows are found.

Pairs of documents and items come only from the rarest windows of an item (fewest items have them):
a pair that reaches the share must hit one of these, so phrases that many items share make no pairs of
their own and yet count in the end. A bitmap of fixed size keeps document windows that no item has
out of the shuffle; the join is exact.

A name is a capitalised word inside a sentence, or one that opens a sentence or line and that the items do
not mainly write in lower case; words that the items have as names are names in any case of letters. Words of
``PLAIN`` are no names. A number has digits or is a number word. A unit is a word of ``UNITS`` right after a
number. A copy in lower case under a name that no item has keeps that name as a word. Items of fewer template words than a window are one window.
A window counts if at least ``LITERALS`` of its words are no placeholders. An item without any such window is found
where it is a whole text: all words equal, in any case. Items without words match nothing, nor do null and empty texts. Items
that differ only in the values of their placeholders are kin and are matched once. Documents and items are told apart by
id and text: repeated rows count once, different texts of one id, and those without id, are judged each by itself. A
very long text is laid out as a whole (about 200 bytes of memory a word). Empty tables give empty results. Other columns are
not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldledger.llm.common import CACHE_WORDS, RangeHash, bitmap, cut, in_bitmap, mixed, signed

WIDTH = 8
MIN_SHARE = 0.5
LITERALS = 4
BITS = 22
#: Units of measure in the plural and singular, as they follow a number.
UNITS = frozenset(
    "kg g mg lb lbs oz kilogram kilograms gram grams pound pounds ounce ounces t ton tons tonne tonnes "
    "km m cm mm mi ft in inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "l ml liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days "
    "week weeks month months year years mph kmh percent % € $ £ euro euros dollar dollars cent cents degree degrees".split()
)
#: Words that open sentences and are no names, number words and their tens.
PLAIN = frozenset(
    "a about after all also although an and another any are as at because before both but by can could did do does during each either every "
    "few find for from given had has have he her here his how however i if in is it its let many more most my no not of on once one only or other "
    "our she since so some such than that the their them then there these they this those though to under until was we were what when where which "
    "while who whose why will with would you your".split()
)
_TENS = "twenty thirty forty fifty sixty seventy eighty ninety"
_ONES = "one two three four five six seven eight nine"
NUMBERS = frozenset(
    f"zero {_ONES} ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen {_TENS} hundred thousand million billion dozen".split()
) | {f"{t}-{o}" for t in _TENS.split() for o in _ONES.split()}
_NUMBER, _NAME, _UNIT, _WORD = range(4)
_KINDS = "number", "name", "unit"
_OUTER = re.compile(r"^[^\w%€$£]+|[^\w%€$£]+$")
_IS_NUMBER = re.compile(r"^[€$£]?[+-]?\d+(?:[.,:/]\d+)*(\D{0,12})$")
_PART = 1 << 20  # bytes of texts laid out at a time; a longer text is one part
#: Width of the one window of an item that has no countable window: its whole text.
WHOLE = 0

_BYTES = np.arange(256)
_BLANK = np.isin(_BYTES, [9, 10, 11, 12, 13, 32])
_SMALL = (_BYTES >= 97) & (_BYTES <= 122)
_LARGE = (_BYTES >= 65) & (_BYTES <= 90)
#: Bytes that make a word odd, which is looked at by itself: digits, signs that belong to numbers, all but two-byte Latin letters.
_ODD = ((_BYTES >= 48) & (_BYTES <= 57)) | np.isin(_BYTES, list(b"_%$")) | (_BYTES >= 128)
_STOP = np.isin(_BYTES, list(b".!?:"))
_LATIN = 0xC3  # first byte of the letters from U+00C0 to U+00FF, two signs (second byte 0x97, 0xB7) aside
_LOWERED = np.where(_LARGE, _BYTES + 32, _BYTES).astype(np.uint64)


def _hashed(lowered: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """60 bits of hash of byte ranges of lower-cased text, above 4 empty ones."""
    sums = RangeHash(lowered + np.uint64(1), 0xC2B2AE3D27D4EB4F).of(start, end)
    made = mixed(sums ^ ((end - start).astype(np.uint64) << np.uint64(40)))
    return np.maximum(made >> np.uint64(4), np.uint64(1)) << np.uint64(4)


def _hashes_of(words: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    data = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64)
    return _hashed(data, np.concatenate([[0], ends[:-1]]), ends) if words else np.zeros(0, np.uint64)


def _listed(words: frozenset) -> np.ndarray:
    return np.sort(_hashes_of([w.encode() for w in words]))


def _among(hashes: np.ndarray, listed: np.ndarray) -> np.ndarray:
    return listed[np.minimum(np.searchsorted(listed, hashes), len(listed) - 1)] == hashes


_UNIT_HASHES, _PLAIN_HASHES, _NUMBER_HASHES = (_listed(x) for x in (UNITS, PLAIN, NUMBERS))


def _kind(core: str, lower: str) -> int:
    """1 number, 2 capitalised, 4 unit word."""
    number = _IS_NUMBER.match(core)
    if (number and (not number[1] or number[1].strip() in UNITS)) or lower in NUMBERS:
        return 1
    name = len(core) > 1 and core[0].isupper() and any(c.islower() for c in core[1:]) and lower not in PLAIN
    return (2 if name else 0) | (4 if lower in UNITS else 0)


class OddWords(dict):
    """word -> (hash, kind | 8 if it ends a sentence) of words that are looked at one by one; hash 0: nothing left."""

    def flags(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > CACHE_WORDS:
            self.clear()
        new = [w for w in dict.fromkeys(words) if w not in self]
        cores, kinds = [], []
        for word in new:
            text = word.decode("utf-8", "replace")
            core = _OUTER.sub("", text)
            lower = core.lower()
            cores.append(lower.encode())
            kinds.append((_kind(core, lower) if core else 0) | (8 if re.search(r"[.!?:]\W*$", text) else 0))
        hashes = np.where([len(c) > 0 for c in cores], _hashes_of(cores), np.uint64(0)) if new else []
        self.update(zip(new, zip(np.array(hashes, np.uint64).tolist(), kinds, strict=True), strict=True))
        found = [self[w] for w in words]
        return np.array([f[0] for f in found], np.uint64), np.array([f[1] for f in found], np.uint8)


class Templates:
    """Template words of texts laid one after the other (``data[offsets[i]:offsets[i + 1]]``).

    ``text`` (its number), ``hashes``, ``codes`` (hash or placeholder) and ``kinds`` of every word that is more than marks.
    ``seen``: bitmaps of the words that items mainly write in lower case and of those that they have as names.
    """

    def __init__(self, data: bytes, offsets: np.ndarray, odd: OddWords, seen: tuple[np.ndarray, np.ndarray] | None = None) -> None:
        self.data = data
        start, end, text, hashes, flags, ended = self._words(data, offsets, odd)
        real = np.flatnonzero(hashes)
        self.start, self.end, self.text, self.hashes = start[real], end[real], text[real], hashes[real]
        flags, after_end = flags[real], ended[real]
        number = flags & 1 > 0
        follows = np.zeros(len(real), bool)
        follows[1:] = number[:-1] & (self.text[1:] == self.text[:-1])
        self.capital, self.opens, self.number = flags & 2 > 0, after_end, number
        name = self.capital & ~after_end
        if seen is not None:
            name |= (self.capital & ~in_bitmap(seen[0], self.hashes)) | in_bitmap(seen[1], self.hashes)
        self.kinds = np.select([number, (flags & 4 > 0) & follows, name], [_NUMBER, _UNIT, _NAME], _WORD).astype(np.uint8)
        self.codes = np.where(self.kinds == _WORD, self.hashes >> np.uint64(4), self.kinds.astype(np.uint64))
        self.first = np.searchsorted(self.text, np.arange(len(offsets)))

    @staticmethod
    def _words(data: bytes, offsets: np.ndarray, odd: OddWords) -> tuple[np.ndarray, ...]:
        raw = np.frombuffer(data, np.uint8)
        inside = ~_BLANK[raw]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = offsets[:-1][offsets[:-1] < len(raw)]
        begins[edges] = inside[edges]
        start = np.flatnonzero(begins)
        if not len(start):
            none = np.zeros(0, np.int64)
            return none, none, none, none.astype(np.uint64), none.astype(np.uint8), none.astype(bool)
        end = start + np.add.reduceat(inside, start, dtype=np.int64)
        text = np.searchsorted(offsets, start, "right") - 1

        after = np.concatenate([[False], raw[:-1] == _LATIN])  # second byte of a letter
        sign = after & ((raw == 0x97) | (raw == 0xB7))
        second = after & ~sign
        lead = np.concatenate([second[1:], [False]])
        letter = _SMALL[raw] | _LARGE[raw] | second | lead
        large = second & (raw <= 0x9E)
        by_itself = np.logical_or.reduceat(_ODD[raw] & ~second & ~lead, start)
        lowered = _LOWERED[raw]
        lowered[large] += np.uint64(32)

        def before(what: np.ndarray) -> np.ndarray:
            return np.concatenate([[0], np.cumsum(what, dtype=np.int64)])

        count, spot = before(letter), np.append(np.flatnonzero(letter), 0)
        has = count[end] > count[start]
        core, stop = np.where(has, spot[count[start]], start), np.where(has, spot[count[end] - 1] + 1, start)
        hashes = np.where(has, _hashed(lowered, core, stop), np.uint64(0))
        small, stops, lines = before(_SMALL[raw] | (second & (raw > 0x9E))), before(_STOP[raw]), before(raw == 10)
        # a large letter or its first byte, and a small one after it
        capital = (_LARGE[raw[core]] | (lead[core] & large[np.minimum(core + 1, len(raw) - 1)])) & (small[stop] > small[core])
        number = _among(hashes, _NUMBER_HASHES)
        flags = np.where(number, 1, 2 * (capital & ~_among(hashes, _PLAIN_HASHES)) + 4 * _among(hashes, _UNIT_HASHES)).astype(np.uint8)
        flags[~has] = 0
        flags |= (8 * (stops[end] > stops[stop])).astype(np.uint8)
        some = np.flatnonzero(by_itself)
        hashes[some], flags[some] = odd.flags([data[a:b] for a, b in zip(start[some].tolist(), end[some].tolist(), strict=True)])
        ended = np.ones(len(start), bool)
        ended[1:] = (flags[:-1] & 8 > 0) | (lines[start[1:]] > lines[end[:-1]]) | (text[1:] != text[:-1])
        return start, end, text, hashes, flags, ended

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows of ``width`` with enough literal words, each inside one text."""
        n = len(self.codes) - width + 1
        if n < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        literal = np.concatenate([[0], np.cumsum(self.kinds == _WORD)])
        enough = literal[width:] - literal[:-width] >= min(LITERALS, width)
        start = np.flatnonzero(enough & (self.text[:n] == self.text[width - 1 :]))
        return start, mixed(RangeHash(mixed(self.codes)).of(start, start + width) + np.uint64(width))

    def wholes(self) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of the texts that have words, by all of their words as they are, without case."""
        lo, hi = self.first[:-1], self.first[1:]
        some = hi > lo
        lo, hi = lo[some], hi[some]
        return lo, mixed(RangeHash(mixed(self.hashes)).of(lo, hi) ^ ((hi - lo).astype(np.uint64) << np.uint64(32)))

    def slots(self, start: int, width: int) -> list[str]:
        """``kind value`` of the placeholders of one window, in order."""
        out = []
        for i in range(start, start + width):
            if self.kinds[i] != _WORD:
                value = _OUTER.sub("", self.data[self.start[i] : self.end[i]].decode("utf-8", "replace")).lower()
                out.append(f"{_KINDS[self.kinds[i]]} {value}")
        return out


def _parts(texts: pa.Array) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Whole texts of a batch, about ``_PART`` bytes at a time: number of the first, the bytes, where each begins (and the end)."""
    values = [x.as_py() or b"" for x in texts]
    bounds = np.concatenate([[0], np.cumsum([len(v) for v in values], dtype=np.int64)])
    at = 0
    while at < len(values):
        upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + _PART, "right")) - 1)
        yield at, b"".join(values[at:upto]), bounds[at : upto + 1] - bounds[at]
        at = upto


def _batch(rows: list[tuple], key: pa.Array, taken: list[int], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays([key.take(pa.array(taken, pa.int64())), *made], names)


def _named(rows: DataFrame, key: str, name: str) -> DataFrame:
    """``one`` (a number for id and text, and the id) and ``text`` of the distinct rows; null ids count as one id."""
    text = F.col("text").cast("binary").alias("text")
    one = F.struct(row_key(key).alias(name), F.col(key).cast("long").alias(key)).alias("one")
    return rows.select(one, text)


def row_key(key: str):
    """What tells rows apart: id and text."""
    return F.xxhash64(F.col(key).cast("long"), F.col("text").cast("binary"), F.col(key).isNull())


def item_words(benchmark: DataFrame, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of fixed size for ``Templates``: words mainly in lower case, words that are names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd = OddWords()
        for batch in batches:
            for _, data, offsets in _parts(batch.column(0)):
                t = Templates(data, offsets, odd)
                word = ~t.number
                lower, inside, opens = (x[word].astype(np.int64) for x in (~t.capital, t.capital & ~t.opens, t.capital & t.opens))
                yield pa.RecordBatch.from_arrays([pa.array(signed(t.hashes[word])), *map(pa.array, (lower, inside, opens))], ["h", "lower", "inside", "opens"])

    words = benchmark.select(F.col("text").cast("binary")).mapInArrow(run, "h long, lower long, inside long, opens long")
    sums = cut(words.groupBy("h").agg(*[F.sum(c).alias(c) for c in ("lower", "inside", "opens")]))
    common = sums.where((F.col("lower") > 0) & (F.col("lower") >= F.col("inside")))
    names = sums.where((F.col("inside") > F.col("lower")) | ((F.col("lower") == 0) & (F.col("opens") > 0)))
    return bitmap(common, "h", bits), bitmap(names, "h", bits)


def item_windows(benchmark: DataFrame, width: int = WIDTH, seen: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """item, item_id, kin, h, at, slots, width, n: the distinct windows of every item (a number for item_id and text); n of them.

    ``kin`` is equal for items of equal windows whose placeholders are equal to each other at the same places: such
    items match the same documents and differ in their values alone.
    """
    words = benchmark.sparkSession.sparkContext.broadcast(seen)
    layout = "one struct<item: long, item_id: long>, kin long, h long, at int, slots array<string>, width int, n int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd = OddWords()
        for batch in batches:
            rows, taken = [], []
            for i, text in enumerate(batch.column(1)):
                t = Templates(text.as_py() or b"", np.array([0, len(text.as_py() or b"")]), odd, words.value)
                own = min(width, len(t.codes))
                start, h = t.windows(own) if own >= LITERALS else t.windows(width)
                if not len(start) and len(t.codes):
                    own, (start, h) = WHOLE, t.wholes()
                _, first = np.unique(h, return_index=True)
                made = [(int(signed(h)[j]), int(start[j]), t.slots(int(start[j]), own)) for j in first.tolist()]
                number: dict[str, int] = {}
                shape = [(a, at, [number.setdefault(v, len(number)) for v in slots]) for a, at, slots in made]
                kin = xxhash.xxh64_intdigest(repr(shape), 7) - (1 << 63)
                rows += [(kin, *m, own, len(first)) for m in made]
                taken += [i] * len(made)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.string()), pa.int32(), pa.int32()]
            yield _batch(rows, batch.column(0), taken, ["one", "kin", "h", "at", "slots", "width", "n"], kinds)

    made = _named(benchmark, "item_id", "item").dropDuplicates(["one", "text"]).mapInArrow(run, layout)
    return made.select("one.*", "kin", "h", "at", "slots", "width", "n")


def document_windows(docs: DataFrame, widths: list[int], bits: np.ndarray, seen: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """doc (a number for doc_id and text), doc_id, h, at, slots of the windows that the bitmap lets through."""
    shared, words = docs.sparkSession.sparkContext.broadcast(bits), docs.sparkSession.sparkContext.broadcast(seen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd = OddWords()
        for batch in batches:
            for begin, data, offsets in _parts(batch.column(1)):
                t, rows, taken = Templates(data, offsets, odd, words.value), [], []
                for width in widths:
                    start, h = t.windows(width) if width != WHOLE else t.wholes()
                    hit = in_bitmap(shared.value, h)
                    start, h = start[hit], signed(h[hit])
                    text = t.text[start]
                    for s, x, i, at in zip(start.tolist(), h.tolist(), text.tolist(), (start - t.first[text]).tolist(), strict=True):
                        rows.append((x, at, t.slots(s, width)))
                        taken.append(begin + i)
                yield _batch(rows, batch.column(0), taken, ["one", "h", "at", "slots"], [pa.int64(), pa.int32(), pa.list_(pa.string())])

    made = _named(docs, "doc_id", "doc").mapInArrow(run, "one struct<doc: long, doc_id: long>, h long, at int, slots array<string>")
    return made.select("one.*", "h", "at", "slots").dropDuplicates(["doc", "h", "at"])


def kindred(items: DataFrame) -> DataFrame:
    """``items`` with one item of each kin, that of the smallest item_id, and ``members``, how many there are."""
    each = items.groupBy("kin", "item", "item_id").agg(F.lit(1).alias("one"))
    chosen = each.groupBy("kin").agg(F.min(F.struct(F.col("item_id").isNull(), "item_id", "item")).alias("first"), F.count("one").alias("members"))
    return items.join(chosen.select("kin", F.col("first.item").alias("item"), "members"), ["kin", "item"])


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, min_share: float = MIN_SHARE, bits: int = BITS) -> DataFrame:
    """One row for each contaminated document: its item with the largest share (ties: smallest id) and their number.

    doc_id, item_id, share, kind ('exact' if every slot has the item's value, else 'reparameterised'), n_items, and doc, a
    number for doc_id and text.
    """
    seen = item_words(benchmark)
    items = cut(kindred(cut(item_windows(benchmark, width, seen))))
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # at most ``width`` values
    found = document_windows(docs, widths, bitmap(items, "h", bits), seen)
    # only windows that an item has; rows of the item table are not multiplied into them
    found = cut(found.join(items.select("h").distinct(), "h", "left_semi"))

    # of an item's windows in order of rarity, a match of t of n hits one of the first n - t + 1
    held = items.groupBy("h").agg(F.count(F.lit(1)).alias("held"))
    ranked = items.join(held, "h").groupBy("item", "n").agg(F.array_sort(F.collect_list(F.struct("held", "h"))).alias("all"))
    need = F.greatest(F.lit(1), F.ceil(F.col("n") * F.lit(min_share))).cast("int")
    rare = ranked.select("item", F.explode(F.slice("all", F.lit(1), F.col("n") - need + 1)).alias("w")).select("item", F.col("w.h").alias("h"))
    pairs = found.select("doc", "h").distinct().join(rare, "h").select("doc", "item").distinct()

    wanted = pairs.join(items.select("item", "item_id", "members", "h", "n", F.col("at").alias("item_at"), F.col("slots").alias("item_slots")), "item")
    met = wanted.join(found, ["doc", "h"])
    filled = F.transform(F.arrays_zip("item_slots", "slots"), lambda s: F.struct(s["item_slots"].alias("i"), s["slots"].alias("d")))
    pair = ["doc", "doc_id", "item", "item_id", "members", "n"]
    diagonals = met.groupBy(*pair, (F.col("at") - F.col("item_at")).alias("diagonal")).agg(
        F.collect_list(F.struct("h", filled.alias("filled"))).alias("ws")  # at most the item's windows
    )
    diagonals = diagonals.withColumn("pairs", F.array_distinct(F.flatten(F.col("ws.filled"))))
    against = F.filter("pairs", lambda p: F.exists("pairs", lambda q: (p["i"] == q["i"]) != (p["d"] == q["d"])))
    same = F.forall("pairs", lambda p: p["i"] == p["d"])
    consistent = diagonals.withColumn("against", against).withColumn("same", same)
    hs = F.transform(F.filter("ws", lambda w: ~F.arrays_overlap(w["filled"], F.col("against"))), lambda w: w["h"])
    # an item found many times in one document counts each of its windows once
    shares = (
        consistent.select(*pair, "same", F.explode(hs).alias("h"))
        .groupBy(*pair, "h")
        .agg(F.max("same").alias("same"))
        .groupBy(*pair)
        .agg(F.count(F.lit(1)).alias("hits"), F.min("same").alias("same"))
        .where(F.col("hits") >= need)
        .withColumn("share", F.col("hits") / F.col("n"))
    )
    best = F.max_by(F.struct("item_id", "share", "same"), F.struct("share", -F.col("item_id"), "item"))
    return shares.groupBy("doc", "doc_id").agg(best.alias("best"), F.sum("members").alias("n_items")).select(
        "doc_id",
        F.col("best.item_id").alias("item_id"),
        F.col("best.share").alias("share"),
        F.when(F.col("best.same"), "exact").otherwise("reparameterised").alias("kind"),
        "n_items",
        "doc",
    )


def clean(docs: DataFrame, benchmark: DataFrame, **options: float) -> DataFrame:
    """The rows of ``docs`` whose document (doc_id and text) is not contaminated."""
    gone = contaminated(docs, benchmark, **options).select(F.col("doc").alias("_gone")).distinct()
    return docs.join(gone, row_key("doc_id") == gone["_gone"], "left_anti")
