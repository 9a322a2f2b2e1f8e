"""Secret scans: fixed patterns, and a linear-chain conditional random field for what they do not name.

Patterns (``base``) are looked for per kind, leftmost and without overlap; matches that are too short are
dropped. The field tags the words of a text as begin, inside or outside of a secret, by

* the shape of the word (length, classes of characters, hex digits, changes between letters and digits, quotes),
* the words before and after it (their letters and their shapes), and
* the file (its length, its share of words with digits and with signs),

and the best tags of the whole text are found by Viterbi. It learns from texts whose words are tagged by the patterns;
the identity of keywords is hidden in half of these windows, so that shape and context have to carry the tags.

Decoding is exact and skips plain prose: a word whose margin for "outside" exceeds all that other tags could gain
around it (``_sure``) is outside on some best path, so the text falls into short runs between such words, and runs of
equal length are decoded at a time.

Spans are code point ranges, end exclusive. A word of the field is cut to its characters of ``[A-Za-z0-9+/_.=-]``. A span of the field
that overlaps a base span is not given, that secret is known already. Null and empty texts have no spans. A very long
text is scanned as a whole and needs memory for its own words. Repeated rows are scanned each by itself, with equal results; rows without doc_id too. Without a base match in the
sample there is nothing to learn from, and only base spans are found. Empty tables give empty results; other columns
are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldledger.llm.common import RangeHash, cut, mixed

#: Fixed by the contract: base kinds, in order, with their patterns.
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{24,}")
_KEYWORDS = b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"
KINDS = "assign", "access", "hex", "field"
#: Bounds of the training sample: texts looked at, windows with and without secrets, words on either side of a secret.
SAMPLE_TEXTS, WITH_SECRET, WITHOUT, AROUND = 20_000, 1_000, 2_000, 10
BUCKETS = 4096
_O, _B, _I = range(3)
_NEVER = -1e4
_ALLOWED = re.compile(rb"[A-Za-z0-9+/_.=-]+")
_PART = 1 << 20  # bytes of texts decoded at a time; a longer text is one part


# Base --------------------------------------------------------------------


def base(text: bytes) -> list[tuple[int, int, int]]:
    """(start, end, number of the kind) of the fixed patterns as byte ranges, sorted."""
    found = []
    small = text.lower()
    if any(k in small for k in _KEYWORDS):
        found += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if b"AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2]))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, end, kind in spans)


def in_code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte ranges as ranges of code points."""
    if not spans or text.isascii():
        return spans
    heads = np.concatenate([[0], np.cumsum(np.frombuffer(text, np.uint8) & 0xC0 != 0x80)])
    return [(int(heads[a]), int(heads[b]), kind) for a, b, kind in spans]


# Features ----------------------------------------------------------------

_BYTES = np.arange(256, dtype=np.uint8)


def _is(chars: bytes) -> np.ndarray:
    return np.isin(_BYTES, np.frombuffer(chars, np.uint8))


_LOWER_CASE, _UPPER_CASE, _DIGIT = (_is(bytes(range(a, b + 1))) for a, b in ((97, 122), (65, 90), (48, 57)))
_BLANK, _LETTER = _is(b" \t\n\x0b\x0c\r"), _LOWER_CASE | _UPPER_CASE
#: Counters of 16 bits side by side: characters of a word that are lower, upper, digits, allowed signs; hex digits and others.
_FIRST = sum(c.astype(np.uint64) << np.uint64(16 * i) for i, c in enumerate((_LOWER_CASE, _UPPER_CASE, _DIGIT, _is(b"+/_.=-"))))
_SECOND = sum(c.astype(np.uint64) << np.uint64(16 * i) for i, c in enumerate((_is(b"0123456789abcdef"), _BYTES >= 128)))
_OUTER = sum(_is(c).astype(np.uint8) << i for i, c in enumerate((b"\"'`", b":=<>", b"(){}[]", b",;#*$%&!?|@~^")))
_SMALL = np.where(_UPPER_CASE, _BYTES + 32, _BYTES).astype(np.uint64)
_SIZES = np.array([1, 3, 6, 10, 16, 24, 40])
#: Radices of a shape: size, mix of classes, share of digits, hex digits only, changes, signs around.
_RADICES = (8, 32, 5, 2, 5, 16)
SHAPES = int(np.prod(_RADICES))
#: Features of a shape, each a product of fields; as a word's own and as its neighbour's.
_OWN_FIELDS = ((), (0,), (1,), (2, 0), (3, 0), (4, 0), (5,), (1, 0), (5, 0))
_NEAR_FIELDS = ((1, 0), (5,), (3, 0))


def word_table(data: np.ndarray, starts_of_texts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the words of texts laid one after the other: start, end (bytes), shape, bucket of the letters, number of the text."""
    inside = ~_BLANK[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    texts = starts_of_texts[starts_of_texts < len(data)]
    begins[texts] = inside[texts]
    start = np.flatnonzero(begins)
    none = np.zeros(0, np.int64)
    if not len(start):
        return none, none, none, none, none
    first = np.add.reduceat(_FIRST[data], start)
    second = np.add.reduceat(_SECOND[data], start)
    outer = np.bitwise_or.reduceat(_OUTER[data], start).astype(np.int64)
    length = np.add.reduceat(inside, start, dtype=np.int64)
    digit = _DIGIT[data]
    change = np.zeros(len(data), bool)
    change[1:] = (digit[1:] & _LETTER[data[:-1]]) | (digit[:-1] & _LETTER[data[1:]])
    change[start] = False
    turns = np.add.reduceat(change, start, dtype=np.int64)
    lower, upper, digits, signs = ((first >> np.uint64(16 * i) & np.uint64(0xFFFF)).astype(np.int64) for i in range(4))
    hexes, other = ((second >> np.uint64(16 * i) & np.uint64(0xFFFF)).astype(np.int64) for i in range(2))
    core = lower + upper + digits + signs
    plain = np.maximum(1, core)
    fields = (
        np.searchsorted(_SIZES, core, "right"),
        (lower > 0) + 2 * (upper > 0) + 4 * (digits > 0) + 8 * (signs > 0) + 16 * (other > 0),
        np.minimum(4, 4 * digits // plain),
        ((hexes > 0) & (hexes == lower + upper + digits)).astype(np.int64),
        np.minimum(4, 8 * turns // plain),
        outer,
    )
    shape = np.zeros(len(start), np.int64)
    for radix, field in zip(_RADICES, fields, strict=True):
        shape = shape * radix + field
    end = start + length
    sums = RangeHash(_SMALL[data] + np.uint64(1))
    bucket = 1 + (mixed(sums.of(start, end)) % np.uint64(BUCKETS - 1)).astype(np.int64)
    return start, end, shape, bucket, np.searchsorted(starts_of_texts, start, "right") - 1


def _rows(shape: np.ndarray, features: tuple) -> np.ndarray:
    """Weight rows of shapes, one for each feature."""
    fields = []
    for radix in reversed(_RADICES):
        fields.insert(0, shape % radix)
        shape = shape // radix
    out, offset = [], 0
    for feature in features:
        row = np.zeros_like(fields[0])
        for f in feature:
            row = row * _RADICES[f] + fields[f]
        out.append(row + offset)
        offset += int(np.prod([_RADICES[f] for f in feature]))
    return np.stack(out, axis=-1)


def _rows_of(features: tuple) -> int:
    return sum(int(np.prod([_RADICES[f] for f in feature])) for feature in features)


def file_rows(words: np.ndarray, with_digits: np.ndarray, with_signs: np.ndarray) -> np.ndarray:
    """Weight rows of a file, from its numbers of words, of those with digits and of those with signs."""
    some = np.maximum(1, words)
    sizes = np.searchsorted(np.array([10, 30, 100, 300, 1000, 3000, 10_000]), words, "right")
    return np.stack([sizes, 8 + np.minimum(15, 40 * with_digits // some), 24 + np.minimum(15, 40 * with_signs // some)], axis=-1)


FILE_ROWS = 40


def _with_digits(shape: np.ndarray) -> np.ndarray:
    return _rows(shape, ((1,),))[..., 0] & 4 > 0


def _with_signs(shape: np.ndarray) -> np.ndarray:
    return _rows(shape, ((5,),))[..., 0] > 0


@dataclass
class Field:
    """Scores for the three tags (``[..., 3]``) of shapes and of word buckets, as the word itself, the word before and the
    word after (``[..., 9]``), of files, and of one tag after another (first index: the tag before)."""

    shapes: np.ndarray
    words: np.ndarray
    file: np.ndarray
    steps: np.ndarray


# Decoding ----------------------------------------------------------------


def emissions(shape: np.ndarray, bucket: np.ndarray, text: np.ndarray, texts: int, field: Field) -> np.ndarray:
    """Scores (n, 3) of all words of the texts; a word has no neighbours in other texts."""
    scores = field.shapes[shape] + field.words[bucket]
    out = scores[:, :3].astype(np.float64)
    same = (text[1:] == text[:-1])[:, None]
    out[1:] += scores[:-1, 3:6] * same
    out[:-1] += scores[1:, 6:9] * same
    counts = [np.bincount(text, x, texts).astype(np.int64) for x in (None, _with_digits(shape), _with_signs(shape))]
    return out + field.file[file_rows(*counts)].sum(1)[text]


def _sure(scores: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Words that are outside on some best path, whatever their neighbours are.

    Take a path with another tag at t, and put "outside" there. The emission gains the margin. The step to t loses at
    most ``lead``. If the next tag is no "inside", the step from t loses at most ``trail``; if it is, it becomes "begin", which
    costs its emission's difference, the step to it and the step after it.
    """
    real = steps[:, :]
    lead = max(float((real[a] - real[a, _O]).max()) for a in range(3))
    trail = max(float((real[a, [_O, _B]] - real[_O, [_O, _B]]).max()) for a in (_B, _I))
    turned = float(max(real[_B, _I], real[_I, _I]) - real[_O, _B]) + float((real[_I] - real[_B]).max())
    margin = scores[:, _O] - scores[:, 1:].max(1)
    next_gain = np.zeros(len(scores))
    next_gain[:-1] = scores[1:, _I] - scores[1:, _B]
    return margin > lead + np.maximum(trail, turned + next_gain) + 1e-6


def viterbi(scores: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Best tags of many sequences of one length: scores (sequences, length, 3); before and after them is outside."""
    count, length, _ = scores.shape
    best = scores[:, 0] + steps[_O]
    came = np.zeros((count, length, 3), np.int8)
    for t in range(1, length):
        reached = best[:, :, None] + steps[None]
        came[:, t] = reached.argmax(1)
        best = reached.max(1) + scores[:, t]
    tags = np.zeros((count, length), np.int8)
    tags[:, -1] = (best + steps[:, _O]).argmax(1)
    for t in range(length - 1, 0, -1):
        tags[:, t - 1] = came[np.arange(count), t, tags[:, t]]
    return tags


def decode(scores: np.ndarray, text: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Best tags of the words of texts laid one after the other, each with outside before and after it."""
    tags = np.zeros(len(scores), np.int8)
    if not len(scores):
        return tags
    open_ = ~_sure(scores, steps)
    edge = np.concatenate([[True], text[1:] != text[:-1], [True]])
    # runs of open words, cut where a text begins
    first = np.flatnonzero(open_ & (np.concatenate([[True], ~open_[:-1]]) | edge[:-1]))
    last = np.flatnonzero(open_ & (np.concatenate([~open_[1:], [True]]) | edge[1:]))
    lengths = last - first + 1
    for length in np.unique(lengths).tolist():
        some = first[lengths == length]
        for at in range(0, len(some), max(1, _PART // length)):
            place = some[at : at + max(1, _PART // length), None] + np.arange(length)
            tags[place] = viterbi(scores[place], steps)
    return tags


# Training ----------------------------------------------------------------


def _spread(rows: np.ndarray, parts: np.ndarray, size: int) -> np.ndarray:
    """Each part (.., 3) added to all of its weight rows (.., features)."""
    flat = rows.reshape(-1)
    repeated = np.repeat(parts.reshape(-1, 3), rows.shape[-1], axis=0)
    return np.stack([np.bincount(flat, repeated[:, k], size) for k in range(3)], axis=1)


def gradient(weights: list[np.ndarray], rows: list[np.ndarray], file: np.ndarray, tags: np.ndarray, real: np.ndarray, penalty: float) -> tuple[float, list[np.ndarray]]:
    """Negative log likelihood of the tagged windows, for each window, and its gradient, by forward and backward sums.

    weights: for each of ``rows`` (n, length, features), for ``file`` (n, features), and the steps; real: which words exist.
    """
    *lists, w_file, steps = weights
    n, length = tags.shape
    scores = sum(w[r].sum(2) for w, r in zip(lists, rows, strict=True)) + w_file[file].sum(1)[:, None]
    scores = np.where(real[:, :, None], scores, np.array([0.0, _NEVER, _NEVER]))
    forward = np.zeros((n, length, 3))
    backward = np.zeros((n, length, 3))
    forward[:, 0] = scores[:, 0] + steps[_O]
    for t in range(1, length):
        forward[:, t] = np.logaddexp.reduce(forward[:, t - 1, :, None] + steps[None], axis=1) + scores[:, t]
    backward[:, -1] = steps[:, _O]
    for t in range(length - 2, -1, -1):
        backward[:, t] = np.logaddexp.reduce(steps[None] + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
    total = np.logaddexp.reduce(forward[:, -1] + steps[:, _O], axis=1)
    given = np.eye(3)[tags]
    miss = (np.exp(forward + backward - total[:, None, None]) - given) * real[:, :, None]

    chance = np.exp(forward + backward - total[:, None, None])
    step = np.zeros((3, 3))
    step[_O] += chance[:, 0].sum(0) - given[:, 0].sum(0)
    step[:, _O] += chance[:, -1].sum(0) - given[:, -1].sum(0)
    for t in range(1, length):
        pair = forward[:, t - 1, :, None] + steps[None] + (scores[:, t] + backward[:, t])[:, None, :] - total[:, None, None]
        step += np.exp(pair).sum(0) - given[:, t - 1].T @ given[:, t]
    path = (scores * given).sum((1, 2)) + steps[_O, tags[:, 0]] + steps[tags[:, -1], _O] + steps[tags[:, :-1], tags[:, 1:]].sum(1)
    loss = float((total - path).sum()) / n
    grads = [_spread(r, miss, len(w)) for w, r in zip(lists, rows, strict=True)]
    grads += [_spread(file, miss.sum(1), len(w_file)), step]
    free = [np.where(w <= _NEVER / 2, 0.0, w) for w in weights]
    loss += penalty / 2 * sum(float((w**2).sum()) for w in free)
    return loss, [g / n + penalty * w for g, w in zip(grads, free, strict=True)]


def fit(shape, bucket, file, tags, real, rounds: int = 60, penalty: float = 2e-4, rate: float = 0.2) -> Field:
    """The field of the tagged windows. ``shape`` and ``bucket`` have one more word on either side (shape -1: none)."""
    blank = shape < 0
    own, near = (_rows(np.maximum(shape, 0), f) for f in (_OWN_FIELDS, _NEAR_FIELDS))
    near = np.where(blank[..., None], _rows_of(_NEAR_FIELDS), near)  # a last row without weight
    named = bucket[..., None]
    rows = [own[:, 1:-1], near[:, :-2], near[:, 2:], named[:, 1:-1], named[:, :-2], named[:, 2:]]
    heights = [_rows_of(_OWN_FIELDS), *[_rows_of(_NEAR_FIELDS) + 1] * 2, *[BUCKETS] * 3, FILE_ROWS]
    weights = [np.zeros((h, 3)) for h in heights] + [np.zeros((3, 3))]
    steps = weights[-1]
    steps[_O, _I] = _NEVER
    means, squares = ([np.zeros_like(w) for w in weights] for _ in range(2))
    for k in range(1, rounds + 1):
        _, grads = gradient(weights, rows, file, tags, real, penalty)
        for w, g, m, s in zip(weights, grads, means, squares, strict=True):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w -= rate * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.99**k)) + 1e-8)
        steps[_O, _I] = _NEVER
        for w in weights[1:3]:
            w[-1] = 0
        for w in weights[3:6]:
            w[0] = 0  # no word, or a hidden one
    every = np.arange(SHAPES)
    own, near = _rows(every, _OWN_FIELDS), _rows(every, _NEAR_FIELDS)
    shapes = np.concatenate([weights[0][own].sum(1), weights[1][near].sum(1), weights[2][near].sum(1)], axis=1)
    return Field(shapes.astype(np.float32), np.concatenate(weights[3:6], axis=1).astype(np.float32), weights[6], steps)


def _tagged(text: bytes) -> tuple[tuple[np.ndarray, ...], np.ndarray, list[tuple[int, int]]]:
    """Words of a text, their tags by the base patterns, and the word ranges of the secrets."""
    words = word_table(np.frombuffer(text, np.uint8), np.array([0]))
    tags = np.zeros(len(words[0]), np.int8)
    merged: list[list[int]] = []
    for start, end, _ in base(text):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    ranges = []
    for start, end in merged:
        lo, hi = int(np.searchsorted(words[1], start, "right")), int(np.searchsorted(words[0], end, "left"))
        if ranges and lo < ranges[-1][1]:  # two secrets in one word
            lo = ranges.pop()[0]
        tags[lo:hi], tags[lo] = _I, _B
        ranges.append((lo, hi))
    return words, tags, ranges


_LETTERS = (b"0123456789abcdef", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")


def _drawn(word: bytes, mark: int) -> bytes:
    """The word with another secret in place of its longest run of allowed characters."""
    run = max(_ALLOWED.finditer(word), key=lambda m: m.end() - m.start())
    draw = np.random.default_rng(mark)
    letters = np.frombuffer(_LETTERS[int(draw.integers(len(_LETTERS)))], np.uint8)
    return word[: run.start()] + letters[draw.integers(0, len(letters), int(draw.integers(12, 48)))].tobytes() + word[run.end() :]


def _window(text: bytes, words: tuple[np.ndarray, ...], tags: np.ndarray, first: int, mark: int | None) -> dict:
    """Shapes and buckets of ``2 * AROUND`` words from ``first`` on and of one more on either side.

    With ``mark``, words have no buckets, and the longest word of every secret holds a secret drawn anew.
    """
    start, end, shapes, buckets, _ = words
    length = 2 * AROUND
    shape, bucket = np.full(length + 2, -1, np.int64), np.zeros(length + 2, np.int64)
    given, real = np.zeros(length, np.int8), np.zeros(length, bool)
    lo, hi = max(0, first - 1), min(len(start), first + length + 1)
    at = np.arange(lo, hi) - first + 1
    shape[at], bucket[at] = shapes[lo:hi], buckets[lo:hi]
    inner = at[(at >= 1) & (at <= length)]
    given[inner - 1], real[inner - 1] = tags[inner - 1 + first], True
    given[: int(np.argmax(given != _I)) if (given != _I).any() else length] = _O  # a window does not begin inside a secret
    if mark is not None:
        bucket[:] = 0
        for b in np.flatnonzero(given == _B).tolist():
            e = b + 1
            while e < length and given[e] == _I:
                e += 1
            spots = [i + first for i in range(b, e)]
            longest = max(spots, key=lambda i: end[i] - start[i])
            word = text[start[longest] : end[longest]]
            if _ALLOWED.search(word):
                shape[longest - first + 1] = word_table(np.frombuffer(_drawn(word, mark), np.uint8), np.array([0]))[2][0]
    counts = [np.array([x]) for x in (len(start), int(_with_digits(shapes).sum()), int(_with_signs(shapes).sum()))]
    return {"shape": shape.tolist(), "bucket": bucket.tolist(), "tags": given.tolist(), "real": real.tolist(), "file": file_rows(*counts)[0].tolist()}


def windows(texts: DataFrame) -> DataFrame:
    """shape, bucket, tags, real, file, secret, place: training windows of a frame with a column ``text``.

    A text gives a window around each of its first four secrets, or one at a place that its hash names. In half of the
    windows words are hidden and secrets drawn anew.
    """
    layout = "shape array<int>, bucket array<int>, tags array<int>, real array<boolean>, file array<int>, secret boolean, place long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x in batch.column(0):
                text = x.as_py()
                words, tags, ranges = _tagged(text)
                if not len(tags):
                    continue
                mark = xxhash.xxh64_intdigest(text, 12)
                starts = [a - AROUND + (mark >> (4 * k) & 7) - 3 for k, (a, _) in enumerate(ranges[:4])] or [mark % len(tags) - AROUND]
                for k, first in enumerate(starts):
                    made = _window(text, words, tags, first, mark + k if mark >> (32 + k) & 1 else None)
                    rows.append({**made, "secret": bool(ranges), "place": (mark + k) % 2**62})
            ints = pa.list_(pa.int32())
            kinds = {"shape": ints, "bucket": ints, "tags": ints, "real": pa.list_(pa.bool_()), "file": ints, "secret": pa.bool_(), "place": pa.int64()}
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in kinds.items()], list(kinds))

    return texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, layout)


def train(docs: DataFrame, texts: int = SAMPLE_TEXTS, with_secret: int = WITH_SECRET, without: int = WITHOUT) -> Field | None:
    """A field fitted on a bounded sample: distinct texts whose hash falls into a share that gives about ``texts`` of them."""
    filled = docs.select(F.col("text").cast("string").alias("text")).where(F.length("text") > 0)
    share = min(1.0, texts / max(1, filled.count()))
    chosen = filled.where(F.shiftrightunsigned(F.xxhash64(F.lit(12), "text"), 12) < F.lit(int(share * 2**52)))
    made = cut(windows(chosen.distinct()))
    order = ["place", "shape", "bucket"]
    taken = made.where("secret").orderBy(*order).limit(with_secret).collect()
    if not taken:
        return None
    rows = taken + made.where("NOT secret").orderBy(*order).limit(without).collect()
    shape, bucket, file, tags, real = (np.array([r[c] for r in rows]) for c in ("shape", "bucket", "file", "tags", "real"))
    return fit(shape, bucket, file, tags, real)


# Scanning ----------------------------------------------------------------


def _runs(tags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of each tagged secret."""
    first = np.flatnonzero(tags == _B)
    ends = np.flatnonzero((tags != _O) & (np.concatenate([tags[1:], [_O]]) != _I))
    return first, ends


def scan(data: bytes, offsets: np.ndarray, field: Field | None) -> list[tuple[list, list]]:
    """Base spans and all spans of the texts ``data[offsets[i]:offsets[i + 1]]``, in code points."""
    own: dict[int, list[tuple[int, int, int]]] = {}
    if field is not None:
        start, end, shape, bucket, text = word_table(np.frombuffer(data, np.uint8), offsets[:-1])
        tags = decode(emissions(shape, bucket, text, len(offsets) - 1, field), text, field.steps)
        for a, b in zip(*(x.tolist() for x in _runs(tags)), strict=True):
            inside = [m.span() for m in _ALLOWED.finditer(data, start[a], end[b])]
            if inside:
                at = int(offsets[text[a]])
                own.setdefault(int(text[a]), []).append((inside[0][0] - at, inside[-1][1] - at, 3))
    out = []
    for i, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        part = data[lo:hi]
        fixed = base(part)
        new = [s for s in own.get(i, []) if not any(s[0] < e and b < s[1] for b, e, _ in fixed)]
        both = sorted(fixed + new, key=lambda s: (s[0], s[2]))
        out.append((in_code_points(part, fixed), in_code_points(part, both)))
    return out


def find(docs: DataFrame, field: Field | None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, by start) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    layout = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_py() for x in batch.column(1)]
            bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            made: list[tuple[list, list]] = []
            at = 0
            while at < len(texts):  # as many whole texts at a time as have _PART bytes
                upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + _PART, "right")) - 1)
                made += scan(b"".join(texts[at:upto]), bounds[at : upto + 1] - bounds[at], shared.value)
                at = upto
            counts = [pa.array([sum(s[2] == k for s in b) for b, _ in made], pa.int64()) for k in range(3)]
            digests = pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in made], pa.string())
            spans = pa.array([joined(s) for _, s in made], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, digests, spans], [x.split()[0] for x in layout.split(", ")])

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text")).mapInArrow(run, layout)
