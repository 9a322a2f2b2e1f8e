"""Quality classifier: cumulative-link (ordinal logistic) regression on graded ratings.

Grades 0, 1, 2: poor, well written but toxic, clean. All grades share one weight for each hashed
feature of the text and differ in ordered thresholds: P(grade > k) = sigmoid(score - threshold k).
Features are the sets of lower-cased words, of their first letters, trailing marks and letter shapes, and
how much the words repeat, over the whole text. A feature's value is its log odds between the top grade
and the others, over the root of the document's number of features. The model is fitted on a bounded sample of rated documents, ``SAMPLE`` of each grade
in expectation and never more than three times that; prediction reads only the text. A sampled row weighs as many
rated rows as it stands for, so probabilities and ``keep`` follow the grades' natural shares at every table size.

Null and empty texts have no feature and get the score 0. Documents without rating only do not train;
repeated ratings of a document train once each. Rows that repeat a doc_id train as one document: equal texts
as one row, ``TEXTS`` different ones or what the bound has room for share its weight. Without two rated grades every document is kept with an
expected grade of 2. Equal texts get equal answers. All columns pass through; columns of the same
names as the results are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldledger.llm.common import CACHE_WORDS, cut

LOG2_FEATURES = 18
SAMPLE = 4000
#: Different texts that train for one doc_id at most.
TEXTS = 64
GRADES = 3
EPOCHS = 8
#: Documents added to each side before log odds are taken, so that rare features stay small.
SMOOTHING = 20
PREFIXES = (4, 5, 6)
KEEP_AT = 0.5
_PARTS = re.compile(rb"^(.*?)([^0-9A-Za-z\x80-\xff]*)$", re.S)
RESULT = ("expected_grade", "p_above_0", "p_above_1", "keep")


def word_features(word: bytes) -> tuple[int, ...]:
    core, marks = _PARTS.match(word).groups()
    names = [b"w " + core.lower()]
    if marks:
        names.append(b"m " + marks)
    letters = core.decode("utf-8", "replace")
    if len(letters) > 1 and letters.isupper():
        names.append(b"s upper")
    if any(c.isdigit() for c in letters):
        names.append(b"s digit")
    names += [b"p%d " % n + letters[:n].lower().encode() for n in PREFIXES if len(letters) > n]
    return tuple(xxhash.xxh64_intdigest(x) & ((1 << LOG2_FEATURES) - 1) for x in names)


class _Features(dict):
    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = word_features(word)
        return value


def features(text: bytes | None, known: _Features) -> np.ndarray:
    words = (text or b"").split()
    distinct = set(words)
    index = np.fromiter(chain.from_iterable(map(known.__getitem__, distinct)), np.int32)
    if len(words) > 1:
        echoes = sum(map(eq, words, words[1:])) / len(words)
        index = np.append(index, _shape(b"echoes", min(4, int(echoes * 20))))
        index = np.append(index, _shape(b"variety", int(8 * len(distinct) / len(words))))
    return np.unique(index).astype(np.int32)


def _shape(name: bytes, level: int) -> int:
    return xxhash.xxh64_intdigest(b"d %s %d" % (name, level)) & ((1 << LOG2_FEATURES) - 1)


def _root(rows: list[np.ndarray]) -> np.ndarray:
    return np.sqrt(np.maximum(1, np.array([len(r) for r in rows], float)))


class OrdinalModel:
    def __init__(self) -> None:
        self.weights = np.zeros(1 << LOG2_FEATURES, np.float32)
        self.thresholds = np.array([-2.0] * (GRADES - 1))
        self.fitted = False

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for k = 0 .. GRADES - 2."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds[None, :], -30, 30)))

    def fit(
        self, rows: list[np.ndarray], grades: np.ndarray, weights: np.ndarray | None = None, epochs: int = EPOCHS, rate: float = 0.5, seed: int = 0
    ) -> None:
        """AdaGrad on the weighted log likelihood of the grades; steps between thresholds stay positive."""
        if len(set(grades.tolist())) < 2:
            return
        weights = np.ones(len(rows)) if weights is None else weights * (len(rows) / weights.sum())
        draw, w = np.random.default_rng(seed), np.zeros(len(self.weights))
        top, sides = grades == GRADES - 1, []
        for side in (top, ~top):
            held = [np.zeros(0, np.int32), *[r for r, s in zip(rows, side, strict=True) if s]]
            heavy = np.repeat(weights[side], [len(r) for r in held[1:]])
            sides.append(np.log((np.bincount(np.concatenate(held), heavy, len(w)) + SMOOTHING) / (weights[side].sum() + SMOOTHING)))
        odds, root = sides[0] - sides[1], _root(rows)
        start, steps = -0.5, np.full(GRADES - 2, 0.0)  # thresholds: start, then + exp(step)
        seen_w, seen_t = np.full(len(w), 1e-6), np.full(GRADES - 1, 1e-6)
        for _ in range(epochs):
            order = draw.permutation(len(rows))
            for at in range(0, len(order), 128):
                pick = order[at : at + 128]
                index = np.concatenate([rows[i] for i in pick]) if len(pick) else np.zeros(0, np.int32)
                owner = np.repeat(np.arange(len(pick)), [len(rows[i]) for i in pick])
                self.thresholds = np.concatenate([[start], start + np.cumsum(np.exp(steps))])
                value = odds[index] / root[pick][owner]
                scores = np.bincount(owner, w[index] * value, len(pick))
                above = np.hstack([np.ones((len(pick), 1)), self.above(scores), np.zeros((len(pick), 1))])
                y = grades[pick]
                rows_at = np.arange(len(pick))
                high, low = above[rows_at, y], above[rows_at, y + 1]
                p = np.maximum(high - low, 1e-9)
                slope_high, slope_low = high * (1 - high), low * (1 - low)
                share = weights[pick] / len(pick)
                d_score = -(slope_high - slope_low) / p * share
                d_threshold = np.zeros(GRADES - 1)
                for k in range(GRADES - 1):
                    d_threshold[k] = (((y == k + 1) * slope_high / p - (y == k) * slope_low / p) * share).sum()
                g = np.bincount(index, d_score[owner] * value, len(w)) + 1e-6 * w
                seen_w += g * g
                w -= rate * g / np.sqrt(seen_w)
                g_t = np.concatenate([[d_threshold.sum()], np.cumsum(d_threshold[::-1])[::-1][1:] * np.exp(steps)])
                seen_t += g_t * g_t
                start -= rate * g_t[0] / np.sqrt(seen_t[0])
                steps -= rate * g_t[1:] / np.sqrt(seen_t[1:])
        self.thresholds = np.concatenate([[start], start + np.cumsum(np.exp(steps))])
        self.weights = (w * odds).astype(np.float32)
        self.fitted = True

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.array([self.weights[r].sum(dtype=np.float64) for r in rows], np.float64) / _root(rows)


def _views(lists: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists as views into Arrow's own buffers: four bytes a feature."""
    return [part for chunk in lists.chunks for part in np.split(chunk.flatten().to_numpy(), np.cumsum(chunk.value_lengths().to_numpy())[:-1]) if len(chunk)]


def graded(labels: DataFrame) -> DataFrame:
    """doc_id, grade of the rows of ``labels`` (quality, toxic) that have a quality."""
    grade = F.when(F.col("quality") <= 0, 0).when(F.coalesce("toxic", F.lit(0)) > 0, 1).otherwise(2)
    return labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade"))


def sample(labels: DataFrame, per_grade: int = SAMPLE) -> DataFrame:
    """About ``per_grade`` rated rows of each grade, by hash, and how many each stands for; 2 * GRADES * per_grade rows at most."""
    rated = graded(labels)
    counts = {r["grade"]: r["count"] for r in rated.groupBy("grade").count().collect()}  # one row for each grade
    share = F.lit(1.0)
    for grade, n in counts.items():
        share = F.when(F.col("grade") == grade, F.lit(min(1.0, per_grade / n))).otherwise(share)
    chance = F.xxhash64("doc_id", F.lit("rated")) / F.lit(2.0**64) + F.lit(0.5)
    taken = rated.where(chance < share).withColumn("weight", 1 / share)
    return taken.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(2 * GRADES * per_grade)


def train(docs: DataFrame, labels: DataFrame, per_grade: int = SAMPLE, **options: float) -> OrdinalModel:
    once = sample(labels, per_grade).groupBy(F.col("doc_id").alias("_rated"), "grade").agg(F.sum("weight").alias("weight"))
    rated = cut(once)  # a bounded table, so it may be broadcast
    room = max(1, min(TEXTS, 2 * GRADES * per_grade // max(1, rated.count())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Features()
        for batch in batches:
            made = [features(x.as_py(), known).tolist() for x in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(made, pa.list_(pa.int32()))], ["doc_id", "grade", "weight", "features"])

    met = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(rated), F.col("doc_id") == F.col("_rated"))
    made = met.select("doc_id", "grade", "weight", F.col("text").cast("binary")).mapInArrow(run, "doc_id long, grade int, weight double, features array<int>")
    texts = made.withColumn("_print", F.xxhash64("features")).dropDuplicates(["doc_id", "grade", "_print"])
    nth = F.row_number().over(Window.partitionBy("doc_id", "grade").orderBy("_print"))  # limited before the rows move
    rows = texts.withColumn("_nth", nth).where(F.col("_nth") <= room).select("doc_id", "grade", "weight", "_print", "features").toArrow()
    ids, grades, weights, prints = (rows.column(i).to_numpy() for i in range(4))
    _, owner, held = np.unique(ids * GRADES + grades, return_inverse=True, return_counts=True)
    weights = weights / held[owner]
    order = np.lexsort([prints, grades, ids])
    lists = _views(rows.column(4))
    model = OrdinalModel()
    if len(order):
        model.fit([lists[i] for i in order], grades[order].astype(np.int64), weights[order], **options)
    return model


def score(docs: DataFrame, model: OrdinalModel, keep_at: float = KEEP_AT) -> DataFrame:
    """``docs`` with expected_grade, p_above_0, p_above_1 and keep (P(grade > 1) of at least ``keep_at``)."""
    docs = docs.drop(*RESULT)
    kinds = [T.DoubleType()] * 3 + [T.BooleanType()]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, k) for n, k in zip(RESULT, kinds, strict=True)]])
    text_at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds, model.fitted))  # 1 MB, set by LOG2_FEATURES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, model = _Features(), OrdinalModel()
        model.weights, model.thresholds, model.fitted = shared.value
        for batch in batches:
            texts = batch.column(text_at).cast(pa.binary())
            scores = model.scores([features(x.as_py(), known) for x in texts])
            above = model.above(scores) if model.fitted else np.ones((len(scores), GRADES - 1))
            made = [above.sum(1), above[:, 0], above[:, 1], above[:, 1] >= keep_at]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, made)], [*batch.schema.names, *RESULT])

    return docs.mapInArrow(run, schema)


def selected(docs: DataFrame, model: OrdinalModel, keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs`` that the model keeps, with their own columns."""
    return score(docs, model, keep_at).where("keep").select(*docs.columns)
