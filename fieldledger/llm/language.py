"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

Texts are laid out in segments of ``SEGMENT`` bytes. Two recurrent passes, one from each side of a
segment, see every byte; each position gets probabilities of the languages, and a document's
probabilities are the mean over all positions of its whole text. Gates are linear between 0 and 1
(clipped), the candidate state is a tanh. Training is backpropagation through time with Adam.

The model is fitted on a bounded sample: ``SAMPLE_DOCS`` documents of each language in hash order,
``SAMPLE_CUTS`` stretches from each, spread over the whole text. Prediction reads only the text.

``und`` (score 0) is given to null texts, texts without a letter, and all if nothing is labelled. Equal
texts get equal answers; rows that repeat are answered each; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEGMENT = 128
HIDDEN = 8
SAMPLE_DOCS = 250
SAMPLE_CUTS = 4
STEPS = 120
BATCH = 192
#: Segments that a task holds at a time.
HELD = 2048
NO_LANGUAGE = "und"
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def _gate(x: np.ndarray) -> np.ndarray:
    return np.clip(x * np.float32(0.25) + np.float32(0.5), 0, 1)


class ByteTagger:
    """Parameters: ``inputs`` (2 directions x 256 bytes x 3 gates), ``state``, ``out``, ``bias``."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 0) -> None:
        draw = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        n = max(1, len(languages))
        self.weights = {
            "inputs": draw.normal(0, 0.3, (512, 3 * hidden)).astype(np.float32),
            "state": draw.normal(0, 0.3, (2, hidden, 3 * hidden)).astype(np.float32),
            "out": draw.normal(0, 0.3, (2, hidden, n)).astype(np.float32),
            "bias": np.zeros(n, np.float32),
        }

    def _states(self, segments: np.ndarray, lengths: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States (time, direction, segment, hidden); the second direction runs backwards in time."""
        w, h = self.weights, self.hidden
        t = segments.shape[1]
        index = np.stack([segments.T, segments.T[::-1]], 1).astype(np.int32)  # time, direction, segment
        index[:, 1] += 256
        inside = np.arange(t)[:, None] < lengths[None, :]
        mask = np.stack([inside, inside[::-1]], 1).astype(np.float32)[..., None]
        full = bool((lengths == t).all())
        state = np.zeros((2, len(segments), h), np.float32)
        states = np.empty((t, 2, len(segments), h), np.float32)
        tape = []
        for i in range(t):
            x = w["inputs"].take(index[i], axis=0)
            a = np.matmul(state, w["state"])
            gates = _gate(x[..., : 2 * h] + a[..., : 2 * h])
            z, r = gates[..., :h], gates[..., h:]
            c = np.tanh(x[..., 2 * h :] + r * a[..., 2 * h :])
            new = state + z * (c - state)
            if not full:
                new *= mask[i]
            if keep:
                tape.append((state, gates, c, a[..., 2 * h :], mask[i]))
            state = states[i] = new
        return states, [index, tape]

    def _scores(self, states: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.matmul(states[:, 0], w["out"][0]) + np.matmul(states[::-1, 1], w["out"][1]) + w["bias"]

    def positions(self, segments: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probabilities (time, segment, language) of every position; those after a segment's end are 0."""
        states, _ = self._states(segments, lengths, keep=False)
        p = self._scores(states)
        np.exp(p - p.max(-1, keepdims=True), out=p)
        p /= p.sum(-1, keepdims=True)
        p *= (np.arange(segments.shape[1])[:, None] < lengths[None, :])[..., None]
        return p

    def gradients(self, segments: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> tuple[float, dict]:
        """Mean cross entropy over all positions and its gradients, backwards through time."""
        w, h = self.weights, self.hidden
        states, (index, tape) = self._states(segments, lengths, keep=True)
        t = segments.shape[1]
        p = self._scores(states)
        p = np.exp(p - p.max(-1, keepdims=True))
        p /= p.sum(-1, keepdims=True)
        inside = (np.arange(t)[:, None] < lengths[None, :]).astype(np.float32)
        total = max(1.0, float(inside.sum()))
        hit = p[:, np.arange(len(labels)), labels]
        loss = float(-(np.log(hit + 1e-9) * inside).sum() / total)
        p[:, np.arange(len(labels)), labels] -= 1
        p *= inside[..., None] / total
        back = states[::-1, 1]
        grads = {
            "bias": p.sum((0, 1)),
            "out": np.stack([np.einsum("tbh,tbl->hl", states[:, 0], p), np.einsum("tbh,tbl->hl", back, p)]),
        }
        from_out = np.stack([np.matmul(p, w["out"][0].T), np.matmul(p, w["out"][1].T)[::-1]], 1)
        d_inputs = np.empty((t, 2, len(segments), 3 * h), np.float32)
        d_state = np.zeros_like(w["state"])
        d = np.zeros_like(states[0])
        turned = w["state"].transpose(0, 2, 1)
        for i in range(t - 1, -1, -1):
            state, gates, c, recalled, mask = tape[i]
            z, r = gates[..., :h], gates[..., h:]
            d = (d + from_out[i]) * mask
            d_c = d * z * (1 - c * c)
            d_gates = np.concatenate([d * (c - state), d_c * recalled], -1) * 0.25 * ((gates > 0) & (gates < 1))
            d_inputs[i] = np.concatenate([d_gates, d_c], -1)
            d_a = np.concatenate([d_gates, d_c * r], -1)
            d_state += np.matmul(state.transpose(0, 2, 1), d_a)
            d = d * (1 - z) + np.matmul(d_a, turned)
        flat, rows = d_inputs.reshape(-1, 3 * h), index.reshape(-1)
        grads["state"] = d_state
        grads["inputs"] = np.stack([np.bincount(rows, flat[:, k], 512) for k in range(3 * h)], 1).astype(np.float32)
        return loss, grads

    def fit(self, segments: np.ndarray, lengths: np.ndarray, labels: np.ndarray, steps: int = STEPS, rate: float = 0.03, seed: int = 0) -> float:
        """Adam over balanced batches; returns the mean loss of the last ten steps."""
        draw = np.random.default_rng(seed)
        groups = [g for g in (np.flatnonzero(labels == k) for k in range(len(self.languages))) if len(g)]
        if len(groups) < 2:
            return 0.0
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        losses = []
        for step in range(1, steps + 1):
            pick = np.concatenate([draw.choice(g, max(1, BATCH // len(groups))) for g in groups])
            loss, grads = self.gradients(segments[pick], lengths[pick], labels[pick])
            losses.append(loss)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            scale = min(1.0, 1.0 / (norm + 1e-9))
            pace = rate * (1 - 0.9 * step / steps)
            for k, g in grads.items():
                g = g * scale
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                self.weights[k] -= (pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return float(np.mean(losses[-10:]))


def held_out(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1


def sample(docs: DataFrame, per_language: int = SAMPLE_DOCS) -> list[tuple[str, bytes]]:
    """(lang, stretch of text) from labelled documents that are not held out: at most per_language * SAMPLE_CUTS each."""
    n = F.greatest(F.length("text") - SEGMENT, F.lit(0)) + 1
    cuts = F.array(*[F.expr(f"substring(text, int(1 + pmod(xxhash64(doc_id, {i}), n)), {SEGMENT})") for i in range(SAMPLE_CUTS)])
    rows = (
        docs.where(F.col("lang").isNotNull() & (F.length("text") > 0) & ~F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
        .withColumn("n", n)
        .select("lang", F.xxhash64("doc_id", F.lit("sample")).alias("order"), "doc_id", cuts.alias("cuts"))
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id"))  # limited in each task before the shuffle
    chosen = rows.withColumn("rank", rank).where(F.col("rank") <= per_language)
    return sorted((r.lang, c.encode()) for r in chosen.select("lang", "cuts").collect() for c in r.cuts)


def layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    segments = np.zeros((len(texts), SEGMENT), np.uint8)
    lengths = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        part = np.frombuffer(text[:SEGMENT], np.uint8)
        segments[i, : len(part)] = part
        lengths[i] = len(part)
    return segments, lengths


def train(docs: DataFrame, **options: int) -> ByteTagger:
    rows = sample(docs)
    languages = sorted({r[0] for r in rows})
    model = ByteTagger(languages)
    if rows:
        segments, lengths = layout([r[1] for r in rows])
        model.fit(segments, lengths, np.array([languages.index(r[0]) for r in rows]), **options)
    return model


def pooled(model: ByteTagger, texts: list[bytes]) -> np.ndarray:
    """Mean language probabilities over all positions of each whole text; zero for empty ones."""
    sums = np.zeros((len(texts), max(1, len(model.languages))))
    block, lengths, owner = np.zeros((HELD, SEGMENT), np.uint8), np.zeros(HELD, np.int64), np.zeros(HELD, np.int64)
    used = 0

    def flush(n: int) -> None:
        if n:
            np.add.at(sums, owner[:n], model.positions(block[:n], lengths[:n]).sum(0))

    for i, text in enumerate(texts):
        data, at = np.frombuffer(text, np.uint8), 0
        while at < len(data):
            n = min(HELD - used, -(-(len(data) - at) // SEGMENT))
            part = data[at : at + n * SEGMENT]
            block[used : used + n].reshape(-1)[: len(part)] = part
            lengths[used : used + n] = SEGMENT
            lengths[used + n - 1] = len(part) - (n - 1) * SEGMENT
            owner[used : used + n] = i
            used, at = used + n, at + len(part)
            if used == HELD:
                flush(used)
                used = 0
    flush(used)
    return sums / np.maximum(1, np.array([len(x) for x in texts], float))[:, None]


def predict(docs: DataFrame, model: ByteTagger) -> DataFrame:
    languages = model.languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                lettered = np.array(part.column(3).to_pylist(), bool)
                texts = [(x.as_py() or b"") if ok else b"" for x, ok in zip(part.column(2), lettered, strict=True)]
                known = lettered & bool(languages)
                shares = pooled(model, texts)
                best = shares.argmax(1)
                names = [languages[k] if ok else NO_LANGUAGE for k, ok in zip(best, known, strict=True)]
                score = np.where(known, np.clip(shares[np.arange(len(best)), best], 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.col("text").cast("binary"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)),
    )
    return rows.mapInArrow(run, SCHEMA)
