"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words. Each passage is encoded from its characters,
its words and how far it repeats itself or its document. Gated attention weighs the encoded
passages (tanh of one projection times the sigmoid of another), the weighted sum is the
document, and a logistic unit scores it. Only documents have labels; which passages matter
is learned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.llm.batches import bounded, text_buffer
from vecloom.llm.labelled import fitted, held_out
from vecloom.llm.shingles import word_digests

SLICE_BYTES = 1 << 20
PASSAGE = 64
TRAIN_PER_CLASS, TRAIN_BYTES = 2000, 64 << 10
ENCODED, GATED, EPOCHS, BATCH, RATE, DECAY, SEED = 16, 8, 60, 128, 0.01, 1e-4, 7
#: Training texts whose bytes are looked at together.
TEXTS_AT_ONCE = 64
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.5

# Kinds of bytes whose shares of a passage are features.
KINDS = ("lower", "upper", "digit", "sentence", "quote", "symbol", "bar", "beyond", "space", "line")


def _kind(b: int) -> int:
    c = chr(b)
    if b >= 128:
        return KINDS.index("beyond")
    if c.isalpha():
        return KINDS.index("lower" if c.islower() else "upper")
    named = {"digit": "0123456789", "sentence": ".,;:!?", "quote": "'\"()-", "bar": "|", "space": " \t", "line": "\n\r\v\f"}
    return next((KINDS.index(k) for k, chars in named.items() if c in chars), KINDS.index("symbol"))


_KIND = np.array([_kind(b) for b in range(256)], np.uint8)
FEATURES = len(KINDS) + 8


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all rows' passages, and where each row's begin; a row without words is one passage of zeros."""
    data, ends = text_buffer(column)
    words, bounds = word_digests(column)
    count = np.diff(bounds)
    n = np.maximum(1, -(-count // PASSAGE))
    begins = np.concatenate(([0], np.cumsum(n)))
    out = np.zeros((int(begins[-1]), FEATURES))
    if not len(words):
        return out, begins
    row_of_word = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(words)) - np.repeat(bounds[:-1], count)
    of_word = begins[row_of_word] + nth // PASSAGE
    size = np.bincount(of_word, minlength=len(out)).astype(float)
    full = size > 0
    share = np.where(full, 1 / np.maximum(size, 1), 0)

    # Bytes go with the word before them, those before the first word with that.
    visible = (data != 32) & ((data < 9) | (data > 13))
    start = visible.copy()
    start[1:] &= ~visible[:-1]
    firsts = ends[:-1][ends[:-1] < ends[1:]]
    start[firsts] = visible[firsts]
    row_of_byte = np.repeat(np.arange(len(count)), np.diff(ends))
    word_of_byte = np.maximum(np.cumsum(start) - 1, bounds[:-1][row_of_byte])
    has_words = count[row_of_byte] > 0
    of_byte = np.where(has_words, of_word[np.minimum(word_of_byte, len(words) - 1)], begins[row_of_byte])
    kind = _KIND[data].astype(np.int64)
    kinds = np.bincount(of_byte * len(KINDS) + kind, minlength=len(out) * len(KINDS)).reshape(len(out), -1).astype(float)
    kinds[~full] = 0
    length = kinds.sum(axis=1)
    shares = kinds / np.maximum(length, 1)[:, None]
    out[:, : len(KINDS)] = np.sqrt(shares)

    letters = np.isin(kind, [KINDS.index(k) for k in ("lower", "upper", "beyond")])
    lettered = np.bincount(word_of_byte[letters & has_words], minlength=len(words))[: len(words)] > 0
    signs = kind == KINDS.index("symbol")
    signed = np.bincount(word_of_byte[signs & has_words], minlength=len(words))[: len(words)] > 0
    k = len(KINDS)
    out[:, k] = np.bincount(of_word, ~lettered, len(out)) * share
    out[:, k + 1] = np.bincount(of_word, signed, len(out)) * share
    out[:, k + 2] = np.log1p(np.bincount(of_word, minlength=len(out))) / 5
    out[:, k + 3] = np.where(full, np.log1p(length * share) / 3, 0)
    for i, key in enumerate((of_word, row_of_word)):
        again = _repeats(key, words)
        out[:, k + 4 + i] = np.bincount(of_word, again, len(out)) * share
    pairs = words[1:] * np.uint64(3) + words[:-1]
    again = np.concatenate(([False], _repeats(row_of_word[1:], pairs) & (row_of_word[1:] == row_of_word[:-1])))
    out[:, k + 6] = np.bincount(of_word, again, len(out)) * share
    out[:, k + 7] = np.log1p(count[np.repeat(np.arange(len(count)), n)]) / 8
    return out, begins


def _repeats(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether a value stood earlier in its group."""
    order = np.lexsort((value, group))
    same = np.zeros(len(value), bool)
    same[1:] = (group[order][1:] == group[order][:-1]) & (value[order][1:] == value[order][:-1])
    out = np.zeros(len(value), bool)
    out[order] = same
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionModel:
    """Weights of encoder, gates and output; ``mean`` and ``scale`` put features on one footing."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, rng: np.random.Generator):
        d = len(mean)
        self.mean, self.scale = mean, scale
        shapes = {"E": (d, ENCODED), "e": (ENCODED,), "V": (ENCODED, GATED), "U": (ENCODED, GATED), "a": (GATED,), "o": (ENCODED,), "c": (1,)}
        self.weights = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 or k in "ao" else np.zeros(s) for k, s in shapes.items()}

    def forward(self, x: np.ndarray, begins: np.ndarray) -> dict[str, np.ndarray]:
        """Every step's values for bags whose passages begin at ``begins``."""
        w = self.weights
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ w["E"] + w["e"])
        t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
        s = (t * g) @ w["a"]
        first, n = begins[:-1], np.diff(begins)
        bag = np.repeat(np.arange(len(n)), n)
        s = np.exp(s - np.maximum.reduceat(s, first)[bag])
        attention = s / np.add.reduceat(s, first)[bag]
        z = np.add.reduceat(attention[:, None] * h, first)
        return {"x": x, "h": h, "t": t, "g": g, "bag": bag, "attention": attention, "z": z, "p": _sigmoid(z @ w["o"] + w["c"])}

    def gradients(self, f: dict[str, np.ndarray], begins: np.ndarray, y: np.ndarray, cost: np.ndarray) -> dict[str, np.ndarray]:
        w, bag, first = self.weights, f["bag"], begins[:-1]
        out = cost * (f["p"] - y) / cost.sum()
        dz = out[:, None] * w["o"]
        da = (dz[bag] * f["h"]).sum(axis=1)
        ds = f["attention"] * (da - np.add.reduceat(f["attention"] * da, first)[bag])
        dt = ds[:, None] * w["a"] * f["g"] * (1 - f["t"] ** 2)
        dg = ds[:, None] * w["a"] * f["t"] * f["g"] * (1 - f["g"])
        dh = f["attention"][:, None] * dz[bag] + dt @ w["V"].T + dg @ w["U"].T
        de = dh * (1 - f["h"] ** 2)
        found = {"E": f["x"].T @ de, "e": de.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ dg, "a": ds @ (f["t"] * f["g"]), "o": out @ f["z"], "c": out.sum(keepdims=True)}
        return {k: v + DECAY * w[k] for k, v in found.items()}


def fit(rows: list[tuple[str, int]], counts: dict[int, int]) -> AttentionModel:
    """Model by Adam; a row costs as much as it stands for among all labelled rows of its class.

    Without rows of either class the score is the same for all texts.
    """
    rng = np.random.default_rng(SEED)
    if len({y for _, y in rows}) < 2:
        model = AttentionModel(np.zeros(FEATURES), np.ones(FEATURES), rng)
        model.weights = {k: np.zeros_like(v) for k, v in model.weights.items()}
        model.weights["c"] = np.array([2.0 if rows and rows[0][1] else -2.0 if rows else 0.0])
        return model
    parts = [passages(pa.array([t for t, _ in rows[k : k + TEXTS_AT_ONCE]], pa.string())) for k in range(0, len(rows), TEXTS_AT_ONCE)]
    x = np.concatenate([p for p, _ in parts])
    begins = np.concatenate(([0], np.cumsum(np.concatenate([np.diff(b) for _, b in parts]))))
    y = np.array([v for _, v in rows], float)
    held = np.bincount(y.astype(int), minlength=2)
    cost = np.array([counts[0] / held[0], counts[1] / held[1]])[y.astype(int)]
    model = AttentionModel(x.mean(axis=0), x.std(axis=0) + 1e-3, rng)
    first, second = ({k: np.zeros_like(v) for k, v in model.weights.items()} for _ in range(2))
    n, step = np.diff(begins), 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        for k in range(0, len(order), BATCH):
            some = order[k : k + BATCH]
            size = n[some]
            own = np.concatenate(([0], np.cumsum(size)))
            at = np.arange(own[-1]) + np.repeat(begins[some] - own[:-1], size)
            f = model.forward(x[at], own)
            step += 1
            for name, grad in model.gradients(f, own, y[some], cost[some]).items():
                first[name] += 0.1 * (grad - first[name])
                second[name] += 0.001 * (grad**2 - second[name])
                rate = RATE * (1 - epoch / EPOCHS)
                model.weights[name] -= rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_PER_CLASS, max_bytes: int = TRAIN_BYTES) -> AttentionModel:
    return fitted(docs, labels, "quality", FOLDS, HELD_OUT, per_class, max_bytes, fit)


def score(docs: DataFrame, model: AttentionModel) -> DataFrame:
    """``docs`` with ``_score``; null and empty texts are one passage without words."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.withColumn("_score", F.lit(0.0)).schema

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text", SLICE_BYTES):
            if batch.num_rows:
                p = held.value.forward(*passages(batch.column("text")))["p"]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=[*batch.schema.names, "_score"])

    return docs.mapInArrow(scored, schema)


def classify(docs: DataFrame, labels: DataFrame, model: AttentionModel | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. Repeated and null ids are scored by their text; an empty table gives no rows."""
    found = score(docs.select("doc_id", "text"), model or train(docs, labels))
    return found.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))
