"""Quality classifier: a factorisation machine over hashed words and structure.

Features of a text: hashed words with weight 1 / sqrt(words); structure statistics (length,
characters a word, shares of symbols, digits, capitals, line breaks, repeated words and lines); metadata: the length
that the table states in ``n_chars``, and how far it is from the text's own (null, negative or no number, or no such
column: the text's own length). Pairwise interactions have rank ``RANK`` and are
scored in linear time by the sum-of-squares identity:
sum over pairs of <v_i, v_j> x_i x_j = (|sum v_i x_i|^2 - sum |v_i x_i|^2) / 2.
Trained by AdaGrad on ``TRAIN_ROWS`` labelled rows at most (``frames.training_rows``), dealt by a hash of the row to
``SHARDS`` Spark groups of bounded size; the score is the mean of the shards' machines.

Defined results: null and empty texts have the structure of an empty text and get a score; without labelled rows all scores are 0.5; equal rows train once and get equal
scores; clashing columns are replaced. Labels, lang, source and doc_id are never inputs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from carelattice.llm.frames import append, training_rows
from carelattice.llm.quality_rules import base_counts, flags_within
from carelattice.llm.words import mix

BITS = 14
RANK = 4
TRAIN_ROWS = 12_000
SHARDS = 4
EPOCHS = 6
BATCH = 64
RATE, L2 = 0.08, 1e-5
THRESHOLD = 0.3
STATS = 14
LENGTH = "n_chars"


def with_length(docs: DataFrame, *columns) -> DataFrame:
    """``columns`` of ``docs`` and ``__stated``, the stated length as a double or NULL."""
    stated = F.col(LENGTH).cast("string").try_cast("double") if LENGTH in docs.columns else F.lit(None).cast("double")
    return docs.select(*columns, F.when((stated >= 0) & (stated < 2.0**62), stated).alias("__stated"))


def features(column: pa.Array, stated: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, slot and value of the hashed words, and a row of statistics for each document."""
    base = base_counts(column)
    found = base.pop("_found")
    n = len(found.count)
    size = np.maximum(np.diff(found.bounds), 1)
    length = np.log1p(flags_within(found.bounds, (found.data & np.uint8(0xC0)) != 0x80)) if n else np.zeros(0)
    told = np.asarray(stated.to_numpy(zero_copy_only=False), float)
    told = np.where(np.isnan(told), length, np.log1p(told))
    count = np.maximum(found.count, 1)
    doc = found.doc
    slot = (mix(found.hash) >> np.uint64(64 - BITS)).astype(np.int64)
    key, times = np.unique(doc * 2**BITS + slot, return_counts=True)
    owner, slot = key >> BITS, key & (2**BITS - 1)
    distinct = np.bincount(owner, minlength=n)
    value = np.sqrt(times / count[owner])
    stats = np.stack([
        np.ones(n), np.log1p(found.count) / 8, np.minimum(base["word_chars"] / count, 20) / 10,
        np.minimum(base["n_symbols"] / count, 2), np.minimum(base["n_dup_lines"] / count * 10, 2),
        base["n_repeat_words"] / count, distinct / np.minimum(count, 2**BITS),
        flags_within(found.bounds, found.data - np.uint8(48) < 10) / size * 5, flags_within(found.bounds, found.data - np.uint8(65) < 26) / size * 2,
        np.minimum(flags_within(found.bounds, found.data == 10) / count * 10, 2), found.count < 10,
        np.exp(-found.count / 20), told / 12, np.minimum(np.abs(told - length), 3),
    ], 1).astype(float) if n else np.zeros((0, STATS))
    return owner, slot, value, stats


class Machine:
    """Weights of one machine: bias and linear terms are the first column, then the factors."""

    def __init__(self, seed: int):
        start = np.random.default_rng(seed)
        self.v = start.normal(0, 0.05, (2**BITS + STATS, RANK + 1))
        self.v[:, 0] = 0
        self.g = np.full(self.v.shape, 1e-6)

    def raw(self, owner, slot, value, n):
        """Scores before the logistic, the summed factors, and the rows used."""
        rows = self.v[slot] * value[:, None]
        total = np.zeros((n, RANK + 1))
        for k in range(RANK + 1):
            total[:, k] = np.bincount(owner, weights=rows[:, k], minlength=n)
        squares = np.bincount(owner, weights=(rows[:, 1:] ** 2).sum(1), minlength=n)
        return total[:, 0] + ((total[:, 1:] ** 2).sum(1) - squares) / 2, total, rows

    def step(self, owner, slot, value, label):
        n = len(label)
        raw, total, rows = self.raw(owner, slot, value, n)
        error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - label)[owner] / np.sqrt(n)
        grad = np.empty_like(rows)
        grad[:, 0] = error * value
        grad[:, 1:] = (error * value)[:, None] * (total[owner, 1:] - rows[:, 1:])
        used, inverse = np.unique(slot, return_inverse=True)
        summed = np.stack([np.bincount(inverse, weights=grad[:, k]) for k in range(RANK + 1)], 1) + L2 * self.v[used]
        self.g[used] += summed ** 2
        self.v[used] -= RATE * summed / np.sqrt(self.g[used])


def _joined(owner, slot, value, stats):
    """Words and statistics as one list of features."""
    n = len(stats)
    return (np.concatenate([owner, np.repeat(np.arange(n), STATS)]),
            np.concatenate([slot, np.tile(np.arange(STATS) + 2**BITS, n)]),
            np.concatenate([value, stats.ravel()]))


def fit(column: pa.Array, stated: pa.Array, label: np.ndarray, seed: int = 11) -> np.ndarray:
    owner, slot, value, stats = features(column, stated)
    cut = np.searchsorted(owner, np.arange(len(label) + 1))
    machine, order = Machine(seed), np.random.default_rng(seed)
    for _ in range(EPOCHS):
        shuffled = order.permutation(len(label))
        for at in range(0, len(label), BATCH):
            chosen = shuffled[at:at + BATCH]
            index = np.concatenate([np.arange(cut[i], cut[i + 1]) for i in chosen])
            own = np.repeat(np.arange(len(chosen)), cut[chosen + 1] - cut[chosen])
            machine.step(*_joined(own, slot[index], value[index], stats[chosen]), label[chosen])
    return machine.v


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows: int = TRAIN_ROWS) -> list[np.ndarray]:
    """One machine a shard; ``docs`` holds the rows to learn from."""
    sample = training_rows(with_length(docs, "doc_id", "text"), labels, label_col, rows).withColumn("__shard", F.pmod("__place", F.lit(SHARDS)))

    def run(key, table):
        table = table.sort_by("__place").combine_chunks()
        whole = lambda c: c.chunk(0) if c.num_chunks == 1 else c.combine_chunks()
        v = fit(whole(table["text"]), whole(table["__stated"]), np.asarray(table["__y"].to_numpy(), float))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "v": pa.array([v.astype(np.float32).tobytes()], pa.binary())})

    got = sample.groupBy("__shard").applyInArrow(run, "shard bigint, v binary").orderBy("shard").collect()
    return [np.frombuffer(r.v, np.float32).reshape(-1, RANK + 1) for r in got]


def scored(docs: DataFrame, model: list[np.ndarray], text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (all columns but the text) with ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(column: pa.Array, stated: pa.Array) -> dict:
        listed = features(column, stated)
        n = len(listed[3])
        joined = _joined(*listed)
        p = np.zeros(n)
        for v in shared.value:
            machine = Machine.__new__(Machine)
            machine.v = v
            p += 1 / (1 + np.exp(-np.clip(machine.raw(*joined, n)[0], -30, 30)))
        p = p / len(shared.value) if shared.value else np.full(n, 0.5)
        return {"score": p, "predicted": (p >= threshold).astype(np.int32)}

    rows = with_length(docs, *[F.col(f"`{c}`") for c in docs.columns])
    return append(rows, text_col, "score double, predicted int", score, ["__stated"]).drop("__stated")
