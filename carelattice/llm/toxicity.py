"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct hashed words, word pairs and pairs with one or two words left
out. Words are lower-cased runs of letters and digits, so punctuation does not hide a word.
Training: ``TRAIN_ROWS`` labelled rows at most (``frames.training_rows``) are dealt by a hash of the row to
``SHARDS`` Spark groups of bounded size; each runs FTRL-proximal with per-coordinate rates and L1,
and the weights are averaged. L1 leaves few non-zero weights (at most 2**BITS), which travel to the
tasks with the scoring function. Every whole text is scored in one pass.

Defined results: null and empty texts have no feature and get the score of the intercept; without
labelled rows all scores are 0.5; a doc with two labels trains once with each, equal rows train once; rows are scored one
by one, so repeated rows get equal scores; clashing columns are replaced. Training reads ids, texts
and labels only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from carelattice.llm.frames import append, pieces, training_rows
from carelattice.llm.words import Words, grams, spans

BITS = 20
TRAIN_ROWS = 10_000
SHARDS = 2
EPOCHS = 5
ALPHA, BETA, L1, L2 = 1.5, 1.0, 2.5, 0.0
SKIPS = (1, 2)


def breaks(data: np.ndarray) -> np.ndarray:
    """Bytes that are neither letters, digits nor parts of other characters (lower case only)."""
    return (data - np.uint8(97) >= 26) & (data - np.uint8(48) >= 10) & (data < 128)


def features(column: pa.Array, used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """Document index and feature of every distinct feature of each document; with ``used``, of
    those features alone that it marks."""
    found: Words = spans(column, breaks, lower=True)
    doc, keys = found.doc.astype(np.uint64) << np.uint64(BITS), []
    for n, skip in [(1, 0), (2, 0), *[(2, s) for s in SKIPS]]:
        hashed, at = grams(found, n, skip) if n > 1 else (found.hash, None)
        slot = hashed >> np.uint64(64 - BITS)
        if used is not None:
            kept = np.flatnonzero(used[slot])
            slot, at = slot[kept], kept if at is None else at[kept]
        keys.append((doc if at is None else doc[at]) | slot)
    key = np.unique(np.concatenate(keys))
    return (key >> np.uint64(BITS)).astype(np.int64), (key & np.uint64(2**BITS - 1)).astype(np.int64), len(found.count)


def ftrl(doc: np.ndarray, slot: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept after ``EPOCHS`` passes, one update a document."""
    z, n = np.zeros(2**BITS + 1), np.zeros(2**BITS + 1)
    cut = np.searchsorted(doc, np.arange(len(label) + 1))
    at = [np.append(slot[a:b], 2**BITS) for a, b in zip(cut[:-1], cut[1:])]  # the last one is the intercept

    def weights(z, n, penalty):
        return np.where(np.abs(z) <= penalty, 0.0, (np.sign(z) * penalty - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    penalty = np.full(2**BITS + 1, L1)
    penalty[-1] = 0.0
    for _ in range(EPOCHS):
        for i, y in zip(at, label):
            w = weights(z[i], n[i], penalty[i])
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - y
            rate = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - rate * w
            n[i] += g * g
    w = weights(z, n, penalty)
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """Indexes and values of the non-zero weights, and the intercept. ``docs`` holds the rows to learn from."""
    sample = training_rows(docs.select("doc_id", "text"), labels, label_col, rows).withColumn("__shard", F.pmod("__place", F.lit(SHARDS)))

    def fit(key, table):
        table = table.sort_by("__place")
        order = np.random.default_rng(7).permutation(len(table))
        table = table.take(pa.array(order)).combine_chunks()
        docs, slots, seen = [], [], 0
        for part in pieces(table.to_batches(), table.column_names.index("text")):
            doc, slot, n = features(part.column("text"))
            docs.append((doc + seen).astype(np.int32))
            slots.append(slot.astype(np.int32))
            seen += n
        doc, slot = np.concatenate(docs), np.concatenate(slots)
        w, bias = ftrl(doc, slot, np.asarray(table["__y"].to_numpy(), float))
        i = np.flatnonzero(w)
        return pa.table({"i": pa.array(np.append(i, -1), pa.int64()), "w": pa.array(np.append(w[i], bias), pa.float64())})

    got = sample.groupBy("__shard").applyInArrow(fit, "i bigint, w double").groupBy("i").agg(
        F.sum("w").alias("w"), F.count("*").alias("k")).toPandas()
    shards = max(1, int(got.loc[got.i == -1, "k"].sum()))
    got = got.sort_values("i")
    bias = float(got.loc[got.i == -1, "w"].sum()) / shards
    got = got[got.i >= 0]
    return got.i.to_numpy(np.int64), got.w.to_numpy() / shards, bias


def scored(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text_col: str = "text") -> DataFrame:
    """``docs`` (all columns but the text) with ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(column: pa.Array) -> dict:
        at, weight, bias = shared.value
        dense = np.zeros(2**BITS)
        dense[at] = weight
        doc, slot, n = features(column, dense != 0)
        total = np.bincount(doc, weights=dense[slot], minlength=n) + bias
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return {"score": p, "predicted": (p >= 0.5).astype(np.int32)}

    return append(docs, text_col, "score double, predicted int", score)
