"""Periodic run detection by descending-LCP Kruskal.

A run is a stretch of words with smallest period q (words q apart are equal) that no neighbouring word
extends. Per document:

1. Suffixes are sorted by prefix doubling over word numbers; neighbours in that order are edges
   weighted by their longest common prefix (LCP).
2. Edges are taken by decreasing LCP. Each unites two suffix classes in a union-find; a class keeps its
   positions in order, and the smaller class is dealt into the larger one.
3. Two positions i < j that become neighbours in a class at LCP l, at a distance d <= l, lie in a
   repetition of period d that ends at word j + l. It is a run if the words before i and j differ. Each
   run of exponent 2 or more is seeded exactly once, by its first word and the word one period later:
   a position between the two would have a smaller period.

A run of ``least_length`` words and ``least_exponent`` periods has an LCP of at least ``least_lcp``
between those two, so smaller edges are never needed; documents without a repeated stretch of that many
words have no edge at all and are not sorted.

Memory: 4 bytes a word for each doubling of the longest repeated stretch, one document at a time. Rows are
neither moved nor grouped, so no key can be hot.

Defined results: null, empty and blank texts have no word and no run; texts shorter than ``least_length``
have no run; repeated rows (equal ids, too) give one row each; null ids stay null; other columns of the
input are ignored, whatever their names. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from carelattice.llm.frames import pieces
from carelattice.llm.words import Words, mix, words

LEAST_LENGTH = 24
LEAST_EXPONENT = 3
FIELDS = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary"


def least_lcp(length: int, exponent: int) -> int:
    """Smallest LCP between a run's first word and the word one period later."""
    return min(max(length, exponent * q) - q for q in range(1, length + 1))


class Positions:
    """Positions in order, in blocks of neighbouring ones, so that dealing one in stays cheap."""

    __slots__ = ("blocks", "filled", "size")

    def __init__(self, first: int):
        self.blocks, self.filled, self.size = {first >> 10: [first]}, [first >> 10], 1

    def add(self, x: int) -> tuple[int, int]:
        """Its neighbours before and after (-1: none)."""
        self.size += 1
        b = x >> 10
        block = self.blocks.get(b)
        if block is None:
            block = self.blocks[b] = []
            insort(self.filled, b)
        at = bisect_left(block, x)
        before = block[at - 1] if at else -1
        after = block[at] if at < len(block) else -1
        block.insert(at, x)
        if before < 0 or after < 0:
            k = bisect_left(self.filled, b)
            if before < 0 and k:
                before = self.blocks[self.filled[k - 1]][-1]
            if after < 0 and k + 1 < len(self.filled):
                after = self.blocks[self.filled[k + 1]][0]
        return before, after

    def __iter__(self):
        for b in self.filled:
            yield from self.blocks[b]


def suffix_edges(word: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order (i, j) with an LCP of ``least`` or more, by decreasing LCP."""
    n = len(word)
    levels = [np.unique(word, return_inverse=True)[1].astype(np.int32)]
    rank, reach, distinct = levels[0], 1, -1
    while distinct < n and reach < 2 * n:
        follow = np.zeros(n, np.int64)
        follow[:max(n - reach, 0)] = rank[reach:].astype(np.int64) + 1
        found, rank = np.unique(rank.astype(np.int64) * (n + 1) + follow, return_inverse=True)
        rank, distinct, reach = rank.astype(np.int32), len(found), reach * 2
        levels.append(rank)
    order = np.argsort(rank, kind="stable")
    i, j, lcp = order[:-1].copy(), order[1:].copy(), np.zeros(max(n - 1, 0), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = i + lcp, j + lcp
        inside = (a < n) & (b < n)
        same = np.zeros(len(i), bool)
        same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        lcp[same] += 1 << k
    kept = np.flatnonzero(lcp >= least)
    kept = kept[np.argsort(-lcp[kept], kind="stable")]
    return i[kept], j[kept], lcp[kept]


def find_runs(word: np.ndarray, length: int = LEAST_LENGTH, exponent: int = LEAST_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of one document's words, by start, then period."""
    first, second, lcps = suffix_edges(word, least_lcp(length, exponent))
    parent: dict[int, int] = {}
    members: dict[int, Positions] = {}
    out = []

    def root(x: int) -> int:
        if x not in parent:
            parent[x], members[x] = x, Positions(x)
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def seed(i: int, j: int, lcp: int) -> None:
        period = j - i
        if period <= lcp and period + lcp >= max(length, exponent * period) and (i == 0 or word[i - 1] != word[j - 1]):
            out.append((i, period + lcp, period))

    for i, j, lcp in zip(first.tolist(), second.tolist(), lcps.tolist()):
        a, b = root(i), root(j)
        if members[a].size < members[b].size:
            a, b = b, a
        parent[b] = a
        large, dealt = members[a], list(members.pop(b))
        last = -1
        for k, x in enumerate(dealt):
            before, after = large.add(x)
            if before >= 0 and before != last:
                seed(before, x, lcp)
            if after >= 0 and (k + 1 == len(dealt) or dealt[k + 1] > after):
                seed(x, after, lcp)
            last = x
    return sorted(out, key=lambda r: (r[0], r[2]))


def repeating(found: Words, least: int) -> np.ndarray:
    """Documents with two equal stretches of ``least`` words."""
    have = np.flatnonzero(found.count > least)
    if not len(have):
        return have
    n = len(found.hash)
    total, value, width, at = None, found.hash, 1, 0
    for bit in range(least.bit_length()):  # hash of ``least`` words from those of 1, 2, 4, .. words
        if least >> bit & 1:
            part = np.concatenate([value[at:], np.zeros(min(at, n), np.uint64)])
            total = part if total is None else mix(total * np.uint64(0x9FB21C651E98DF25) + part)
            at += width
        value = mix(value * np.uint64(0xD6E8FEB86659FD93) + np.concatenate([value[width:], np.zeros(min(width, n), np.uint64)]))
        width *= 2
    size = np.maximum(found.count - least + 1, 0)[have]
    owner = np.repeat(have, size)
    where = np.repeat(found.first[have], size) + np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    key = np.sort(mix(total[where] ^ mix(owner.astype(np.uint64))))
    doubled = key[1:][key[1:] == key[:-1]]
    if not len(doubled):
        return have[:0]
    mine = mix(total[where] ^ mix(owner.astype(np.uint64)))
    slot = np.minimum(np.searchsorted(doubled, mine), len(doubled) - 1)
    return np.unique(owner[doubled[slot] == mine])


def detect(docs: DataFrame, length: int = LEAST_LENGTH, exponent: int = LEAST_EXPONENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: n_words, its runs by start and period, and the text (UTF-8) of the words that no
    run contains after its first period, joined by one space."""
    least = least_lcp(length, exponent)

    def run(batches):
        for batch in pieces(batches, 1):
            found = words(batch.column(1))
            runs: dict[int, list] = {}
            for d in repeating(found, least).tolist():
                a = int(found.first[d])
                if mine := find_runs(found.hash[a:a + int(found.count[d])], length, exponent):
                    runs[d] = mine
            kept = []
            for d, text in enumerate(batch.column(1).to_pylist()):
                parts = (text or "").encode().split()
                if d in runs:
                    gone = np.zeros(len(parts) + 1, np.int64)
                    for start, size, period in runs[d]:
                        gone[start + period] += 1
                        gone[start + size] -= 1
                    parts = [w for w, g in zip(parts, np.cumsum(gone).tolist()) if not g]
                kept.append(b" ".join(parts))
            offsets = np.cumsum([0, *(len(runs.get(d, ())) for d in range(len(batch)))]).astype(np.int32)
            flat = np.array([r for d in sorted(runs) for r in runs[d]], np.int64).reshape(-1, 3)
            rows = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.count.astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), rows), pa.array(kept, pa.binary())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, FIELDS)
