"""Words of whole text columns, as numpy arrays: the shared first step of the Arrow operators.

A word is a maximal run of bytes other than space and \\t-\\r. Hashes are 64 bits; two different
words (or shingles) are taken for the same one with a probability of about pairs / 2**64.
Memory: text is hashed in segments of 128 KB, cut between words.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 17
_BASES = [0x9E3779B97F4A7C15, 0xD1342543DE82EF95]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def separators(data: np.ndarray) -> np.ndarray:
    return (data == 0x20) | (data - np.uint8(9) < 5)


def newlines(data: np.ndarray) -> np.ndarray:
    return data == 0x0A


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z; all other bytes as they are."""
    return data + ((data - np.uint8(65) < 26) * np.uint8(32))


class Words(NamedTuple):
    data: np.ndarray     # the column's bytes, lower-cased on request
    bounds: np.ndarray   # byte offsets of the documents, one more than there are documents
    start: np.ndarray    # byte offset of each word
    end: np.ndarray
    hash: np.ndarray     # uint64
    count: np.ndarray    # words of each document
    first: np.ndarray    # index of each document's first word

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def text(self, index: int) -> bytes:
        return self.data[self.start[index]:self.end[index]].tobytes()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its rows; null counts as empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at.astype(np.int64) - at[0]


def _powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base modulo 2**64, and of its inverse."""
    if which not in _POWERS or len(_POWERS[which][0]) < n:
        size = max(n, SEGMENT + 1)
        made = []
        for base in (_BASES[which], pow(_BASES[which], -1, 2**64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        _POWERS[which] = tuple(made)
    return _POWERS[which]


def _cuts(gap: np.ndarray) -> list[int]:
    """Segment borders at word borders; ``gap`` marks bytes where a word can't continue."""
    cuts, n = [0], len(gap)
    while n - cuts[-1] > SEGMENT:
        target = cuts[-1] + SEGMENT
        back = np.flatnonzero(gap[max(cuts[-1] + 1, target - 4096):target])
        if len(back):
            cuts.append(int(max(cuts[-1] + 1, target - 4096) + back[-1]))
            continue
        ahead = target
        while ahead < n:
            found = np.flatnonzero(gap[ahead:ahead + SEGMENT])
            if len(found):
                ahead += int(found[0])
                break
            ahead += SEGMENT
        cuts.append(min(ahead, n))
    return cuts + [n] if cuts[-1] < n else cuts


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans of ``data``."""
    value = data.astype(np.uint64)
    out = (end - start).astype(np.uint64)
    for which in range(2):  # polynomials in two bases
        power, inverse = _powers(len(data) + 1, which)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(value * power[:len(data)], out=total[1:])
        part = (total[end] - total[start]) * inverse[start]
        part ^= part >> np.uint64(32)
        out = (out ^ part) * np.uint64(_BASES[which] | 1)
        out ^= out >> np.uint64(29)
    return mix(out)


def spans(column: pa.Array, separator, lower: bool = False) -> Words:
    """Maximal runs of non-separator bytes within each row, with their hashes."""
    data, bounds = column_bytes(column)
    if lower:
        data = lowered(data)
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    gap = separator(data)
    starts, ends, hashes = [], [], []
    borders = _cuts(gap | edge[:n]) if n else [0]
    for a, z in zip(borders[:-1], borders[1:]):
        inside = ~gap[a:z]
        left = inside.copy()
        left[1:] &= gap[a:z - 1] | edge[a + 1:z]
        right = inside.copy()
        right[:-1] &= gap[a + 1:z] | edge[a + 1:z]
        start, end = np.flatnonzero(left), np.flatnonzero(right) + 1
        hashes.append(hash_spans(data[a:z], start, end))
        starts.append(start + a)
        ends.append(end + a)
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    start, end, hashed = join(starts, np.int64), join(ends, np.int64), join(hashes, np.uint64)
    first = np.searchsorted(start, bounds)
    return Words(data, bounds, start, end, hashed, np.diff(first), first[:-1])


def words(column: pa.Array, lower: bool = False) -> Words:
    return spans(column, separators, lower)


def lines(column: pa.Array) -> Words:
    """Pieces between newlines (empty ones are left out)."""
    return spans(column, newlines)


def grams(found: Words, n: int, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``n`` words of one document, and the index of each run's first word.
    ``skip`` leaves out that many words after the first."""
    reach = n + skip
    last = found.first + found.count - reach
    size = np.maximum(found.count - reach + 1, 0)
    at = np.repeat(np.maximum(last - size + 1, 0), size) + ramp(size)
    total = np.zeros(len(at), np.uint64)
    for k in [0, *range(1 + skip, reach)]:
        total = total * np.uint64(0x9FB21C651E98DF25) + found.hash[at + k]
    return mix(total + np.uint64(n * 64 + skip)), at


def ramp(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. size - 1 for each size, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def sum_by(group: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(group, weights=value, minlength=n)
