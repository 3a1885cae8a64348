"""Quality rules: counts over words and lines, and bands of zstandard ratios.

``compression_bands`` judges every text by how well it compresses. A ratio is compressed bytes
over bytes. The whole text must lie between the limits for its length; so must more than half of
its fixed chunks of ``CHUNK`` bytes (a last chunk below half of that is left out). Repetitive text
falls below the lower limit, random text above the upper one.

Defined results: a null text counts as empty; an empty text has ratio 0, no chunk, and fails the
base rule; repeated rows and equal ids are judged one by one; columns of the same names as the
results are replaced. Texts of any length are read whole; memory is a few times the Arrow batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from carelattice.llm.frames import append
from carelattice.llm.words import Words, grams, lines, mix, separators, words

LEVEL = 3
CHUNK = 2048
#: From so many bytes on: lowest and highest ratio of the whole text.
BANDS = [(0, 0.0, 9.9), (64, 0.40, 2.5), (128, 0.42, 1.3), (256, 0.45, 0.90), (512, 0.42, 0.80),
         (1024, 0.40, 0.74), (2048, 0.37, 0.70), (4096, 0.34, 0.68), (16384, 0.30, 0.66)]
CHUNK_BAND = (0.36, 0.74)
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5

SYMBOLS = b"#*$%&|<>"

FIELDS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "ratio double, n_chunks bigint, n_odd_chunks bigint, base_failed boolean, kept boolean"
)


def flags_within(bounds: np.ndarray, flag: np.ndarray) -> np.ndarray:
    """How many flags each document has."""
    total = np.zeros(len(flag) + 1, np.int64)
    np.cumsum(flag, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _keys(doc: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    return mix(hashed + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def repeat_words(found: Words, n: int = WINDOW) -> np.ndarray:
    """Words of each document in windows of ``n`` words that the document holds twice or more."""
    hashed, at = grams(found, n)
    doc = found.doc
    key = _keys(doc[at], hashed)
    ordered = np.sort(key)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(again):
        return np.zeros(len(found.count), np.int64)
    place = np.minimum(np.searchsorted(again, key), len(again) - 1)
    twice = at[again[place] == key]
    covered = np.bincount(twice, minlength=len(doc) + 1) - np.bincount(twice + n, minlength=len(doc) + 1)
    flag = np.cumsum(covered)[:-1] > 0
    return np.bincount(doc[flag], minlength=len(found.count))


def duplicate_lines(column: pa.Array, word_bytes: np.ndarray, n: int) -> np.ndarray:
    """Lines with a word that equal an earlier line of the document."""
    found = lines(column)
    total = np.concatenate([[0], np.cumsum(word_bytes)])
    real = total[found.end] > total[found.start]
    doc = found.doc[real]
    _, first = np.unique(_keys(doc, found.hash[real]), return_index=True)
    return np.bincount(doc, minlength=n) - np.bincount(doc[first], minlength=n)


def base_counts(column: pa.Array) -> dict:
    found = words(column)
    n = len(found.count)
    word_bytes = ~separators(found.data)
    symbol = np.zeros(len(found.data), bool)
    for byte in SYMBOLS:
        symbol |= found.data == byte
    return {
        "n_words": found.count.astype(np.int64),
        "word_chars": flags_within(found.bounds, word_bytes & ((found.data & 0xC0) != 0x80)),
        "n_symbols": flags_within(found.bounds, symbol),
        "n_dup_lines": duplicate_lines(column, word_bytes, n).astype(np.int64),
        "n_repeat_words": repeat_words(found).astype(np.int64),
        "_found": found,
    }


def compression(found: Words, bands=BANDS, chunk: int = CHUNK, chunk_band=CHUNK_BAND, level: int = LEVEL) -> dict:
    """Ratio of each whole text, its chunks, and the verdict of the bands."""
    packer = zstandard.ZstdCompressor(level=level)
    n = len(found.count)
    ratio, chunks, odd = np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(n):
        a, z = int(found.bounds[i]), int(found.bounds[i + 1])
        if a == z:
            continue
        ratio[i] = len(packer.compress(found.data[a:z])) / (z - a)
        for at in range(a, z, chunk):
            size = min(chunk, z - at)
            if 2 * size < chunk:
                break
            part = len(packer.compress(found.data[at:at + size])) / size
            chunks[i] += 1
            odd[i] += not chunk_band[0] <= part <= chunk_band[1]
    size = np.diff(found.bounds)
    band = np.searchsorted([b[0] for b in bands], size, side="right") - 1
    low, high = np.array([b[1] for b in bands])[band], np.array([b[2] for b in bands])[band]
    return {"ratio": ratio, "n_chunks": chunks, "n_odd_chunks": odd,
            "in_band": (ratio >= low) & (ratio <= high) & (2 * odd <= chunks)}


def judge(column: pa.Array) -> dict:
    base = base_counts(column)
    packed = compression(base.pop("_found"))
    failed = (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * base["n_words"])
    kept = packed.pop("in_band") & ~failed
    return {**base, **packed, "base_failed": failed, "kept": kept}


def compression_bands(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` (all columns but the text) with the counts, ratios and verdict of each text."""
    return append(docs, text_col, FIELDS, judge)
