"""Substring dedup by super-k-mers: words covered by a window of 35 words that starts anywhere else too.

1. The minimiser of a window is the smallest hash of its runs of ``M`` words (44 bits). Consecutive windows
   with the same minimiser make one super-k-mer. Equal windows have equal minimisers, so only
   minimisers that the corpus holds twice can matter: Spark counts them, and a bitmap of fixed
   size lets all others stay where they are.
2. The rest travels as one packed string per super-k-mer to the bucket of its minimiser. There all
   windows are sorted by 128 bits of their words and counted. The minimisers with most super-k-mers
   (``HOT`` at most) are dealt to several buckets of about ``HOT_ROWS``; windows that are alone in
   their bucket are compared once more across the buckets of their minimiser.
3. Windows found twice become word ranges, and each document drops the words in its ranges.

Defined results: null and blank texts have no word and the digest of the empty text; texts of under
35 words lose nothing; repeated rows (equal ids and texts, too) count as separate documents and lose
the same words. Rows are joined on 64 bits of id and text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from carelattice.llm.bloom import bitmap, marked
from carelattice.llm.frames import identified, pieces
from carelattice.llm.words import Words, grams, mix, words

WINDOW = 35
M = 5
HOT = 2**16
HOT_ROWS = 2000
_PLACE = np.uint64(20)


def super_kmers(found: Words, window: int = WINDOW, m: int = M) -> tuple[np.ndarray, ...]:
    """Document, first word, number of windows, minimiser and number of its places (2: several) of each
    super-k-mer."""
    n = len(found.hash)
    key = np.full(n + window, np.uint64(2**64 - 1))
    hashed, at = grams(found, m)
    key[at] = (hashed >> _PLACE << _PLACE) | (at.astype(np.uint64) & np.uint64(2**20 - 1))
    width, want = 1, window - m + 1
    while width < want:  # smallest of ``want`` consecutive runs, leftmost of equals
        step = min(width, want - width)
        key = np.minimum(key[:len(key) - step], key[step:])
        width += step
    size = np.maximum(found.count - window + 1, 0)
    owner = np.repeat(np.arange(len(size)), size)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    key = key[found.first[owner] + first]
    mini = key >> _PLACE
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (mini[1:] != mini[:-1])
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(owner))[:len(start)]
    places = 1 + (key[start] != key[end - 1])
    return owner[start], first[start], end - start, mini[start], places


def repeated_minimisers(docs: DataFrame, window: int, m: int) -> DataFrame:
    def run(batches):
        for batch in pieces(batches, 0):
            _, _, _, mini, places = super_kmers(words(batch.column(0)), window, m)
            value, inverse = np.unique(mini, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(value.view(np.int64)), pa.array(np.bincount(inverse, places, len(value)).astype(np.int64))], names=["mini", "n"])

    return docs.select("text").mapInArrow(run, "mini bigint, n bigint").groupBy("mini").agg(F.sum("n").alias("n")).where("n > 1")


def packed(docs: DataFrame, repeated: DataFrame, window: int, m: int) -> DataFrame:
    """(mini, salt, salts, row_key, first, words): super-k-mers whose minimiser may be repeated."""
    hot = repeated.where(F.col("n") > HOT_ROWS).orderBy(F.desc("n"), "mini").limit(HOT).toArrow()
    salts = {int(k): -(-int(n) // HOT_ROWS) for k, n in zip(hot["mini"].to_numpy(), hot["n"].to_numpy())}
    shared = docs.sparkSession.sparkContext.broadcast((bitmap(repeated, "mini"), salts))

    def run(batches):
        bits, many = shared.value
        for batch in pieces(batches, 0):
            doc, first, size, mini, _ = super_kmers(words(batch.column(0)), window, m)
            kept = np.flatnonzero(marked(bits, mini))
            texts, last, split = [], -1, []
            for i, a, n in zip(doc[kept].tolist(), first[kept].tolist(), size[kept].tolist()):
                if i != last:
                    split, last = batch.column(0)[i].as_py().encode().split(), i
                texts.append(b" ".join(split[a:a + n + window - 1]))
            of = [many.get(x, 1) for x in mini[kept].tolist()]
            key = batch.column(1).take(pa.array(doc[kept]))
            salt = mix(key.to_numpy().view(np.uint64)) % np.array(of, np.uint64) if of else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(mini[kept].view(np.int64)), pa.array(salt.astype(np.int32)), pa.array(of, pa.int32()), key,
                 pa.array(first[kept].astype(np.int32)), pa.array(texts, pa.binary())],
                names=["mini", "salt", "salts", "row_key", "first", "words"])

    return docs.select("text", "row_key").mapInArrow(run, "mini bigint, salt int, salts int, row_key bigint, first int, words binary")


def _windows(table: pa.Table, window: int):
    """Windows of whole buckets: row, offset in the row, 128 bits, and how often the bucket holds them."""
    column = table["words"].combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    found = words(column)
    one, at = grams(found, window)
    row = found.doc[at]
    two, _ = grams(found._replace(hash=mix(found.hash ^ np.uint64(0x2545F4914F6CDD1D))), window)
    mini, salt = table["mini"].to_numpy(), table["salt"].to_numpy()
    bucket = np.cumsum(np.append(0, (mini[1:] != mini[:-1]) | (salt[1:] != salt[:-1])))[row]
    order = np.lexsort((two, one, bucket))
    new = np.ones(len(order), bool)
    b, x, y = bucket[order], one[order], two[order]
    new[1:] = (b[1:] != b[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    group = np.cumsum(new) - 1
    count = np.empty(len(order), np.int64)
    count[order] = np.bincount(group)[group] if len(order) else 0
    opening = np.empty(len(order), bool)
    opening[order] = new
    return row, at - found.first[row], one, two, count, opening


def count_buckets(batches, window: int):
    """Sorted buckets in; word ranges of windows found twice out, and what salted buckets leave open."""
    names = ["row_key", "a", "z", "mini", "one", "two"]

    def judged(table):
        row, offset, one, two, count, opening = _windows(table, window)
        key, first = table["row_key"].to_numpy(), table["first"].to_numpy().astype(np.int64)
        twice = np.flatnonzero(count > 1)
        if len(twice):
            starts = np.ones(len(twice), bool)  # windows in a row of one super-k-mer join to one range
            starts[1:] = (row[twice][1:] != row[twice][:-1]) | (offset[twice][1:] != offset[twice][:-1] + 1)
            at = np.flatnonzero(starts)
            ends = twice[np.append(at[1:], len(twice)) - 1]
            r = row[twice[at]]
            none = pa.nulls(len(at), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[r]), pa.array(first[r] + offset[twice[at]]), pa.array(first[r] + offset[ends] + window), none, none, none], names=names)
        salted = table["salts"].to_numpy()[row] > 1
        open_ = np.flatnonzero(salted & opening)
        if len(open_):
            alone, r = count[open_] == 1, row[open_]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[r], mask=~alone), pa.array(first[r] + offset[open_]), pa.array(first[r] + offset[open_] + window),
                 pa.array(table["mini"].to_numpy()[r]), pa.array(one[open_].view(np.int64)), pa.array(two[open_].view(np.int64))], names=names)

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        mini, salt = table["mini"].to_numpy(), table["salt"].to_numpy()
        border = np.flatnonzero((mini != mini[-1]) | (salt != salt[-1])) if len(mini) else []
        whole = int(border[-1]) + 1 if len(border) else 0
        if whole:
            yield from judged(table.slice(0, whole).combine_chunks())
        held = table.slice(whole)
    if held is not None and len(held):
        yield from judged(held.combine_chunks())


def repeated_ranges(docs: DataFrame, window: int = WINDOW, m: int = M) -> DataFrame:
    """(row_key, ranges): the word ranges of each document that windows found twice cover."""
    repeated = repeated_minimisers(docs, window, m)
    rows = packed(docs, repeated, window, m).repartition("mini", "salt").sortWithinPartitions("mini", "salt")
    found = rows.mapInArrow(lambda batches: count_buckets(batches, window), "row_key bigint, a bigint, z bigint, mini bigint, one bigint, two bigint")
    # at most one row for each salt of a minimiser and window
    across = found.where("mini is not null").groupBy("mini", "one", "two").agg(
        F.count("*").alias("n"), F.collect_list(F.when(F.col("row_key").isNotNull(), F.struct("row_key", "a", "z"))).alias("alone"))
    across = across.where("n > 1").select(F.explode("alone").alias("r")).select("r.*")
    ranges = found.where("mini is null").select("row_key", "a", "z").unionByName(across)
    return ranges.groupBy("row_key").agg(F.sort_array(F.collect_set(F.struct("a", "z"))).alias("ranges"))


FIELDS = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


def without_ranges(parts: list[bytes], ranges: list[dict] | None) -> list[bytes]:
    if not ranges:
        return parts
    out, at = [], 0
    for r in ranges:
        out += parts[at:max(at, r["a"])]
        at = max(at, r["z"])
    return out + parts[at:]


def dedup(docs: DataFrame, window: int = WINDOW, m: int = M, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row a document: n_words, n_removed, digest of the kept words, and on request the kept words."""
    docs = identified(docs, id_col, text_col)
    # ranges are read by the join alone; the scan is repeated instead of kept
    joined = docs.join(repeated_ranges(docs, window, m), "row_key", "left").select("doc_id", "text", "ranges")

    def run(batches):
        for batch in pieces(batches, 1):
            n_words, removed, digest, kept_text = [], [], [], []
            for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                parts = (text or "").encode().split()
                kept = without_ranges(parts, ranges)
                whole = b" ".join(kept)
                n_words.append(len(parts))
                removed.append(len(parts) - len(kept))
                digest.append(hashlib.sha256(whole).hexdigest())
                kept_text.append(whole if with_text else None)
            columns = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns.append(pa.array([x.decode() for x in kept_text], pa.string()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(run, FIELDS + (", kept string" if with_text else ""))
