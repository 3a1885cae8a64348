"""MinHash near-dedup with circulant signatures: documents whose sets of 2-word shingles overlap by 80 % or
more, as connected components.

1. Signature: a first permutation s of the 2**32 places spreads the shingles, a second one p gives the
   values; coordinate k is the smallest p(s(x) + k), so that two permutations, the second shifted
   circularly by one place a coordinate, make all coordinates.
2. ``BANDS`` bands of ``ROWS`` coordinates. Two sets at similarity 0.8 agree in one band at least except with
   a probability of (1 - 0.8**ROWS)**BANDS = 5e-6, more similar ones with less. That is the only loss.
3. Documents with equal sets are one class; all further work is on classes that share a band's bucket with
   another class.
4. Star rounds: in each bucket that still holds two components, each class is compared with one lead of
   another component. Rounds go on until one finds no link (``ROUNDS`` at most; their number decides cost only).
   In large groups of near copies nearly all classes end in one component without pairs among them.
5. Between rounds, classes that can't have a link out of their component leave. In any order of the shingles, two
   sets with m in common share one among the first n - m + 1 of either. The order: shingles that one component
   alone holds, then the others by the number of holders. m follows from the own size and the partner's,
   so each class has a prefix for each step of partners' sizes (``rounds.STEP`` apart). A class stays if one of its
   prefix shingles is in the prefix of a class in another component, sizes fitting; outliers, whose own
   shingles come first, leave.
6. The last turn compares every pair of classes in two components that share such a prefix shingle. No link
   between candidates can be missed here, so the components are those of all links among them.
7. Every comparison is exact, on the full sets; those whose sizes alone rule out a link are not made.

A class is told by 64 bits of its set, a shingle by 64 bits of its words: of 10**9 different sets, two
fall together with a probability of about 3 %.

Defined results: null or blank texts have no shingle and are alone; fewer than two words make one shingle;
equal ids count as separate rows; a null id is the smallest of its component only if all its ids are
null; ``kept`` is true where id and component are the same, nulls included. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from carelattice.llm.bloom import bitmap, marked
from carelattice.llm.components import components
from carelattice.llm.frames import bound_batches, identified, pieces, stored
from carelattice.llm.jaccard import Seen, class_ids, one_row_each, rows_marked, shingle_sets
from carelattice.llm.rounds import PERCENT, crossing_pairs, mixed_rows, star_pairs, still_open
from carelattice.llm.words import mix

N = 2
ROWS = 6
BANDS = 40
ROUNDS = 3
LOOKS = 1 << 14   # shingles whose coordinates are computed at once


def permuted(x: np.ndarray, one: int, two: int) -> np.ndarray:
    """A permutation of the numbers under 2**32."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(one)
    x ^= x >> np.uint32(13)
    x *= np.uint32(two)
    x ^= x >> np.uint32(16)
    return x


def signatures(hashed: np.ndarray, border: np.ndarray, coordinates: int) -> np.ndarray:
    """One row of ``coordinates`` for each set (all ones for empty ones)."""
    out = np.full((len(border) - 1, coordinates), 2**32 - 1, np.uint32)
    place = permuted((hashed >> np.uint64(32)).astype(np.uint32), 0x85EBCA6B, 0xC2B2AE35)
    held = np.flatnonzero(np.diff(border))
    at = 0
    while at < len(held):  # sets of about ``LOOKS`` shingles together, so that they stay in the cache
        end = max(at + 1, int(np.searchsorted(border[held], border[held[at]] + LOOKS)))
        some = held[at:end]
        a, z = border[some[0]], border[some[-1] + 1]
        first = border[some] - a
        for k in range(coordinates):
            out[some, k] = np.minimum.reduceat(permuted(place[a:z] + np.uint32(k), 0x7FEB352D, 0x846CA68B), first)
        at = end
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """64 bits of each band's number and coordinates."""
    out = np.empty((len(signature), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(signature), mix(np.array([b + 1], np.uint64))[0])
        for k in range(rows):
            key = mix(key * np.uint64(0x9FB21C651E98DF25) + signature[:, b * rows + k])
        out[:, b] = key
    return out


def signed(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, row_key, n (set size), class, and, for one document at least of each class, its band keys."""

    def run(batches):
        seen = Seen()
        for batch in pieces(batches, 1):
            hashed, border = shingle_sets(batch.column(1), n)
            size, ids = np.diff(border), class_ids(hashed, border)
            new = np.flatnonzero(seen.new(ids))
            owner = np.repeat(np.arange(len(size)), size)
            pick = np.zeros(len(size), bool)
            pick[new] = True
            some = np.concatenate([[0], np.cumsum(size[new])])
            keys = band_keys(signatures(hashed[pick[owner]], some, bands * rows), bands, rows)
            held = np.zeros(len(size), np.int64)
            held[new] = bands
            offsets = np.concatenate([[0], np.cumsum(held)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(size.astype(np.int64)), pa.array(ids.view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1).view(np.int64)))],
                names=["doc_id", "row_key", "n", "class", "bands"])

    return docs.select("doc_id", "text", "row_key").mapInArrow(run, "doc_id bigint, row_key bigint, n bigint, class bigint, bands array<bigint>")


def shared_bands(sets: DataFrame) -> DataFrame:
    """(bucket, class, n, shared): the buckets of two classes or more; ``shared`` is how many of them the class is in."""
    once = sets.where("size(bands) > 0").select("class", "n", "bands")
    buckets = once.select(F.explode("bands").alias("bucket"), "class").groupBy("bucket").agg(
        F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi")
    bits = sets.sparkSession.sparkContext.broadcast(bitmap(buckets, "bucket"))

    def run(batches):
        for batch in batches:
            keys = batch.column(2)
            flat, offsets = keys.flatten().to_numpy(zero_copy_only=False), keys.offsets.to_numpy()
            offsets = offsets - offsets[0]
            kept = marked(bits.value, flat.view(np.uint64))
            owner = np.repeat(np.arange(len(batch)), np.diff(offsets))
            held = np.bincount(owner[kept], minlength=len(batch))
            some = pa.array(np.flatnonzero(held))
            mine = np.concatenate([[0], np.cumsum(held[held > 0])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(some), batch.column(1).take(some), pa.ListArray.from_arrays(pa.array(mine), pa.array(flat[kept]))],
                names=["class", "n", "bands"])

    found = stored(once.mapInArrow(run, "class bigint, n bigint, bands array<bigint>").dropDuplicates(["class"]), "banded")
    rows = found.select("class", "n", F.size("bands").alias("shared"), F.explode("bands").alias("bucket"))
    again = rows.groupBy("bucket").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("bucket")
    return stored(rows.join(again, "bucket"), "buckets")


def full_sets(docs: DataFrame, sets: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(class, shingles) of the wanted classes of ``sets``, once each."""
    bits = docs.sparkSession.sparkContext.broadcast((bitmap(wanted, "class"), bitmap(one_row_each(sets, wanted), "row_key")))

    def run(batches):
        seen = Seen()
        for batch in pieces(rows_marked(batches, bits.value[1], 1), 0):
            hashed, border = shingle_sets(batch.column(0), n)
            ids = class_ids(hashed, border)
            new = seen.new(np.where(marked(bits.value[0], ids), ids, np.uint64(0)))
            size = np.diff(border)
            offsets = np.concatenate([[0], np.cumsum(size[new])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[new].view(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashed[np.repeat(new, size)].view(np.int64)))],
                names=["class", "shingles"])

    made = docs.select("text", "row_key").mapInArrow(run, "class bigint, shingles array<bigint>")
    return made.join(wanted, "class", "left_semi").dropDuplicates(["class"])


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets overlap enough."""
    x, y = sets.select(F.col("class").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("class").alias("b"), F.col("shingles").alias("y"))
    common = pairs.join(x, "a").join(y, "b").select("a", "b", "na", "nb", F.size(F.array_intersect("x", "y")).alias("common"))
    return common.where(F.expr(f"100 * common >= {PERCENT} * (na + nb - common)")).select("a", "b", "common")


def members(docs: DataFrame, n: int = N, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n (set size), class, root: one row a document. Rows with the same root are one component; empty
    sets share root 0 and are linked with nothing."""
    docs = bound_batches(identified(docs))
    sets = stored(signed(docs, n, bands, rows), "signed")
    buckets = shared_bands(sets)
    full = stored(full_sets(docs, sets, buckets.select("class").distinct(), n), "sets")
    mixed, flat, links, tested, roots, new = buckets.withColumn("root", F.col("class")), None, [], [], None, True
    for turn in range(ROUNDS + 1):
        last = not new or turn == ROUNDS
        if turn:
            first, mixed, full, flat = still_open(mixed_rows(mixed, roots), full, flat)
            if not first.limit(1).count():
                break
            last = last or not mixed.limit(1).count()
        pairs = crossing_pairs(first) if last else star_pairs(mixed, turn)
        if tested:
            pairs = pairs.join(reduce(DataFrame.unionByName, tested), ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        links.append(stored(linked(pairs, full), "found"))
        tested.append(pairs.select("a", "b"))
        new = links[-1].limit(1).count() > 0
        if new or roots is None:
            roots = stored(components(reduce(DataFrame.unionByName, links)), "roots")
        if last:
            break
    found = sets.select("doc_id", "n", "class").join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
    return found.withColumn("root", F.coalesce("root", "class"))


def near_copies(docs: DataFrame, n: int = N) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links), kept, class: one row a document."""
    found = members(docs, n)
    least = found.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return found.join(least, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "class")
