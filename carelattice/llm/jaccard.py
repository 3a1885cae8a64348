"""N-gram Jaccard join by vertical partitioning: all documents whose sets of 5-word shingles overlap
by 80 % or more, as connected components.

1. Documents with equal sets form one class (64 bits identify it: with n different sets about n**2 / 2**65
   wrong merges are expected, two or three with 10**10 of them); all work below is on classes.
2. Global order of shingles: rare ones by hash, then those of many documents by count. The counts
   come from chunks of the whole corpus: a chunk reports each shingle that ``LOCAL`` or more of its
   classes hold, so a shingle in more than ``LOCAL`` classes of every chunk is never missed. The
   order only decides how fast the join is, never its result.
3. Two sets of similarity 0.8 share a shingle among the first n - ceil(0.8 n) + 1 of either in any
   order. Shingles that just one class has there are left out (bitmap, then exact count).
4. Round 1 pairs each class with the most central class of each of its buckets. Of the shingles that two
   components then still share, those stay whose place in the prefix leaves room for a link, for each step of
   partners' sizes. Round 2 takes every pair of components in buckets of up to ``LIGHT`` classes. Classes of larger
   buckets go on in rounds (``rounds``) with leads of other components; before each, classes leave whose prefixes in a
   new order (shingles that one component alone holds first) meet no other component. The last round takes all
   pairs left. A link is in one of the rounds or inside a component, so the components are those of all links.
5. Pairs are verified in the order's fragments: each fragment counts its partial overlap of a pair
   separately, and the counts are summed per pair. In rounds 1 and 2 the overlap of the prefixes comes first; most
   pairs can't reach the threshold any more after it, and the others' sets are not moved.

Defined results: null or blank texts have no shingle and are alone; fewer than five words make one
shingle of them all; equal ids count as separate rows; a null id is the smallest of its component
only if all its ids are null.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from carelattice.llm.bloom import bitmap, marked
from carelattice.llm.components import components
from carelattice.llm.frames import bound_batches, fetched, identified, lean, pieces, stored
from carelattice.llm.rounds import PERCENT, by_size, crossing_pairs, mixed_rows, open_by_prefix, star_pairs, still_open
from carelattice.llm.words import grams, mix, words

N = 5
CHUNK_SHINGLES = 2_000_000   # a chunk of the counting pass
LOCAL = 2                    # reported by a chunk from so many of its classes on
HEAVY = 16                   # placed at the end of the order from so many classes on
HEAVY_MOST = 2**18           # of these, the most frequent
FRAGMENTS = 4
LIGHT = 64                   # classes of a bucket whose pairs are listed at once
ROUNDS = 3                   # of stars; their number decides cost only
SEEN = 200_000               # classes that a task remembers so as to leave out copies


def least_overlap(n: np.ndarray) -> np.ndarray:
    return (n * PERCENT + 99) // 100


def shingle_sets(column: pa.Array, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, document by document, and the border of each document."""
    found = words(column, lower=True)
    hashed, at = grams(found, n)
    doc = found.doc
    owner = [doc[at]]
    parts = [hashed]
    for k in range(1, n):  # short texts as a whole
        whole, first = grams(found, k)
        short = found.count[doc[first]] == k
        parts.append(whole[short])
        owner.append(doc[first[short]])
    owner, hashed = np.concatenate(owner), np.concatenate(parts)
    order = np.lexsort((hashed, owner))
    owner, hashed = owner[order], hashed[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashed[1:] != hashed[:-1])
    owner, hashed = owner[new], hashed[new]
    return hashed, np.searchsorted(owner, np.arange(len(column) + 1))


def class_ids(hashed: np.ndarray, border: np.ndarray) -> np.ndarray:
    """64 bits that identify each set (0: empty), from two independent sums over its shingles."""
    out = np.zeros(len(border) - 1, np.uint64)
    if len(hashed):
        for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
            total = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashed ^ np.uint64(salt)), dtype=np.uint64)])
            out = mix(out + (total[border[1:]] - total[border[:-1]]))
    return np.where(np.diff(border) > 0, np.maximum(out, np.uint64(1)), np.uint64(0))


class Seen:
    """Classes that the task has met; forgotten when there are many, which only costs work."""

    def __init__(self):
        self.known: set[int] = set()

    def new(self, ids: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ids), bool)
        for i, x in enumerate(ids.tolist()):
            if x and x not in self.known:
                out[i] = True
                self.known.add(x)
        if len(self.known) > SEEN:
            self.known.clear()
        return out


def _chosen(hashed, border, pick):
    """Shingles of the picked documents, with their document."""
    owner = np.repeat(np.arange(len(border) - 1), np.diff(border))
    kept = pick[owner]
    return hashed[kept], owner[kept]


def repeated(held: list[np.ndarray], times: int) -> tuple[np.ndarray, np.ndarray]:
    """Values that ``held`` has so many times or more, and their counts; empties ``held``. Values that it has once, most of
    them, are sorted in place and not copied again."""
    value = np.concatenate(held) if held else np.zeros(0, np.uint64)
    held.clear()
    value.sort()
    if times > 1 and len(value):
        equal = np.concatenate([[False], value[1:] == value[:-1], [False]])
        value = value[equal[1:] | equal[:-1]]
    value, count = np.unique(value, return_counts=True)
    return value[count >= times], count[count >= times]


def heavy_shingles(docs: DataFrame, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of many classes, sorted, and their counts (at most ``HEAVY_MOST``)."""

    def run(batches):
        seen, held, size = Seen(), [], 0

        def report():
            shingle, count = repeated(held, LOCAL)
            return pa.RecordBatch.from_arrays([pa.array(shingle.view(np.int64)), pa.array(count)], names=["s", "n"])

        for batch in pieces(batches, 0):
            hashed, border = shingle_sets(batch.column(0), n)
            held.append(_chosen(hashed, border, seen.new(class_ids(hashed, border)))[0])
            size += len(held[-1])
            if size >= CHUNK_SHINGLES:
                yield report()
                size = 0
        yield report()

    counts = docs.select("text").mapInArrow(lean(run), "s bigint, n bigint").groupBy("s").agg(F.sum("n").alias("n"))
    top = fetched(counts.where(F.col("n") >= HEAVY).orderBy(F.desc("n"), "s").limit(HEAVY_MOST))
    shingle, count = top["s"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.argsort(shingle)
    return shingle[order], count[order]


def rank_of(hashed: np.ndarray, heavy: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """0 for rare shingles, the count for those of many classes."""
    if not len(heavy[0]):
        return np.zeros(len(hashed), np.int64)
    at = np.minimum(np.searchsorted(heavy[0], hashed), len(heavy[0]) - 1)
    return np.where(heavy[0][at] == hashed, heavy[1][at], 0)


def with_prefixes(docs: DataFrame, heavy, n: int = N) -> DataFrame:
    """doc_id, n (set size), class, and, for one document at least of each class, the prefix of its set."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)

    def run(batches):
        seen = Seen()
        for batch in pieces(batches, 1):
            hashed, border = shingle_sets(batch.column(1), n)
            size, ids = np.diff(border), class_ids(hashed, border)
            new = seen.new(ids)
            owner = np.repeat(np.arange(len(size)), size)
            order = np.lexsort((hashed, rank_of(hashed, shared.value), owner))  # within each document
            place = np.arange(len(owner)) - np.repeat(border[:-1], size)
            length = np.where(new, size - least_overlap(size) + 1, 0)
            kept = place < length[owner]
            offsets = np.concatenate([[0], np.cumsum(np.minimum(length, size))]).astype(np.int32)
            prefix = pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashed[order][kept].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(size.astype(np.int64)), pa.array(ids.view(np.int64)), prefix],
                names=["doc_id", "row_key", "n", "class", "prefix"])

    return docs.select("doc_id", "text", "row_key").mapInArrow(
        lean(run), "doc_id bigint, row_key bigint, n bigint, class bigint, prefix array<bigint>")


def shared_prefix_rows(sets: DataFrame) -> DataFrame:
    """(shingle, class, n, pos) for the prefix shingles that two classes or more have there."""
    once = sets.where("size(prefix) > 0")
    shingles = once.select(F.explode("prefix").alias("shingle"), "class").groupBy("shingle").agg(
        F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi")
    bits = sets.sparkSession.sparkContext.broadcast(bitmap(shingles, "shingle"))

    def run(batches):
        for batch in batches:
            prefix = batch.column(2)
            flat, offsets = prefix.flatten().to_numpy(zero_copy_only=False).view(np.uint64), prefix.offsets.to_numpy()
            offsets = offsets - offsets[0]
            owner = np.repeat(np.arange(len(batch)), np.diff(offsets))
            kept = marked(bits.value, flat)
            at = pa.array(owner[kept])
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat[kept].view(np.int64)), batch.column(0).take(at), batch.column(1).take(at),
                 pa.array((np.arange(len(owner)) - offsets[owner])[kept].astype(np.int64))],
                names=["shingle", "class", "n", "pos"])

    rows = once.select("class", "n", "prefix").mapInArrow(lean(run), "shingle bigint, class bigint, n bigint, pos bigint")
    rows = stored(rows, "prefix-rows", bits).distinct()
    again = rows.groupBy("shingle").agg(F.count("*").alias("bucket")).where("bucket > 1")
    rows = rows.join(again, "shingle")
    central = rows.groupBy("class").agg(F.count("*").alias("shared"))  # relative to the prefix's length
    before = F.row_number().over(Window.partitionBy("class").orderBy("pos")) - 1  # shared ones; a prefix at most
    return stored(rows.join(central, "class").select(
        "shingle", "class", "n", "pos", before.alias("before"), (F.col("shared") / prefix_length("n")).alias("central")), "buckets")


def may_link(a: str, b: str) -> F.Column:
    """Whether sizes and places of the common shingle leave room for a link. Of the shingles before it,
    only those that other classes have in their prefixes, too, can be common."""
    na, nb, pa_, pb, ba, bb = (F.col(x) for x in (f"{a}.n", f"{b}.n", f"{a}.pos", f"{b}.pos", f"{a}.before", f"{b}.before"))
    rest = F.least(na - pa_, nb - pb) + F.least(ba, bb)
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * PERCENT) & (rest * (100 + PERCENT) >= (na + nb) * PERCENT)


def _pairs(x: DataFrame) -> DataFrame:
    """Rows with a.class, a.n, b.class, b.n as distinct pairs, smaller class first."""
    first = F.col("a.class") < F.col("b.class")
    pick = lambda yes, no, name: F.when(first, F.col(yes)).otherwise(F.col(no)).alias(name)
    return x.where("a.class <> b.class").select(
        pick("a.class", "b.class", "a"), pick("b.class", "a.class", "b"), pick("a.n", "b.n", "na"), pick("b.n", "a.n", "nb")).distinct()


def central_pairs(rows: DataFrame) -> DataFrame:
    lead = rows.groupBy("shingle").agg(F.max_by(F.struct("class", "n", "pos", "before"), F.struct("central", "class")).alias("lead"))
    lead = lead.select("shingle", "lead.*")
    return _pairs(rows.alias("a").join(lead.alias("b"), "shingle").where(may_link("a", "b")))


def prefix_length(n: str) -> F.Column:
    return F.col(n) - F.floor((F.col(n) * PERCENT + 99) / 100) + 1


def hopeful(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs whose prefixes have enough in common. All common shingles up to the end of the prefix that
    ends first lie in both prefixes, and no more than the rest of its set can follow."""
    lists = rows.groupBy("class").agg(F.collect_list("shingle").alias("prefix"))
    both = pairs.join(lists.select(F.col("class").alias("a"), F.col("prefix").alias("x")), "a").join(
        lists.select(F.col("class").alias("b"), F.col("prefix").alias("y")), "b")
    rest = F.greatest(F.col("na") - prefix_length("na"), F.col("nb") - prefix_length("nb"))
    most = F.size(F.array_intersect("x", "y")) + rest
    return both.where(most * (100 + PERCENT) >= (F.col("na") + F.col("nb")) * PERCENT).select("a", "b", "na", "nb")


def both_ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()


def one_row_each(sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """The key of one row (class, row_key) of each ``wanted`` class, so that no other text is cut into shingles again."""
    return sets.join(wanted, "class", "left_semi").groupBy("class").agg(F.min("row_key").alias("row_key"))


def rows_marked(batches, bits: np.ndarray, key: int):
    """Of the batches, the rows whose key (column number) has its bit set."""
    for batch in batches:
        yield batch.filter(pa.array(marked(bits, batch.column(key).to_numpy().view(np.uint64))))


def segments(docs: DataFrame, sets: DataFrame, wanted: DataFrame, heavy, n: int = N) -> DataFrame:
    """(class, fragment, shingles) of the ``wanted`` classes of ``sets``, stored: the order cut into fragments, the last
    one for shingles of many classes."""
    bits = docs.sparkSession.sparkContext.broadcast((bitmap(wanted, "class"), heavy, bitmap(one_row_each(sets, wanted), "row_key")))

    def run(batches):
        seen = Seen()
        for batch in pieces(rows_marked(batches, bits.value[2], 1), 0):
            hashed, border = shingle_sets(batch.column(0), n)
            ids = class_ids(hashed, border)
            pick = seen.new(np.where(marked(bits.value[0], ids), ids, np.uint64(0)))
            kept, owner = _chosen(hashed, border, pick)
            rank = rank_of(kept, bits.value[1])
            part = np.where(rank > 0, FRAGMENTS - 1, (kept >> np.uint64(32)) * np.uint64(FRAGMENTS - 1) >> np.uint64(32)).astype(np.int64)
            key = owner * FRAGMENTS + part
            order = np.argsort(key, kind="stable")
            slot, size = np.unique(key, return_counts=True)
            offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[slot // FRAGMENTS].view(np.int64)), pa.array((slot % FRAGMENTS).astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(kept[order].view(np.int64)))],
                names=["class", "fragment", "shingles"])

    made = docs.select("text", "row_key").mapInArrow(lean(run), "class bigint, fragment int, shingles array<bigint>")
    return stored(made.join(wanted, "class", "left_semi").dropDuplicates(["class", "fragment"]), "segments", bits)


def verified(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs that link, with their overlap: counted in each fragment, summed per pair."""
    left = parts.select(F.col("class").alias("a"), "fragment", F.col("shingles").alias("x"))
    right = parts.select(F.col("class").alias("b"), "fragment", F.col("shingles").alias("y"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"]).select(
        "a", "b", "na", "nb", F.size(F.array_intersect("x", "y")).alias("common"))
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
    return total.where(F.expr(f"100 * common >= {PERCENT} * (na + nb - common)")).select("a", "b", "common")


def roots_of(docs: DataFrame, sets: DataFrame, rows: DataFrame, heavy, n: int = N) -> DataFrame:
    """(node, root) of all linked classes, round by round until no pair is left that could link two components."""
    first = stored(hopeful(central_pairs(rows), rows), "pairs")
    links = [stored(verified(first, segments(docs, sets, both_ends(first), heavy, n)), "links")]
    tested, roots = [first.select("a", "b")], stored(components(links[0]), "roots")
    flat = rows.select(F.col("shingle").alias("bucket"), "class", "n", "pos", F.col("class").alias("root"))
    mixed = stored(mixed_rows(flat, roots), "mixed")
    light, crowd = by_size(open_by_prefix(mixed), LIGHT)
    second = crossing_pairs(light).join(first, ["a", "b"], "left_anti")
    second = stored(hopeful(second, rows), "pairs")
    links.append(stored(verified(second, segments(docs, sets, both_ends(second), heavy, n)), "links"))
    tested.append(second.select("a", "b"))
    roots = stored(components(reduce(DataFrame.unionByName, links)), "roots")
    mixed = stored(mixed_rows(mixed.drop("pos").join(crowd, "class", "left_semi"), roots), "mixed")
    full, flat, turn, new = None, None, 1, True
    while mixed.limit(1).count():
        if full is None:
            full = segments(docs, sets, mixed.select("class").distinct(), heavy, n)
        prefixes, mixed, full, flat = still_open(mixed, full, flat)
        if not prefixes.limit(1).count():
            break
        last = not new or turn == ROUNDS or not mixed.limit(1).count()
        pairs = crossing_pairs(prefixes) if last else star_pairs(mixed, turn)
        pairs = stored(pairs.join(reduce(DataFrame.unionByName, tested), ["a", "b"], "left_anti"), "pairs")
        links.append(stored(verified(pairs, full), "links"))
        tested.append(pairs.select("a", "b"))
        new = links[-1].limit(1).count() > 0
        if new:
            roots = stored(components(reduce(DataFrame.unionByName, links)), "roots")
        if last:
            break
        mixed, turn = mixed_rows(mixed, roots), turn + 1
    return roots


def members(docs: DataFrame, n: int = N) -> DataFrame:
    """doc_id, row_key (64 bits of id and text), n (set size), class, root: one row a document. Rows with
    the same root are one component; empty sets are components of their own kind and share root 0."""
    docs = bound_batches(identified(docs))
    heavy = heavy_shingles(docs, n)
    sets = stored(with_prefixes(docs, heavy, n), "sets")
    roots = roots_of(docs, sets, shared_prefix_rows(sets), heavy, n)
    found = sets.select("doc_id", "row_key", "n", "class").join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
    return found.withColumn("root", F.coalesce("root", "class"))


def jaccard_components(docs: DataFrame, n: int = N) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links), class: one row a document."""
    found = members(docs.select("doc_id", "text"), n)
    least = found.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    return found.join(least, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"), "class")


def keep_one(docs: DataFrame, n: int = N) -> DataFrame:
    """``docs``, with all their columns, without all but one document (smallest id) of each component.
    Documents without words are linked with nothing and stay."""
    found = members(docs.select("doc_id", "text"), n)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    kept = found.where("n > 0").groupBy("root").agg(F.min_by("row_key", order).alias("__key")).select("__key")
    blank = found.where("n = 0").select(F.col("row_key").alias("__key")).distinct()
    keyed = docs.withColumn("__key", F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string")))
    once = keyed.join(kept, "__key", "left_semi").dropDuplicates(["__key"])
    return once.unionByName(keyed.join(blank, "__key", "left_semi")).drop("__key")
