"""Hard-negative mining over anchor-clustered shared lists (MAXIMUS).

1. Components become floor(``SCALE`` * x); all scores are integer inner products of these.
2. Anchors are clustered by direction: spherical k-means fitted on ``SAMPLE`` anchors at most (the ones with
   the smallest hashes); every anchor goes to its nearest centroid. A cluster knows the largest angle t between its
   centroid and a member.
3. The shared list of a cluster holds all rows by descending upper bound |row| * cos(max(0, angle(row,
   centroid) - t)); a member's score with a row is at most |member| times that. The bounds of all rows
   are counted in ``BINS`` bins a cluster, which tells how many rows a stretch of a list has before
   it is made.
4. The head of each list (``HEAD`` rows, by whole bins) is walked first. The worst entry that each member holds after
   it tells how far down the list a better one can be; only that stretch is made and walked then. All
   else is certified to be of no use. No list is cut short otherwise.
5. A stretch of a list is dealt into pieces of about ``PIECE`` rows, and a cluster's members into blocks of about
   ``BLOCK``. Each pair of piece and block is one group: the piece is sorted by bound once, all members of the
   block walk it in slabs, and a member leaves when the next bound certifies that it is done.
   Pieces are dealt by row number, so that equal vectors or ids do not meet in one group.

Positives are walked first; their scores set the negatives' limits. Of several rows with an anchor's id, the one with
the smallest label and vector is the anchor; all of them are candidates, except for the anchor of their id.
Rows with a null id, label, vector or component, or a component that is not finite, take no part. Shorter
vectors count as ending in zeros. Components are held within +-2**28 after scaling; scores are exact
as long as they fit 64 bits. Repeated rows are candidates of their own. Ties go to the smaller id.
Other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from carelattice.llm.frames import stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LEAST_PERCENT = 30
MOST_PERCENT = 90
CLUSTERS = 8
SAMPLE = 20_000
STEPS = 8
BINS = 2048
HEAD = 16_384
PIECE = 8192
BLOCK = 512
SLAB = 1024
SLACK = 1e-6      # widens the bounds against rounding
EXACT = 2**53
NONE = -2**62
ALL = 2**62


def quantised(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v) of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    most = float(2**28)
    v = F.transform("embedding", lambda x: F.greatest(F.lit(-most), F.least(F.lit(most), F.floor(x.cast("double") * scale).cast("double"))).cast("int"))
    return rows.where("vec_id is not null and label is not null and embedding is not null").where(finite).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), v.alias("v"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows of a matrix, shorter ones filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    flat, offsets = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    size = np.diff(offsets)
    out = np.zeros((len(column), dim), np.int64)
    owner = np.repeat(np.arange(len(size)), size)
    out[owner, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], size)] = flat
    return out


def lengths(m: np.ndarray) -> np.ndarray:
    return np.sqrt((m.astype(np.float64) ** 2).sum(axis=1))


def directions(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(lengths(m), 1e-300)[:, None]


def centroids(anchors: DataFrame, dim: int, clusters: int = CLUSTERS, sample: int = SAMPLE) -> np.ndarray:
    """Unit vectors from spherical k-means over a bounded sample; starts from the first of them that lie farthest apart."""
    some = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").toArrow()
    unit = directions(matrix(some["v"], dim)) if len(some) else np.zeros((0, dim))
    unit = unit[lengths(unit) > 0]
    if not len(unit):
        return np.eye(1, dim)
    found, near = [unit[0]], unit @ unit[0]
    while len(found) < min(clusters, len(unit)):
        found.append(unit[int(np.argmin(near))])
        near = np.maximum(near, unit @ found[-1])
    centre = np.array(found)
    for _ in range(STEPS):
        nearest = np.argmax(unit @ centre.T, axis=1)
        for c in range(len(centre)):
            total = unit[nearest == c].sum(axis=0)
            size = np.sqrt((total ** 2).sum())
            centre[c] = total / size if size > 0 else centre[c]
    return centre


def clustered(anchors: DataFrame, centre: np.ndarray, dim: int) -> DataFrame:
    """The anchors with cluster, angle to its centroid and length."""
    def run(batches):
        for batch in batches:
            m = matrix(batch.column(2), dim)
            cosine = directions(m) @ centre.T
            cluster = np.argmax(cosine, axis=1)
            size = lengths(m)
            angle = np.where(size > 0, np.arccos(np.clip(cosine[np.arange(len(m)), cluster], -1, 1)), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cluster.astype(np.int32)), pa.array(angle), pa.array(size)],
                                             names=["vec_id", "label", "v", "cluster", "angle", "length"])

    return anchors.select("vec_id", "label", "v").mapInArrow(run, "vec_id bigint, label bigint, v array<int>, cluster int, angle double, length double")


class Lists:
    """The clusters' shared lists: bounds of rows, and how many rows lie in each bin of bounds."""

    def __init__(self, rows: DataFrame, centre: np.ndarray, width: np.ndarray, dim: int, longest: float):
        self.rows, self.centre, self.width, self.dim, self.longest = rows, centre, width, dim, max(longest, 1.0)
        k = len(centre)
        bounds, bins = self.bounds, self.bins

        def run(batches):
            for batch in batches:
                at = bins(bounds(batch.column(0))) + np.arange(k) * BINS
                slot, n = np.unique(at, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(n.astype(np.int64))], names=["slot", "n"])

        counts = rows.select("v").mapInArrow(run, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
        self.count = np.zeros(k * BINS, np.int64)
        self.count[counts["slot"].to_numpy()] = counts["n"].to_numpy()
        self.count = self.count.reshape(k, BINS)

    def __getstate__(self):  # tasks need the numbers only
        return {**self.__dict__, "rows": None}

    def bounds(self, column: pa.Array) -> np.ndarray:
        """Row by cluster: the most that a member of length 1 can score."""
        m = matrix(column, self.dim)
        angle = np.arccos(np.clip(directions(m) @ self.centre.T, -1, 1))
        return lengths(m)[:, None] * (np.cos(np.maximum(0.0, angle - self.width - SLACK)) + SLACK)

    def bins(self, bound: np.ndarray) -> np.ndarray:
        return np.clip(((bound / self.longest + 1) * (BINS / 2)).astype(np.int64), 0, BINS - 1)

    def bin_of(self, bound: np.ndarray) -> np.ndarray:
        """The bin in which a walk may stop that looks for this bound or more."""
        return self.bins(np.clip(bound, -self.longest, self.longest))

    def head(self) -> np.ndarray:
        """For each cluster, the first bin of the head of its list."""
        below = np.cumsum(self.count[:, ::-1], axis=1)[:, ::-1]  # rows in this bin or a better one
        enough = below >= HEAD
        return np.where(enough.any(axis=1), BINS - 1 - np.argmax(enough[:, ::-1], axis=1), 0)

    def stretch(self, low: np.ndarray, high: np.ndarray) -> DataFrame | None:
        """(cluster, piece, vec_id, label, v, bound) of the rows in the bins from ``low`` up to ``high``, or None where there are none."""
        at = np.arange(BINS)
        rows = np.where((at >= low[:, None]) & (at < high[:, None]), self.count, 0).sum(axis=1)
        if not rows.sum():
            return None
        self.pieces = np.maximum(1, -(-rows // PIECE)) * (rows > 0)
        pieces, bounds, bins = self.pieces, self.bounds, self.bins

        def run(batches):
            turn = 0
            for batch in batches:
                bound = bounds(batch.column(2))
                b = bins(bound)
                for c in np.flatnonzero(pieces):
                    kept = np.flatnonzero((b[:, c] >= low[c]) & (b[:, c] < high[c]))
                    if len(kept):
                        some = pa.array(kept)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(kept), c, np.int32)), pa.array(((kept + turn) % pieces[c]).astype(np.int32)), batch.column(0).take(some),
                             batch.column(1).take(some), batch.column(2).take(some), pa.array(bound[kept, c])],
                            names=["cluster", "piece", "vec_id", "label", "v", "bound"])
                turn += len(batch)

        return self.rows.select("vec_id", "label", "v").mapInArrow(run, "cluster int, piece int, vec_id bigint, label bigint, v array<int>, bound double")


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def best(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` entries of each owner, by descending score, then id."""
    order = np.lexsort((ids, -score, owner))
    of = owner[order]
    new = np.ones(len(of), bool)
    new[1:] = of[1:] != of[:-1]
    start = np.maximum.accumulate(np.where(new, np.arange(len(of)), 0))
    return order[np.arange(len(of)) - start < k]


def walk(rows: pa.Table, members: pa.Table, dim: int, k: int, same: bool) -> pa.Table:
    """The first ``k`` rows of a piece for each slot of each member, from a walk down the sorted piece."""
    order = np.argsort(-rows["bound"].to_numpy(), kind="stable")
    bound, ids, label = (rows[c].to_numpy()[order] for c in ("bound", "vec_id", "label"))
    vectors = matrix(rows["v"], dim)[order]
    anchor, own, length = (members[c].to_numpy() for c in ("vec_id", "label", "length"))
    query = matrix(members["v"], dim)
    slots = [matrix(members[c], max(len(x) for x in members[c].to_pylist())) for c in ("low", "high", "floor")]
    low, high, floor = slots
    width = low.shape[1]
    floor = np.maximum(low, floor)
    held = [np.zeros(0, np.int64)] * 3  # owner (member * width + slot), score, row
    for at in range(0, len(ids), SLAB):
        wanted = np.where(high >= floor, floor, ALL).min(axis=1)
        active = np.flatnonzero(length * bound[at] * (1 + SLACK) + SLACK >= wanted)
        if not len(active):
            break
        end = min(at + SLAB, len(ids))
        score = products(query[active], vectors[at:end])
        fits = (label[at:end] == own[active, None]) == same
        fits &= ids[at:end] != anchor[active, None]
        parts = [held]
        for s in range(width):
            m, r = np.nonzero(fits & (score >= floor[active, s, None]) & (score <= high[active, s, None]))
            parts.append([active[m] * width + s, score[m, r], r + at])
        owner, value, row = (np.concatenate(x) for x in zip(*parts))
        first = best(owner, value, ids[row], k)
        held = [owner[first], value[first], row[first]]
        count = np.bincount(held[0], minlength=len(anchor) * width)
        last = np.flatnonzero(np.append(held[0][1:] != held[0][:-1], True)) if len(held[0]) else np.zeros(0, np.int64)
        full = last[count[held[0][last]] == k]
        floor.reshape(-1)[held[0][full]] = held[1][full]
    return pa.table({"anchor": anchor[held[0] // width], "slot": pa.array((held[0] % width).astype(np.int32)), "score": held[1], "vec_id": ids[held[2]]})


FOUND = "anchor bigint, slot int, score bigint, vec_id bigint"


def _first(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("place", place).where(F.col("place") <= k)


def _walked(lists: Lists, members: DataFrame, blocks: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool) -> DataFrame | None:
    rows = lists.stretch(low, high)
    if rows is None:
        return None
    dim = lists.dim
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.element_at(F.array(*[F.lit(int(x)) for x in n]), F.col("cluster") + 1) - 1))
    some = F.col("cluster").isin(*[int(c) for c in np.flatnonzero(blocks * lists.pieces)])
    left = rows.where(some).withColumn("block", upto(np.maximum(blocks, 1)))
    right = members.where(some).withColumn("piece", upto(np.maximum(lists.pieces, 1)))
    key = ["cluster", "piece", "block"]

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if not len(a) or not len(b):
            return pa.table({"anchor": pa.array([], pa.int64()), "slot": pa.array([], pa.int32()), "score": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64())})
        return walk(a, b, dim, k, same)

    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, FOUND)


def search(lists: Lists, members: DataFrame, blocks: np.ndarray, k: int, same: bool) -> DataFrame:
    """(anchor, slot, score, vec_id, place): the first ``k`` rows for each slot of each member (vec_id, label, v, cluster, block,
    length, low, high)."""
    cut = lists.head()
    top = np.full(len(cut), BINS)
    found = _walked(lists, members.withColumn("floor", F.col("low")), blocks, cut, top, k, same)
    if found is None:  # no rows, or no members
        return _first(members.sparkSession.createDataFrame([], FOUND), k)
    found = stored(_first(found, k), "head")
    if not lists.count[np.arange(BINS) < cut[:, None]].any():
        return found
    worst = found.groupBy("anchor", "slot").agg(F.count("*").alias("n"), F.min("score").alias("worst")).where(F.col("n") == k)
    worst = worst.groupBy(F.col("anchor").alias("vec_id")).agg(F.map_from_entries(F.collect_list(F.struct("slot", "worst"))).alias("worst"))
    floor = F.transform("low", lambda low, s: F.greatest(low, F.coalesce(F.try_element_at(F.col("worst"), s.cast("int")), low)))
    rest = stored(members.join(worst, "vec_id", "left").withColumn("floor", floor).drop("worst"), "members")
    wanted = F.array_min(F.zip_with("floor", "high", lambda low, high: F.when(low <= high, low.cast("double")).otherwise(F.lit(float(ALL)))))
    # a member of length 0 scores 0 with any row
    need = F.when(F.col("length") > 0, wanted / F.col("length")).otherwise(F.when(wanted <= 0, F.lit(-float(ALL))).otherwise(F.lit(float(ALL))))
    stop = {r.cluster: r.need for r in rest.groupBy("cluster").agg(F.min(need).alias("need")).collect()}  # one row a cluster
    stop = np.array([stop.get(c, float(ALL)) for c in range(len(cut))])
    low = np.where(stop * (1 - SLACK) - SLACK > lists.longest * (1 + 2 * SLACK), BINS, lists.bin_of(stop - np.abs(stop) * SLACK - SLACK))
    more = _walked(lists, rest, blocks, np.minimum(low, cut), cut, k, same)
    return found if more is None else stored(_first(found.drop("place").unionByName(more), k), "walked")


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST_PERCENT,
         most: int = MOST_PERCENT, scale: int = SCALE, clusters: int = CLUSTERS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. ``rows`` has vec_id, label, embedding;
    a negative's score lies from ``least`` to ``most`` percent of its positive's."""
    rows = stored(quantised(rows, scale), "vectors")
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    dim, longest = rows.agg(F.max(F.size("v")), F.max(size)).first()
    dim, longest = max(dim or 1, 1), longest or 0.0
    chosen = rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")
    chosen = stored(chosen, "anchors")
    centre = centroids(chosen, dim, clusters)
    placed = stored(clustered(chosen, centre, dim), "placed")
    width, blocks = np.zeros(len(centre)), np.zeros(len(centre), np.int64)
    for r in placed.groupBy("cluster").agg(F.max("angle").alias("angle"), F.count("*").alias("n")).collect():  # one row a cluster
        width[r.cluster], blocks[r.cluster] = r.angle, -(-r.n // BLOCK)
    lists = Lists(rows, centre, width, dim, longest)
    dealt = F.pmod(F.xxhash64("vec_id"), F.element_at(F.array(*[F.lit(int(max(x, 1))) for x in blocks]), F.col("cluster") + 1)).cast("int")
    members = placed.withColumn("block", dealt).withColumn("low", F.array(F.lit(NONE))).withColumn("high", F.array(F.lit(ALL)))
    near = search(lists, members, blocks, positives, True)
    near = near.select(F.col("anchor").alias("vec_id"), F.struct("place", "score", F.col("vec_id").alias("id")).alias("p"))
    held = near.groupBy("vec_id").agg(F.sort_array(F.collect_list("p")).alias("p"))  # ``positives`` at most
    limits = members.drop("low", "high").join(held, "vec_id").withColumn(
        "low", F.expr(f"transform(p, x -> (x.score - pmod(x.score, 100)) div 100 * {least} + (pmod(x.score, 100) * {least} + 99) div 100)")).withColumn(
        "high", F.expr(f"transform(p, x -> (x.score - pmod(x.score, 100)) div 100 * {most} + pmod(x.score, 100) * {most} div 100)"))
    limits = stored(limits, "limits")
    far = search(lists, limits.drop("p"), blocks, negatives, False)
    slots = limits.select(F.col("vec_id").alias("anchor"), F.posexplode("p").alias("slot", "p"))
    return slots.join(far, ["anchor", "slot"]).select(
        F.col("anchor").alias("anchor_id"), F.col("p.id").alias("positive_id"), F.col("place").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))


#: The contract in DuckDB's SQL, over all pairs of an anchor and a row.
ORACLE = """
    with r as (select vec_id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) as label,
        list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
      from embeddings where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
    a as (select * from r where vec_id % 100 = 0 qualify row_number() over (partition by vec_id order by label, v) = 1),
    s as (select a.vec_id as anchor_id, a.label = r.label as same, r.vec_id, cast(list_inner_product(a.v, r.v) as bigint) as score
      from a join r on a.vec_id <> r.vec_id),
    p as (select anchor_id, vec_id as positive_id, score as positive_score,
        row_number() over (partition by anchor_id order by score desc, vec_id) as slot
      from s where same qualify slot <= 5)
    select p.anchor_id, positive_id,
      cast(row_number() over (partition by p.anchor_id, slot order by score desc, vec_id) as int) as rank,
      vec_id as negative_id, positive_score, score as negative_score
    from p join s on p.anchor_id = s.anchor_id and not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
    qualify rank <= 10"""
