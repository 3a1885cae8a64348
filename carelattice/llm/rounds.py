"""Rounds of comparison between classes of documents (sets of shingles) that share buckets, shared by the joins
that look for all links of 80 % or more: stars of leads while they find links, then all pairs still possible.

Tables: rows (bucket, class, n, root; in the first round also shared, how many buckets the class is in), where n is the size
of the class's set; full sets (class, shingles), a class in one row or several.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from carelattice.llm.frames import stored

PERCENT = 80
STEP = 1.05


def _pair(a: str, b: str) -> list[F.Column]:
    """The two classes, the smaller one first, with their sizes."""
    first = F.col(f"{a}.class") < F.col(f"{b}.class")
    pick = lambda yes, no, name: F.when(first, F.col(yes)).otherwise(F.col(no)).alias(name)
    return [pick(f"{a}.class", f"{b}.class", "a"), pick(f"{b}.class", f"{a}.class", "b"), pick(f"{a}.n", f"{b}.n", "na"), pick(f"{b}.n", f"{a}.n", "nb")]


def _sizes_fit(a: str, b: str) -> F.Column:
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    return F.least(na, nb) * 100 >= F.greatest(na, nb) * PERCENT


def mixed_rows(rows: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """Rows of the buckets that hold two components, with the class's root (``roots`` None: as it is)."""
    if roots is not None:
        rows = rows.drop("root").join(roots.select(F.col("node").alias("class"), "root"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    mixed = rows.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("bucket")
    return rows.join(mixed, "bucket")


def size_step(n: F.Column) -> F.Column:
    """Sizes within ``STEP`` of each other have the same number, or neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / F.lit(math.log(STEP))).cast("int")


def by_partner(rows: DataFrame, there: str | None = None) -> DataFrame:
    """Each row once for each step of sizes (``other``) that a partner may have, with the overlap a link needs at least.
    ``there``: a column of the steps that partners do have (step, lo, hi: their least and greatest root); others are left out."""
    first, last = size_step(F.ceil(F.col("n") * PERCENT / 100)), size_step(F.floor(F.col("n") * 100 / PERCENT))
    sizes = F.sequence(first, last)
    if there:
        sizes = F.transform(F.filter(there, lambda t: t["step"].between(first, last) & (
            (t["lo"] != F.col("root")) | (t["hi"] != F.col("root")))), lambda t: t["step"])
    least = F.greatest(F.floor(F.exp(F.col("other") * F.lit(math.log(STEP))) * (1 - 1e-9)), F.ceil(F.col("n") * PERCENT / 100))
    need = F.floor(((F.col("n") + least) * PERCENT + 99 + PERCENT) / (100 + PERCENT))
    return rows.withColumn("step", size_step(F.col("n"))).withColumn("other", F.explode(sizes)).withColumn("need", need)


def steps_there(rows: DataFrame) -> DataFrame:
    """For each bucket the steps of size of its rows (``there``, a few hundred at most) with their least and greatest root."""
    ends = rows.groupBy("bucket", size_step(F.col("n")).alias("step")).agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    return ends.groupBy("bucket").agg(F.collect_list(F.struct("step", "lo", "hi")).alias("there"))


def meeting(met: DataFrame) -> DataFrame:
    """Of the prefix shingles s (class, n, root, step, other, s), those that are in the prefix of a class in another component,
    sizes fitting: (bucket, class, n, root, side). A bucket is a shingle and two steps of size; side -1 and 1 meet each other, 0 itself."""
    first = stored(met.select(F.xxhash64("s", F.least("step", "other"), F.greatest("step", "other")).alias("bucket"), "class", "n", "root",
                              F.signum(F.col("other") - F.col("step")).cast("int").alias("side")), "first")
    ends = [f(F.when(F.col("side") == k, F.col("root"))).alias(f"{name}{k + 1}") for k in (-1, 0, 1) for f, name in ((F.min, "lo"), (F.max, "hi"))]
    met = first.join(first.groupBy("bucket").agg(*ends), "bucket")
    partner = [(F.col("side") == k) & ((F.col(f"lo{1 - k}") != F.col("root")) | (F.col(f"hi{1 - k}") != F.col("root"))) for k in (-1, 0, 1)]
    return met.where(F.coalesce(partner[0] | partner[1] | partner[2], F.lit(False))).select("bucket", "class", "n", "root", "side")


def open_by_prefix(rows: DataFrame) -> DataFrame:
    """Which of ``rows`` (prefixes in one order: bucket is a shingle, pos its place) may be the first common shingle of a link between
    components, as ``meeting`` gives them; sets aren't read. The first common shingle of a link leaves room for the overlap behind it in both sets.
    All common shingles up to the end of the prefix that ends first lie in both prefixes, so in buckets of two components.
    A row is dealt to the steps of size that other components have in its bucket, not to all that a link allows."""
    own = rows.groupBy("class").agg(F.count("*").alias("met"))
    upper = F.least(F.ceil(F.exp((F.col("other") + 1) * F.lit(math.log(STEP))) * (1 + 1e-9)), F.floor(F.col("n") * 100 / PERCENT))
    behind = F.ceil(F.greatest(F.col("n"), upper) * PERCENT / 100) - 1
    room = (F.col("n") - F.col("pos") >= F.col("need")) & (F.col("met") + behind >= F.col("need"))
    met = by_partner(rows.join(own, "class").join(steps_there(rows), "bucket"), "there").where(room).select("class", "n", "root", "step", "other", F.col("bucket").alias("s"))
    return stored(meeting(met), "open")


def by_size(prefixes: DataFrame, light: int) -> tuple[DataFrame, DataFrame]:
    """The rows of buckets of at most ``light`` classes, whose pairs are as many as the rows up to that factor; the classes
    of the other buckets. Two classes that can link are in one light bucket or both among these classes."""
    held = prefixes.groupBy("bucket").agg(F.count("*").alias("held"))
    counted = prefixes.join(held, "bucket")
    return counted.where(F.col("held") <= light).drop("held"), stored(counted.where(F.col("held") > light).select("class").distinct(), "heavy")


def still_open(rows: DataFrame, full: DataFrame, flat: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """What can have a link out of its component: prefix shingles (as ``meeting`` gives them), the mixed rows and
    the sets of their classes (in as many rows as ``full`` has of each, with its columns); and the shingles that two components
    share (class, bucket), for the next round: components only grow together, so that others needn't be listed again."""
    classes = rows.select("class", "n", "root").distinct()
    if flat is None:
        held = stored(full.join(classes, "class"), "open")
        flat = held.select("class", "n", "root", F.explode("shingles").alias("bucket"))
    else:
        flat = stored(flat.join(classes, "class"), "open")
    spread = flat.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("holders")).where("lo <> hi")
    flat = stored(flat.join(spread.select("bucket", "holders"), "bucket"), "shared")
    own = flat.groupBy("class", "n", "root").agg(F.sort_array(F.collect_list(F.struct("holders", "bucket"))).alias("l"))  # a set at most
    places = F.size("l") - F.col("need") + 1  # of the prefix, behind the component's own shingles
    met = by_partner(own).withColumn("places", places.cast("int"))
    met = met.where("places > 0").select("class", "n", "root", "step", "other", F.explode(F.slice("l.bucket", 1, F.col("places"))).alias("s"))
    first = stored(meeting(met), "first")
    left = first.select("class").distinct()
    return first, stored(mixed_rows(rows.join(left, "class", "left_semi")), "mixed"), stored(
        full.join(left, "class", "left_semi"), "sets"), flat.select("class", "bucket")


def star_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """Each class with a lead of another component, in each bucket. The first lead is the class that shares most
    buckets, in later rounds one dealt by a hash; the second is the first one's counterpart elsewhere."""
    place = F.struct(F.col("shared") if turn == 0 else F.xxhash64("class", F.lit(turn)), F.col("class"))
    lead = F.max_by(F.struct("class", "n", "root"), place)
    groups = rows.groupBy("bucket").agg(lead.alias("one"))
    others = rows.join(groups, "bucket").where("root <> one.root").groupBy("bucket").agg(lead.alias("two"))
    both = groups.join(others, "bucket").select("bucket", "one", "two")
    met = rows.alias("a").join(both.alias("l"), "bucket").select(
        F.struct("a.class", "a.n").alias("a"), F.when(F.col("a.root") == F.col("l.one.root"), F.col("l.two")).otherwise(F.col("l.one")).alias("b"))
    return met.where(_sizes_fit("a", "b")).select(*_pair("a", "b")).distinct()


def crossing_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of a bucket that lie in two components. Components meet first, then their classes."""
    groups = rows.groupBy("bucket", "root", "side").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    g, h = groups.alias("g"), groups.alias("h")
    meet = g.join(h, (F.col("g.bucket") == F.col("h.bucket")) & (F.col("g.root") < F.col("h.root")) & (
        F.col("g.side") + F.col("h.side") == 0) & (F.col("g.hi") * 100 >= F.col("h.lo") * PERCENT) & (F.col("h.hi") * 100 >= F.col("g.lo") * PERCENT)).select(
        "g.bucket", "g.side", F.col("g.root").alias("ra"), F.col("h.root").alias("rb")).alias("m")
    a, b = rows.alias("a"), rows.alias("b")
    one = meet.join(a, (F.col("m.bucket") == F.col("a.bucket")) & (F.col("m.ra") == F.col("a.root")) & (
        F.col("m.side") == F.col("a.side"))).select("m.bucket", "m.rb", "m.side", F.struct("a.class", "a.n").alias("a"))
    return one.alias("o").join(b, (F.col("o.bucket") == F.col("b.bucket")) & (F.col("o.rb") == F.col("b.root")) & (
        F.col("o.side") + F.col("b.side") == 0) & _sizes_fit("a", "b")).select(
        *_pair("a", "b")).distinct()
