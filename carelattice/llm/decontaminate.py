"""Benchmark decontamination with DataFrame functions alone: SimHash of item-sized windows, multi-index
Hamming blocks, exact check.

1. Shingles are hashes of five consecutive lower-cased words. A window without a shingle of any item
   has similarity 0, so only windows around shared shingles are made: of an item's length (a shorter
   document is one window), and with enough shared places for the similarity sought.
2. Each window and item gets 64 SimHash bits over its shingles, each as often as it occurs. Items are indexed
   by ``RADIUS`` + 1 blocks of bits: fingerprints within ``RADIUS`` agree on one block at least, so
   the join on (length, block, value) finds all of them. Two sets of similarity 0.8 differ in
   9.7 bits on average (deviation 2.9), so radius 19 holds 99.9 % of those on the very limit.
3. Candidates are verified exactly: sum of the smaller over sum of the larger count of every shingle,
   at least 0.8.

Result: one row for each document and item found: the best window's first word (0-based; the first
of equals) and similarity. Defined results: null, empty and short texts (under five words) hold
nothing; items under five words are not sought; equal items are all reported; repeated rows (same id
and text) are reported once, different texts of one id each. Input columns other than id and text
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from carelattice.llm.frames import identified, stored

N = 5
SIMILARITY = 0.8
RADIUS = 19
#: Up to so many item shingles, documents are picked by a set inside the scan; beyond, by a join.
LISTED = 100_000


def word_hashes(text: Column) -> Column:
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+")
    return F.transform(F.filter(split, lambda w: w != ""), lambda w: F.xxhash64(w))


def computed(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Adds a column through a generator of one row. Filters and lambdas further up can't pull its
    expression into themselves, where it would be evaluated again for every element."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def shingled(df: DataFrame, text: str) -> DataFrame:
    """Adds ``shingles``: the hash of each run of five words, in order."""
    hashed = computed(df, word_hashes(F.col(text)), "__w")
    at = F.sequence(F.lit(0), F.size("__w") - N)
    runs = F.transform(at, lambda i: F.xxhash64(*[F.get("__w", i + k) for k in range(N)]))
    none = F.array().cast("array<bigint>")
    return computed(hashed, F.when(F.size("__w") >= N, runs).otherwise(none), "shingles").drop("__w")


def simhash(shingles: Column) -> Column:
    """64 bits: bit b is set if it is set in more than half of the shingles."""
    size = F.size(shingles)

    def bit(b: Column) -> Column:
        ones = F.aggregate(shingles, F.lit(0), lambda total, s: total + F.getbit(s, b))
        return F.when(2 * ones > size, F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"), lambda acc, b: acc.bitwiseOR(bit(b)))


def blocks(fingerprint: Column, radius: int) -> Column:
    """(block, value) for ``radius`` + 1 blocks of bits that cover the fingerprint."""
    borders = [64 * k // (radius + 1) for k in range(radius + 2)]
    return F.array(*[
        F.struct(F.lit(k).alias("block"), F.shiftright(fingerprint, a).bitwiseAND(F.lit((1 << (z - a)) - 1)).alias("value"))
        for k, (a, z) in enumerate(zip(borders, borders[1:]))])


def weighted_similarity(x: Column, y: Column) -> Column:
    """Sum of the smaller over sum of the larger count of every shingle."""
    times = lambda shingles, s: F.size(F.filter(shingles, lambda v: v == s))
    common = F.aggregate(F.array_distinct(x), F.lit(0), lambda total, s: total + F.least(times(x, s), times(y, s)))
    return common / (F.size(x) + F.size(y) - common)


def items_of(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item_id, n (words), shingles, fingerprint of the items that can be sought."""
    base = items.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("__text"))
    made = shingled(base, "__text").drop("__text").where(F.size("shingles") > 0)
    return stored(made.withColumn("n", F.size("shingles") + N - 1).withColumn("fingerprint", simhash(F.col("shingles"))), "items")


def touched(docs: DataFrame, known: DataFrame) -> DataFrame:
    """row_key, doc_id, shingles of the documents that share a shingle with an item, each once."""
    wanted = known.select(F.explode("shingles").alias("s")).distinct()
    listed = wanted.limit(LISTED + 1).toArrow()["s"].to_pylist()
    found = shingled(docs, "text")
    if len(listed) <= LISTED:
        found = found.where(F.exists("shingles", lambda s: s.isin(listed))) if listed else found.limit(0)
    else:
        keys = found.select("row_key", F.explode("shingles").alias("s")).join(wanted, "s", "left_semi").select("row_key").distinct()
        found = found.join(keys, "row_key", "left_semi")
    return stored(found.select("row_key", "doc_id", "shingles"), "touched").dropDuplicates(["row_key"])


def windows(found: DataFrame, known: DataFrame) -> DataFrame:
    """row_key, doc_id, n, start, shingles, fingerprint of all windows of item length around shared shingles."""
    terms = known.select("n", F.explode("shingles").alias("s")).distinct()
    hits = found.select("row_key", F.posexplode("shingles").alias("pos", "s")).join(terms, "s")
    places = hits.groupBy("row_key", "n").agg(F.collect_set("pos").alias("places"))
    last = F.greatest(F.size("shingles") + N - 1 - F.col("n"), F.lit(0))
    around = lambda p: F.sequence(F.greatest(p - F.col("n") + N, F.lit(0)), F.greatest(F.least(p, last), F.greatest(p - F.col("n") + N, F.lit(0))))
    # the smaller counts of a window and an item that are similar enough sum up to this at least
    item = F.col("n") - (N - 1)
    need = F.ceil((F.least(item, F.size("shingles")) + item) * F.lit(SIMILARITY / (1 + SIMILARITY)) - 1e-9)
    held = lambda s: F.size(F.filter("places", lambda p: (p >= s) & (p < s + item)))
    starts = F.filter(F.array_distinct(F.flatten(F.transform("places", around))), lambda s: (s <= last) & (held(s) >= need))
    made = places.join(found, "row_key").withColumn("start", F.explode(starts))
    part = F.slice("shingles", F.col("start") + 1, F.col("n") - (N - 1))
    made = computed(made, part, "__part").select("row_key", "doc_id", "n", "start", F.col("__part").alias("shingles"))
    return made.withColumn("fingerprint", simhash(F.col("shingles")))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text", radius: int = RADIUS) -> DataFrame:
    """row_key, doc_id, item_id, first_word, similarity: one row for each document and item that it holds."""
    known = items_of(items, item_id, item_text)
    found = touched(identified(docs, id_col, text_col), known)
    made = stored(windows(found, known), "windows")
    index = known.select("item_id", "n", F.col("fingerprint").alias("sought"), F.inline(blocks(F.col("fingerprint"), radius)))
    near = made.select("row_key", "n", "start", "fingerprint", F.inline(blocks(F.col("fingerprint"), radius))).join(
        index, ["n", "block", "value"]).where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("sought"))) <= radius)
    pairs = near.select("row_key", "n", "start", "item_id").distinct()
    checked = pairs.join(made.drop("fingerprint"), ["row_key", "n", "start"]).join(
        known.select("item_id", F.col("shingles").alias("__item")).dropDuplicates(), "item_id").withColumn(
        "similarity", weighted_similarity(F.col("shingles"), F.col("__item"))).where(F.col("similarity") >= SIMILARITY)
    best = F.max_by("start", F.struct("similarity", -F.col("start")))
    return checked.groupBy("row_key", "doc_id", "item_id").agg(best.alias("first_word"), F.max("similarity").alias("similarity"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, that hold no item."""
    bad = contaminated(docs, items, id_col, text_col).select(F.col("row_key").alias("__bad")).distinct()
    key = F.xxhash64(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    return docs.join(bad, key == F.col("__bad"), "left_anti")


ORACLE = """
with words as (
  select doc_id, text, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') w from documents),
docs as (select row_number() over () r, doc_id, w, len(w) nw from (select distinct doc_id, text, w from words) where len(w) >= 5),
parts as (select item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') w from benchmark),
items as (select row_number() over () k, item_id, w, len(w) n from parts where len(w) >= 5),
ds as (select r, i - 1 p, array_to_string(list_slice(w, i, i + 4), ' ') s from (select r, w, unnest(range(1, nw - 3)) i from docs)),
its as (select k, array_to_string(list_slice(w, i, i + 4), ' ') s from (select k, w, unnest(range(1, n - 3)) i from items)),
hits as (select distinct d.r, d.p, t.k from ds d join its t using (s)),
starts as (
  select distinct r, k, start from (
    select h.r, h.k, i.n, d.nw, unnest(range(greatest(h.p - i.n + 5, 0), greatest(least(h.p, greatest(d.nw - i.n, 0)), greatest(h.p - i.n + 5, 0)) + 1)) start
    from hits h join items i using (k) join docs d using (r)) where start <= greatest(nw - n, 0)),
win as (select st.r, st.k, st.start, ds.s, count(*) c from starts st join items i using (k) join ds on ds.r = st.r and ds.p between st.start and st.start + i.n - 5 group by all),
ic as (select k, s, count(*) c from its group by all),
size as (select r, k, start, sum(c) m from win group by all),
common as (select w.r, w.k, w.start, sum(least(w.c, i.c)) o from win w join ic i on i.k = w.k and i.s = w.s group by all),
scored as (select c.r, c.k, c.start, cast(o as double) / cast(z.m + (i.n - 4) - o as double) similarity from common c join size z using (r, k, start) join items i using (k))
select doc_id, item_id, cast(arg_min(start, (-similarity, start)) as bigint) first_word, max(similarity) similarity
from (select d.r, d.doc_id, i.item_id, s.start, s.similarity from scored s join docs d using (r) join items i using (k) where similarity >= 0.8)
group by r, doc_id, item_id
"""
