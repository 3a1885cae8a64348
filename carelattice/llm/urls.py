"""URL filter: host and path rules, and gradient-boosted trees for the urls that no rule fits.

Labelled urls are those that a rule decides. The trees (MLlib) see lexical features only: lengths,
depth, digit ratio, entropy, hyphens, parameter counts, host labels, and how common the host's
suffixes are among all pages. They are fitted on ``TRAIN_ROWS`` different labelled urls at most (smallest hash
of the url), each weighted by its pages, and judge every other url.

Defined results: a null url, or one without ``://``, has empty host and path and no rule; the trees
judge it by its features. If all labelled urls are of one class, the rest gets that class; if the
smallest hashes are of one class only, each class gives half of the sample; without any label, the rest is allowed. Repeated rows are judged alike and kept. Columns of the input
other than id and url are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from carelattice.llm.frames import append, stored
from carelattice.llm.words import column_bytes

#: Verdict, host, path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
TRAIN_ROWS = 20_000
TREES, DEPTH = 12, 4
LEXICAL = ("length", "host_length", "path_length", "depth", "digits", "entropy", "hyphens", "parameters",
           "query_length", "labels", "secure", "fragment", "extension")


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    rest = F.when(F.locate("://", url) > 0, F.expr("substring(__url, locate('://', __url) + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (as host and path) and its verdict; null if none fits."""
    rule = verdict = F.lit(None).cast("string")
    for kind, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, name + start).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def lexical(column: pa.Array) -> dict:
    """Counts and shares over the url's bytes."""
    data, bounds = column_bytes(column)
    n = len(bounds) - 1
    size = np.diff(bounds)
    row = np.repeat(np.arange(n), size)
    count = lambda flag: np.bincount(row[flag], minlength=n).astype(float)
    key, times = np.unique(row * 256 + data, return_counts=True)
    share = times / size[key >> 8]
    urls = column.to_pylist()
    split = [(u or "").partition("://")[2] for u in urls]
    host = [s.split("/", 1)[0].split("?", 1)[0].split("#", 1)[0] for s in split]
    path = [s[len(h):].split("?", 1)[0].split("#", 1)[0] for s, h in zip(split, host)]
    query = [s.split("#", 1)[0].partition("?")[2] for s in split]
    return {"features": pa.array(np.stack([
        np.log1p(size), [len(h) for h in host], [len(p) for p in path],
        [len([x for x in p.split("/") if x]) for p in path], count((data >= 48) & (data < 58)) / np.maximum(size, 1),
        np.bincount(key >> 8, weights=-share * np.log2(share), minlength=n), [h.count("-") for h in host],
        [len([x for x in q.split("&") if x]) for q in query], [len(q) for q in query], [h.count(".") + bool(h) for h in host],
        [(u or "").startswith("https") for u in urls], [("#" in s) for s in split], [("." in p.rpartition("/")[2]) for p in path],
    ], 1).astype(float).tolist() if n else [], pa.list_(pa.float64()))}


def with_features(pages: DataFrame) -> DataFrame:
    """Adds lexical features and the share of pages with the same last label, and last two labels, of the host."""
    made = append(pages.withColumn("__whole", F.col("__url")), "__whole", "features array<double>", lexical)
    for k in (1, 2):
        made = made.withColumn(f"__suffix{k}", F.substring_index("host", ".", -k))
    n = F.broadcast(made.agg(F.count("*").alias("__n")))  # one row
    for k in (1, 2):
        common = made.groupBy(f"__suffix{k}").agg(F.count("*").alias(f"__n{k}"))
        made = made.join(common, f"__suffix{k}", "left")
    shares = [F.log1p(F.col(f"__n{k}") / F.col("__n") * 1e6) for k in (1, 2)]
    return made.join(n).withColumn("features", array_to_vector(F.concat("features", F.array(*shares))))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, rows: int = TRAIN_ROWS) -> DataFrame:
    """One row a page: id, host, path, rule, verdict, and the trees' probability of ``block`` (null where a rule decides)."""
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("__url"))
    host, path = parts(F.col("__url"))
    base = base.withColumn("host", F.coalesce(host, F.lit(""))).withColumn("path", F.coalesce(path, F.lit("")))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    base = base.withColumn("rule", rule).withColumn("__said", verdict)
    known = with_features(base)
    labelled = base.select("__url", "__said").where("__said is not null").groupBy("__url", "__said").agg(F.count("*").cast("double").alias("pages"))
    classes = [r["__said"] for r in labelled.select("__said").distinct().collect()]
    sample = labelled.orderBy(F.xxhash64("__url"), "__url").limit(rows)
    if len(classes) == 2 and sample.select("__said").distinct().count() < 2:
        sample, rare = (labelled.where(F.col("__said") == k).orderBy(F.xxhash64("__url"), "__url").limit(max(1, rows // 2)) for k in classes)
        sample = sample.unionByName(rare)
    sample = known.join(F.broadcast(sample.select("__url", "pages")), "__url").groupBy("__url").agg(
        F.first((F.col("__said") == "block").cast("double")).alias("label"), F.first("pages").alias("pages"), F.first("features").alias("features"))
    if len(classes) < 2:
        rest = "block" if classes == ["block"] else "allow"
        judged = known.withColumn("block_score", F.lit(float(rest == "block")))
    else:
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=5, labelCol="label", featuresCol="features", weightCol="pages").fit(stored(sample, "urls"))
        judged = model.transform(known).withColumn("block_score", vector_to_array("probability")[1])
    said = F.coalesce("__said", F.when(F.col("block_score") >= 0.5, "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", said.alias("verdict"),
                         F.when(F.col("rule").isNull(), F.col("block_score")).alias("block_score"))
