"""Claims anomalies: z-score, interquartile range, utilisation, isolation forest, report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carelattice.functions.columns import RISK_TIER, bucket
from carelattice.operators.aggregates import exact_quantiles, global_stats
from carelattice.session import materialise

FEATURES = ("total_paid", "claim_count", "avg_paid", "std_paid")


def zscore_flag(df: DataFrame, value: str, limit: float = 3.0) -> DataFrame:
    """z_score against the population standard deviation of the whole column, and z_flag."""
    stats = global_stats(df, value)
    v = F.col(value).cast("double")
    score = F.abs((v - stats.select("mean").scalar()) / stats.select("std_pop").scalar())
    return df.withColumn("z_score", score).withColumn(
        "z_flag", F.coalesce(F.col("z_score") > limit, F.lit(False)).cast("int")
    )


def iqr_flag(df: DataFrame, value: str, factor: float = 1.5) -> DataFrame:
    """1 outside [Q1 - factor*IQR, Q3 + factor*IQR], with exact quartiles."""
    spread = F.lit(factor) * (F.col("q1") - F.col("q0"))
    limits = exact_quantiles(df, value, [0.25, 0.75]).select(F.struct((F.col("q0") - spread).alias("low"), (F.col("q1") + spread).alias("high"))).scalar()
    v = F.col(value).cast("double")
    outside = (v < limits["low"]) | (v > limits["high"])
    return df.withColumn("iqr_flag", F.coalesce(outside, F.lit(False)).cast("int"))


def member_claim_features(claims: DataFrame) -> DataFrame:
    paid = F.col("paid_amount").cast("double")
    copay = F.col("member_copay").cast("double") / F.nullif(F.col("allowed_amount"), F.lit(0)).cast("double")
    return claims.groupBy("mem_id").agg(
        F.sum("paid_amount").cast("double").alias("total_paid"),
        F.count("claim_id").alias("claim_count"),
        F.avg(paid).alias("avg_paid"),
        F.coalesce(F.stddev_samp(paid), F.lit(0.0)).alias("std_paid"),
        F.avg(copay).alias("avg_copay_ratio"),
    )


def utilization_flag(features: DataFrame, factor: float = 2.5) -> DataFrame:
    stats = global_stats(features, "claim_count")
    limit = stats.select(F.col("mean") + factor * F.col("std_samp")).scalar()
    over = F.coalesce(F.col("claim_count") > limit, F.lit(False))
    return features.withColumn("utilization_flag", over.cast("int"))


def repeated_amount(claims: DataFrame, value: str = "paid_amount", at_least: int = 5) -> DataFrame:
    """Amounts a provider was paid at least ``at_least`` times."""
    return claims.groupBy("provider_npi", value).agg(F.count(F.lit(1)).alias("times")).filter(
        F.col("times") >= at_least
    )


# ---- isolation forest ----------------------------------------------------------------------

SAMPLE = 256
NODE_SCHEMA = "tree int, node int, feature int, cut double, left int, right int, size int, depth int"


def _grow(rows: np.ndarray, rng: np.random.Generator) -> list[tuple]:
    """Random splits down to the usual height limit; returns (feature, cut, left, right, size, depth)."""
    limit = int(np.ceil(np.log2(max(len(rows), 2))))
    nodes: list[tuple] = []
    todo = [(rows, 0, -1, "")]
    while todo:
        part, depth, parent, side = todo.pop()
        place = len(nodes)
        if parent >= 0:
            feature, cut, left, right, size, at = nodes[parent]
            nodes[parent] = (feature, cut, place, right, size, at) if side == "l" else (feature, cut, left, place, size, at)
        low, high = part.min(axis=0), part.max(axis=0)
        open_features = np.flatnonzero(high > low)
        if depth >= limit or len(part) <= 1 or not len(open_features):
            nodes.append((-1, 0.0, -1, -1, len(part), depth))
            continue
        feature = int(rng.choice(open_features))
        cut = float(rng.uniform(low[feature], high[feature]))
        nodes.append((feature, cut, -1, -1, len(part), depth))
        goes_left = part[:, feature] <= cut
        todo.append((part[goes_left], depth + 1, place, "l"))
        todo.append((part[~goes_left], depth + 1, place, "r"))
    return nodes


def _mean_path(n):
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2)
    path = 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, path))


def isolation_forest(
    df: DataFrame, key: str, features: Sequence[str] = FEATURES, trees: int = 100,
    contamination: float = 0.05, seed: int = 42,
) -> DataFrame:
    """anomaly_score (higher is odder) and anomaly_label for the top ``contamination`` share.

    Each tree sees at most 256 rows, chosen by the smallest hashes of (row key, tree); only
    rows whose hash is small enough to be a candidate are ever copied per tree. Trees grow
    in parallel, one small group each. The forest has at most trees x 511 nodes, a bound
    that does not depend on the data, and every row is scored in Arrow batches.
    """
    n = df.count()
    wanted = min(1.0, 4.0 * SAMPLE / max(n, 1))
    scale = 1 << 53
    keyed = df.select(F.col(key).alias("_key"), F.array(*[F.col(f).cast("double") for f in features]).alias("x"))
    chance = lambda t: F.pmod(F.xxhash64(F.col("_key"), t, F.lit(seed)), F.lit(scale))
    picked = F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: chance(t) < F.lit(int(wanted * scale))
    )
    candidates = keyed.withColumn("tree", F.explode(picked)).withColumn("_h", chance(F.col("tree")))
    order = Window.partitionBy("tree").orderBy("_h", "_key")
    sample = candidates.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= SAMPLE)

    def grow(batch: pd.DataFrame) -> pd.DataFrame:
        tree = int(batch["tree"].iloc[0])
        ordered = batch.sort_values("_n")
        nodes = _grow(np.vstack(ordered["x"].to_numpy()), np.random.default_rng([seed, tree]))
        out = pd.DataFrame(nodes, columns=["feature", "cut", "left", "right", "size", "depth"])
        return out.assign(tree=tree, node=range(len(out)))[
            ["tree", "node", "feature", "cut", "left", "right", "size", "depth"]
        ]

    grown = sample.select("tree", "_n", "x").groupBy("tree").applyInPandas(grow, NODE_SCHEMA)
    nodes = grown.toPandas().sort_values(["tree", "node"])  # at most trees x 511 rows
    forest = [
        tuple(part[c].to_numpy() for c in ("feature", "cut", "left", "right", "size", "depth"))
        for _, part in nodes.groupby("tree")
    ]
    usual = float(_mean_path(min(SAMPLE, max(n, 1)))) or 1.0

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        rows = np.vstack(x.to_numpy()) if len(x) else np.empty((0, len(features)))
        total = np.zeros(len(rows))
        for feature, cut, left, right, size, depth in forest:
            at = np.zeros(len(rows), dtype=int)
            while True:
                f = feature[at]
                inner = np.flatnonzero(f >= 0)
                if not len(inner):
                    break
                here = at[inner]
                goes_left = rows[inner, f[inner]] <= cut[here]
                at[inner] = np.where(goes_left, left[here], right[here])
            total += depth[at] + _mean_path(size[at])
        return pd.Series(np.power(2.0, -total / len(forest) / usual))

    # written once: the quantile and every later reader take the scores, not the forest
    scored = materialise(df.withColumn("anomaly_score", score(F.array(*[F.col(f).cast("double") for f in features]))), "scores")
    limit = exact_quantiles(scored, "anomaly_score", [1 - contamination]).first().q0
    return scored.withColumn("anomaly_label", (F.col("anomaly_score") > F.lit(limit)).cast("int"))


# ---- report --------------------------------------------------------------------------------


def risk_report(claims: DataFrame, forest: bool = True) -> DataFrame:
    """Per member: features, flags, risk score 0..3 and tier. ``forest=False`` leaves out the
    isolation forest, which has no SQL counterpart."""
    flagged = zscore_flag(claims, "paid_amount")
    costly = flagged.groupBy("mem_id").agg(F.max("z_flag").alias("z_member"))
    members = utilization_flag(member_claim_features(claims))
    flags = ["utilization_flag", "z_member"]
    if forest:
        members = isolation_forest(members, "mem_id")
        flags.append("anomaly_label")
    scored = members.join(costly, "mem_id").withColumn(
        "risk_score", reduce(lambda a, b: a + b, [F.col(f) for f in flags])
    )
    return scored.withColumn("risk_tier", bucket(F.col("risk_score"), *RISK_TIER, closed="right"))


def flagged_claims(claims: DataFrame, report: DataFrame) -> DataFrame:
    """Claims that any method flags: their own amount, or their member."""
    flags = [c for c in ("utilization_flag", "anomaly_label") if c in report.columns]
    marked = iqr_flag(zscore_flag(claims, "paid_amount"), "paid_amount")
    any_member = reduce(lambda a, b: a | b, [F.col(f) == 1 for f in flags])
    members = report.filter(any_member).select("mem_id", *flags)
    joined = marked.join(members, "mem_id", "left").fillna(0, flags)
    return joined.filter((F.col("z_flag") == 1) | (F.col("iqr_flag") == 1) | any_member)
