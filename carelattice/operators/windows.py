"""Ranking, deduplication and interval windows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_k_per_group(df: DataFrame, key: Sequence[str], order: Sequence[Column], k: int,
                    rank: str | None = None) -> DataFrame:
    """The best k rows per key. Spark cuts each task's rows to k per key before the shuffle,
    so a key with very many rows sends only k per task."""
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= k)
    return kept if rank else kept.drop(name)


def dedupe_latest(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_k_per_group(df, key, order, 1)


def join_nullsafe(df: DataFrame, reduced: DataFrame, key: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a table that was grouped by ``key`` back to its rows; NULL keys meet NULL keys."""
    renamed = reduced.select(*[F.col(k).alias(f"_k_{k}") for k in key], *[c for c in reduced.columns if c not in key])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key])
    return df.join(renamed, same, how).drop(*[f"_k_{k}" for k in key])


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once; NULL keys count as equal."""
    repeated = df.groupBy(*key).count().filter("count > 1").drop("count")
    return join_nullsafe(df, repeated, key, "left_semi")


def unique_over(df: DataFrame, key: Sequence[str], name: str = "is_unique") -> DataFrame:
    """Flag rows whose key occurs once; NULL keys count as equal. Counted before the join, not in
    a window, so that a key with very many rows needs no single task."""
    counts = df.groupBy(*key).agg((F.count(F.lit(1)) == 1).alias(name))
    return join_nullsafe(df, counts, key)


def change_from_previous(df: DataFrame, partition: Sequence[str], order: str, value: str,
                         previous: str, change_pct: str, decimals: int = 1) -> DataFrame:
    """Previous value along ``order`` and the percent change, rounded only at the end. Meant
    for aggregated rows: one per partition and period."""
    before = F.lag(value).over(Window.partitionBy(*partition).orderBy(order))
    change = (F.col(value) - F.col(previous)) / F.nullif(F.col(previous), F.lit(0)) * 100
    return df.withColumn(previous, before).withColumn(change_pct, F.round(change, decimals))


def pct_of_total(df: DataFrame, value: str, name: str) -> DataFrame:
    """Percent of the column's total, by a scalar subquery instead of a one-task window."""
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(name, F.col(value) / F.nullif(total, F.lit(0)) * 100)


def merge_intervals(df: DataFrame, key: Sequence[str], start: str, end: str, gap_days: int = 0
                    ) -> DataFrame:
    """Merge closed day intervals per key when the next one starts at most ``gap_days`` + 1
    days after the running end. Gives key, span_start, span_end (NULL when open), segments.

    Intervals are first reduced to one per (key, start day), which bounds what the window
    sees for any key by the calendar.
    """
    far = F.lit("9999-12-31").cast("date")
    daily = df.groupBy(*key, F.col(start).alias("_s")).agg(
        F.max(F.coalesce(F.col(end), far)).alias("_e"), F.count(F.lit(1)).alias("_n")
    )
    window = Window.partitionBy(*key).orderBy("_s")
    reached = F.max("_e").over(window.rowsBetween(Window.unboundedPreceding, -1))
    joined = F.coalesce(F.col("_s") <= F.date_add(reached, gap_days + 1), F.lit(False))
    flagged = daily.withColumn("_new", F.when(joined & reached.isNotNull(), 0).otherwise(1))
    islands = flagged.withColumn("_island", F.sum("_new").over(window))
    spans = islands.groupBy(*key, "_island").agg(
        F.min("_s").alias("span_start"), F.max("_e").alias("_e"), F.sum("_n").alias("segments")
    )
    return spans.select(*key, "span_start", F.nullif(F.col("_e"), far).alias("span_end"), "segments")


def covered_days(df: DataFrame, key: Sequence[str], start: str, end: str, gap_days: int = 0
                 ) -> DataFrame:
    """Days in the union of the half-open intervals [start, end) per key."""
    usable = df.filter(F.col(end) > F.col(start)).withColumn("_last", F.date_sub(end, 1))
    spans = merge_intervals(usable, key, start, "_last", gap_days)
    return spans.groupBy(*key).agg(
        F.sum(F.datediff("span_end", "span_start") + 1).alias("covered_days"),
        F.count(F.lit(1)).alias("spans"),
    )
