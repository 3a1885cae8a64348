"""Joins with a shape of their own: prefix, interval, orphans, key-set membership."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def prefix_lookup(code: Column, prefixes: Sequence[tuple[str, str]]) -> Column:
    """Label of the longest prefix of ``code`` in a fixed list, NULL when none matches.

    One map access per distinct prefix length, so no join and no shuffle at all.
    """
    by_length: dict[int, list[tuple[str, str]]] = {}
    for prefix, label in prefixes:
        by_length.setdefault(len(prefix), []).append((prefix, label))
    found = []
    for length in sorted(by_length, reverse=True):
        pairs = [F.lit(part) for pair in by_length[length] for part in pair]
        found.append(F.create_map(*pairs)[F.substring(code, 1, length)])
    return F.coalesce(*found)


def prefix_join(
    df: DataFrame, code: str, prefixes: DataFrame, prefix: str, lengths: Sequence[int],
    mode: str = "longest",
) -> DataFrame:
    """Left join on "prefix begins code" as one equality join per prefix length.

    ``longest`` keeps one row per input row; ``all`` gives one row per matching prefix.
    Each branch is an equi join, so a large prefix table is as safe as a small one. A prefix
    must occur once in ``prefixes``.
    """
    values = [c for c in prefixes.columns if c != prefix]
    candidates = df
    for length in sorted(lengths, reverse=True):
        side = prefixes.filter(F.length(prefix) == length).select(
            F.col(prefix).alias(f"_p{length}"), F.struct(prefix, *values).alias(f"_m{length}")
        )
        candidates = candidates.join(
            side, F.substring(F.col(code), 1, length) == F.col(f"_p{length}"), "left"
        )
    matches = [F.col(f"_m{length}") for length in sorted(lengths, reverse=True)]
    if mode == "longest":
        picked = candidates.withColumn("_m", F.coalesce(*matches))
    else:
        hits = F.filter(F.array(*matches), lambda m: m.isNotNull())
        picked = candidates.withColumn("_m", F.explode_outer(hits))
    return picked.select(*df.columns, *[F.col(f"_m.{v}").alias(v) for v in values])


def interval_join(
    left: DataFrame, right: DataFrame, key: Sequence[str], left_day: str, right_day: str,
    days: int,
) -> DataFrame:
    """Rows of ``right`` whose day lies in [left_day, left_day + days], per key.

    Left rows go to the two calendar buckets their window touches, right rows to their own
    bucket: an equi join on (key, bucket), so a busy key is spread over the calendar.
    """
    width = days + 1

    def bucket_of(day: Column) -> Column:
        return F.floor(F.unix_date(day) / width)

    first = bucket_of(F.col(left_day))
    last = bucket_of(F.date_add(F.col(left_day), days))
    spread = left.withColumn("_bucket", F.explode(F.sequence(first, last)))
    placed = right.withColumn("_bucket", bucket_of(F.col(right_day)))
    within = F.col(right_day).between(F.col(left_day), F.date_add(F.col(left_day), days))
    return spread.join(placed, [*key, "_bucket"]).filter(within).drop("_bucket")


def orphans(child: DataFrame, parent: DataFrame, key: str | Sequence[str]) -> DataFrame:
    return child.join(parent, key, "left_anti")


def member_of(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(keys, on, "left_semi")


def flag_member_of(df: DataFrame, keys: DataFrame, on: str, name: str) -> DataFrame:
    """1 when the row's key occurs in ``keys``, else 0."""
    marked = keys.select(on).distinct().withColumn(name, F.lit(1))
    return df.join(marked, on, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def at_least(df: DataFrame, facts: DataFrame, key: str, n: int) -> DataFrame:
    """Rows of ``df`` whose key has at least ``n`` facts; no restriction when n <= 0."""
    if n <= 0:
        return df
    enough = facts.groupBy(key).count().filter(F.col("count") >= n)
    return df.join(enough, key, "left_semi")
