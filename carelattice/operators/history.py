"""Profiles kept per day and part of a table, and merged without reading the table again.

``sketch`` reduces a table to one row per part and column: counts, extremes, the moments behind mean and spread,
and two mergeable sketches (distinct values, quantiles). ``store`` keeps these rows by table and day; ``merged``
turns the rows of any set of days and parts into profiles, ``volume_history`` into changes from one stored day to
the next. What is kept grows with days, parts and columns, never with the rows of the table.

Distinct counts and quartiles are estimates: about 1.04 / sqrt(2 ** lg) relative error of a distinct count, and about
1.7 / k of the rows in the place of a quantile. Few values are held exactly: up to ``k`` numbers, and about
2 ** lg / 11 distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LG_DISTINCT = 16   # a distinct sketch has at most 2 ** 16 registers
QUANTILE_K = 4096  # a quantile sketch of so many numbers is exact
QUARTILES = (0.25, 0.5, 0.75)
NUMBERS = {"int", "bigint", "smallint", "tinyint", "float", "double"}
HISTORY = ("table_name string, day date, part string, column_name string, data_type string, row_count bigint, null_count bigint, "
           "empty_count bigint, min_value string, max_value string, min_number double, max_number double, number_count bigint, "
           "mean double, squares double, distinct_sketch binary, quantile_sketch binary")


def _is_number(type_name: str) -> bool:
    return type_name in NUMBERS or type_name.startswith("decimal")


def sketch(df: DataFrame, part: Column | None = None, lg: int = LG_DISTINCT, k: int = QUANTILE_K) -> DataFrame:
    """One row per part and column, in one pass; only one row of sketches a task and part is shuffled.

    ``part`` (a state, a source) defaults to the whole table. A table without rows gives one row per column with zero
    counts when it has no parts, and none otherwise. NaN counts as a row without a number; maps are not accepted.
    """
    aggregates, entries = [F.count(F.lit(1)).alias("n")], []
    # A distinct sketch skips empty strings, so values get a prefix there.
    for i, (name, type_name) in enumerate(df.dtypes):
        value = F.col(f"`{name}`")
        text = value.cast("string")
        number = value.cast("double") if _is_number(type_name) else F.lit(None).cast("double")
        number = F.when(~F.isnan(number), number)
        aggregates += [
            F.sum(value.isNull().cast("long")).alias(f"nulls{i}"), F.sum((text == "").cast("long")).alias(f"empty{i}"),
            F.min(value).cast("string").alias(f"min{i}"), F.max(value).cast("string").alias(f"max{i}"),
            F.min(number).alias(f"low{i}"), F.max(number).alias(f"high{i}"), F.count(number).alias(f"numbers{i}"),
            F.avg(number).alias(f"mean{i}"), (F.var_pop(number) * F.count(number)).alias(f"squares{i}"),
            F.hll_sketch_agg(F.concat(F.lit("="), text), lg).alias(f"distinct{i}"),
            F.kll_sketch_agg_double(number, k).alias(f"quantile{i}"),
        ]
        zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
        entries.append(F.struct(
            F.lit(name).alias("column_name"), F.lit(type_name).alias("data_type"), F.col("n").alias("row_count"),
            zero(f"nulls{i}").alias("null_count"), zero(f"empty{i}").alias("empty_count"),
            F.col(f"min{i}").alias("min_value"), F.col(f"max{i}").alias("max_value"),
            F.col(f"low{i}").alias("min_number"), F.col(f"high{i}").alias("max_number"), F.col(f"numbers{i}").alias("number_count"),
            F.col(f"mean{i}").alias("mean"), F.col(f"squares{i}").alias("squares"),
            F.col(f"distinct{i}").alias("distinct_sketch"), F.col(f"quantile{i}").alias("quantile_sketch"),
        ))
    rows = df.agg(*aggregates).withColumn("part", F.lit("")) if part is None else (
        df.groupBy(F.coalesce(part.cast("string"), F.lit("")).alias("part")).agg(*aggregates))
    return rows.select("part", F.inline(F.array(*entries)))


def store(sketches: DataFrame, path: str, table: str, day: date) -> None:
    """Keep a day's rows. A second run for the same table and day replaces the first."""
    rows = sketches.select(F.lit(table).alias("table_name"), F.lit(day).cast("date").alias("day"), *sketches.columns)
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("table_name", "day").parquet(path))


def read(spark: SparkSession, path: str, table: str | None = None, first: date | None = None, last: date | None = None) -> DataFrame:
    """Stored rows of a table and a range of days; both are partitions, so other files aren't read."""
    rows = spark.read.schema(HISTORY).parquet(path)
    if table is not None:
        rows = rows.filter(F.col("table_name") == table)
    if first is not None:
        rows = rows.filter(F.col("day") >= F.lit(first))
    if last is not None:
        rows = rows.filter(F.col("day") <= F.lit(last))
    return rows


def merged(history: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profiles over all rows of ``history`` that share ``by`` (any of table_name, day, part) and the column.

    mean and std come from the parts' moments around their own means, so that large values don't cancel."""
    keys = [*by, "column_name", "data_type"]
    together = Window.partitionBy(*keys)
    middle = F.sum(F.col("mean") * F.col("number_count")).over(together) / F.nullif(F.sum("number_count").over(together), F.lit(0))
    apart = F.col("squares") + F.col("number_count") * (F.col("mean") - F.col("_middle")) * (F.col("mean") - F.col("_middle"))
    number = F.max("max_number").isNotNull()
    sums = history.withColumn("_middle", middle).groupBy(*keys).agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.sum("empty_count").alias("empty_count"),
        F.when(number, F.min_by("min_value", "min_number")).otherwise(F.min("min_value")).alias("min_value"),
        F.when(number, F.max_by("max_value", "max_number")).otherwise(F.max("max_value")).alias("max_value"),
        F.max("_middle").alias("mean"), F.sum("number_count").alias("_n"), F.sum(apart).alias("_squares"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_count"),
        F.kll_merge_agg_double(F.when(F.col("number_count") > 0, F.col("quantile_sketch"))).alias("_quantiles"),
    )
    spread = F.when(F.col("_n") > 1, F.sqrt(F.col("_squares") / (F.col("_n") - 1)))
    quantile = lambda q: F.when(F.col("_n") > 0, F.kll_sketch_get_quantile_double("_quantiles", F.lit(q)))
    return sums.select(
        *keys, "row_count", "null_count", "empty_count", "distinct_count", "min_value", "max_value", "mean", spread.alias("std"),
        *[quantile(q).alias(f"q{round(q * 100)}") for q in QUARTILES],
    )


def distinct_counts(df: DataFrame) -> DataFrame:
    """Exact distinct values per column (NULL is none). Repeated values are combined before the shuffle, which carries
    the digests of distinct values only."""
    digests = [F.struct(F.lit(c).alias("column_name"), F.sha2(F.col(f"`{c}`").cast("string"), 256).alias("value")) for c in df.columns]
    values = df.select(F.inline(F.array(*digests))).groupBy("column_name", "value").agg(F.lit(1).alias("_one"))
    return values.groupBy("column_name").agg(F.count("value").alias("distinct_count"))


def volume_history(history: DataFrame) -> DataFrame:
    """Rows per table and stored day, rows of the stored day before it and the relative change (NULL for the first)."""
    days = history.groupBy("table_name", "day", "part").agg(F.max("row_count").alias("n"))  # alike in all columns
    days = days.groupBy("table_name", "day").agg(F.sum("n").alias("row_count"))
    earlier = F.lag("row_count").over(Window.partitionBy("table_name").orderBy("day"))
    out = days.withColumn("previous_rows", earlier)
    return out.withColumn("change", F.col("row_count") / F.nullif(F.col("previous_rows"), F.lit(0)) - 1)


def newest(history: DataFrame, column: str) -> DataFrame:
    """Per table and day the newest value of a date or time column, from its stored largest text."""
    return history.filter(F.col("column_name") == column).groupBy("table_name", "day").agg(F.max("max_value").alias("newest"))
