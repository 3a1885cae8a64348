"""Profiles, counts, histograms, rates and exact quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def profile(df: DataFrame, distinct: bool = True) -> DataFrame:
    """Per column: rows, NULLs, empty strings, smallest, largest, mean and, on request, an
    approximate distinct count. One pass over the table."""
    numeric = {"int", "bigint", "smallint", "tinyint", "float", "double"}
    aggregates, entries = [F.count(F.lit(1)).alias("n")], []
    for i, (name, type_name) in enumerate(df.dtypes):
        value, text = F.col(name), F.col(name).cast("string")
        is_number = type_name in numeric or type_name.startswith("decimal")
        aggregates += [
            F.sum(value.isNull().cast("long")).alias(f"nulls{i}"),
            F.sum((text == "").cast("long")).alias(f"empty{i}"),
            F.min(value).cast("string").alias(f"min{i}"),
            F.max(value).cast("string").alias(f"max{i}"),
            (F.avg(value.cast("double")) if is_number else F.first(F.lit(None).cast("double"))).alias(f"mean{i}"),
        ]
        fields = [
            F.lit(name).alias("column_name"), F.lit(type_name).alias("data_type"),
            F.col(f"nulls{i}").alias("null_count"),
            F.coalesce(F.col(f"empty{i}"), F.lit(0)).alias("empty_count"),
            F.col(f"min{i}").alias("min_value"), F.col(f"max{i}").alias("max_value"),
            F.round(f"mean{i}", 4).alias("mean_value"),
        ]
        if distinct:
            aggregates.append(F.approx_count_distinct(value).alias(f"distinct{i}"))
            fields.append(F.col(f"distinct{i}").alias("approx_distinct"))
        entries.append(F.struct(*fields))
    return df.agg(*aggregates).select(F.col("n").alias("row_count"), F.inline(F.array(*entries)))


def value_counts(df: DataFrame, *columns: str, name: str = "n") -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int, by: Sequence[str] = ()
              ) -> DataFrame:
    """Counts per fixed-width bin 1..bins; the top edge belongs to the last bin."""
    place = F.floor((F.col(value) - low) / (high - low) * bins).cast("int") + 1
    inside = F.col(value).between(low, high)
    binned = df.filter(inside).withColumn("bin", F.least(place, F.lit(bins)))
    return binned.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))


def rate(df: DataFrame, by: Sequence[str], flag: Column, name: str = "rate_pct") -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(flag.cast("int")) * 100.0 / F.count(F.lit(1)), 4).cast("double").alias(name),
    )


def avg_where(value: Column, condition: Column) -> Column:
    return F.avg(F.when(condition, value))


def low_count_suppress(df: DataFrame, count: str, n: int = 10) -> DataFrame:
    return df.filter(F.col(count) >= n)


def global_stats(df: DataFrame, value: str) -> DataFrame:
    """One row: count, mean, population and sample standard deviation."""
    v = F.col(value).cast("double")
    return df.agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"),
        F.stddev_pop(v).alias("std_pop"), F.stddev_samp(v).alias("std_samp"),
    )


BINS = 4096
LEVELS = 3


def _bin(v: Column, low: Column, high: Column) -> Column:
    """Place of a value among ``BINS`` equal steps; never falls as values rise. NaN is the largest value."""
    step = F.floor((v - low) / F.nullif(high - low, F.lit(0.0)) * BINS).cast("double")
    inside = F.when(F.isnan(v) | (v >= high), BINS - 1).when(v <= low, 0).otherwise(F.coalesce(step, F.lit(0.0)))
    return F.greatest(F.lit(0.0), F.least(F.lit(BINS - 1.0), inside)).cast("int")


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], levels: int = LEVELS) -> DataFrame:
    """Exact quantiles with linear interpolation, as one row of columns q0, q1, ... NULLs do not count.

    All quantiles narrow together: values are counted in ``BINS`` steps between the smallest and the largest
    one, the step that holds a wanted rank is cut in ``BINS`` again, and after ``levels`` rounds the values
    that are left are counted one by one (a value of very many rows is one row there). A round is one
    aggregation over the table; only the brackets of the wanted ranks, two a quantile at most, go from one
    to the next, by a broadcast of that many rows. The result is a plan: nothing runs before it is used.
    """
    rows = df.select(F.col(value).cast("double").alias("v")).where("v is not null")
    finite = F.when(~F.isnan("v") & (F.abs("v") < float("inf")), F.col("v"))
    figures = [F.count("v").alias("n"), F.min(finite).alias("low"), F.max(finite).alias("high"), F.min("v").alias("first"), F.max("v").alias("last")]
    wanted = F.array(*[
        F.struct(F.lit(2 * i + j).alias("i"), (F.ceil if j else F.floor)((F.col("n") - 1) * F.lit(float(q))).cast("long").alias("k"))
        for i, q in enumerate(qs) for j in (0, 1)])
    total = rows.agg(*figures)
    brackets = total.withColumn("wanted", wanted).drop("n")
    upto = F.sum("n").over(Window.partitionBy("bracket").orderBy("step"))  # of BINS rows, or of the values left
    reached = F.filter("wanted", lambda r: (r["k"] >= F.col("upto") - F.col("n")) & (r["k"] < F.col("upto")))
    inside = F.transform(reached, lambda r: F.struct(r["i"].alias("i"), (r["k"] - F.col("upto") + F.col("n")).alias("k")))
    for level in range(levels + 1):
        limits = F.broadcast(brackets.withColumnRenamed("first", "bracket"))
        held = rows.join(limits, F.col("v").between(F.col("bracket"), F.col("last")))
        held = held.withColumn("step", F.col("v") if level == levels else _bin(F.col("v"), F.col("low"), F.col("high")).cast("double"))
        counts = held.select("v", "bracket", "step", "wanted").groupBy("bracket", "step").agg(*figures, F.first("wanted").alias("wanted"))
        brackets = counts.withColumn("upto", upto).withColumn("wanted", inside).where(F.size("wanted") > 0).select("low", "high", "first", "last", "wanted")
    found = brackets.select(F.col("first").alias("v"), F.explode("wanted").alias("r"))
    pairs = found.agg(*[F.max(F.when(F.col("r.i") == i, F.col("v"))).alias(f"_{i}") for i in range(2 * len(qs))])
    n = total.select("n").scalar()

    def between(i: int, q: float) -> Column:
        a, b = F.col(f"_{2 * i}"), F.col(f"_{2 * i + 1}")
        place = (n - 1) * F.lit(float(q))
        return F.when(a == b, a).otherwise(a + (b - a) * (place - F.floor(place))).alias(f"q{i}")

    return pairs.select(*[between(i, q) for i, q in enumerate(qs)])
