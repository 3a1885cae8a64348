"""Sources and sinks."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from carelattice.operators.skew import Running, sliced_running

log = logging.getLogger(__name__)

MESSAGE_SCHEMA = (
    "topic string, partition int, offset long, timestamp timestamp, key string, value string"
)


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str, null_value: str = "",
    corrupt_column: str | None = None,
) -> DataFrame:
    """CSV with a header under an explicit schema, so codes keep their leading zeros."""
    reader = spark.read.schema(schema).option("header", True).option("nullValue", null_value)
    reader = reader.option("mode", "PERMISSIVE")
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.csv(path)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")


def read_events(
    spark: SparkSession, topics: Sequence[str], *, servers: str | None = None,
    path: str | None = None, max_per_trigger: int | None = None,
) -> DataFrame:
    """A stream of messages with the columns of ``MESSAGE_SCHEMA``: from a broker when
    ``servers`` is given, else from a folder of JSON files with the same columns. Offsets
    live in the checkpoint of the query that reads the stream."""
    if servers:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", "earliest")
        )
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        raw = reader.load()
        return raw.select(
            "topic", "partition", "offset", "timestamp",
            F.col("key").cast("string").alias("key"), F.col("value"),
        )
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.json(path).filter(F.col("topic").isin(list(topics)))


def assert_source(df: DataFrame, min_rows: int = 1) -> dict[str, int]:
    """Row and column counts; raises when the source holds too few rows."""
    rows = df.count()
    if rows < min_rows:
        raise ValueError(f"source has {rows} rows, at least {min_rows} expected")
    return {"rows": rows, "columns": len(df.columns)}


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_partitioned(
    df: DataFrame, path: str, by: Mapping[str, Column], cluster_by: Sequence[str] = (),
    *, day: str | None = None, as_of: date | None = None, lookback_days: int | None = None,
) -> None:
    """Replace only the partitions present in ``df``. With a lookback, only partitions that hold a row of
    ``as_of - lookback_days`` or later are replaced, by all their rows: a partition that the lookback cuts through
    keeps its earlier rows, all other partitions stay as they are.

    Rows are rebalanced by partition and clustering columns: small cells are written
    together, and adaptive execution splits a cell that is too large for one task.
    """
    rows = df.withColumns(dict(by))
    if lookback_days is not None:
        since = F.lit(str(as_of - timedelta(days=lookback_days))).cast("date")
        touched = rows.filter(F.col(day) >= since).select(*[F.col(k).alias(f"_{k}") for k in by]).distinct()
        rows = rows.join(touched, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in by]), "left_semi")
    if cluster_by:
        keys = [*by, *cluster_by]
        rows = rows.hint("rebalance", *[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def upsert(
    target: DataFrame, updates: DataFrame, key: Sequence[str], order_by: Sequence[str],
    sync_schema: bool = True,
) -> DataFrame:
    """Target with updates merged in: per key the latest row by ``order_by``; on a tie the
    update wins. ``sync_schema`` adds new columns and drops the ones updates no longer have."""
    columns = updates.columns if sync_schema else target.columns
    both = (
        target.withColumn("_from_update", F.lit(0))
        .unionByName(updates.withColumn("_from_update", F.lit(1)), allowMissingColumns=True)
    )
    newest = [F.col(c).desc_nulls_last() for c in [*order_by, "_from_update"]]
    rest = [F.col(c) for c in columns if c not in key]
    window = Window.partitionBy(*key).orderBy(*newest, *rest)
    kept = both.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1")
    return kept.select(*columns)


def publish(predictions: DataFrame, key: str, *, topic: str, servers: str | None = None,
            path: str | None = None) -> None:
    """Write each row as one JSON message keyed by ``key``."""
    messages = predictions.select(
        F.lit(topic).alias("topic"), F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*predictions.columns)).alias("value"),
    )
    if servers:
        messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
    else:
        messages.write.mode("append").json(path)


def publish_stream(predictions: DataFrame, key: str, *, topic: str, checkpoint: str,
                   servers: str | None = None, path: str | None = None,
                   trigger: Mapping | None = None) -> StreamingQuery:
    messages = predictions.select(
        F.lit(topic).alias("topic"), F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*predictions.columns)).alias("value"),
    )
    writer = messages.writeStream.option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    if servers:
        return writer.format("kafka").option("kafka.bootstrap.servers", servers).start()
    return writer.format("json").option("path", path).start()


class AppendCounter:
    """Counts appends that failed; an audit sink must not stop the job it audits."""

    def __init__(self) -> None:
        self.failed = 0

    def append(self, df: DataFrame, path: str) -> bool:
        try:
            df.write.mode("append").parquet(path)
            return True
        except Exception:
            self.failed += 1
            log.exception("append to %s failed", path)
            return False


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def sorted_output(df: DataFrame, order: Sequence[Column], place: str | None = None) -> DataFrame:
    """The rows in a global order. With ``place`` each row also gets its number in that order, 1 first: rows are cut in
    ranges and numbered within them, so no task holds the table; ``order`` must then be total."""
    if place is None:
        return df.orderBy(*order)
    return sliced_running(df, [], order, {place: Running("rows")}).orderBy(place)


def table_counts(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Rows per table; a missing table counts 0."""
    spark = next(t for t in tables.values() if t is not None).sparkSession
    parts = []
    for name, table in tables.items():
        label = F.lit(name).alias("table_name")
        if table is None:
            parts.append(spark.range(1).select(label, F.lit(0).cast("long").alias("row_count")))
        else:
            parts.append(table.agg(F.count(F.lit(1)).alias("row_count")).select(label, "row_count"))
    return union_all(parts)


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    parts = list(parts)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
