"""Late data: rows on time and rows behind the watermark, kept apart and counted by batch."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

PROGRESS = "newest timestamp, n_rows long, late_rows long, batch_id long"


def _table(spark: SparkSession, out_dir: str, name: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{out_dir}/{name}")


def _replace(df: DataFrame, path: str, *by: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def split_late_job(stream: DataFrame, ts: str, late: str, out_dir: str, checkpoint: str, trigger: Mapping | None = None) -> StreamingQuery:
    """Land all rows of a stream with ``is_late``: whether the row's time lies more than ``late`` (an interval) before
    the newest time of all earlier batches, as a watermark of that delay would judge it.

    Late rows are kept in a partition of their own instead of being dropped. ``progress`` has one row a batch: newest
    time, rows and late rows. Both are replaced when a batch runs again, and a batch reads the progress of
    smaller numbers only, so a replay judges alike. A row without a time is on time.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], PROGRESS).write.mode("append").partitionBy("batch_id").parquet(f"{out_dir}/progress")

    def land(batch: DataFrame, batch_id: int) -> None:
        before = _table(batch.sparkSession, out_dir, "progress", PROGRESS).where(F.col("batch_id") < batch_id)
        bound = before.agg((F.max("newest") - F.expr(f"interval {late}")).alias("b")).scalar()  # one row a batch
        judged = batch.withColumn("is_late", F.coalesce(F.col(ts) < bound, F.lit(False))).withColumn("batch_id", F.lit(batch_id).cast("long"))
        _replace(judged, f"{out_dir}/rows", "batch_id", "is_late")
        landed = _table(batch.sparkSession, out_dir, "rows", judged.schema).where(F.col("batch_id") == batch_id)
        count = landed.agg(F.max(ts).cast("timestamp").alias("newest"), F.count(F.lit(1)).alias("n_rows"),
                           F.coalesce(F.sum(F.col("is_late").cast("long")), F.lit(0).cast("long")).alias("late_rows"))
        _replace(count.withColumn("batch_id", F.lit(batch_id).cast("long")), f"{out_dir}/progress", "batch_id")

    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def rows(spark: SparkSession, out_dir: str, late: bool | None = None) -> DataFrame:
    """What the job has landed: all rows, only late ones, or only those on time; the partition is all that is read."""
    found = spark.read.parquet(f"{out_dir}/rows")  # a folder's name is text
    kept = found if late is None else found.where(F.col("is_late") == F.lit(str(late).lower()))
    return kept.withColumn("is_late", F.col("is_late") == "true")


def counts(spark: SparkSession, out_dir: str) -> DataFrame:
    """(batch_id, newest, n_rows, late_rows) of each batch."""
    return _table(spark, out_dir, "progress", PROGRESS).select("batch_id", "newest", "n_rows", "late_rows")
