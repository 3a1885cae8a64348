"""Stream operators with state per key: boards of the last n rows, silent devices.

Rows of a board reach the state as (instant in microseconds, tie, JSON of the row); types are taken off before
and put on after, so one processor serves every table. Silences are ends of sessions. Time is event time: a key's state is
dropped, and silence is found, when the watermark passes an instant, never by the clock.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def _frame(**columns) -> pd.DataFrame:
    """Text columns as plain objects, numbers as 64-bit integers."""
    return pd.DataFrame({name: pd.Series(list(v), dtype=object if name in ("key", "body") else "int64") for name, v in columns.items()})


PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


class LastN(StatefulProcessor):
    """Keeps the n latest rows of a key; emits the whole board of each key that got rows. A timer at the newest
    row's instant plus ``keep`` forgets the key."""

    def __init__(self, n: int, keep_us: int):
        self.n, self.keep_us = n, keep_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "at long, tie string, body string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = [tuple(r) for r in self.rows.get()]
        for part in rows:  # at most n of a batch's rows are kept at any time
            held += list(zip(part["at"].tolist(), part["tie"].tolist(), part["body"].tolist()))
            held = sorted(set(held), reverse=True)[:self.n]
        self.rows.put(held)
        for at in self.handle.listTimers():
            self.handle.deleteTimer(at[0] if isinstance(at, tuple) else at)
        self.handle.registerTimer((held[0][0] + self.keep_us) // 1000 + 1)
        yield _frame(key=[key[0]] * len(held), place=range(1, len(held) + 1), body=[r[2] for r in held])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.rows.clear()
        yield _frame(key=[], place=[], body=[])

    def close(self) -> None:
        pass


def last_n_per_key(stream: DataFrame, key: Sequence[str], ts: str, tie: str, n: int, keep: str = "30 days", late: str = "1 hour") -> DataFrame:
    """The last ``n`` rows of each key as a board: ``place`` 1 is the newest (ties: larger ``tie`` first).

    On a stream in update mode: each batch gives the whole board of the keys that it touched, so the newest batch's rows of
    a key are its board (``current_boards``). State is at most n rows a key; a key without rows for ``keep`` is
    forgotten. Rows later than the watermark (``late``) are dropped. On a batch: the same by rank.
    """
    if not stream.isStreaming:
        from carelattice.operators.windows import top_k_per_group

        order = [F.col(ts).desc(), F.col(tie).cast("string").desc()]
        return top_k_per_group(stream.where(F.col(ts).isNotNull()).dropDuplicates(), key, order, n, rank="place")
    body = StructType([f for f in stream.schema.fields])
    seconds = stream.sparkSession.sql(f"select unix_seconds(timestamp'1970-01-01 00:00:00Z' + interval {keep})").first()[0]
    rows = stream.where(F.col(ts).isNotNull()).withWatermark(ts, late).select(
        F.to_json(F.struct(*[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in key])).alias("key"), F.col(ts), _micros(ts).alias("at"),
        F.coalesce(F.col(tie).cast("string"), F.lit("")).alias("tie"), F.to_json(F.struct(*stream.columns), JSON).alias("body"))
    boards = rows.groupBy("key").transformWithStateInPandas(
        LastN(n, seconds * 1_000_000), "key string, place int, body string", "Update", "EventTime")
    return boards.select(F.from_json("body", body, JSON).alias("r"), "place").select("r.*", "place")


def board_writer(path: str):
    """A ``foreachBatch`` sink for boards; running a batch again replaces its rows."""
    def land(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)

    return land


def run_job(rows: DataFrame, mode: str, path: str, checkpoint: str, trigger: Mapping | None = None) -> StreamingQuery:
    """Land boards or silences with ``board_writer``. Lists, timers and large state need RocksDB as state store, whatever the session
    names; a query keeps the setting that it starts with, so the session gets its own back."""
    spark = rows.sparkSession
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        writer = rows.writeStream.outputMode(mode).foreachBatch(board_writer(path)).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def current_boards(boards: DataFrame, key: Sequence[str]) -> DataFrame:
    """Each key's newest board, out of all that a stream has written."""
    newest = boards.groupBy(*key).agg(F.max("batch_id").alias("_newest"))
    joined = boards.join(newest.select(*[F.col(k).alias(f"_k_{k}") for k in key], "_newest"), _same(key) & (F.col("batch_id") == F.col("_newest")))
    return joined.select(*[c for c in boards.columns if c != "batch_id"])


def _same(key: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in key:
        out = out & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return out


def silences(readings: DataFrame, key: Sequence[str], ts: str, limit_seconds: Column, late: str = "10 minutes") -> DataFrame:
    """One row for each time a key fell silent: its last reading (``silent_since``) and when the next one was due at
    the latest (``due_at``, ``limit_seconds`` later).

    A silence is reported once, when the watermark passes ``due_at``, whether or not a reading follows later. Readings that
    lie behind the watermark are dropped; so are repeats of a reading, of which state keeps those that the watermark has
    not passed. The others are merged to sessions: a session's end is when the next reading was due. State of these is the
    first and last reading of a session that may go on. ``limit_seconds`` is one value a key. Append mode.
    """
    gap = F.make_interval(secs=limit_seconds.cast("bigint").cast("decimal(18,6)"))
    rows = readings.where(F.col(ts).isNotNull()).withWatermark(ts, late).select(*key, F.col(ts), gap.alias("_gap"))
    once = rows.dropDuplicates([*key, ts])
    found = once.groupBy(*key, F.session_window(F.col(ts), F.col("_gap")).alias("_w")).agg(F.max(ts).alias("_last"))
    return found.select(*key, F.col("_last").cast("timestamp").alias("silent_since"), F.col("_w.end").cast("timestamp").alias("due_at"))
