"""Windowed and keyed stream operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.sources.schemas import CADENCE


def vitals_window(vitals: DataFrame, size: str = "24 hours", slide: str | None = None, watermark: str | None = "1 hour"
                  ) -> DataFrame:
    """Mean readings per patient and window of event time. The watermark only bounds the
    state of this aggregate; silver keeps late events."""
    rows = vitals.withWatermark("event_time", watermark) if watermark else vitals
    span = F.window("event_time", size, slide) if slide else F.window("event_time", size)
    readings = {"heart_rate_bpm": "mean_hr", "spo2_pct": "mean_spo2", "systolic_bp_mmHg": "mean_sbp"}
    means = rows.groupBy("patient_id", span.alias("w")).agg(
        F.count(F.lit(1)).alias("readings"),
        *[F.avg(F.col(c).cast("double")).alias(name) for c, name in readings.items()],
    )
    return means.select(
        "patient_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "readings",
        *[F.round(name, 2).alias(name) for name in readings.values()],
    )


def latest_per_key(stream: DataFrame, key: Sequence[str], ts: str, tie: str) -> DataFrame:
    """Newest row per key; on a stream run it in update mode. State is one row per key."""
    payload = F.struct(*[c for c in stream.columns if c not in key])
    newest = stream.groupBy(*key).agg(F.max_by(payload, F.struct(ts, tie)).alias("_r"))
    return newest.select(*key, "_r.*")


def dedup_stream(stream: DataFrame, keys: Sequence[str], ts: str, bound: str) -> DataFrame:
    """Drop repeats of a key within the bound; state older than the bound is forgotten."""
    return stream.withWatermark(ts, bound).dropDuplicatesWithinWatermark(list(keys))


def observe_late(df: DataFrame, ts: str, arrived: str, bound_seconds: int, name: str = "late") -> DataFrame:
    """Count, as an observed metric, the rows that arrived later than the bound."""
    delay = F.unix_seconds(arrived) - F.unix_seconds(ts)
    return df.observe(name, F.count(F.lit(1)).alias("rows"),
                      F.sum(F.coalesce(delay > bound_seconds, F.lit(False)).cast("long")).alias("late_rows"))


def session_gap(device_type: Column, missed: int = 3) -> Column:
    """Silence that ends a session: ``missed`` expected readings of the device type."""
    out = None
    for kind, seconds in CADENCE.items():
        text = f"{seconds * missed} seconds"
        out = F.when(device_type == kind, text) if out is None else out.when(device_type == kind, text)
    return out.otherwise("60 seconds")


def device_sessions(readings: DataFrame, ts: str = "ts", missed: int = 3, watermark: str | None = None) -> DataFrame:
    """Sessions of continuous readings per device, by event time. Readings merge to sessions
    within each input partition before the shuffle, so a busy device sends few rows, if the session
    has ``spark.sql.sessionWindow.merge.sessions.in.local.partition`` (``build_session`` sets it)."""
    rows = readings.withWatermark(ts, watermark) if watermark else readings
    span = F.session_window(F.col(ts), session_gap(F.col("device_type"), missed))
    return rows.groupBy("device_id", "device_type", span.alias("w")).agg(F.count(F.lit(1)).alias("readings")).select(
        "device_id", "device_type", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "readings"
    )
