"""Helpers that put Arrow functions over whole text columns into a plan."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from carelattice.llm.words import column_bytes
from carelattice.session import scratch_dir

PIECE = 2 << 20
BATCH = 4 << 20   # bytes of rows that Spark hands to a function at once
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def bound_batches(df: DataFrame) -> DataFrame:
    """``df``; its session hands rows to Arrow functions in batches of about ``BATCH`` bytes from now on. Without
    it a batch has 10,000 rows, or 64 MB, both on Spark's side and in the function, whatever is done with a piece of it."""
    df.sparkSession.conf.set(BATCH_SETTING, str(BATCH))
    return df


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside delete their shuffle files as soon as they end, instead of when the driver happens to
    collect its garbage: what lies on disk is one query's files, not those of all queries so far."""
    before = spark.conf.get(CLEANUP_SETTING)
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_SETTING, before)


def lean(function: Callable) -> Callable:
    """``function`` over batches, whose worker gives free memory back at its end. Workers are used again in turn, also while
    they wait: each would keep what its largest task needed."""

    def run(batches):
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return run


def append(df: DataFrame, text: str, fields: str, function: Callable[..., dict], also: Sequence[str] = ()) -> DataFrame:
    """``df`` without the text, with the columns ``fields`` that ``function`` computes from it (and from the columns
    ``also``, which stay).

    Rows are neither moved nor reordered. A column of the input whose name (in any case) is among
    ``fields`` is replaced. Null texts reach ``function`` as they are.
    """
    added = StructType.fromDDL(fields)
    clash = {name.lower() for name in [*added.names, text]}
    kept = [c for c in df.columns if c.lower() not in clash]
    whole = "__text"  # the text travels under a name of its own, so it may be among the replaced columns
    while whole in {c.lower() for c in kept}:
        whole += "_"
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias(whole))

    others = [kept.index(c) for c in also]

    def run(batches):
        for batch in pieces(batches, len(kept)):
            made = function(batch.column(len(kept)), *[batch.column(i) for i in others])
            arrays = batch.columns[:len(kept)] + [as_array(made[n]) for n in added.names]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *added.names])

    bound_batches(df)
    schema = StructType([*df.select(*[F.col(f"`{c}`") for c in kept]).schema.fields, *added.fields])
    return source.mapInArrow(lean(run), schema)


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, rows: int) -> DataFrame:
    """At most ``rows`` distinct labelled rows of ``docs``: its columns (text and others beside doc_id), ``__y`` and
    ``__place``, a hash of the whole row that is different in each and may deal them to shards.

    Labels are bounded first (by a hash of their id), then the joined rows (by their own hash), so an id that has very
    many rows or labels can't exceed the bound. Equal rows with equal labels count as one; rows without id or label don't count.
    """
    known = labels.select(F.col("doc_id").alias("__id"), F.col(label_col).cast("int").alias("__y")).where("__id is not null and __y is not null")
    chosen = known.distinct().orderBy(F.xxhash64("__id"), "__id", "__y").limit(rows)
    others = [c for c in docs.columns if c != "doc_id"]
    marked = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select(
        "__y", *others, F.xxhash64("__id", "__y", *others).alias("__place"))
    places = marked.select("__place").distinct().orderBy("__place").limit(rows)
    bounded = marked.join(F.broadcast(places), "__place")
    return bounded.groupBy("__place").agg(*[F.first(c).alias(c) for c in ("__y", *others)])


def pieces(batches, text: int, limit: int = PIECE):
    """The batches cut into runs of rows whose texts have ``limit`` bytes together at most (or one row)."""
    for batch in batches:
        bounds = column_bytes(batch.column(text))[1]
        at = 0
        while at < len(batch):
            end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, side="right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def fetched(df: DataFrame) -> pa.Table:
    """The rows of a small table, for the driver."""
    with shuffles_dropped(df.sparkSession):
        return df.select("*").toArrow()  # planned anew, as the setting holds for plans made under it


def as_array(values) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values)


def identified(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text, with a key of the row's content for joins: rows with the same id and text
    have one result, so a key that several rows share is harmless."""
    return df.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
    ).withColumn("row_key", F.xxhash64("doc_id", "text"))


def held_out(modulus: int, id_col: str = "doc_id"):
    """Whether crc32 of the id as text is a multiple of ``modulus`` (null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus == 0


def stored(df: DataFrame, purpose: str, *broadcasts: Broadcast) -> DataFrame:
    """Write to the shared folder and read again: computed once, whatever executors get lost. Executors drop the
    ``broadcasts`` that only ``df`` needs, instead of holding them until the driver happens to collect its garbage."""
    path = scratch_dir(df.sparkSession, purpose)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    for shared in broadcasts:
        shared.unpersist()
    return df.sparkSession.read.schema(df.schema).parquet(path)
