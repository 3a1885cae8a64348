"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.ui.enabled": "false",
    "spark.sql.maxMetadataStringLength": "1000",  # a plan names its folders, however deep they lie
}


def build_session(app: str = "carelattice", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is only ever chosen for a local master with the setting unset;
    on a cluster executors on other machines could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="carelattice-")  # one process: driver and executor are the same
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """The same rows over all cores, for work that is dear by row: a file of few bytes or one row group is read by one
    task, however many rows it has."""
    spark = df.sparkSession
    tasks = max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks)


METHODS = "spark.sql.codegen.hugeMethodLimit"


def short_methods(df: DataFrame) -> DataFrame:
    """``df``; its session fuses no steps from now on where that makes a method of more than 8,000 bytes: the JVM never
    compiles such a method, it is interpreted row by row."""
    df.sparkSession.conf.set(METHODS, "8000")
    return df


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back: a result that is used several
    times is computed once and outlives the loss of an executor."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
