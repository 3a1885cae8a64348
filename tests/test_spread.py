"""Work that is dear by row runs on all cores, also over a file that one task reads."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from carelattice.functions.columns import as_of_date
from carelattice.governance import access, phi
from carelattice.ml.readmission import ROWS_PER_PART, training_parts
from carelattice.plans import staging
from carelattice.streaming import validate


def one_file(spark, tmp_path, df):
    df.coalesce(1).write.parquet(f"{tmp_path}/t")
    found = spark.read.parquet(f"{tmp_path}/t")
    assert found.rdd.getNumPartitions() == 1
    return found


def test_messages_are_parsed_on_all_cores(spark, tmp_path):
    body = F.when(F.col("id") % 2 == 0, '{"source":"monitor","patient_id":"1"}').otherwise("{not json")
    sent = spark.range(100).select(
        F.lit("healthcare.vitals").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.lit("2024-01-01").cast("timestamp").alias("timestamp"), F.lit(None).cast("string").alias("key"), body.alias("value"))
    parsed = validate.parse(one_file(spark, tmp_path, sent))
    assert parsed.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert parsed.count() == 100 and validate.valid(parsed).count() == 50


def test_months_are_made_on_all_cores(spark, tmp_path):
    rows = spark.range(60).selectExpr(
        "cast(id as string) as member_id", "'f' as first_name", "'l' as last_name", "date'1960-01-01' as date_of_birth",
        "date'2000-01-01' as coverage_effective_date", "date'2000-12-31' as coverage_termination_date", "'P' as plan_type",
        "'Gold' as metal_level", "'NY' as state", "'Self' as relationship")
    months = staging.member_months(one_file(spark, tmp_path, rows), as_of_date("2000-06-30"))
    assert months.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert months.count() == 60 * 12


def test_nested_fields_are_searched_once(spark):
    keys = phi.Keyring(spark, {"k1": bytes(range(32))}, "k1")
    rows = spark.range(3).select(F.col("id"), *[phi.encrypt_value(F.col("id") + 1, keys).alias(c) for c in ("mrn", "email")])
    inner = F.struct(F.struct("email", F.lit("{x").alias("phone")).alias("b"), F.lit("{}").alias("ssn"))
    messages = rows.select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.lit("2024-01-01").cast("timestamp").alias("timestamp"),
        F.lit("k").alias("key"), F.when(F.col("id") == 2, "{}").otherwise(F.to_json(F.struct("mrn", inner.alias("a")))).alias("value"))
    audited = access.phi_access_audit(messages, "etl")
    got = {r.context["offset"]: r.fields for r in audited.collect()}
    assert got == {"0": ["mrn", "a.b.email"], "1": ["mrn", "a.b.email"]}
    plan = audited._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(sequence") == 1


def test_parts_grow_with_rows(spark):
    assert training_parts(0, 8) == 1 and training_parts(150_000, 8) == 8
    assert all(n / training_parts(n, 8) <= ROWS_PER_PART for n in (9_000_000, 54_000_000))
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    run = entry._pinned(lambda spark, sf: spark.conf.get(name, None), 400)
    try:
        assert run(spark, "") == "400"
        assert entry._pinned(lambda spark, sf: spark.conf.get(name, None))(spark, "") is None
    finally:
        spark.conf.unset(name)


def test_snapshots_and_messages_are_built_once_on_all_cores(spark, tmp_path, monkeypatch):
    from suite import topics

    day = F.lit("2000-01-01").cast("timestamp")
    spark.range(50).select(F.col("id").alias("o_orderkey"), (F.col("id") % 9).alias("o_custkey"), day.alias("o_orderdate")).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(9).select(F.col("id").alias("c_custkey"), F.lit(1).alias("c_nationkey")).write.parquet(f"{tmp_path}/customer.parquet")
    features = topics.view(spark, str(tmp_path), "patients").select(topics.c.surrogate_id(F.col("patient_id")).alias("person_id"))
    monkeypatch.setattr(topics.ft, "trained", lambda *_: (None, None))
    monkeypatch.setattr(topics.ft, "current_features", lambda *_: features)
    monkeypatch.setattr(topics.silver, "scoring_job", lambda *_: None)
    read, sent = [], []
    monkeypatch.setattr(topics.silver, "publish_features", lambda df, *_: read.append((df.count(), df.inputFiles())))

    def batches(spark, df, ts, purpose, start):
        sent.append(df.rdd.getNumPartitions())
        start(None, str(tmp_path)), start(None, str(tmp_path))
        raise InterruptedError

    monkeypatch.setattr(topics, "in_two_batches", batches)
    try:
        topics.scoring_versions_stream(spark, str(tmp_path))
    except InterruptedError:
        pass
    assert [n for n, _ in read] == [5, 9] and all("current-features" in f for f in read[1][1])
    assert sent[0] >= spark.sparkContext.defaultParallelism
