"""Sources and sinks on small literal tables."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from carelattice.session import materialise, scratch_dir
from carelattice.sources import tables
from carelattice.sources.seeds import seed


def test_csv_keeps_leading_zeros_and_nulls(spark, tmp_path):
    (tmp_path / "in.csv").write_text("mem_id,zip_code\nA,02134\nB,\n")
    rows = tables.read_csv(spark, str(tmp_path / "in.csv"), "mem_id string, zip_code string").collect()
    assert [tuple(r) for r in rows] == [("A", "02134"), ("B", None)]


def test_assert_source(spark):
    assert tables.assert_source(spark.range(3)) == {"rows": 3, "columns": 1}
    with pytest.raises(ValueError):
        tables.assert_source(spark.range(0))


def test_write_and_read_table(spark, tmp_path):
    tables.write_table(spark.range(5), str(tmp_path / "t"))
    tables.write_table(spark.range(4), str(tmp_path / "t"))
    assert tables.read_table(spark, str(tmp_path), "t").count() == 4


def test_write_partitioned_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    day = datetime.date
    rows = [("a", day(2000, 1, 1), "NY"), ("b", day(2001, 6, 1), "NY"), ("c", day(2001, 6, 2), "IN")]
    by = {"year": F.year("d")}
    tables.write_partitioned(spark.createDataFrame(rows, "k string, d date, state string"), path, by, ["state"])
    fresh = spark.createDataFrame([("x", day(2001, 7, 1), "TX"), ("old", day(2000, 1, 1), "TX")], "k string, d date, state string")
    tables.write_partitioned(fresh, path, by, ["state"], day="d", as_of=day(2001, 7, 2), lookback_days=90)
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == ["a", "x"]


def test_a_partition_cut_by_the_lookback_keeps_its_rows(spark, tmp_path):
    day = datetime.date
    rows = [("a", day(2000, 12, 31), "NY"), ("b", day(2001, 1, 2), "NY"), ("c", day(2001, 6, 2), None), ("d", None, "TX")]
    table = spark.createDataFrame(rows, "k string, d date, state string")
    for by, kept in (({"year": F.year("d")}, ["b", "c"]), ({"year": F.year("d"), "part": F.col("state")}, ["c"])):
        path = str(tmp_path / str(len(by)))
        for _ in range(2):
            tables.write_partitioned(table, path, by, day="d", as_of=day(2001, 6, 3), lookback_days=30)
        assert sorted(r.k for r in spark.read.parquet(path).collect()) == kept


def test_sorted_output_numbers_rows(spark):
    table = spark.range(50, 0, -1)
    assert [r.id for r in tables.sorted_output(table, [F.col("id")]).collect()] == list(range(1, 51))
    placed = tables.sorted_output(table, [F.col("id").desc()], place="place").collect()
    assert [(r.id, r.place) for r in placed] == [(51 - i, i) for i in range(1, 51)]


def test_upsert_latest_wins_and_schema_syncs(spark):
    old = spark.createDataFrame([("m1", 1, "x"), ("m2", 5, "y")], "id string, v int, gone string")
    new = spark.createDataFrame([("m1", 2, True), ("m3", 1, False)], "id string, v int, fresh boolean")
    rows = {tuple(r) for r in tables.upsert(old, new, ["id"], ["v"]).collect()}
    assert rows == {("m1", 2, True), ("m2", 5, None), ("m3", 1, False)}
    kept = tables.upsert(old, new, ["id"], ["v"], sync_schema=False)
    assert kept.columns == ["id", "v", "gone"]


def test_audit_append_failure_does_not_raise(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("x")
    sink = tables.AppendCounter()
    assert not sink.append(spark.range(1), str(blocked / "sub"))
    assert sink.failed == 1
    assert sink.append(spark.range(1), str(tmp_path / "ok"))


def test_publish_writes_keyed_json(spark, tmp_path):
    path = str(tmp_path / "out")
    tables.publish(spark.createDataFrame([(7, 0.5)], "patient_id long, score double"), "patient_id",
                   topic="healthcare.predictions", path=path)
    (row,) = spark.read.json(path).collect()
    assert (row.topic, row.key, row.value) == ("healthcare.predictions", "7", '{"patient_id":7,"score":0.5}')


def test_event_stream_from_files(spark, tmp_path):
    rows = [("a", 0, 1, None, "k", "{}"), ("b", 0, 2, None, "k", "{}")]
    spark.createDataFrame(rows, tables.MESSAGE_SCHEMA).write.json(str(tmp_path / "in"))
    stream = tables.read_events(spark, ["a"], path=str(tmp_path / "in"))
    out = tables.publish_stream(stream.select("topic", "offset"), "offset", topic="t", path=str(tmp_path / "out"),
                                checkpoint=str(tmp_path / "c"))
    out.awaitTermination()
    assert spark.read.json(str(tmp_path / "out")).count() == 1


def test_exports(spark, tmp_path):
    tables.export_csv(spark.range(2), str(tmp_path / "c"))
    tables.export_json(spark.range(2), str(tmp_path / "j"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def test_table_counts_missing_is_zero(spark):
    rows = tables.table_counts({"a": spark.range(3), "b": None}).collect()
    assert {tuple(r) for r in rows} == {("a", 3), ("b", 0)}


def test_scratch_is_under_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(root)
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
    kept = materialise(spark.range(4), "test")
    assert kept.count() == 4 and os.path.commonpath([root, kept.inputFiles()[0].removeprefix("file://")]) == root.rstrip("/")


def test_seed_sizes(spark):
    assert seed(spark, "icd10_to_ccs").count() == 33
    assert seed(spark, "icd10_codes").count() == 15
    assert seed(spark, "icd10_concepts").count() == 13
    assert seed(spark, "visit_class").count() == 8
