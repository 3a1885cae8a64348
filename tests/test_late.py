"""Rows behind the watermark are kept apart and counted by batch."""

import datetime

from carelattice.streaming import late

SCHEMA = "id int, ts timestamp"


def at(hours):
    return None if hours is None else datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=hours)


def test_split_by_batch(spark, tmp_path):
    batches = [[(1, 0), (2, 10), (3, 1)], [(4, 6), (5, 9), (6, None), (7, 20)], [(8, 17), (9, 15), (10, 20), (11, 16)]]
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(SCHEMA).json(f"{tmp_path}/in")
    for rows in batches:
        spark.createDataFrame([(i, at(h)) for i, h in rows], SCHEMA).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        late.split_late_job(stream, "ts", "4 hours", f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    got = late.rows(spark, f"{tmp_path}/out").collect()
    assert {r.id for r in got if r.is_late} == {9} and len(got) == 11
    assert {r.id for r in late.rows(spark, f"{tmp_path}/out", late=True).collect()} == {9}
    counted = sorted((r.batch_id, r.newest, r.n_rows, r.late_rows) for r in late.counts(spark, f"{tmp_path}/out").collect())
    assert counted == [(0, at(10), 3, 0), (1, at(20), 4, 0), (2, at(20), 4, 1)]


def test_a_replay_judges_alike(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(SCHEMA).json(f"{tmp_path}/in")
    for rows in ([(1, 10)], [(2, 1), (3, 30)]):
        spark.createDataFrame([(i, at(h)) for i, h in rows], SCHEMA).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        late.split_late_job(stream, "ts", "4 hours", f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    last = max((tmp_path / "ck" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for name in (last, last.with_name(f".{last.name}.crc")):
        name.unlink(missing_ok=True)  # the batch ran, its commit was lost
    late.split_late_job(stream, "ts", "4 hours", f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    assert sorted((r.id, r.is_late) for r in late.rows(spark, f"{tmp_path}/out").collect()) == [(1, False), (2, True), (3, False)]
    assert [r.late_rows for r in late.counts(spark, f"{tmp_path}/out").orderBy("batch_id").collect()] == [0, 1]
