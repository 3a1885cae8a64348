"""Boards of the last n rows and silent devices, over several batches of a stream."""

import datetime
import random

from pyspark.sql import functions as F

from carelattice.streaming import state

BASE = datetime.datetime(2024, 1, 1)
SCHEMA = "device_id string, kind string, ts timestamp, n int"


def at(seconds):
    return BASE + datetime.timedelta(seconds=seconds)


def stream_of(spark, folder, *batches):
    """A stream that reads one batch of rows after the other."""
    for k, rows in enumerate(batches):
        path = f"{folder}/in"
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(path)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(f"{folder}/in")


def run(df, folder, mode, sink):
    query = df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start()
    query.awaitTermination()


def test_last_n_over_batches(spark, tmp_path):
    pick = random.Random(1)
    rows = [(f"d{pick.randrange(4)}", None, at(60 * k), k) for k in range(90)] + [("d0", "same", at(60 * 89), 200), (None, "x", at(60), 1)]
    stream = stream_of(spark, tmp_path, rows[:40], rows[40:70], rows[70:])
    boards = state.last_n_per_key(stream, ["device_id"], "ts", "n", 5, late="2 days")
    run(boards, tmp_path, "update", state.board_writer(f"{tmp_path}/out"))
    got = state.current_boards(spark.read.parquet(f"{tmp_path}/out"), ["device_id"]).collect()
    want = state.last_n_per_key(spark.createDataFrame(rows, SCHEMA), ["device_id"], "ts", "n", 5).collect()
    key = lambda r: (str(r.device_id), r.place, r.ts, r.n, r.kind)
    assert sorted(map(key, got)) == sorted(map(key, want)) and len(got) == 21


def test_forgotten_keys(spark, tmp_path):
    day = 86400
    stream = stream_of(spark, tmp_path, [("a", "", at(0), 1), ("b", "", at(0), 2)], [("b", "", at(3 * day), 3)], [("b", "", at(6 * day), 4)], [("a", "", at(6 * day), 5)])
    boards = state.last_n_per_key(stream, ["device_id"], "ts", "n", 3, keep="2 days", late="1 second")
    run(boards, tmp_path, "update", state.board_writer(f"{tmp_path}/out"))
    got = state.current_boards(spark.read.parquet(f"{tmp_path}/out"), ["device_id"]).collect()
    assert {(r.device_id, r.place, r.n) for r in got if r.device_id == "a"} == {("a", 1, 5)}


def silent(rows, limit, watermark):
    out = []
    for key in {r[0] for r in rows}:
        times = sorted({r[2] for r in rows if r[0] == key})
        for a, b in zip(times, [*times[1:], None]):
            due = a + datetime.timedelta(seconds=limit[key])
            if due <= watermark and (b is None or b > due):
                out.append((key, a, due))
    return sorted(out)


def test_silence_is_told_once(spark, tmp_path):
    limit = {"a": 30, "b": 60, "c": 30, "d": 30}
    rows = [("a", "", at(s), 0) for s in (0, 10, 20, 100, 110, 141, 400)] + [("b", "", at(s), 0) for s in (0, 55, 115, 300, 900)]
    rows += [("c", "", at(5), 0), ("d", "", at(990), 0)] + [("e", "", at(1000), 0)]
    limit["e"] = 30
    pick = random.Random(2)
    shuffled = sorted(rows, key=lambda r: r[2].timestamp() + pick.random() * 15)  # a little out of order
    stream = stream_of(spark, tmp_path, shuffled[:5], shuffled[5:9], shuffled[9:])
    seconds = F.when(F.col("device_id") == "b", 60).otherwise(30)
    found = state.silences(stream, ["device_id", "kind"], "ts", seconds, "20 seconds")
    run(found, tmp_path, "append", state.board_writer(f"{tmp_path}/out"))
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted((r.device_id, r.silent_since, r.due_at) for r in got) == silent(rows, limit, at(980))


def test_jobs_need_no_setting_of_the_session(spark, tmp_path):
    """Also where the session names the default state store, which has neither lists nor timers."""
    rows = [("a", "", at(0), 1), ("a", "", at(60), 2), ("b", "", at(7200), 3)]
    name, default = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    before = spark.conf.get(name)
    spark.conf.set(name, default)
    try:
        stream = stream_of(spark, tmp_path, rows[:1], rows[1:])
        boards = state.last_n_per_key(stream, ["device_id"], "ts", "n", 2)
        state.run_job(boards, "update", f"{tmp_path}/boards", f"{tmp_path}/ck_boards").awaitTermination()
        found = state.silences(stream, ["device_id", "kind"], "ts", F.lit(90), "1 minute")
        state.run_job(found, "append", f"{tmp_path}/silent", f"{tmp_path}/ck_silent").awaitTermination()
        assert spark.conf.get(name) == default
    finally:
        spark.conf.set(name, before)
    got = state.current_boards(spark.read.parquet(f"{tmp_path}/boards"), ["device_id"]).collect()
    assert {(r.device_id, r.place, r.n) for r in got} == {("a", 1, 2), ("a", 2, 1), ("b", 1, 3)}
    assert [(r.device_id, r.silent_since, r.due_at) for r in spark.read.parquet(f"{tmp_path}/silent").collect()] == [("a", at(60), at(150))]


def test_silences_call_no_function_per_key(spark, tmp_path):
    """Sessions in the state store; a reading on the last instant is in time, repeats and rows behind the watermark are dropped."""
    rows = [[("a", "x", at(0), 1), ("a", "x", at(30), 2), ("a", "x", at(30), 3), (None, "x", at(5), 4), ("b", None, at(0), 5)],
            [("c", "x", at(100), 6), ("a", None, None, 7)], [("d", "x", at(300), 8), ("b", None, at(99), 9)], [("b", None, at(20), 10), ("e", "x", at(310), 11)]]
    found = state.silences(stream_of(spark, tmp_path, *rows), ["device_id", "kind"], "ts", F.lit(30), "10 seconds")
    assert "TransformWithState" not in found._jdf.queryExecution().analyzed().toString()
    run(found, tmp_path, "append", state.board_writer(f"{tmp_path}/out"))
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    want = {("a", at(30), at(60)), (None, at(5), at(35)), ("b", at(0), at(30)), ("b", at(99), at(129)), ("c", at(100), at(130))}
    assert {(r.device_id, r.silent_since, r.due_at) for r in got} == want and len(got) == len(want)
