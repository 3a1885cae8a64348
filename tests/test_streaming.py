"""Validation rules, replay safety, late data, windows, scoring."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from carelattice.ml import readmission as r
from carelattice.ml.features import FEATURES
from carelattice.session import METHODS
from carelattice.sources.tables import MESSAGE_SCHEMA, read_events
from carelattice.streaming import silver, validate, windows

NOW = datetime.datetime(2024, 1, 1, 12)
VITAL, ADMIT, LAB, IOT = "healthcare.vitals", "healthcare.admissions", "healthcare.lab_results", "iot.telemetry"


def batch(spark, *messages):
    rows = [(t, 0, i, NOW, "k", v if isinstance(v, str) else json.dumps(v)) for i, (t, v) in enumerate(messages)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def admission(**more):
    return {"source": "ehr", "patient_id": "1", "encounter_id": "e", "admission_type": "inpatient", "facility_id": "f",
            "admit_time": "2024-01-01T00:00:00Z", **more}


def lab(**more):
    return {"source": "lab_device", "patient_id": "1", "order_id": "o", "test_code": "c", "test_name": "n",
            "collected_at": "2024-01-01T00:00:00Z", "resulted_at": "2024-01-01T01:00:00+00:00", **more}


CASES = [
    (VITAL, {"source": "monitor", "patient_id": "p1", "heart_rate_bpm": 72}, None),
    (VITAL, {"source": " monitor ", "patient_id": "p1", "heart_rate_bpm": "72"}, None),
    (VITAL, {"source": "monitor", "patient_id": "p1", "heart_rate_bpm": 72.0, "spo2_pct": None}, None),
    (VITAL, {"source": "monitor", "patient_id": "p1", "heart_rate_bpm": 72.5}, "heart_rate_bpm: not a valid int"),
    (VITAL, {"source": "monitor", "patient_id": "p1", "heart_rate_bpm": 10}, "heart_rate_bpm: not in 20..300"),
    (VITAL, {"source": "monitor", "patient_id": "p1", "spo2_pct": 150}, "spo2_pct: not in 0..100"),
    (VITAL, {"source": "monitor", "patient_id": "p1", "colour": 1}, "colour: extra field"),
    (VITAL, {"source": "monitor", "patient_id": 7}, "patient_id: not a valid string"),
    (VITAL, {"source": "monitor"}, "patient_id: field required"),
    (VITAL, {"heart_rate_bpm": 9999, "patient_id": "p"}, "source: field required; heart_rate_bpm: not in 20..300"),
    (VITAL, "{not json", "json decode failed"),
    (VITAL, "[1, 2]", "not an object"),
    ("other.topic", {}, "no schema registered for topic other.topic"),
    (ADMIT, admission(), None),
    (ADMIT, admission(diagnosis_codes=["I10"], disposition="home", discharge_time="2024-01-02T00:00:00Z"), None),
    (ADMIT, admission(diagnosis_codes=[1]), "diagnosis_codes: not a valid array"),
    (ADMIT, admission(disposition="lost"), "disposition: not one of home, transfer, ama, expired, still_admitted"),
    (ADMIT, admission(chief_complaint="x" * 501), "chief_complaint: longer than 500"),
    (ADMIT, admission(admit_time="soon"), "admit_time: not a valid timestamp"),
    (LAB, lab(abnormal_flag="HH", value_numeric="1.5"), None),
    (LAB, lab(abnormal_flag="Q"), "abnormal_flag: not one of L, H, LL, HH, A, AA, N"),
    (IOT, {"source": "iot", "patient_id": "1", "device_id": "d", "device_type": "wearable",
           "metrics": {"a": 1, "b": "x", "c": True, "d": 1.5}, "battery_pct": 50}, None),
    (IOT, {"source": "iot", "patient_id": "1", "device_id": "d", "device_type": "toaster"},
     "device_type: not one of wearable, continuous_monitor, smart_pill_bottle, glucose_meter, pulse_oximeter, bp_cuff"),
    (IOT, {"source": "iot", "patient_id": "1", "device_id": "d", "device_type": "wearable", "metrics": {"a": [1]}},
     "metrics: not a valid map"),
]


def test_validation_cases(spark):
    parsed = validate.parse(batch(spark, *[(t, v) for t, v, _ in CASES])).orderBy("offset").collect()
    assert [row.error_message for row in parsed] == [message for _, _, message in CASES]
    assert {row.error_type for row in parsed} == {None, "ValidationError", "UnknownTopic"}


def test_bytes_that_are_not_utf8(spark):
    rows = [(VITAL, 0, 0, NOW, None, bytearray(b"\xff\xfe"))]
    schema = MESSAGE_SCHEMA.replace("value string", "value binary")
    assert validate.parse(spark.createDataFrame(rows, schema)).first().error_message == "utf-8 decode failed"


def test_defaults_are_stable(spark):
    event = validate.valid(validate.parse(batch(spark, CASES[0][:2])))
    first, second = event.first(), event.first()
    assert first == second and first.event_time == NOW and first.schema_version == 1 and len(first.event_id) == 64


def test_predictions_topic(spark):
    good = {"source": "ehr", "patient_id": "1", "prediction_type": "readmission_30d", "model_id": "m", "model_version": "1",
            "score": 0.2, "confidence": 0.6, "features_used": ["a"], "top_feature_contributions": {"a": 0.1},
            "valid_from": "2024-01-01T00:00:00Z", "valid_until": "2024-01-01T01:00:00Z"}
    bad = {**good, "score": 2, "top_feature_contributions": {"a": "high"}}
    topic = "healthcare.predictions"
    rows = validate.parse(batch(spark, (topic, good), (topic, bad)), [topic]).orderBy("offset").collect()
    assert rows[0].error_message is None
    assert rows[1].error_message == "score: not in 0..1; top_feature_contributions: not a valid map"


def test_enrichment_and_alerts(spark):
    person = spark.createDataFrame([("p1", 8532, 1965)], "person_id string, gender_concept_id int, year_of_birth int")
    events = validate.valid(validate.parse(batch(
        spark, (VITAL, {"source": "monitor", "patient_id": "p1", "spo2_pct": 85}),
        (VITAL, {"source": "monitor", "patient_id": "ghost", "heart_rate_bpm": 72, "spo2_pct": 98}),
        (LAB, lab(abnormal_flag="HH")))))
    rows = {row.offset: row._enrichment for row in validate.enrich(events, person).collect()}
    assert tuple(rows[0]) == (True, 8532, 1965) and tuple(rows[1]) == (False, None, None)
    assert {(a.offset, a.alert) for a in validate.critical_alerts(events).collect()} == {(0, "critical_vitals"), (2, "critical_lab")}


TOPICS = [VITAL, ADMIT, LAB, IOT, "other.topic"]


def land(spark, tmp_path, source, out="out", checkpoint="ck"):
    stream = read_events(spark, TOPICS, path=str(source))
    silver.silver_job(stream, None, str(tmp_path / out), str(tmp_path / checkpoint)).awaitTermination()
    return silver.read_silver(spark, str(tmp_path / out)), silver.read_dlq(spark, str(tmp_path / out))


def test_silver_job_is_replay_safe(spark, tmp_path):
    source = tmp_path / "in"
    batch(spark, *[(t, v) for t, v, _ in CASES]).write.mode("append").json(str(source))
    rows, letters = land(spark, tmp_path, source)
    good = sum(m is None for *_, m in CASES)
    assert (rows.count(), letters.count()) == (good, len(CASES) - good)
    # the same checkpoint has nothing more to do
    rows, letters = land(spark, tmp_path, source)
    assert rows.count() + letters.count() == len(CASES)
    # a lost checkpoint replays everything: positions still occur once
    rows, letters = land(spark, tmp_path, source, checkpoint="ck2")
    assert (rows.count(), letters.count()) == (good, len(CASES) - good)
    # a later redelivery of the same positions replaces, new positions are added
    batch(spark, *[(t, v) for t, v, _ in CASES]).write.mode("append").json(str(source))
    rows, letters = land(spark, tmp_path, source)
    assert (rows.count(), letters.count()) == (good, len(CASES) - good)


def test_dedup_stream_and_latest(spark, tmp_path):
    source = tmp_path / "in"
    rows = batch(spark, *[(VITAL, {"n": i}) for i in range(5)])
    rows.union(rows).write.json(str(source))
    stream = read_events(spark, [VITAL], path=str(source))
    kept = windows.dedup_stream(stream, ["topic", "partition", "offset"], "timestamp", "1 hour")
    query = kept.writeStream.format("memory").queryName("kept").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("kept").count() == 5
    newest = windows.latest_per_key(stream.select("topic", "timestamp", "offset", "value"), ["topic"], "timestamp", "offset")
    query = newest.writeStream.format("memory").queryName("newest").outputMode("update").trigger(availableNow=True).start()
    query.awaitTermination()
    assert json.loads(spark.table("newest").collect()[-1].value) == {"n": 4}


def test_sessions_stream_closes_with_watermark(spark, tmp_path):
    base = datetime.datetime(2024, 1, 1)
    rows = [("d", "wearable", base + datetime.timedelta(seconds=s)) for s in (0, 5, 10, 100, 105, 9000)]
    spark.createDataFrame(rows, "device_id string, device_type string, ts timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("device_id string, device_type string, ts timestamp").parquet(str(tmp_path / "in"))
    query = windows.device_sessions(stream, watermark="10 seconds").writeStream.format("memory").queryName(
        "sessions").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(row.readings for row in spark.table("sessions").collect()) == [2, 3]


def test_scoring_job(spark, tmp_path):
    schema = "person_id long, discharge_time timestamp, label int, " + ", ".join(f"{f} double" for f in FEATURES)
    rows = [(i, NOW, i % 2, *([float(i % 2)] * len(FEATURES))) for i in range(60)]
    features = spark.createDataFrame(rows, schema)
    model = r.train(features, r.TrainConfig(trees=2, depth=2))
    stay = {"discharge_time": "2024-01-03T00:00:00Z"}
    source = tmp_path / "in"
    batch(spark, (ADMIT, admission(**stay)), (ADMIT, admission(**stay)), (ADMIT, {**admission(**stay), "patient_id": "3"}),
          (ADMIT, {**admission(), "patient_id": "4"}), (ADMIT, {**admission(**stay), "patient_id": "unknown"}),
          (ADMIT, "{bad")).write.json(str(source))
    stream = read_events(spark, [ADMIT], path=str(source))
    at = F.lit(NOW)
    silver.scoring_job(stream, features.drop("label"), model, str(tmp_path / "o"), str(tmp_path / "c"), at).awaitTermination()
    out = spark.read.json(str(tmp_path / "o" / "predictions")).collect()
    assert sorted(row.key for row in out) == ["1", "3"]
    values = [json.loads(row.value) for row in out]
    assert all(0 <= v["score"] <= 1 and v["prediction_type"] == "readmission_30d" for v in values)


@pytest.mark.parametrize("late", [0, 1])
def test_late_rows_are_counted(spark, late):
    from pyspark.sql import Observation

    rows = spark.createDataFrame([(NOW, NOW + datetime.timedelta(hours=2 * late))], "ts timestamp, arrived timestamp")
    seen = Observation("late_rows")
    delay = F.unix_seconds("arrived") - F.unix_seconds("ts")
    rows.observe(seen, F.sum((delay > 3600).cast("long")).alias("late")).collect()
    assert seen.get["late"] == late
    assert windows.observe_late(rows, "ts", "arrived", 3600).count() == 1


def test_a_message_is_read_in_one_pass(spark):
    """No look into the document a field, no interpreted lists for the valid, no method too long to be compiled."""
    parsed = validate.parse(batch(spark, *[(t, v) for t, v, _ in CASES]))
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert "try_variant_get(_json" in plan and "$.source" not in plan
    assert plan.count("from_json") + plan.count("jsontostructs") == 1 and parsed.sparkSession.conf.get(METHODS) == "8000"


def test_texts_are_those_of_the_document(spark):
    texts = {'"\\u00e4\\n \\"q\\""': "ä\n \"q\"", '" padded "': "padded", '""': "", '"72"': "72", '"\\ud83d\\ude00"': "\U0001f600", "72": None, "null": None, '["a"]': None}
    sent = [(VITAL, f'{{"event_id":{x},"zz":1,"source":"ehr","b":2,"patient_id":"1"}}') for x in texts]
    counts = {"-0": 0, "7.2e1": 72, "3.0": 3, '"2"': 2, "null": None}
    sent += [(VITAL, f'{{"schema_version":{x},"source":"ehr","patient_id":"1"}}') for x in counts]
    rows = validate.parse(batch(spark, *sent)).orderBy("offset").collect()
    assert [r._v_event_id for r in rows[:len(texts)]] == list(texts.values())
    assert [r.error_message.split("; ")[-2:] for r in rows[:len(texts)]] == [["zz: extra field", "b: extra field"]] * len(texts)
    assert [r._v_schema_version for r in rows[len(texts):]] == list(counts.values())
    assert [r.error_message for r in rows[len(texts):]] == [None, None, None, None, None]
