"""Encryption, de-identification, access and audit on literal rows."""

import datetime
import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from carelattice.governance import access, deid, phi

KEY, OTHER = bytes(range(32)), bytes(range(32, 64))


@pytest.fixture
def keys(spark):
    return phi.Keyring(spark, {"k1": KEY}, "k1")


def values(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "v string")


def test_modes_and_passthrough(spark, keys):
    df = values(spark, ["x", "x", "", None]).coalesce(1)
    det = [r.e for r in df.select(phi.encrypt_value(F.col("v"), keys, deterministic=True).alias("e")).collect()]
    ran = [r.e for r in df.select(phi.encrypt_value(F.col("v"), keys).alias("e")).collect()]
    assert det[0] == det[1] and ran[0] != ran[1]
    assert det[2:] == ["", None] and ran[2:] == ["", None]


def test_long_value_round_trip_and_tamper(spark, keys):
    df = values(spark, ["long text " * 50]).select(phi.encrypt_value(F.col("v"), keys, aad="a").alias("e"))
    sealed = df.first().e
    opened = values(spark, [sealed, sealed.replace('"ct":"', '"ct":"AAAA'), "plain"])
    assert [r.p for r in opened.select(phi.decrypt_value(F.col("v"), keys, "a").alias("p")).collect()] == ["long text " * 50, None, "plain"]
    assert values(spark, [sealed]).select(phi.decrypt_value(F.col("v"), keys, "b")).first()[0] is None


def test_unknown_key_is_counted(spark, keys):
    df = spark.createDataFrame([("m1",), ("m2",)], "mrn string")
    sealed = phi.encrypt_phi(df, "person", keys)
    stranger = phi.Keyring(spark, {"k9": OTHER}, "k9")
    assert phi.decrypt_failures(sealed, "person", stranger).first().failed_rows == 2
    assert phi.decrypt_failures(sealed, "person", keys).first().failed_rows == 0


def test_encrypting_twice_changes_nothing(spark, keys):
    once = phi.encrypt_phi(spark.createDataFrame([("m1",)], "mrn string"), "person", keys)
    again = phi.encrypt_phi(spark.createDataFrame(once.collect(), once.schema), "person", keys)
    assert phi.decrypt_phi(again, "person", keys).first().mrn == "m1"


def test_rotation_is_idempotent(spark, keys):
    both = phi.Keyring(spark, {"k1": KEY, "k2": OTHER}, "k2")
    old = phi.encrypt_phi(spark.createDataFrame([("m1", "a@b.c"), (None, "")], "mrn string, email string"), "person", keys)
    old = spark.createDataFrame(old.collect(), old.schema)
    new = phi.rotate_keys(old, "person", both, "k1")
    new = spark.createDataFrame(new.collect(), new.schema)
    twice = phi.rotate_keys(new, "person", both, "k1")
    assert twice.collect() == new.collect()
    assert [tuple(r) for r in phi.decrypt_phi(new, "person", both).collect()] == [("m1", "a@b.c"), (None, "")]


def test_key_is_not_in_any_plan(spark, keys):
    df = phi.encrypt_phi(spark.createDataFrame([("m1",)], "mrn string"), "person", keys)
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("extended")
        df.explain("formatted")
    import base64
    for secret in (KEY.hex(), KEY.hex().upper(), base64.b64encode(KEY).decode(), "0, 1, 2, 3, 4, 5"):
        assert secret not in out.getvalue()


def test_events_keep_readings(spark, keys):
    df = spark.createDataFrame([("p1", "M1", "e1", "d1", 72)], "patient_id string, mrn string, encounter_id string, device_id string, heart_rate int")
    sealed = phi.encrypt_phi(df, "event", keys)
    row = sealed.first()
    assert row.heart_rate == 72 and all(v.startswith('{"v":1') for v in row[:4])
    assert phi.leak_check(sealed, "event").filter("not passed").count() == 0
    assert phi.leak_check(df, "event").filter("not passed").count() == 4
    message = sealed.select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.lit(1).cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"), F.lit("k").alias("key"),
        F.to_json(F.struct(F.struct(*df.columns).alias("event"))).alias("value"))
    audited = access.phi_access_audit(message, "etl").first()
    assert sorted(audited.fields) == ["event.device_id", "event.encounter_id", "event.mrn", "event.patient_id"]


def test_registry_modes():
    assert len(phi.REGISTRY) == 22
    assert phi.REGISTRY["person.mrn"].mode == "deterministic" and phi.REGISTRY["location.city"].mode == "none"
    assert {f.path for f in phi.fields_under("event.")} == {"event.patient_id", "event.encounter_id", "event.device_id", "event.mrn"}


@pytest.mark.parametrize("code, parity, safe", [
    ("46802", "46***", "468"), ("46802-1234", "46***-1234", "468"), ("", None, None), (None, None, None), ("123", "00000", "00000"),
])
def test_redact_zip(spark, code, parity, safe):
    df = values(spark, [code])
    assert df.select(deid.redact_zip(F.col("v"), "parity")).first()[0] == parity
    assert df.select(deid.redact_zip(F.col("v"))).first()[0] == safe


def test_ages_and_years(spark):
    at = F.lit("2026-06-01").cast("date")
    df = values(spark, ["1920-01-01", "1976-06-01", "2025-03-15T08:00:00Z", "not a date"])
    rows = df.select(deid.generalize_age(F.col("v"), at).alias("a"), deid.date_to_year(F.col("v")).alias("y")).collect()
    assert [r.a for r in rows][:2] == [90, 50] and [r.y for r in rows][2:] == [2025, None]


def test_nested_deidentification(spark):
    schema = ("name string, phone string, zip string, mrn string, birth_datetime string, ip string, "
              "details struct<ssn:string,note:string>, visits array<struct<visit_date:string,city:string>>")
    row = ("Ann", "555", "46802", "M1", "1980-05-05T00:00:00", "10.0.1.77", ("123", "ok"), [("2024-02-03", "FW")])
    got = deid.deidentify(spark.createDataFrame([row], schema), zip_mode="parity").first()
    assert got.name.startswith("DH_") and got.mrn.startswith("DH_") and got.phone is None
    assert (got.zip, got.birth_datetime, got.ip) == ("46***", 1980, "10.0.1.0")
    assert got.details.ssn.startswith("DH_") and got.details.note == "ok"
    assert [(v.visit_date, v.city) for v in got.visits] == [(2024, "FW")]


def test_person_and_visit(spark):
    df = spark.createDataFrame([("Ann", "M1", 1910, "a@b.c")], "name string, mrn string, year_of_birth int, email string")
    got = deid.deidentify_person(df, F.lit("2026-01-01").cast("date")).first()
    assert got.year_of_birth == 1936 and got.email is None and got.name != got.mrn
    visit = spark.createDataFrame([(1, datetime.datetime(2025, 3, 1), datetime.datetime(2025, 3, 4))],
                                  "visit_occurrence_id int, visit_start_datetime timestamp, visit_end_datetime timestamp")
    row = deid.deidentify_visit(visit).first()
    assert (row.visit_start_datetime, row.visit_start_year, row.visit_end_year) == (None, 2025, 2025)


DECISIONS = [
    ("admin", "export", "anything", ["person.mrn"], True, ["person.mrn"]),
    ("clinician", "read", "clinical_care", ["person.mrn", "vitals.hr"], True, ["person.mrn", "vitals.hr"]),
    ("clinician", "write", "clinical_care", ["person.mrn"], False, []),
    ("data_scientist", "read", "model_training", ["person.mrn"], False, []),
    ("data_scientist", "read", "model_training", ["omcdm_person.year_of_birth"], True, ["omcdm_person.year_of_birth"]),
    ("data_scientist", "read", "billing", ["omcdm_person.year_of_birth"], False, []),
    ("clinician", "read", "clinical_care", ["personal.x"], False, []),
    ("stranger", "read", "clinical_care", ["person.mrn"], False, []),
    ("model", "read", "model_inference", ["measurement.value"], True, ["measurement.value"]),
    ("viewer", "read", "clinical_care", [], True, []),
]


def test_access_decisions(spark):
    df = spark.createDataFrame([(i, *d[:4]) for i, d in enumerate(DECISIONS)],
                               "id int, role string, action string, purpose string, fields array<string>")
    rows = access.evaluate_access(df).orderBy("id").collect()
    assert [(r.allow, r.filtered_fields) for r in rows] == [d[4:] for d in DECISIONS]
    assert (rows[7].reason, rows[7].fields_asked) == ("role_unknown", 1)
    assert (rows[1].reason, rows[1].fields_asked) == ("fields_granted", 2)


def test_governed_read_projects_masks_and_audits(spark, tmp_path):
    df = spark.createDataFrame([("m", 1980)], "mrn string, year_of_birth int")
    at = F.lit("2024-01-01").cast("timestamp")
    path = str(tmp_path / "audit")
    seen = access.governed_read(df, "omcdm_person", "ds", "data_scientist", "model_training", at=at, audit_path=path)
    assert seen.columns == ["mrn", "year_of_birth"]
    with pytest.raises(PermissionError):
        access.governed_read(df, "person", "ds", "data_scientist", "model_training", at=at, audit_path=path)
    audit = spark.read.parquet(path)
    assert {(r.resource_id, r.outcome) for r in audit.collect()} == {("omcdm_person", "success"), ("person", "denied")}
    assert access.audit_query(audit, actor_id="ds", limit=1).count() == 1
    assert access.audit_csv(audit).filter("resource_id = 'omcdm_person'").first().fields == "omcdm_person.mrn,omcdm_person.year_of_birth"


def test_protected_fields_are_found_at_any_depth(spark):
    sealed = '{\\"v\\":1,\\"kid\\":\\"k1\\",\\"ct\\":\\"x\\",\\"n\\":\\"y\\",\\"alg\\":\\"z\\"}'
    text = '{"mrn":"%s","a":{"b":{"c":{"d":{"e":{"ssn":"%s","note":"%s"}}},"phone":"%s"}}}' % ((sealed,) * 4)
    df = spark.createDataFrame([(text,), (None,), ("[1]",)], "value string")
    got = [r[0] for r in df.select(access.phi_fields_present(F.col("value"))).collect()]
    assert sorted(got[0]) == ["a.b.c.d.e.ssn", "a.b.phone", "mrn"] and not got[1] and not got[2]
