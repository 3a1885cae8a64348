"""Governance queries and oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelattice.functions.columns import as_of_date
from carelattice.governance import access, deid, phi
from carelattice.session import spread
from suite import warehouse as w
from suite.views import AS_OF, load, view, with_views

KEY = bytes(range(32))
NEXT = bytes(range(1, 33))


def people(spark, sf):
    """Persons with contact columns, from the customer table."""
    (customer,) = load(spark, sf, "customer")
    key = F.col("c_custkey")
    return spread(customer.select("c_custkey", "c_name")).select(
        key.alias("person_id"), F.concat(F.lit("M"), key.cast("string")).alias("mrn"),
        F.date_add(F.lit("1900-01-01").cast("date"), ((key * 7919) % 33000).cast("int")).cast("string").alias("birth_datetime"),
        F.col("c_name").alias("name"),
        F.when(key % 23 == 5, "").otherwise(F.concat(F.lower("c_name"), F.lit("@example.com"))).alias("email"),
        F.when(key % 31 == 3, None).otherwise(F.lit("260-555-0100")).alias("phone"),
        (1900 + (key * 7919) % 33000 / 366).cast("int").alias("year_of_birth"),
    )


O_PEOPLE = """select c_custkey as person_id, 'M' || c_custkey as mrn,
    cast(date '1900-01-01' + cast((c_custkey * 7919) % 33000 as int) as varchar) as birth_datetime, c_name as name,
    case when c_custkey % 23 = 5 then '' else lower(c_name) || '@example.com' end as email,
    case when c_custkey % 31 = 3 then null else '260-555-0100' end as phone,
    cast(floor(1900 + ((c_custkey * 7919) % 33000) / 366::double) as int) as year_of_birth from customer"""


def ring(spark):
    return phi.Keyring(spark, {"k1": KEY}, "k1")


def phi_roundtrip(spark, sf):
    keys = ring(spark)
    return phi.decrypt_phi(phi.encrypt_phi(people(spark, sf), "person", keys), "person", keys)


def phi_leaks(spark, sf):
    rows = phi.encrypt_phi(people(spark, sf), "person", ring(spark))
    return phi.leak_check(rows, "person").unionByName(phi.leak_check(people(spark, sf), "person"))


def phi_rotation(spark, sf):
    both = phi.Keyring(spark, {"k1": KEY, "k2": NEXT}, "k2")
    old = phi.encrypt_phi(people(spark, sf), "person", ring(spark))
    renewed = phi.rotate_keys(old, "person", both, "k1")
    kid = phi.envelope(F.col("mrn"))["kid"].alias("kid")
    return renewed.groupBy(kid).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("mrn").alias("mrns"))


def joinable(spark, sf):
    """Orders find their person by the deterministic envelope of the identifier."""
    keys = ring(spark)
    person = phi.encrypt_phi(people(spark, sf).select("person_id", "year_of_birth"), "person", keys)
    (orders,) = load(spark, sf, "orders")
    events = spread(orders.select("o_custkey")).select(F.col("o_custkey").alias("patient_id"))
    sealed = phi.encrypt_phi(events, "event", keys).withColumnRenamed("patient_id", "person_id")
    return sealed.join(person, "person_id").groupBy("year_of_birth").agg(F.count(F.lit(1)).alias("n"))


def deid_person(spark, sf):
    return deid.deidentify_person(people(spark, sf), as_of_date(AS_OF)).drop("birth_datetime", "email", "phone")


def deid_visit(spark, sf):
    return deid.deidentify_visit(w.visit(spark, sf).select(
        "visit_occurrence_id", "visit_start_datetime", "visit_end_datetime")).drop("visit_start_datetime", "visit_end_datetime")


def deid_events(spark, sf):
    rows = view(spark, sf, "device_readings").withColumn("notes", F.lit("text"))
    return deid.deidentify_events(rows).drop("notes", "ts")


def deid_generic(spark, sf):
    rows = view(spark, sf, "eligibility").select(
        "mem_id", "first_name", "zip_code", "email", "effective_date", "state",
        F.concat(F.lit("10.0."), (F.col("row_key") % 200).cast("string"), F.lit(".17")).alias("ip"),
        F.struct(F.col("last_name"), F.col("mem_id").alias("mrn")).alias("details"),
    )
    out = deid.deidentify(rows, zip_mode="parity")
    return out.select("mem_id", "first_name", "zip_code", "effective_date", "state", "ip",
                      "details.last_name", F.col("details.mrn").alias("mrn"))


def generalized_age(spark, sf):
    born = F.col("birth_datetime")
    return people(spark, sf).select("person_id", deid.generalize_age(born, as_of_date(AS_OF)).alias("age"),
                                    deid.date_to_year(born).alias("birth_year"))


def requests(spark, sf):
    rows = view(spark, sf, "requests")
    return rows.withColumn("fields", F.when(F.col("fields") == "", F.array().cast("array<string>"))
                           .otherwise(F.split("fields", ",")))


def decisions(spark, sf):
    return access.evaluate_access(requests(spark, sf)).select(
        "request_id", "allow", "reason", "fields_asked", F.array_join("filtered_fields", ",").alias("filtered"))


def audit_query(spark, sf):
    return access.audit_query(view(spark, sf, "access_log"), resource_id="person",
                              since=F.lit("2024-01-10").cast("timestamp"), limit=100, ts="ts")


def audit_rollup(spark, sf):
    rows = view(spark, sf, "access_log")
    rows = rows.withColumn("fields", F.when(F.col("fields") != "", F.split("fields", ",")))
    return access.audit_rollup(rows, F.lit("2024-01-20").cast("timestamp"), ts="ts")


def governed(spark, sf):
    return access.governed_read(people(spark, sf).withColumnRenamed("name", "full"), "person", "dr1", "clinician",
                                "clinical_care", at=as_of_date(AS_OF)).select("person_id", "mrn", "year_of_birth")


def phi_audit(spark, sf):
    """Messages with encrypted identifiers give audit rows."""
    events = spread(view(spark, sf, "device_readings")).select(
        "event_id", "ts", F.when(F.col("event_id") % 4 > 0, F.col("patient_id")).alias("patient_id"), "device_id")
    sealed = phi.encrypt_phi(events, "event", ring(spark))
    body = F.to_json(F.struct("patient_id", "device_id", F.lit(72).alias("heart_rate")))
    messages = sealed.select(
        F.lit("iot.telemetry").alias("topic"), (F.col("event_id") % 6).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"), F.lit("k").alias("key"),
        F.when(F.col("event_id") % 5 == 0, F.lit('{"a":1}')).otherwise(body).alias("value"))
    audited = access.phi_access_audit(messages, "etl")
    return audited.select(F.col("context")["offset"].cast("long").alias("offset"), "resource_id", "action",
                          F.array_join("fields", ",").alias("fields"))


def phi_audit_nested(spark, sf):
    """Encrypted identifiers one, three and five levels deep."""
    events = spread(view(spark, sf, "device_readings")).select("event_id", "ts", "patient_id", "device_id")
    sealed = phi.encrypt_phi(events, "event", ring(spark))
    deep = F.struct(F.struct("patient_id", F.struct(F.struct("device_id").alias("d")).alias("c")).alias("b"))
    messages = sealed.select(
        F.lit("iot.nested").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"), F.lit("k").alias("key"), F.to_json(F.struct("device_id", deep.alias("a"))).alias("value"))
    return access.phi_access_audit(messages, "etl").select(
        F.col("context")["offset"].cast("long").alias("offset"), F.array_join("fields", ",").alias("fields"))


QUERIES = {
    "phi_roundtrip": phi_roundtrip,
    "phi_leak_check": phi_leaks,
    "phi_key_rotation": phi_rotation,
    "phi_joinable": joinable,
    "deidentify_person": deid_person,
    "deidentify_visit": deid_visit,
    "deidentify_events": deid_events,
    "deidentify_table": deid_generic,
    "generalized_age": generalized_age,
    "access_decisions": decisions,
    "governed_read": governed,
    "audit_query": audit_query,
    "audit_rollup": audit_rollup,
    "phi_access_audit": phi_audit,
    "phi_access_audit_nested": phi_audit_nested,
}


def dh(value: str, salt: str) -> str:
    return f"'DH_' || substr(sha256('{salt}::' || {value}), 1, 16)"


def leak_rows(plain: bool) -> str:
    parts = []
    for c in ("person_id", "mrn", "birth_datetime", "email", "phone"):
        bad = f"count(*) filter (where coalesce(cast({c} as varchar), '') <> '')" if plain else "0"
        parts.append(f"select 'no_plain_phi' as check_id, 'person' as table_name, '{c}' as column_name, 'fatal' as severity, "
                     f"{bad} as failed_rows, count(*) as total_rows, {bad} = 0 as passed from people")
    return " union all ".join(parts)


ACCESS = """
    with p(role, actions, purposes, pattern) as (values
      ('admin', ['read','write','export','deidentify','key_rotation'], ['*'], '.*'),
      ('clinician', ['read'], ['clinical_care','quality_improvement','research_consented'], '(person|visit|condition|drug|measurement|vitals)\\..*'),
      ('data_scientist', ['read','deidentify'], ['model_training','model_evaluation','research_export'], 'omcdm_.*'),
      ('analyst', ['read'], ['clinical_care','research_export','quality_improvement','billing'], '(mart_|omcdm_).*'),
      ('service', ['read','write'], ['*'], '.*'),
      ('model', ['read'], ['clinical_care','model_inference'], '(person|visit|measurement|vitals)\\..*'),
      ('viewer', ['read'], ['clinical_care'], 'mart_.*')),
    split as (select r.*, case when r.fields = '' then [] else string_split(r.fields, ',') end as wanted,
        p.actions, p.purposes, p.pattern from requests r left join p on r.role = p.role),
    seen as (select *, list_filter(wanted, lambda f: regexp_full_match(f, pattern)) as got from split),
    verdict as (select *, case when actions is null then 1 when not list_contains(actions, action) then 2
        when not (list_contains(purposes, '*') or list_contains(purposes, purpose)) then 3
        when len(wanted) = 0 then 4 when len(got) = 0 then 5 else 6 end as v from seen)
    select request_id, v in (4, 6) as allow,
      ['role_unknown', 'action_denied', 'purpose_denied', 'no_fields_named', 'fields_denied', 'fields_granted'][v] as reason,
      cast(len(wanted) as int) as fields_asked,
      case when v = 6 then array_to_string(got, ',') else '' end as filtered
    from verdict"""


def oracle(sql):
    return with_views(sql, people=O_PEOPLE, **w.OMOP_VIEWS)


ORACLES = {
    "phi_roundtrip": oracle("select * replace (cast(person_id as varchar) as person_id) from people"),
    "phi_leak_check": oracle(leak_rows(False) + " union all " + leak_rows(True)),
    "phi_key_rotation": oracle("select 'k2' as kid, count(*) as n, count(distinct mrn) as mrns from people"),
    "phi_joinable": oracle("""
        select year_of_birth, count(*) as n from orders join people on o_custkey = person_id group by 1"""),
    "deidentify_person": oracle(f"""
        select person_id, {dh('mrn', 'mrn')} as mrn, {dh('name', 'person-name')} as name,
          greatest(year_of_birth, year(date '{AS_OF}') - 90)::int as year_of_birth from people"""),
    "deidentify_visit": oracle("""
        select visit_occurrence_id, year(visit_start_datetime)::int as visit_start_year, year(visit_end_datetime)::int as visit_end_year
        from o_visit"""),
    "deidentify_events": oracle(f"""
        select event_id, {dh('device_id', 'iot-device')} as device_id, {dh('patient_id', 'iot-patient')} as patient_id,
          device_type, metrics from device_readings"""),
    "deidentify_table": oracle(f"""
        select mem_id, {dh('first_name', 'deid-2026-06-name')} as first_name,
          case when length(zip_code) < 5 then '00000' else substr(zip_code, 1, 2) || '***' end as zip_code,
          year(effective_date::date)::int as effective_date, state, '10.0.' || (row_key % 200) || '.0' as ip,
          {dh('last_name', 'deid-2026-06-name')} as last_name, {dh('mem_id', 'deid-2026-06-mrn')} as mrn from eligibility"""),
    "generalized_age": oracle(f"""
        select person_id, least(round_even((date '{AS_OF}' - birth_datetime::date) / 365.25, 0), 90)::int as age,
          year(birth_datetime::date)::int as birth_year from people"""),
    "access_decisions": oracle(ACCESS),
    "governed_read": oracle("select person_id, mrn, year_of_birth from people"),
    "audit_query": oracle("""
        select * from access_log where resource_id = 'person' and ts >= timestamp '2024-01-10'
        order by ts desc, audit_id limit 100"""),
    "audit_rollup": oracle("""
        select resource_id, actor_id, field, count(*) as accesses, count(*) filter (where outcome = 'denied') as denied,
          max(ts) as last_access
        from (select *, unnest(case when fields = '' then [null] else string_split(fields, ',') end) as field
              from access_log where ts >= timestamp '2024-01-20') group by 1, 2, 3"""),
    "phi_access_audit": oracle("""
        select event_id as "offset", 'iot.telemetry' as resource_id, 'read' as action,
          case when event_id % 4 > 0 then 'patient_id,device_id' else 'device_id' end as fields
        from device_readings where event_id % 5 <> 0"""),
    "phi_access_audit_nested": oracle("""
        select event_id as "offset", concat_ws(',', case when device_id is not null then 'device_id' end,
          case when patient_id is not null then 'a.b.patient_id' end,
          case when device_id is not null then 'a.b.c.d.device_id' end) as fields
        from device_readings where patient_id is not null or device_id is not null"""),
}
