"""Healthcare views over the driver's star tables.

Each view is one SELECT in SQL that Spark and DuckDB read alike, so a query and its oracle
start from the same rows. ``load`` gives Spark DataFrames; ``with_views`` puts the views
in front of an oracle query as common table expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
AS_OF = "2001-09-01"
EVENTS_AS_OF = "2024-02-01"

CODES = "E11.9 I10 J44.1 J44.0 J45.909 K21.0 K21.9 M54.5 F41.9 F32.9 N18.3 D50.9 I50.9 H25.1 999".split()


def code(key: str) -> str:
    cases = " ".join(f"when {i} then '{c}'" for i, c in enumerate(CODES))
    return f"case {key} % {len(CODES)} {cases} end"


DOB = "cast(date '1915-01-01' + cast((c_custkey * 7919) % 33000 as int) as string)"
START = "date '1995-01-01' + cast((c_custkey * 13) % 1500 as int)"
END = "date '1995-01-01' + cast((c_custkey * 13) % 1500 + (c_custkey * 17) % 2000 as int)"
MEMBER = "concat('MEM', lpad(cast({} as string), 12, '0'))"
ORDER_DAY = "cast(o_orderdate as date)"
MESSAGE_DAY = "(date '2024-01-01' + cast(o_orderkey % 28 as int))"

VIEWS = {
    "eligibility": f"""
        select {MEMBER.format('case when c_custkey % 50 = 49 then c_custkey - 1 else c_custkey end')} as mem_id,
          c_custkey as row_key,
          concat('First', cast(c_custkey as string)) as first_name,
          concat('Last', cast(c_custkey as string)) as last_name,
          case when c_custkey % 41 = 7 then '' else {DOB} end as dob,
          case when c_custkey % 23 = 5 then '' else concat(lower(c_name), '@example.com') end as email,
          case when c_custkey % 31 = 3 then '' else '260-555-0100' end as phone,
          concat(cast(c_custkey as string), ' Main St') as address,
          concat('City', cast(c_nationkey as string)) as city,
          case c_nationkey % 5 when 0 then 'NY' when 1 then 'MA' when 2 then 'IN' when 3 then 'TX' else 'ZZ' end as state,
          cast((c_custkey * 37 + 501) % 100000 as string) as zip_code,
          cast({START} as string) as effective_date,
          case when c_custkey % 7 = 0 then cast({END} as string) else 'Active' end as termination_date,
          case c_custkey % 6 when 3 then 'Spouse' when 4 then 'Child' when 5 then 'Domestic Partner' else 'Self' end as covered_relation,
          case c_mktsegment when 'BUILDING' then 'hmo' when 'AUTOMOBILE' then 'PPO' when 'MACHINERY' then 'EPO'
            when 'HOUSEHOLD' then 'HDHP' else 'POS' end as plan_type,
          case c_nationkey % 4 when 0 then 'Bronze' when 1 then 'Silver' when 2 then 'Gold' else 'Platinum' end as metal_level,
          case c_custkey % 2 when 0 then 'Yes' else 'No' end as hsa_eligible
        from customer""",
    "segments": f"""
        select {MEMBER.format('o_custkey')} as mem_id, o_orderkey as segment_id,
          case o_orderkey % 2 when 0 then 'HMO' else 'PPO' end as plan_type,
          {ORDER_DAY} as effective_date,
          case when o_orderkey % 37 = 0 then cast(null as date)
            else {ORDER_DAY} + cast(20 + o_orderkey % 200 as int) end as termination_date
        from orders""",
    "claims": f"""
        select o.o_orderkey as claim_id, {MEMBER.format('o.o_custkey')} as mem_id,
          coalesce(l.supplier, 0) as provider_npi,
          cast(o.o_orderdate as date) as claim_date, cast(o.o_orderdate as date) as admit_date,
          cast(o.o_orderdate as date) + cast(o.o_orderkey % 8 as int) as discharge_date,
          case o.o_orderstatus when 'F' then 'inpatient' when 'O' then 'medical' else 'pharmacy' end as claim_type,
          o.o_orderpriority as service_type,
          {code('o.o_orderkey')} as primary_diagnosis,
          cast(o.o_totalprice as decimal(18,6)) as allowed_amount,
          cast(cast(o.o_totalprice as decimal(18,6)) * cast(0.8 as decimal(3,2)) as decimal(18,6)) as paid_amount,
          cast(cast(o.o_totalprice as decimal(18,6)) * cast(0.2 as decimal(3,2)) as decimal(18,6)) as member_copay
        from orders o left join
          (select l_orderkey, min(l_suppkey) as supplier from lineitem group by l_orderkey) l
          on o.o_orderkey = l.l_orderkey""",
    "member_claims": f"""
        select o_orderkey as claim_id, {MEMBER.format('o_custkey')} as mem_id, o_orderkey % 97 as provider_npi,
          cast(o_orderdate as date) as claim_date, o_orderpriority as service_type,
          cast(o_totalprice as decimal(18,6)) as allowed_amount,
          cast(cast(o_totalprice as decimal(18,6)) * cast(0.8 as decimal(3,2)) as decimal(18,6)) as paid_amount,
          cast(cast(o_totalprice as decimal(18,6)) * cast(0.2 as decimal(3,2)) as decimal(18,6)) as member_copay
        from orders""",
    "diagnoses": f"""
        select distinct l_orderkey as claim_id, {code('l_partkey')} as icd10_code from lineitem""",
    "providers": """
        select s_suppkey as provider_npi, s_name as provider_name,
          concat('facility', cast(s_suppkey % 20 as string)) as facility_name,
          cast(s_nationkey as string) as facility_state,
          concat('spec', cast(s_nationkey % 9 as string)) as specialty,
          1 + s_suppkey % 3 as tier
        from supplier""",
    "patients": f"""
        select cast(c_custkey as string) as patient_id, {DOB} as birthdate,
          case when c_custkey % 97 = 11 then cast(date '2000-06-15' as string) else cast(null as string) end as deathdate,
          case c_custkey % 5 when 0 then 'm' when 1 then 'F' when 2 then 'M' when 3 then 'f' else 'X' end as gender,
          case c_custkey % 6 when 0 then 'White' when 1 then 'black' when 2 then 'asian' when 3 then 'native'
            when 4 then 'other' else 'unlisted' end as race,
          case c_custkey % 3 when 0 then 'nonhispanic' when 1 then 'Hispanic' else '' end as ethnicity,
          concat('City', cast(c_nationkey as string)) as city,
          case c_nationkey % 5 when 0 then 'NY' when 1 then 'MA' when 2 then 'IN' when 3 then 'TX' else 'ZZ' end as state,
          cast((c_custkey * 37 + 501) % 100000 as string) as zip
        from customer""",
    "encounters": f"""
        select cast(o_orderkey as string) as encounter_id, cast(o_custkey as string) as patient_id,
          cast({ORDER_DAY} as string) as start,
          cast({ORDER_DAY} + cast(o_orderkey % 8 as int) as string) as stop,
          case o_orderpriority when '1-URGENT' then 'emergency' when '2-HIGH' then 'inpatient'
            when '3-MEDIUM' then 'outpatient' when '4-NOT SPECIFIED' then 'wellness' else 'virtual' end as encounterclass,
          concat('Encounter ', cast(o_orderkey % 10 as string)) as description
        from orders""",
    "conditions": f"""
        select cast(o_custkey as string) as patient_id, cast({ORDER_DAY} as string) as start,
          case when o_orderkey % 3 = 0 then '' else cast({ORDER_DAY} + 30 as string) end as stop,
          {code('o_orderkey')} as code, concat('Condition ', {code('o_orderkey')}) as description
        from orders""",
    "medications": """
        select cast(o.o_custkey as string) as patient_id, cast(cast(l.l_shipdate as date) as string) as start,
          cast(cast(l.l_shipdate as date) + cast(l.l_quantity as int) as string) as stop,
          case when l.l_partkey % 40 = 39 then '' when l.l_partkey % 40 >= 37 then concat('NDC', cast(l.l_partkey % 40 as string))
            else cast(l.l_partkey % 40 as string) end as code,
          concat('Drug ', cast(l.l_partkey % 40 as string)) as description,
          case l.l_returnflag when 'R' then 'Hypertension' when 'A' then 'Diabetes' else cast(null as string) end as reasondescription
        from lineitem l join orders o on l.l_orderkey = o.o_orderkey""",
    "observations": """
        select cast(user_id as string) as patient_id, cast(ts as timestamp) as dt,
          case event_id % 7 when 0 then 'Systolic blood pressure' when 1 then 'Heart rate' when 2 then 'Body temperature'
            when 3 then 'Hemoglobin A1c' when 4 then 'Creatinine' when 5 then 'Hemoglobin'
            else 'Thyroid stimulating hormone' end as description,
          concat('L', cast(event_id % 7 as string)) as code,
          case when event_id % 19 = 0 then 'n/a' else cast(cast(value as decimal(12,2)) as string) end as value,
          'u' as units
        from events""",
    "heart_rates": f"""
        select cast(o_custkey as string) as patient_id,
          cast({ORDER_DAY} + cast(o_orderkey % 11 as int) as timestamp) as dt, 'Heart rate' as description, 'HR' as code,
          cast(cast(50 + o_orderkey % 90 as int) as string) as value, 'bpm' as units
        from orders""",
    "raw_vitals": """
        select 'healthcare.vitals' as topic, cast(user_id % 6 as int) as prt, event_id as off, cast(ts as timestamp) as sent_at,
          case when event_id % 29 = 0 then '{not json'
            when event_id % 29 = 1 then concat('{"source":"monitor","event_id":"e', cast(event_id as string), '","event_time":"', replace(substring(cast(ts as string), 1, 19), ' ', 'T'), 'Z","patient_id":"', cast(user_id as string), '","heart_rate_bpm":9999}')
            when event_id % 29 = 2 then concat('{"source":"monitor","event_id":"e', cast(event_id as string), '","patient_id":"', cast(user_id as string), '","colour":"red"}')
            when event_id % 29 = 3 then concat('{"source":"abacus","patient_id":"', cast(user_id as string), '"}')
            when event_id % 29 = 4 then concat('{"source":"monitor","heart_rate_bpm":', cast(60 + event_id % 40 as string), '}')
            else concat('{"source":"monitor","event_id":"e', cast(event_id as string), '","event_time":"', replace(substring(cast(ts as string), 1, 19), ' ', 'T'), 'Z","patient_id":"', cast(user_id * 2 as string), '","heart_rate_bpm":', cast(30 + event_id % 130 as string), ',"spo2_pct":', cast(82 + event_id % 19 as string), ',"systolic_bp_mmHg":', cast(80 + event_id % 90 as string), '}')
          end as value
        from events""",
    "raw_admissions": f"""
        select 'healthcare.admissions' as topic, cast(o_custkey % 4 as int) as prt, o_orderkey as off, cast({MESSAGE_DAY} as timestamp) as sent_at,
          case when o_orderkey % 31 = 6 then '[1, 2]' else concat('{{', case when o_orderkey % 31 = 7 then '' else '"source":"ehr",' end,
            '"event_id":"a', cast(o_orderkey as string), '","event_time":"', cast({MESSAGE_DAY} as string), 'T10:00:00Z',
            '","patient_id":"', cast(o_custkey as string), '","encounter_id":"e', cast(o_orderkey as string),
            '","admission_type":"', case when o_orderkey % 31 = 0 then 'spa' else 'inpatient' end,
            case when o_orderkey % 31 in (1, 7) then '' else '","facility_id":"f1' end,
            '","chief_complaint":"', repeat('x', cast(case when o_orderkey % 31 = 2 then 501 else o_orderkey % 9 end as int)),
            '","admit_time":"', case when o_orderkey % 31 = 3 then 'soon' else concat(cast({MESSAGE_DAY} as string), 'T08:00:00Z') end,
            case when o_orderkey % 31 = 4 then '","disposition":"lost' else '","disposition":"home' end,
            '","diagnosis_codes":', case when o_orderkey % 31 = 5 then '[1]' else '["I10"]' end,
            case when o_orderkey % 2 = 0 then concat(',"discharge_time":"', cast({MESSAGE_DAY} as string), 'T20:00:00Z"') else '' end, '}}') end as value
        from orders""",
    "raw_labs": f"""
        select 'healthcare.lab_results' as topic, cast(o_custkey % 4 as int) as prt, o_orderkey as off, cast({MESSAGE_DAY} as timestamp) as sent_at,
          concat('{{"source":"lab_device","event_id":"l', cast(o_orderkey as string), '","patient_id":"', cast(o_custkey as string),
            '","order_id":"o1', case when o_orderkey % 31 = 2 then '' else '","test_code":"c1' end, '","test_name":"n1","value_numeric":',
            case when o_orderkey % 31 = 1 then '"high"' else cast(o_orderkey % 90 as string) end,
            case when o_orderkey % 31 = 3 then ',"schema_version":"two"' else '' end,
            case when o_orderkey % 31 = 0 then ',"abnormal_flag":"Q"' when o_orderkey % 5 = 0 then ',"abnormal_flag":"HH"'
              when o_orderkey % 5 = 1 then ',"abnormal_flag":"LL"' when o_orderkey % 5 = 2 then ',"abnormal_flag":"AA"'
              when o_orderkey % 5 = 3 then ',"abnormal_flag":"N"' else '' end,
            ',"collected_at":"2024-01-01T00:00:00Z","resulted_at":"2024-01-01T01:00:00Z"}}') as value
        from orders""",
    "raw_telemetry": """
        select case when event_id % 31 = 4 then 'other.topic' else 'iot.telemetry' end as topic, cast(user_id % 6 as int) as prt, event_id as off,
          cast(ts as timestamp) as sent_at,
          concat('{"source":"iot","event_id":"t', cast(event_id as string), '","event_time":"', replace(substring(cast(ts as string), 1, 19), ' ', 'T'), 'Z",',
            case when event_id % 31 = 3 then '"patient_id":7' else concat('"patient_id":"', cast(user_id as string), '"') end,
            ',"device_id":"d', cast(user_id as string), '","device_type":"', case when event_id % 31 = 0 then 'toaster' else 'wearable' end,
            '","metrics":', case when event_id % 31 = 1 then '{"a":[1]}' else '{"heart_rate":70,"worn":true,"note":"x"}' end,
            ',"battery_pct":', case when event_id % 31 = 2 then '150' else cast(event_id % 101 as string) end, '}') as value
        from events""",
    "claim_forms": """
        select o_orderkey as doc_id, concat('EXPLANATION OF BENEFITS', chr(10), 'Claim ID: CLM', cast(o_orderkey as string), chr(10),
          'Member ID: MEM', cast(o_custkey as string), chr(10), 'Date of Service: ', cast(cast(o_orderdate as date) as string), chr(10),
          'Allowed Amount: $', cast(cast(o_totalprice as decimal(12,2)) as string), chr(10),
          'Plan: ', o_orderpriority, chr(10), 'Plan: ', o_orderstatus, chr(10), 'no separator here') as text
        from orders""",
    "form_blocks": """
        select l_orderkey as doc_id, 1 + l_linenumber % 2 as page_number, l_linenumber as line_number,
          concat(l_returnflag, cast(l_partkey as string)) as text,
          cast(72 + (l_partkey % 5) * 90 as double) as x0, cast(40 + l_linenumber * 60 as double) as y0,
          cast(72 + (l_partkey % 5) * 90 + 80 as double) as x1, cast(40 + l_linenumber * 60 + 14 as double) as y1
        from lineitem""",
    "scored": """
        select d.doc_id as row_id, l.quality as label,
          cast(cast(d.n_chars % 101 as decimal(18,6)) / cast(100 as decimal(18,6)) as double) as score
        from labels l join documents d on l.doc_id = d.doc_id""",
    "access_log": """
        select concat('a', cast(event_id as string)) as audit_id, cast(ts as timestamp) as ts,
          concat('actor', cast(user_id as string)) as actor_id,
          case event_id % 4 when 0 then 'read' when 1 then 'write' when 2 then 'export' else 'read' end as action,
          'table' as resource_type,
          case event_id % 3 when 0 then 'person' when 1 then 'visit' else 'vitals' end as resource_id,
          case event_id % 3 when 0 then 'person.mrn,person.birth_datetime' when 1 then 'visit.admit_time' else '' end as fields,
          'clinical_care' as purpose,
          case event_id % 10 when 0 then 'denied' else 'success' end as outcome,
          concat('{"partition":', cast(event_id % 6 as string), '}') as context
        from events""",
    "requests": """
        select event_id as request_id,
          case event_id % 8 when 0 then 'admin' when 1 then 'clinician' when 2 then 'data_scientist' when 3 then 'analyst'
            when 4 then 'service' when 5 then 'model' when 6 then 'viewer' else 'intern' end as role,
          case event_id % 5 when 0 then 'write' when 1 then 'export' else 'read' end as action,
          case event_id % 7 when 0 then 'model_training' when 1 then 'billing' when 2 then 'research_export' else 'clinical_care' end as purpose,
          case event_id % 4 when 0 then 'person.mrn,person.year_of_birth' when 1 then 'omcdm_visit_occurrence.visit_start_date,person.mrn'
            when 2 then 'mart_member_roster.state' else '' end as fields
        from events""",
    "device_readings": """
        select event_id, concat('d', cast(user_id as string)) as device_id, cast(user_id as string) as patient_id,
          cast(ts as timestamp) as ts,
          case event_id % 6 when 0 then 'wearable' when 1 then 'continuous_monitor' when 2 then 'smart_pill_bottle'
            when 3 then 'glucose_meter' when 4 then 'pulse_oximeter' else 'bp_cuff' end as device_type,
          concat('{"heart_rate":', cast(40 + event_id % 80 as string), ',"systolic":', cast(100 + event_id % 50 as string),
            ',"diastolic":', cast(60 + event_id % 30 as string), ',"note":"x', cast(event_id % 3 as string), '","worn":true}') as metrics
        from events""",
}


def load(spark: SparkSession, sf_dir: str, *names: str) -> tuple[DataFrame, ...]:
    """The named views (or driver tables) as DataFrames."""
    for table in TABLES:
        if any(re.search(rf"\b{table}\b", VIEWS.get(n, n)) for n in names):
            spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    out = tuple(spark.sql(VIEWS[n]) if n in VIEWS else spark.table(n) for n in names)
    return out


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load(spark, sf_dir, name)[0]


def with_views(sql: str, **extra: str) -> str:
    """Put the views (and ``extra`` CTEs) the query mentions in front of it."""
    known = {**VIEWS, **extra}
    wanted: list[str] = []

    def visit(text: str, own: str | None = None) -> None:
        for name, body in known.items():
            if name != own and name not in wanted and re.search(rf"\b{name}\b", text):
                visit(body, name)
                if name not in wanted:
                    wanted.append(name)

    visit(sql)
    ctes = [f"{name} as ({known[name]})" for name in wanted]
    if not ctes:
        return sql
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {', '.join(ctes)}, {body[5:]}"
    return f"with {', '.join(ctes)} {body}"


def exact_mean(total: str, n: str, places: int) -> str:
    """Oracle text for a half-up mean of a decimal total with 6 places, in integer arithmetic."""
    scaled = f"cast(({total}) * 1000000 as hugeint)"
    return (
        f"cast((2 * {scaled} * {10 ** places} + 1000000 * ({n})) // (2000000 * ({n})) as double) / {10 ** places}"
    )
