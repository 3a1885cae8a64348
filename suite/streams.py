"""Streaming, event and document queries with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelattice.functions import columns as c
from carelattice.functions.columns import as_of_date
from carelattice.ml import readmission
from carelattice.operators import documents
from carelattice.session import scratch_dir
from carelattice.streaming import silver, state, validate, windows
from suite import features as ft
from suite import warehouse as w
from suite.views import AS_OF, VIEWS, load, view, with_views


def as_messages(df):
    return df.select(
        "topic", F.col("prt").alias("partition"), F.col("off").alias("offset"),
        F.col("sent_at").alias("timestamp"), F.lit(None).cast("string").alias("key"), "value")


def messages(spark, sf):
    return as_messages(view(spark, sf, "raw_vitals"))


def message_stream(spark, sf, name="raw_vitals", table="events"):
    """The same messages as a stream over the table's file."""
    schema = spark.read.parquet(f"{sf}/{table}.parquet").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet").parquet(sf)
    source.createOrReplaceTempView(table)
    return spark.sql(VIEWS[name])


def people(spark, sf):
    """Known patients by their plain id."""
    (customer,) = load(spark, sf, "customer")
    return customer.select(
        F.col("c_custkey").alias("person_id"),
        F.when(F.col("c_custkey") % 2 == 0, 8507).otherwise(8532).alias("gender_concept_id"),
        (1940 + F.col("c_custkey") % 60).cast("int").alias("year_of_birth"))


def shown(events):
    e = F.col("_enrichment")
    return events.select(
        "topic", "partition", "offset", "event_id", "event_time", "source", "schema_version", "patient_id", "payload",
        e["known_patient"].alias("known_patient"), e["gender_concept_id"].alias("gender_concept_id"),
        e["year_of_birth"].alias("year_of_birth"))


def silver_batch(spark, sf):
    return shown(validate.enrich(validate.valid(validate.parse(messages(spark, sf))), people(spark, sf)))


def dlq_batch(spark, sf):
    return validate.to_dlq(validate.parse(messages(spark, sf))).drop("error_stack")


def landed(spark, sf):
    person = people(spark, sf)
    out = scratch_dir(spark, "silver")
    stream = as_messages(message_stream(spark, sf))
    silver.silver_job(stream, person, out, f"{out}/_checkpoint").awaitTermination()
    return out


def silver_stream(spark, sf):
    return shown(silver.read_silver(spark, landed(spark, sf)))


def dlq_stream(spark, sf):
    return silver.read_dlq(spark, landed(spark, sf)).drop("error_stack")


def valid_vitals(spark, sf):
    return validate.vitals_columns(validate.valid(validate.parse(messages(spark, sf))))


def vitals_window(spark, sf):
    return windows.vitals_window(valid_vitals(spark, sf), "24 hours", None, None)


def vitals_window_stream(spark, sf):
    """The window over a stream in update mode: the newest state of every window, open ones included."""
    out = scratch_dir(spark, "vitals")
    stream = validate.vitals_columns(validate.valid(validate.parse(as_messages(message_stream(spark, sf)))))
    query = (
        windows.vitals_window(stream, "24 hours", None, "1 hour").writeStream.foreachBatch(state.board_writer(f"{out}/t"))
        .option("checkpointLocation", f"{out}/c").outputMode("update").trigger(availableNow=True).start())
    query.awaitTermination()
    return state.current_boards(spark.read.parquet(f"{out}/t"), ["patient_id", "window_start"])


def dedup_stream(spark, sf):
    out = scratch_dir(spark, "dedup")
    stream = as_messages(message_stream(spark, sf))
    twice = stream.union(as_messages(message_stream(spark, sf)))
    kept = windows.dedup_stream(twice, ["topic", "partition", "offset"], "timestamp", "60 days")
    query = (
        kept.select("topic", "partition", "offset").writeStream.format("parquet").option("path", f"{out}/t")
        .option("checkpointLocation", f"{out}/c").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(f"{out}/t")


def alerts(spark, sf):
    found = validate.critical_alerts(validate.valid(validate.parse(messages(spark, sf))))
    return found.select("partition", "offset", "patient_id", "alert")


def late(spark, sf):
    """Readings with their lateness flag; the metric itself is observed by the job."""
    rows = view(spark, sf, "device_readings").withColumn("arrived", F.col("ts") + F.make_dt_interval(
        F.lit(0), F.lit(0), (F.col("event_id") % 90).cast("int")))
    seen = windows.observe_late(rows, "ts", "arrived", 3600)
    return seen.select("event_id", (F.unix_seconds("arrived") - F.unix_seconds("ts") > 3600).alias("is_late"))


def latest(spark, sf):
    return windows.latest_per_key(
        view(spark, sf, "device_readings").select("device_id", "ts", "event_id", "device_type"), ["device_id"], "ts", "event_id")


def sessions(spark, sf):
    return windows.device_sessions(view(spark, sf, "device_readings"), missed=50)


def device_metrics(spark, sf):
    rows = view(spark, sf, "device_readings").withColumn("m", F.from_json("metrics", "map<string,string>"))
    return rows.select(
        "event_id", c.device_metric("m", "heart_rate").alias("heart_rate"), c.device_metric("m", "note").alias("note"),
        c.pulse_pressure(c.device_metric("m", "systolic", "int"), c.device_metric("m", "diastolic", "int")).alias("pulse_pressure"),
        c.device_metric("m", "worn", "boolean").alias("worn"), c.json_field("metrics", "$.note").alias("note_text"))


def lab_flags(spark, sf):
    rows = w.measurement(spark, sf)
    value = F.col("value_as_number")
    flagged = rows.select("measurement_id", c.abnormal_flag(value, F.lit(40.0), F.lit(90.0)).alias("flag"))
    return flagged.withColumn("critical", c.critical_lab(F.col("flag")))


def concept_categories(spark, sf):
    return view(spark, sf, "conditions").join(
        spark.createDataFrame([(code, text) for code, text, *_ in w.seeds.hcc_rows()], "code string, name string"), "code", "left",
    ).groupBy(c.concept_category("name").alias("category")).agg(F.count(F.lit(1)).alias("n"))


def ages(spark, sf):
    born, day = F.col("birthdate").cast("date"), as_of_date(AS_OF)
    return view(spark, sf, "patients").select(
        "patient_id", *[c.age(born, day, m).alias(m) for m in ("boundary", "completed", "tenths", "rounded")])


def scored_admissions(spark, sf):
    """Admission messages, built from orders, scored against the feature snapshot."""
    features = ft.current_features(spark, sf)
    model, _ = ft.trained(spark, sf)
    (orders,) = load(spark, sf, "orders")
    body = F.to_json(F.struct(
        F.lit("ehr").alias("source"), c.surrogate_id(F.col("o_custkey")).cast("string").alias("patient_id"),
        F.col("o_orderkey").cast("string").alias("encounter_id"), F.lit("inpatient").alias("admission_type"),
        F.lit("fac").alias("facility_id"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("admit_time"),
        F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("discharge_time")))
    sent = orders.select(
        F.lit("healthcare.admissions").alias("topic"), F.lit(0).alias("partition"), F.col("o_orderkey").alias("offset"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"), F.lit(None).cast("string").alias("key"), body.alias("value"))
    events = validate.valid(validate.parse(sent))
    return ft.checked(silver.score_batch(events, features, model, as_of_date(AS_OF)))


def blocks(spark, sf):
    return view(spark, sf, "form_blocks")


def pages(spark, sf):
    return documents.pages_from_blocks(blocks(spark, sf))


REGIONS = [("top", 1, 0.0, 0.0, 300.0, 200.0), ("left", 2, 0.0, 100.0, 120.0, 400.0)]


def bbox(spark, sf):
    regions = spark.createDataFrame(REGIONS, "region string, page_number long, x double, y double, width double, height double")
    return documents.bbox_extract(blocks(spark, sf), regions)


QUERIES = {
    "silver_events": silver_batch,
    "dead_letters": dlq_batch,
    "silver_stream": silver_stream,
    "dead_letter_stream": dlq_stream,
    "vitals_window": vitals_window,
    "vitals_window_stream": vitals_window_stream,
    "dedup_stream": dedup_stream,
    "critical_alerts": alerts,
    "late_events": late,
    "latest_per_key": latest,
    "device_sessions": sessions,
    "device_metrics": device_metrics,
    "lab_flags": lab_flags,
    "concept_categories": concept_categories,
    "ages": ages,
    "scored_admissions": scored_admissions,
    "form_fields": lambda s, d: documents.extract_key_values(view(s, d, "claim_forms")),
    "typed_claims": lambda s, d: documents.typed_claim(view(s, d, "claim_forms")),
    "page_stats": lambda s, d: documents.page_stats_from_blocks(blocks(s, d)),
    "page_stats_nested": lambda s, d: documents.page_stats(pages(s, d)),
    "document_context": lambda s, d: documents.document_context(pages(s, d), "doc_id"),
    "bbox_extract": bbox,
}

VALID = "event_id % 29 > 4"
SILVER = f"""
    select topic, prt as partition, off as "offset", json_extract_string(value, '$.event_id') as event_id,
      coalesce(try_cast(replace(replace(json_extract_string(value, '$.event_time'), 'T', ' '), 'Z', '') as timestamp), sent_at) as event_time,
      json_extract_string(value, '$.source') as source, 1 as schema_version,
      json_extract_string(value, '$.patient_id') as patient_id, value as payload
    from raw_vitals where json_valid(value) and (json_extract(value, '$.heart_rate_bpm')::int between 20 and 300)
      and json_extract_string(value, '$.patient_id') is not null and json_extract(value, '$.colour') is null
      and json_extract_string(value, '$.source') in ('ehr', 'iot', 'lab_device', 'wearable', 'monitor', 'synthea', 'edge_gateway')"""
O_SILVER = """
    select s.*, c.c_custkey is not null as known_patient,
      case when c.c_custkey % 2 = 0 then 8507 when c.c_custkey is not null then 8532 end as gender_concept_id,
      cast(1940 + c.c_custkey % 60 as int) as year_of_birth
    from good s left join customer c on cast(c.c_custkey as varchar) = s.patient_id"""
O_DLQ = """
    select sha256(topic || '|' || prt || '|' || off) as dlq_id, sent_at as dlq_time, topic as source_topic,
      prt as source_partition, off as source_offset, value as original_payload, 'ValidationError' as error_type,
      case off % 29 when 0 then 'json decode failed' when 1 then 'heart_rate_bpm: not in 20..300' when 2 then 'colour: extra field'
        when 3 then 'source: not one of ehr, iot, lab_device, wearable, monitor, synthea, edge_gateway'
        else 'patient_id: field required' end as error_message, 'silver-job' as consumer_id
    from raw_vitals where off % 29 <= 4"""
WINDOWED = """
    select patient_id, date_trunc('day', event_time) as window_start, date_trunc('day', event_time) + interval 1 day as window_end,
      count(*) as readings, round(avg(json_extract(payload, '$.heart_rate_bpm')::int), 2) as mean_hr,
      round(avg(json_extract(payload, '$.spo2_pct')::double), 2) as mean_spo2,
      round(avg(json_extract(payload, '$.systolic_bp_mmHg')::int), 2) as mean_sbp
    from good group by 1, 2"""
GAP = "case device_type " + " ".join(f"when '{k}' then {v * 50}" for k, v in windows.CADENCE.items()) + " end"


def oracle(sql, **extra):
    return with_views(sql, good=SILVER, **w.OMOP_VIEWS, **extra)


PAGES = """select doc_id, page_number, string_agg(text, chr(10) order by line_number, text, x0, y0) as text, count(*) as n
    from form_blocks group by 1, 2"""

PAGE_STATS = """select doc_id, cast(count(*) as int) as total_pages, cast(sum(length(text)) as bigint) as total_chars,
    cast(sum(n) as bigint) as total_blocks from p group by 1"""

ORACLES = {
    "scored_admissions": oracle(f"""
        select {ft.PREDICTED} from (select distinct p.person_id from o_person p join orders o
          on p.person_source_value = cast(o.o_custkey as varchar) where o.o_orderkey % 2 = 0)"""),
    "silver_events": oracle(O_SILVER),
    "silver_stream": oracle(O_SILVER),
    "dead_letters": oracle(O_DLQ),
    "dead_letter_stream": oracle(O_DLQ),
    "vitals_window": oracle(WINDOWED),
    "vitals_window_stream": oracle(WINDOWED),
    "dedup_stream": oracle('select topic, prt as partition, off as "offset" from raw_vitals'),
    "critical_alerts": oracle("""
        select partition, "offset", patient_id, 'critical_vitals' as alert from good
        where json_extract(payload, '$.spo2_pct')::double < 90 or json_extract(payload, '$.heart_rate_bpm')::int < 40
          or json_extract(payload, '$.heart_rate_bpm')::int > 140 or json_extract(payload, '$.systolic_bp_mmHg')::int < 90"""),
    "late_events": oracle("select event_id, (event_id % 90) * 60 > 3600 as is_late from device_readings"),
    "latest_per_key": oracle("""
        select device_id, ts, event_id, device_type from device_readings
        qualify row_number() over (partition by device_id order by ts desc, event_id desc) = 1"""),
    "device_sessions": oracle(f"""
        with marked as (
          select *, {GAP} as gap, case when epoch(ts) < epoch(lag(ts) over o) + {GAP} then 0 else 1 end as fresh
          from device_readings window o as (partition by device_id, device_type order by ts)),
        numbered as (select *, sum(fresh) over (partition by device_id, device_type order by ts rows unbounded preceding) as s from marked)
        select device_id, device_type, min(ts) as session_start, max(ts) + to_seconds(any_value(gap)) as session_end, count(*) as readings
        from numbered group by device_id, device_type, s"""),
    "device_metrics": oracle("""
        select event_id, json_extract(metrics, '$.heart_rate')::double as heart_rate, cast(null as double) as note,
          json_extract(metrics, '$.systolic')::int - json_extract(metrics, '$.diastolic')::int as pulse_pressure,
          json_extract(metrics, '$.worn')::boolean as worn, json_extract_string(metrics, '$.note') as note_text from device_readings"""),
    "lab_flags": oracle("""
        select measurement_id, flag, coalesce(flag in ('LL', 'HH', 'AA'), false) as critical from (
          select measurement_id, case when value_as_number < 32 then 'LL' when value_as_number < 40 then 'L'
            when value_as_number > 117 then 'HH' when value_as_number > 90 then 'H' end as flag from o_measurement)"""),
    "concept_categories": oracle("""
        select case when code = 'E11.9' then 'endocrine' when code in ('I10', 'I50.9') then 'circulatory'
            when code in ('J44.0', 'J45.909') then 'respiratory' when code = 'J44.1' then 'other'
            when code = 'N18.3' then 'genitourinary' when code in ('F41.9', 'F32.9') then 'mental'
            when code in ('K21.0', 'K21.9', 'M54.5') then 'other' end as category, count(*) as n
        from conditions group by 1"""),
    "ages": oracle(f"""
        select patient_id, cast(year(d) - year(b) as int) as boundary, cast(year(d) - year(b) - case when strftime(d, '%m%d') < strftime(b, '%m%d') then 1 else 0 end as int) as completed,
          round((d - b) / 365.25, 1) as tenths, round_even((d - b) / 365.25, 0)::int as rounded
        from (select patient_id, birthdate::date as b, date '{AS_OF}' as d from patients)"""),
    "form_fields": oracle("""
        select doc_id, field, arg_max(value, i) as value from (
          select doc_id, trim(split_part(line, ':', 1)) as field, trim(regexp_replace(line, '^[^:]*:', '')) as value, i
          from (select doc_id, unnest(string_split(text, chr(10))) as line,
                  generate_subscripts(string_split(text, chr(10)), 1) as i from claim_forms)
          where contains(line, ':')) group by 1, 2"""),
    "typed_claims": oracle("""
        select o_orderkey as doc_id, 'CLM' || o_orderkey as claim_id, 'MEM' || o_custkey as member_id, o_orderdate::date as service_date,
          cast(null as varchar) as cpt_code, cast(null as decimal(12,2)) as billed_amount,
          cast(o_totalprice as decimal(12,2)) as allowed_amount, cast(null as decimal(12,2)) as paid_amount,
          cast(null as decimal(12,2)) as patient_amount from orders"""),
    "page_stats": oracle(PAGE_STATS, p=PAGES),
    "page_stats_nested": oracle(PAGE_STATS, p=PAGES),
    "document_context": oracle("""
        select doc_id, '# Document: ' || doc_id || chr(10) || 'Pages: ' || count(*) || ' | Chars: ' || sum(length(text))::bigint || chr(10) || chr(10)
          || string_agg('## Page ' || page_number || chr(10) || text || chr(10), chr(10) order by page_number) as context
        from p group by 1""", p=PAGES),
    "bbox_extract": oracle("""
        with r(region, page, x, y, w, h) as (values ('top', 1, 0.0, 0.0, 300.0, 200.0), ('left', 2, 0.0, 100.0, 120.0, 400.0))
        select doc_id, region, string_agg(text, ' ' order by line_number, text) as text
        from form_blocks join r on page_number = page and x0 < x + w and x1 > x and y0 < y + h and y1 > y group by 1, 2"""),
}
