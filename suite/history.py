"""Profiles from stored history, and documents in chunks: queries and oracles."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from carelattice.functions.columns import as_of_date
from carelattice.operators import documents, history, quality
from carelattice.session import scratch_dir
from suite import warehouse as w
from suite.views import AS_OF, view

oracle = w.oracle
DAYS = ["1997-01-01", "1997-06-01", "1997-12-01", AS_OF]
PROFILED = [("mem_id", "string"), ("row_key", "bigint"), ("dob", "string"), ("email", "string"),
            ("phone", "string"), ("zip_code", "string"), ("state", "string")]
CHUNK = 50


def day(text):
    return datetime.date.fromisoformat(text)


def profile(spark, sf):
    """Sketched by state, merged over the states; distinct counts exact, and whether their estimates lie within 2 %."""
    rows = view(spark, sf, "eligibility").select(*[c for c, _ in PROFILED])
    merged = history.merged(history.sketch(rows, F.col("state"))).withColumnRenamed("distinct_count", "estimate")
    both = merged.join(history.distinct_counts(rows), "column_name")
    fits = F.abs(F.col("estimate") - F.col("distinct_count")) <= 0.02 * F.col("distinct_count")
    return both.select(
        "column_name", "data_type", "row_count", "null_count", "empty_count", "distinct_count", fits.alias("estimate_fits"),
        "min_value", "max_value", F.round("mean", 4).alias("mean_value"), F.round("std", 4).alias("std"), "q25", "q50", "q75")


def stored(spark, sf, *tables, days=DAYS):
    """Tables as they stood on some days; the first day is stored twice, with later rows the first time."""
    path = scratch_dir(spark, "history")
    for table in tables:
        if table == "claims":
            rows, ts, part = view(spark, sf, "claims").select("claim_id", "claim_date", "claim_type", "allowed_amount"), "claim_date", F.col("claim_type")
        else:
            rows, ts, part = w.condition(spark, sf).select("condition_occurrence_id", "condition_start_datetime"), "condition_start_datetime", None
        for until, text in [(days[-1], days[0]), *[(d, d) for d in days]]:
            history.store(history.sketch(rows.filter(F.col(ts) < F.lit(day(until))), part), path, table, day(text))
    return path


def volume_by_day(spark, sf):
    return history.volume_history(history.read(spark, stored(spark, sf, "claims", "omop_condition", days=DAYS[1:]))).withColumn("change", F.round("change", 8))


def profile_by_day(spark, sf):
    """Claims per day and claim type, from storage alone."""
    rows = history.merged(history.read(spark, stored(spark, sf, "claims"), "claims", last=day(DAYS[2])), ["day", "part"])
    return rows.filter("column_name in ('allowed_amount', 'claim_date')").select(
        "day", "part", "column_name", "row_count", "null_count", "min_value", "max_value", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


def freshness_and_volume(spark, sf):
    """The table as it is against the newest stored day before it."""
    conditions = w.condition(spark, sf)
    past = history.volume_history(history.read(spark, stored(spark, sf, "omop_condition", days=DAYS[1:3]), "omop_condition", last=day(DAYS[2])))
    previous = past.agg(F.max_by("row_count", "day")).scalar()
    return quality.suite(
        quality.freshness(conditions, "omop_condition", "condition_start_datetime", as_of_date(AS_OF), 24),
        quality.volume(conditions, "omop_condition", previous_rows=previous))


def blocks(spark, sf):
    return view(spark, sf, "form_blocks")


def context_chunks(spark, sf):
    return documents.context_chunks(blocks(spark, sf), limit=CHUNK)


def context_from_chunks(spark, sf):
    """Chunks put together again."""
    chunks = F.array_sort(F.collect_list(F.struct("chunk", "text")))
    return context_chunks(spark, sf).groupBy("doc_id").agg(
        F.array_join(F.transform(chunks, lambda c: c["text"]), "").alias("context"))


QUERIES = {
    "column_profile": profile,
    "volume_by_day": volume_by_day,
    "profile_by_day": profile_by_day,
    "freshness_and_volume": freshness_and_volume,
    "context_chunks": context_chunks,
    "context_from_chunks": context_from_chunks,
}

PROFILE = " union all ".join(
    f"""select count(*) as row_count, '{c}' as column_name, '{t}' as data_type,
        count(*) filter (where {c} is null) as null_count, count(*) filter (where cast({c} as varchar) = '') as empty_count,
        count(distinct {c}) as distinct_count, true as estimate_fits, cast(min({c}) as varchar) as min_value, cast(max({c}) as varchar) as max_value,
        """ + (f"""round(avg({c}), 4) as mean_value, round(stddev_samp({c}), 4) as std, quantile_disc({c}, 0.25)::double as q25,
        quantile_disc({c}, 0.5)::double as q50, quantile_disc({c}, 0.75)::double as q75""" if t == "bigint" else
               "null::double as mean_value, null::double as std, null::double as q25, null::double as q50, null::double as q75")
    + " from eligibility" for c, t in PROFILED)
KNOWN_DAYS = ", ".join(f"(date '{d}')" for d in DAYS)
LATER_DAYS = ", ".join(f"(date '{d}')" for d in DAYS[1:])
VOLUMES = f"""select 'claims' as table_name, day, count(claim_id) as row_count from (values {LATER_DAYS}) v(day)
    left join claims on claim_date < day group by 2
  union all select 'omop_condition', day, count(condition_occurrence_id) from (values {LATER_DAYS}) v(day)
    left join o_condition on condition_start_datetime < day group by 2"""
BEFORE = f"(select count(*) from o_condition where condition_start_datetime < date '{DAYS[2]}')"
GOOD = f"count(*) between 100 and 10000000 and coalesce(count(*)::double / nullif({BEFORE}, 0) - 1 between -0.10 and 0.25, true)"
STALE = f"max(condition_start_datetime) < date '{AS_OF}' - interval 24 hour"
BY_DAY = f"""select day, claim_type as part, '{{c}}' as column_name, count(*) as row_count, count(*) filter (where {{c}} is null) as null_count,
    cast(min({{c}}) as varchar) as min_value, cast(max({{c}}) as varchar) as max_value, {{mean}} as mean, {{std}} as std
  from (values {KNOWN_DAYS}) v(day) join claims on claim_date < day where day <= date '{DAYS[2]}' group by 1, 2"""
PIECES = f"""lines as (select doc_id, page_number, line_number, coalesce(text, '') as text,
    lag(page_number) over o as before, lead(page_number) over o as after, row_number() over o as pos from form_blocks
    window o as (partition by doc_id order by page_number, line_number, text)),
  pieces as (
    select doc_id, pos, page_number, case when before is null then '## Page ' || page_number || chr(10)
        when before <> page_number then chr(10) || '## Page ' || page_number || chr(10) else chr(10) end
      || text || case when after = page_number then '' else chr(10) end as text from lines
    union all select doc_id, 0, null, '# Document: ' || doc_id || chr(10) || 'Pages: ' || count(distinct page_number) || ' | Chars: '
      || (sum(length(text)) + count(*) - count(distinct page_number))::bigint || chr(10) || chr(10) from lines group by 1),
  cuts as (select *, (coalesce(sum(length(text)) over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding), 0)::bigint
    // {CHUNK}) as cut from pieces),
  joined as (select doc_id, cut, string_agg(text, '' order by pos) as text, min(page_number) as first_page, max(page_number) as last_page
    from cuts group by 1, 2)"""

ORACLES = {
    "column_profile": oracle(PROFILE),
    "volume_by_day": oracle(f"""
        with days as ({VOLUMES}), steps as (select *, lag(row_count) over (partition by table_name order by day) as previous_rows from days)
        select *, round(row_count::double / nullif(previous_rows, 0) - 1, 8) as change from steps"""),
    "profile_by_day": oracle(
        BY_DAY.format(c="allowed_amount", mean="round(avg(allowed_amount::double), 4)", std="round(stddev_samp(allowed_amount::double), 4)")
        + " union all " + BY_DAY.format(c="claim_date", mean="null::double", std="null::double")),
    "freshness_and_volume": oracle(f"""
        select 'freshness_condition_start_datetime' as check_id, 'omop_condition' as table_name, 'condition_start_datetime' as column_name,
          'error' as severity, case when {STALE} then count(*) else 0 end as failed_rows, count(*) as total_rows, not {STALE} as passed from o_condition
        union all
        select 'volume', 'omop_condition', '*', 'error', case when {GOOD} then 0 else count(*) end, count(*), {GOOD} from o_condition"""),
    "context_chunks": oracle(f"""
        with {PIECES} select doc_id, (row_number() over (partition by doc_id order by cut))::int as chunk, first_page, last_page, text from joined"""),
    "context_from_chunks": oracle(f"""
        with {PIECES} select doc_id, string_agg(text, '' order by cut) as context from joined group by 1"""),
}
