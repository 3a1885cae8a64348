"""Cohorts, patient summaries, counts, anomalies: queries and oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelattice.functions.columns import as_of_date, surrogate_id
from carelattice.operators import aggregates, anomaly, joins, population
from carelattice.operators.windows import pct_of_total, top_k_per_group
from carelattice.plans import marts
from carelattice.session import materialise
from carelattice.sources.tables import table_counts
from suite import warehouse as w
from suite.views import AS_OF, load, view

oracle = w.oracle


def DAY():
    return as_of_date(AS_OF)


def cohort(spark, sf):
    drug = materialise(w.drug(spark, sf), "drug")  # read by three of the conditions
    tables = {
        "person": w.person(spark, sf), "condition": w.condition(spark, sf), "drug": drug,
        "visit": w.visit(spark, sf), "adherence": marts.medication_adherence(drug),
    }
    return population.cohort(
        tables, DAY(), min_age=18, max_age=80, ccs_categories=["circulatory", "endocrine"],
        drug_classes=["rxcui_numeric"], adherence_categories=["non_adherent"], min_visits=5, min_drugs=3)


def cohort_vitals(spark, sf):
    tables = {"person": w.person(spark, sf), "measurement": w.measurement(spark, sf)}
    return population.cohort(
        tables, DAY(), gender_concept_id=8532, measurement_categories=["vitals_hr"], min_measurements=10)


def cohort_state(spark, sf):
    members = view(spark, sf, "eligibility").select(
        F.expr("cast(row_key as string)").alias("member_id"), "state")
    tables = {"person": w.person(spark, sf), "roster": members, "adherence": w.adherence(spark, sf)}
    return population.cohort_size(population.cohort(tables, DAY(), states=["NY", "TX"], min_pdc=0.5))


def vitals(spark, sf):
    """Readings from the event table in the silver layout."""
    events = load(spark, sf, "events")[0]
    return events.select(
        surrogate_id(F.col("user_id")).alias("person_id"),
        F.col("ts").cast("timestamp").alias("event_time"), F.col("event_id").alias("offset"),
        (30 + F.col("event_id") % 130).alias("heart_rate_bpm"), (82 + F.col("event_id") % 19).alias("spo2_pct"),
        (80 + F.col("event_id") % 90).alias("systolic_bp_mmHg"), F.lit("monitor").alias("source"),
    )


def patient_360(spark, sf):
    full = population.patient_360(
        w.person(spark, sf), w.condition(spark, sf), w.visit(spark, sf), vitals(spark, sf), as_of=DAY())
    text = lambda name, field: F.array_join(F.transform(name, lambda r: r[field].cast("string")), ",")
    return full.select(
        "person_id", "person_source_value", "gender_concept_id", "year_of_birth", "age",
        F.size("conditions").alias("condition_count"), text("conditions", "condition_concept_id").alias("conditions"),
        F.size("visits").alias("visit_count"), text("visits", "visit_occurrence_id").alias("visits"),
        F.size("recent_vitals").alias("vital_count"), text("recent_vitals", "heart_rate_bpm").alias("heart_rates"),
    )


def claims(spark, sf):
    return view(spark, sf, "member_claims")


def zscore(spark, sf):
    flagged = anomaly.zscore_flag(claims(spark, sf).select("claim_id", "paid_amount"), "paid_amount", 1.5)
    return flagged.withColumn("z_score", F.round("z_score", 6))


def iqr(spark, sf):
    return anomaly.iqr_flag(claims(spark, sf).select("claim_id", "paid_amount"), "paid_amount", 0.5)


def member_features(spark, sf):
    rows = anomaly.member_claim_features(claims(spark, sf))
    return rows.select("mem_id", "claim_count", *[
        F.round(c, 4).alias(c) for c in ("total_paid", "avg_paid", "std_paid", "avg_copay_ratio")])


def risk_report(spark, sf):
    rows = anomaly.risk_report(claims(spark, sf), forest=False)
    return rows.select("mem_id", "claim_count", "utilization_flag", "z_member", "risk_score", "risk_tier")


def quantiles(spark, sf):
    row = aggregates.exact_quantiles(claims(spark, sf), "paid_amount", [0.05, 0.25, 0.5, 0.75, 0.95])
    return row.select(*[F.round(c, 6).alias(c) for c in row.columns])


def pipeline_counts(spark, sf):
    return table_counts({
        "person": w.person(spark, sf), "visit": w.visit(spark, sf), "condition": w.condition(spark, sf),
        "drug": w.drug(spark, sf), "predictions": None,
    })


def isolation_forest(spark, sf):
    features = anomaly.member_claim_features(claims(spark, sf))
    rows = anomaly.isolation_forest(features, "mem_id")
    share = rows.agg(F.avg("anomaly_label")).scalar()
    lowest = rows.where("anomaly_label = 1").agg(F.min("anomaly_score")).scalar()
    highest = rows.where("anomaly_label = 0").agg(F.max("anomaly_score")).scalar()
    return rows.select(
        "mem_id", F.col("anomaly_score").between(0.0, 1.0).alias("score_in_range"),
        share.between(0.0, 0.06).alias("share_fits"), (highest <= lowest).alias("labels_follow_scores"))


def flagged_claims(spark, sf):
    rows = claims(spark, sf)
    return anomaly.flagged_claims(rows, anomaly.risk_report(rows, forest=False)).select(
        "claim_id", "mem_id", "z_flag", "iqr_flag", "utilization_flag")


def repeated_amount(spark, sf):
    rows = view(spark, sf, "claims").withColumn("paid_amount", (F.floor(F.col("paid_amount") / 20000) * 20000).cast("long"))
    return anomaly.repeated_amount(rows, at_least=10)


def stats(spark, sf):
    return aggregates.global_stats(claims(spark, sf), "paid_amount").select(
        "n", *[F.round(c, 4).alias(c) for c in ("mean", "std_pop", "std_samp")])


QUERIES = {
    "cohort": cohort,
    "cohort_by_measurements": cohort_vitals,
    "cohort_size_by_state": cohort_state,
    "patient_360": patient_360,
    "pipeline_counts": pipeline_counts,
    "histogram": lambda s, d: aggregates.histogram(claims(s, d), "paid_amount", 0, 400000, 20, ["service_type"]),
    "claim_rates": lambda s, d: aggregates.rate(claims(s, d), ["service_type"], F.col("paid_amount") > 200000),
    "suppressed_counts": lambda s, d: aggregates.low_count_suppress(
        aggregates.value_counts(claims(s, d), "mem_id"), "n", 15),
    "average_where": lambda s, d: claims(s, d).groupBy("service_type").agg(
        F.round(aggregates.avg_where(F.col("paid_amount").cast("double"), F.col("paid_amount") > 200000), 4)
        .alias("avg_large_paid")),
    "top_claims_per_member": lambda s, d: top_k_per_group(
        claims(s, d), ["mem_id"], [F.col("paid_amount").desc(), F.col("claim_id")], 3, rank="rank"),
    "share_of_total": lambda s, d: pct_of_total(
        claims(s, d).groupBy("service_type").agg(F.sum("paid_amount").cast("double").alias("paid")), "paid", "pct")
        .withColumn("pct", F.round("pct", 6)),
    "orphan_events": lambda s, d: joins.orphans(
        load(s, d, "events")[0].select("event_id", F.col("user_id").alias("o_custkey")),
        load(s, d, "orders")[0].select("o_custkey"), "o_custkey"),
    "orphan_events_planted": lambda s, d: joins.orphans(
        load(s, d, "events")[0].select("event_id", F.when(F.col("event_id") % 7 == 0, -1 - F.col("event_id"))
                                       .otherwise(F.col("user_id")).alias("o_custkey")),
        load(s, d, "orders")[0].select("o_custkey"), "o_custkey"),
    "flagged_members": lambda s, d: joins.flag_member_of(
        view(s, d, "eligibility").select("mem_id", "row_key"),
        claims(s, d).filter("paid_amount > 390000"), "mem_id", "has_large_claim"),
    "zscore_flag": zscore,
    "iqr_flag": iqr,
    "exact_quantiles": quantiles,
    "global_stats": stats,
    "member_claim_features": member_features,
    "risk_report": risk_report,
    "flagged_claims": flagged_claims,
    "repeated_amount": repeated_amount,
    "isolation_forest": isolation_forest,
}

ADHERED = w.ADHERENCE.strip()
TOTALS = w.TOTALS.format(days=w.SUM_DAYS)
ZSTATS = "select avg(paid_amount::double) as m, stddev_pop(paid_amount::double) as s from member_claims"
QUART = """select quantile_cont(paid_amount::double, 0.25) as q1, quantile_cont(paid_amount::double, 0.75) as q3
    from member_claims"""
RISK = """select mem_id, count(*) as claim_count,
    max(case when abs(paid_amount::double - m) / s > 3 then 1 else 0 end) as z_member
  from member_claims, zstats group by 1"""
REPORT = """select mem_id, claim_count, utilization_flag, z_member, utilization_flag + z_member as risk_score,
    case utilization_flag + z_member when 0 then 'Normal' when 1 then 'Monitor' when 2 then 'Elevated' else 'Critical' end
      as risk_tier
  from (select *, case when claim_count > (select avg(claim_count) + 2.5 * stddev_samp(claim_count) from risk)
          then 1 else 0 end as utilization_flag from risk)"""
NEWEST = """(select {key}, string_agg({value}, ',' order by rn) as list, count(*) as n from (
    select {key}, {value}, row_number() over (partition by {key} order by {order}) as rn from {table}) where rn <= {k} group by 1)"""

ORACLES = {
    "isolation_forest": oracle("""
        select distinct mem_id, true as score_in_range, true as share_fits, true as labels_follow_scores from member_claims"""),
    "cohort": oracle(f"""
        select person_id, year_of_birth, gender_concept_id from o_person p
        where year_of_birth <= year(date '{AS_OF}') - 18 and year_of_birth >= year(date '{AS_OF}') - 80
          and exists (select 1 from o_condition c where c.person_id = p.person_id and c.ccs_category in ('circulatory', 'endocrine'))
          and exists (select 1 from o_drug d where d.person_id = p.person_id and d.drug_code_type in ('rxcui_numeric'))
          and exists (select 1 from adhered a where a.person_id = p.person_id and a.adherence_category in ('non_adherent'))
          and (select count(*) from o_visit v where v.person_id = p.person_id) >= 5
          and (select count(*) from o_drug d where d.person_id = p.person_id) >= 3""", adhered=ADHERED, totals=TOTALS),
    "cohort_by_measurements": oracle("""
        select person_id, year_of_birth, gender_concept_id from o_person p where gender_concept_id = 8532
          and exists (select 1 from o_measurement m where m.person_id = p.person_id and m.measurement_category = 'vitals_hr')
          and (select count(*) from o_measurement m where m.person_id = p.person_id) >= 10"""),
    "cohort_size_by_state": oracle("""
        select count(distinct person_id) as cohort_size from o_person p
        where exists (select 1 from adhered a where a.person_id = p.person_id and a.pdc_score >= 0.5)
          and exists (select 1 from eligibility e where cast(e.row_key as varchar) = p.person_source_value
                      and e.state in ('NY', 'TX'))""", adhered=ADHERED, totals=TOTALS),
    "patient_360": oracle(f"""
        select p.person_id, person_source_value, gender_concept_id, year_of_birth,
          cast(year(date '{AS_OF}') - year_of_birth as int) as age,
          cast(coalesce(c.n, 0) as int) as condition_count, coalesce(c.list, '') as conditions,
          cast(coalesce(v.n, 0) as int) as visit_count, coalesce(v.list, '') as visits,
          cast(coalesce(t.n, 0) as int) as vital_count, coalesce(t.list, '') as heart_rates
        from o_person p
          left join {NEWEST.format(key='person_id', value='condition_concept_id', table='o_condition', k=20,
                                   order='condition_start_datetime desc, condition_occurrence_id')} c on p.person_id = c.person_id
          left join {NEWEST.format(key='person_id', value='visit_occurrence_id', table='o_visit', k=10,
                                   order='visit_start_datetime desc, visit_occurrence_id')} v on p.person_id = v.person_id
          left join {NEWEST.format(key='user_id', value='hr', table='(select user_id, 30 + event_id % 130 as hr, ts, event_id from events)', k=20,
                                   order='ts desc, event_id')} t on p.person_source_value = cast(t.user_id as varchar)"""),
    "pipeline_counts": oracle("""
        select 'person' as table_name, count(*) as row_count from patients union all select 'visit', count(*) from encounters
        union all select 'condition', count(*) from conditions
        union all select 'drug', count(*) from medications where code <> '' union all select 'predictions', 0"""),
    "histogram": oracle("""
        select service_type, least(floor((paid_amount - 0) / 400000 * 20)::int + 1, 20) as bin, count(*) as n
        from member_claims where paid_amount between 0 and 400000 group by 1, 2"""),
    "claim_rates": oracle("""
        select service_type, count(*) as n,
          round(count(*) filter (where paid_amount > 200000) * 100.0::double / count(*), 4) as rate_pct
        from member_claims group by 1"""),
    "suppressed_counts": oracle("select mem_id, count(*) as n from member_claims group by 1 having count(*) >= 15"),
    "average_where": oracle("""
        select service_type, round(avg(paid_amount::double) filter (where paid_amount > 200000), 4) as avg_large_paid
        from member_claims group by 1"""),
    "top_claims_per_member": oracle("""
        select *, cast(row_number() over (partition by mem_id order by paid_amount desc, claim_id) as int) as rank
        from member_claims qualify rank <= 3"""),
    "share_of_total": oracle("""
        select service_type, sum(paid_amount)::double as paid,
          round(sum(paid_amount)::double / (select sum(paid_amount)::double from member_claims) * 100, 6) as pct
        from member_claims group by 1"""),
    "orphan_events": oracle("""
        select event_id, user_id as o_custkey from events
        where user_id not in (select o_custkey from orders)"""),
    "orphan_events_planted": oracle("""
        with planted as (select event_id, case when event_id % 7 = 0 then -1 - event_id else user_id end as o_custkey from events)
        select event_id, o_custkey from planted where o_custkey not in (select o_custkey from orders)"""),
    "flagged_members": oracle("""
        select mem_id, row_key, case when mem_id in (select mem_id from member_claims where paid_amount > 390000)
          then 1 else 0 end as has_large_claim from eligibility"""),
    "zscore_flag": oracle("""
        select claim_id, paid_amount, round(abs((paid_amount::double - m) / s), 6) as z_score,
          case when abs((paid_amount::double - m) / s) > 1.5 then 1 else 0 end as z_flag
        from member_claims, zstats""", zstats=ZSTATS),
    "iqr_flag": oracle("""
        select claim_id, paid_amount, case when paid_amount::double < q1 - 0.5 * (q3 - q1)
          or paid_amount::double > q3 + 0.5 * (q3 - q1) then 1 else 0 end as iqr_flag
        from member_claims, quart""", quart=QUART),
    "exact_quantiles": oracle("select " + ", ".join(
        f"round(quantile_cont(paid_amount::double, {q}), 6) as q{i}" for i, q in enumerate([0.05, 0.25, 0.5, 0.75, 0.95]))
        + " from member_claims"),
    "global_stats": oracle("""
        select count(*) as n, round(avg(paid_amount::double), 4) as mean, round(stddev_pop(paid_amount::double), 4) as std_pop,
          round(stddev_samp(paid_amount::double), 4) as std_samp from member_claims"""),
    "member_claim_features": oracle("""
        select mem_id, count(claim_id) as claim_count, round(sum(paid_amount)::double, 4) as total_paid,
          round(avg(paid_amount::double), 4) as avg_paid, round(coalesce(stddev_samp(paid_amount::double), 0), 4) as std_paid,
          round(avg(member_copay::double / allowed_amount::double), 4) as avg_copay_ratio
        from member_claims group by 1"""),
    "risk_report": oracle("select * from report", report=REPORT, risk=RISK, zstats=ZSTATS),
    "flagged_claims": oracle("""
        with marked as (
          select claim_id, c.mem_id, case when abs((paid_amount::double - m) / s) > 3 then 1 else 0 end as z_flag,
            case when paid_amount::double < q1 - 1.5 * (q3 - q1) or paid_amount::double > q3 + 1.5 * (q3 - q1)
              then 1 else 0 end as iqr_flag, r.utilization_flag
          from member_claims c join report r on c.mem_id = r.mem_id, zstats, quart)
        select * from marked where z_flag + iqr_flag + utilization_flag > 0""",
        report=REPORT, risk=RISK, zstats=ZSTATS, quart=QUART),
    "repeated_amount": oracle("""
        select provider_npi, cast(floor(paid_amount / 20000) * 20000 as bigint) as paid_amount, count(*) as times
        from claims group by 1, 2 having count(*) >= 10"""),
}
