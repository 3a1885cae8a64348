"""Claims playbook queries and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelattice.functions.columns import as_of_date
from carelattice.plans import playbook as p
from carelattice.plans.staging import member_months, stg_members
from carelattice.sources.seeds import ICD10_HCC, seed
from suite.views import AS_OF, exact_mean, load, with_views

DAY = as_of_date


def hcc_values() -> str:
    rows = [line.split(",") for line in ICD10_HCC.strip().splitlines()]
    values = ", ".join(f"('{c}', '{h}', cast({w} as decimal(10,4)))" for c, _, h, w, _ in rows)
    return f"select * from (values {values}) v(icd10_code, hcc_code, hcc_weight)"


def enrollment_spans(spark, sf):
    return p.enrollment_spans(*load(spark, sf, "segments"), DAY(AS_OF))


def claim_running(spark, sf):
    return p.claim_running(*load(spark, sf, "member_claims"))


def provider_metrics(spark, sf):
    return p.provider_metrics(*load(spark, sf, "claims", "providers"))


def provider_ranking(spark, sf):
    return p.provider_ranking(provider_metrics(spark, sf))


def readmissions(spark, sf):
    return p.readmissions(*load(spark, sf, "claims", "providers"), days=90, min_cases=10)


def all_members(spark, sf):
    """Every eligibility row; some members have two."""
    (rows,) = load(spark, sf, "eligibility")
    return rows.select(
        "mem_id", "row_key", F.expr("try_cast(dob as date)").alias("dob"), F.upper("plan_type").alias("plan_type"), "metal_level",
        F.expr("try_cast(effective_date as date)").alias("effective_date"),
        F.expr("try_cast(nullif(termination_date, 'Active') as date)").alias("termination_date"))


def hcc_risk_all_plans(spark, sf):
    claims, diagnoses = load(spark, sf, "member_claims", "diagnoses")
    rows = p.one_per_member(all_members(spark, sf), DAY("2000-09-01"))
    return p.hcc_risk(rows, claims, diagnoses, seed(spark, "icd10_codes"), DAY("2000-09-01"))


def pmpm_in_force(spark, sf):
    return p.pmpm_in_force(all_members(spark, sf), *load(spark, sf, "member_claims"))


def pmpm_by_enrolment_all_plans(spark, sf):
    (raw,) = load(spark, sf, "eligibility")
    return p.pmpm_by_enrolment(member_months(stg_members(raw), DAY(AS_OF), one_plan=True), *load(spark, sf, "member_claims"))


def stays_with_next(spark, sf):
    return p.stays_with_next(*load(spark, sf, "claims"))


QUERIES = {
    "enrollment_spans": enrollment_spans,
    "claim_running": claim_running,
    "hcc_risk": hcc_risk_all_plans,
    "hcc_risk_all_plans": hcc_risk_all_plans,
    "pmpm": pmpm_in_force,
    "pmpm_in_force": pmpm_in_force,
    "pmpm_by_enrolment_all_plans": pmpm_by_enrolment_all_plans,
    "pmpm_by_enrolment": pmpm_by_enrolment_all_plans,
    "provider_metrics": provider_metrics,
    "provider_ranking": provider_ranking,
    "readmissions": readmissions,
    "stays_with_next": stays_with_next,
}

METRICS = f"""select p.provider_npi, any_value(p.provider_name) provider_name, any_value(p.specialty) specialty,
    any_value(p.tier) tier, count(distinct c.claim_id) as total_claims, count(distinct c.mem_id) as unique_members,
    cast(sum(c.paid_amount) as decimal(28,6)) as total_paid, cast(sum(c.allowed_amount) as decimal(28,6)) as total_allowed,
    cast(sum(c.member_copay) as decimal(28,6)) as total_copay,
    {exact_mean('sum(c.paid_amount)', 'count(*)', 4)} as avg_paid_per_claim,
    {exact_mean('sum(c.allowed_amount)', 'count(*)', 4)} as avg_allowed_per_claim,
    {exact_mean('sum(c.allowed_amount)', 'count(distinct c.mem_id)', 2)} as cost_per_member
  from providers p join claims c on p.provider_npi = c.provider_npi group by p.provider_npi"""

ORACLES = {
    "enrollment_spans": with_views(f"""
        with marked as (
          select *, case when effective_date <= max(coalesce(termination_date, date '9999-12-31'))
              over (partition by mem_id, plan_type order by effective_date, segment_id
                    rows between unbounded preceding and 1 preceding) + 1 then 0 else 1 end as fresh
          from segments),
        islands as (
          select *, sum(fresh) over (partition by mem_id, plan_type order by effective_date, segment_id) as island
          from marked),
        spans as (
          select mem_id, plan_type, min(effective_date) as span_start,
            case when bool_or(termination_date is null) then null else max(termination_date) end as span_end,
            count(*) as coverage_segments
          from islands group by mem_id, plan_type, island)
        select mem_id, plan_type, span_start, span_end, coverage_segments,
          cast(coalesce(span_end, date '{AS_OF}') - span_start as int) as days_enrolled,
          case when span_end < date '{AS_OF}' then 'Terminated' else 'Active' end as status
        from spans"""),
    "claim_running": with_views(f"""
        select mem_id, claim_id, provider_npi, claim_date, service_type, allowed_amount, paid_amount, member_copay,
          cast(sum(paid_amount) over w as decimal(28,6)) as cumulative_paid,
          cast(sum(paid_amount) over (partition by mem_id order by claim_date, claim_id
               rows between 3 preceding and current row) as decimal(28,6)) as rolling_4_claim_paid,
          {exact_mean('sum(paid_amount) over w', 'count(*) over w', 4)} as avg_paid_to_date,
          row_number() over (partition by mem_id order by claim_date desc, claim_id desc) as claim_seq
        from member_claims
        window w as (partition by mem_id order by claim_date, claim_id
                     rows between unbounded preceding and current row)"""),
    "provider_metrics": with_views(METRICS),
    "provider_ranking": with_views("""
        with ranked as (
          select *, rank() over (partition by specialty order by total_paid desc) as cost_rank_in_specialty,
            rank() over (partition by tier order by total_paid desc) as cost_rank_in_tier from metrics)
        select provider_npi, provider_name, specialty, tier, total_claims, unique_members,
          round(total_paid, 2) as total_paid, cost_per_member, avg_paid_per_claim,
          cast(cost_rank_in_specialty as int) as cost_rank_in_specialty, cast(cost_rank_in_tier as int) as cost_rank_in_tier,
          case when cost_rank_in_specialty <= 3 then 'High-Cost Specialty' when tier = 3 then 'Out-of-Network'
            when cost_rank_in_tier <= 5 then 'High-Cost Tier' else 'Normal' end as flag
        from ranked where cost_rank_in_specialty <= 10 or cost_rank_in_tier <= 10""", metrics=METRICS),
    "readmissions": with_views(f"""
        with stays as (
          select c.*, p.facility_name, p.facility_state,
            lead(c.admit_date) over (partition by c.mem_id order by c.admit_date, c.claim_id) as next_admit
          from claims c join providers p on c.provider_npi = p.provider_npi where c.claim_type = 'inpatient'),
        flagged as (
          select *, case when next_admit is not null and next_admit - discharge_date <= 90 then 1 else 0 end as again
          from stays)
        select facility_name, facility_state, count(*) as total_discharges, cast(sum(again) as bigint) as readmissions,
          cast(round(sum(again) * 100.0 / count(*), 2) as double) as readmission_rate_pct,
          {exact_mean('sum(paid_amount)','count(*)',2)} as avg_admission_cost,
          case when sum(again) > 0 then {exact_mean('sum(case when again = 1 then paid_amount end)','sum(again)',2)} end as avg_readmission_cost
        from flagged group by 1, 2 having count(*) >= 10
        order by readmission_rate_pct desc, facility_name, facility_state limit 25"""),
    "stays_with_next": with_views("""
        select claim_id, mem_id, provider_npi, admit_date, discharge_date, primary_diagnosis, paid_amount,
          lead(admit_date) over w as next_admit_date, lead(primary_diagnosis) over w as next_primary_diagnosis
        from claims where claim_type = 'inpatient'
        window w as (partition by mem_id order by admit_date, claim_id)"""),
}

# The same queries over all eligibility rows, one plan for each member and month.
ALL_MEMBERS = """select mem_id, row_key, try_cast(dob as date) as dob, upper(plan_type) as plan_type, metal_level,
    try_cast(effective_date as date) as s, coalesce(try_cast(nullif(termination_date, 'Active') as date), date '9999-12-31') as e
    from eligibility"""
ORACLES |= {
    "hcc_risk_all_plans": with_views("""
        with one as (
          select mem_id, dob from all_members qualify row_number() over (partition by mem_id
            order by coalesce(s <= date '2000-09-01' and e >= date '2000-09-01', false) desc, s desc nulls last, row_key desc) = 1),
        codes as (
          select distinct c.mem_id, h.icd10_code, h.hcc_code, h.hcc_weight from member_claims c
            join diagnoses d on c.claim_id = d.claim_id join hcc h on d.icd10_code = h.icd10_code
          where c.claim_date >= date '1999-09-01'),
        risk as (
          select mem_id, dob, sum(hcc_weight) as weight, count(distinct hcc_code) as active_hcc_count,
            case when date_sub('month', dob, date '2000-09-01') < 45 * 12 then 1.0
                 when date_sub('month', dob, date '2000-09-01') < 65 * 12 then 1.4 else 2.0 end as factor
          from one join codes using (mem_id) group by mem_id, dob)
        select mem_id, dob, cast(weight as double) as total_hcc_weight, active_hcc_count,
          cast(factor as double) as demographic_factor,
          cast(round(weight * cast(factor as decimal(3,1)), 2) as double) as risk_score,
          case when round(weight * cast(factor as decimal(3,1)), 2) < 1 then 'Low'
               when round(weight * cast(factor as decimal(3,1)), 2) < 2 then 'Moderate'
               when round(weight * cast(factor as decimal(3,1)), 2) < 3 then 'High' else 'Very High' end as risk_category
        from risk order by risk_score desc, mem_id limit 100""", all_members=ALL_MEMBERS, hcc=hcc_values()),
    "pmpm_in_force": with_views(f"""
        with monthly as (
          select mem_id, date_trunc('month', claim_date)::date as claim_month, sum(paid_amount) as paid,
            sum(allowed_amount) as allowed, sum(member_copay) as copay from member_claims group by all),
        planned as (
          select m.*, p.plan_type, p.metal_level from monthly m left join all_members p
            on m.mem_id = p.mem_id and p.s <= last_day(m.claim_month) and p.e >= m.claim_month
          qualify row_number() over (partition by m.mem_id, m.claim_month order by p.s desc, p.row_key desc) = 1),
        cells as (
          select claim_month, plan_type, metal_level, count(*) as member_count, cast(sum(paid) as decimal(28,6)) as total_paid,
            cast(sum(allowed) as decimal(28,6)) as total_allowed, cast(sum(copay) as decimal(28,6)) as total_copay
          from planned group by all),
        priced as (
          select *, {exact_mean('total_paid','member_count',2)} as pmpm_paid,
            {exact_mean('total_allowed','member_count',2)} as pmpm_allowed from cells)
        select claim_month, plan_type, metal_level, member_count, total_paid, total_allowed,
          total_copay, pmpm_paid, pmpm_allowed, lag(pmpm_paid) over w as prev_month_pmpm,
          round((pmpm_paid - lag(pmpm_paid) over w) / nullif(lag(pmpm_paid) over w, 0) * 100, 1) + 0.0 as mom_change_pct
        from priced window w as (partition by plan_type, metal_level order by claim_month)""", all_members=ALL_MEMBERS),
    "pmpm_by_enrolment_all_plans": with_views(f"""
        with covered as (
          select *, unnest(generate_series(date_trunc('month', s)::date,
              date_trunc('month', case when e = date '9999-12-31' then date '{AS_OF}' else e end)::date,
              interval 1 month))::date as coverage_month
          from all_members where e >= date '{AS_OF}'),
        one as (
          select * from covered qualify row_number() over (partition by mem_id, coverage_month
            order by s desc, plan_type desc, metal_level desc) = 1),
        monthly as (
          select mem_id, date_trunc('month', claim_date)::date as coverage_month, sum(paid_amount) as paid
          from member_claims group by all)
        select coverage_month, plan_type, metal_level, count(*) as member_months,
          {exact_mean('coalesce(sum(paid), 0)', 'count(*)', 2)} as pmpm_paid
        from one left join monthly using (mem_id, coverage_month) group by 1, 2, 3""", all_members=ALL_MEMBERS),
}
for _name, _full in {"hcc_risk": "hcc_risk_all_plans", "pmpm": "pmpm_in_force", "pmpm_by_enrolment": "pmpm_by_enrolment_all_plans"}.items():
    ORACLES[_name] = ORACLES[_full]
