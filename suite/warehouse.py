"""Staging, OMOP, second mapping and marts: queries and oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelattice.functions.columns import as_of_date
from carelattice.operators import joins, windows
from carelattice.plans import marts, omop, staging, synthea
from carelattice.sources import seeds, tables
from suite.views import AS_OF, exact_mean, load, with_views

def DAY():
    return as_of_date(AS_OF)


def sid(*parts: str) -> str:
    """Oracle text of a surrogate id."""
    text = " || '|' || ".join(f"coalesce(cast({p} as varchar), '')" for p in parts)
    return f"('0x' || substr(sha256({text}), 1, 15))::bigint"


def prefix_values() -> str:
    values = ", ".join(f"('{p}', '{c}')" for p, c in seeds.prefix_categories())
    return f"select * from (values {values}) v(prefix, category)"


def concept_values() -> str:
    values = ", ".join(f"('{c}', {a}, {b})" for c, a, b in seeds.concept_rows())
    return f"select * from (values {values}) v(code, concept, source_concept)"


CCS = """coalesce((select arg_max(p.category, length(p.prefix)) from prefixes p
    where starts_with({}, p.prefix)), 'unmapped')"""

O_STAGED = f"""select mem_id as member_id, first_name, last_name, try_cast(dob as date) as date_of_birth, email, phone,
    address, city, state, lpad(trim(zip_code), 5, '0') as zip_code, effective_date::date as coverage_effective_date,
    nullif(termination_date, 'Active')::date as coverage_termination_date, covered_relation as relationship,
    upper(plan_type) as plan_type, metal_level, hsa_eligible = 'Yes' as hsa_eligible from eligibility"""
O_PERSON = f"""select {sid('patient_id')} as person_id, patient_id as person_source_value,
    case upper(gender) when 'M' then 8507 when 'F' then 8532 else 0 end as gender_concept_id,
    upper(gender) as gender_source_value, birthdate::date as birth_datetime,
    year(birthdate::date)::int as year_of_birth, month(birthdate::date)::int as month_of_birth,
    day(birthdate::date)::int as day_of_birth, 0 as race_concept_id, 0 as ethnicity_concept_id from patients"""
O_VISIT = f"""select {sid('encounter_id')} as visit_occurrence_id, {sid('patient_id')} as person_id,
    case upper(encounterclass) when 'INPATIENT' then 9201 when 'OUTPATIENT' then 9202 when 'EMERGENCY' then 9203
      when 'AMBULATORY' then 9202 when 'WELLNESS' then 9202 else 0 end as visit_concept_id,
    "start"::date as visit_start_date, "start"::timestamp as visit_start_datetime, stop::date as visit_end_date,
    stop::timestamp as visit_end_datetime, 32827 as visit_type_concept_id, encounter_id as visit_source_value,
    encounterclass as visit_source_label, description as visit_source_description from encounters"""
O_CONDITION = f"""select {sid('patient_id', 'd', 'code', 'n')} as condition_occurrence_id, {sid('patient_id')} as person_id,
    {sid('code')} as condition_concept_id, d as condition_start_date, d::timestamp as condition_start_datetime,
    nullif(stop, '')::date as condition_end_date, nullif(stop, '')::date::timestamp as condition_end_datetime,
    32827 as condition_type_concept_id, code as condition_source_value, description as condition_source_label,
    {CCS.format('code')} as ccs_category
  from (select *, "start"::date as d, row_number() over (partition by patient_id, "start", code
          order by nullif(stop, '')::date nulls first, description nulls first) as n from conditions)"""
O_DRUG = f"""select {sid('patient_id', 'd', 'code', 'n')} as drug_exposure_id, {sid('patient_id')} as person_id,
    {sid('lower(code)')} as drug_concept_id, d as drug_exposure_start_date, d::timestamp as drug_exposure_start_datetime,
    stop::date as drug_exposure_end_date, stop::timestamp as drug_exposure_end_datetime, 32827 as drug_type_concept_id,
    code as drug_source_value, description as drug_source_label,
    case when regexp_matches(code, '^[0-9]+') then 'rxcui_numeric' else 'rxcui_other' end as drug_code_type,
    lower(reasondescription) as reason_description
  from (select *, "start"::date as d, row_number() over (partition by patient_id, "start", code
          order by stop::date nulls first, description nulls first, lower(reasondescription) nulls first) as n
        from medications where code <> '')"""
MEASUREMENT = """case when regexp_matches(lower(description), 'blood pressure|systolic|diastolic') then 'vitals_bp'
    when regexp_matches(lower(description), 'heart rate|pulse') then 'vitals_hr'
    when regexp_matches(lower(description), 'temperature|temp') then 'vitals_temp'
    when regexp_matches(lower(description), 'bmi|weight|height') then 'vitals_body'
    when regexp_matches(lower(description), 'glucose|hba1c|cholesterol|triglyceride|a1c') then 'lab_metabolic'
    when regexp_matches(lower(description), 'creatinine|egfr|bun|urea') then 'lab_renal'
    when regexp_matches(lower(description), 'hemoglobin|hct|wbc|plt|rbc') then 'lab_hematology'
    when regexp_matches(lower(description), 'tsh|t3|t4|insulin|cortisol') then 'lab_endocrine' else 'other' end"""


def o_measurement(view: str) -> str:
    return f"""select {sid('patient_id', "strftime(dt, '%Y-%m-%d %H:%M:%S')", 'code', 'n')} as measurement_id,
    {sid('patient_id')} as person_id, {sid('lower(code)')} as measurement_concept_id, dt::date as measurement_date,
    dt as measurement_datetime, hour(dt)::int as measurement_time, try_cast(value as double) as value_as_number,
    units as unit_source_value, 0 as unit_concept_id, 0 as measurement_type_concept_id, code as measurement_source_value, description as measurement_source_label,
    {MEASUREMENT} as measurement_category
  from (select *, row_number() over (partition by patient_id, dt, code order by description, try_cast(value as double), units) as n
        from {view} where try_cast(value as double) is not null)"""


NULLS = {
    "omop_person": ["race_source_value", "ethnicity_source_value", "location_id", "provider_id", "care_site_id"],
    "omop_visit": ["provider_id", "care_site_id", "admitted_from_concept_id", "admitted_from_source_value",
                   "discharged_to_concept_id", "discharged_to_source_value"],
    "omop_condition": ["stop_reason", "provider_id", "visit_occurrence_id"],
    "omop_drug": ["stop_reason", "refills", "quantity", "days_supply", "sig", "route_concept_id", "lot_number",
                  "provider_id", "visit_occurrence_id"],
    "omop_measurement": ["operator_concept_id", "value_as_concept_id", "range_low", "range_high", "provider_id",
                         "visit_occurrence_id"],
}

OMOP_VIEWS = {
    "o_person": O_PERSON, "o_visit": O_VISIT, "o_condition": O_CONDITION, "o_drug": O_DRUG,
    "o_measurement": o_measurement("observations"), "o_heart": o_measurement("heart_rates"),
    "prefixes": prefix_values(), "concepts": concept_values(), "staged": O_STAGED,
}


def oracle(sql: str, **extra: str) -> str:
    return with_views(sql, **{**OMOP_VIEWS, **extra})


# ---- queries -------------------------------------------------------------------------------


def stg_members(spark, sf):
    return staging.stg_members(*load(spark, sf, "eligibility"))


def member_months(spark, sf):
    return staging.member_months(stg_members(spark, sf), DAY())


def member_roster(spark, sf):
    return staging.member_roster(stg_members(spark, sf), DAY())


def person(spark, sf):
    return omop.omop_person(*load(spark, sf, "patients"))


def visit(spark, sf):
    return omop.omop_visit(*load(spark, sf, "encounters"))


def condition(spark, sf):
    return omop.omop_condition(*load(spark, sf, "conditions"))


def drug(spark, sf):
    return omop.omop_drug(*load(spark, sf, "medications"))


def measurement(spark, sf):
    return omop.omop_measurement(*load(spark, sf, "observations"))


def with_typed_nulls(name, build):
    """The typed placeholder columns are checked by a test; SQL NULL literals have no type."""
    return lambda spark, sf: build(spark, sf).drop(*NULLS[name])


def synthea_person(spark, sf):
    return synthea.synthea_person(*load(spark, sf, "patients"), as_of_date("2026-01-01"))


def synthea_condition(spark, sf):
    return synthea.synthea_condition(*load(spark, sf, "conditions"))


def synthea_visit(spark, sf):
    return synthea.synthea_visit(*load(spark, sf, "encounters"))


def condition_prevalence(spark, sf):
    return synthea.condition_prevalence(synthea_condition(spark, sf), synthea_person(spark, sf))


def adherence(spark, sf):
    return marts.medication_adherence(drug(spark, sf))


def adherence_union(spark, sf):
    return marts.medication_adherence(drug(spark, sf), method="union")


def condition_drug_pairs(spark, sf):
    return marts.condition_drug_pairs(condition(spark, sf), drug(spark, sf))


def prefix_join_all(spark, sf):
    (rows,) = load(spark, sf, "conditions")
    joined = joins.prefix_join(
        rows.select("patient_id", "start", "code"), "code", seeds.seed(spark, "icd10_to_ccs"),
        "icd10_prefix", [1, 2], mode="all",
    )
    return joined.groupBy("code", "ccs_category").agg(F.count(F.lit(1)).alias("n"))


def interval_join(spark, sf):
    conditions, drugs = load(spark, sf, "conditions", "medications")
    left = conditions.select("patient_id", F.col("start").cast("date").alias("onset"), F.col("code").alias("dx"))
    right = drugs.select("patient_id", F.col("start").cast("date").alias("filled"), F.col("code").alias("rx"))
    return joins.interval_join(left, right, ["patient_id"], "onset", "filled", 14)


def roster_upsert(spark, sf):
    """Yesterday's roster (without hsa_eligible) merged with today's changed rows."""
    today = member_roster(spark, sf).select(
        "member_id", "state", "plan_type", "enrollment_status", "days_enrolled", "hsa_eligible"
    )
    old = today.drop("hsa_eligible").withColumns({
        "plan_type": F.lit("OLD"), "days_enrolled": F.col("days_enrolled") - 1})
    return tables.upsert(old, today.filter("state in ('NY', 'MA')"), ["member_id"], ["days_enrolled"])


def covered_days(spark, sf):
    return windows.covered_days(drug(spark, sf), ["person_id", "drug_source_value"],
                                "drug_exposure_start_date", "drug_exposure_end_date")


QUERIES = {
    "stg_members": stg_members,
    "member_months": member_months,
    "member_roster": member_roster,
    "omop_person": with_typed_nulls("omop_person", person),
    "omop_visit": with_typed_nulls("omop_visit", visit),
    "omop_condition": with_typed_nulls("omop_condition", condition),
    "omop_drug": with_typed_nulls("omop_drug", drug),
    "omop_measurement": with_typed_nulls("omop_measurement", measurement),
    "synthea_person": synthea_person,
    "synthea_condition": synthea_condition,
    "synthea_visit": synthea_visit,
    "condition_prevalence": condition_prevalence,
    "medication_adherence": adherence,
    "medication_adherence_union": adherence_union,
    "covered_days": covered_days,
    "condition_drug_pairs": condition_drug_pairs,
    "prefix_join_all": prefix_join_all,
    "interval_join": interval_join,
    "roster_upsert": roster_upsert,
    "drug_utilisation": lambda spark, sf: marts.drug_utilisation(drug(spark, sf)),
    "visit_summary": lambda spark, sf: marts.visit_summary(visit(spark, sf)),
    "patient_characteristics": lambda spark, sf: marts.patient_characteristics(person(spark, sf), DAY()),
}

# ---- oracles -------------------------------------------------------------------------------

AGE = f"(year(date '{AS_OF}') - year(date_of_birth))"
ROSTER = f"""
    with ages as (
      select member_id, arg_max({AGE}, (date_trunc('month', coalesce(coverage_termination_date, date '{AS_OF}')), date_of_birth))
        as age from staged
      where (coverage_termination_date is null or coverage_termination_date >= date '{AS_OF}') and date_of_birth is not null
        and date_trunc('month', coverage_effective_date) <= date_trunc('month', coalesce(coverage_termination_date, date '{AS_OF}'))
      group by member_id),
    latest as (
      select * from staged qualify row_number() over (partition by member_id
        order by coverage_effective_date desc nulls last, first_name nulls first, last_name nulls first) = 1)
    select l.member_id, first_name, last_name, date_of_birth,
      case when age < 18 then 'Minor' when age <= 25 then 'Young Adult' when age <= 40 then 'Adult'
        when age <= 55 then 'Middle' when age <= 65 then 'Pre-Senior' when age > 65 then 'Senior' end as age_bucket,
      email, phone, address, city, state, zip_code, plan_type, metal_level, hsa_eligible, coverage_effective_date,
      coverage_termination_date, cast(date '{AS_OF}' - coverage_effective_date as bigint) as days_enrolled, relationship,
      case when coverage_termination_date < date '{AS_OF}' then 'Inactive' else 'Active' end as enrollment_status,
      case when coalesce(zip_code, '') = '' then 1 else 0 end as missing_zip,
      case when coalesce(email, '') = '' then 1 else 0 end as missing_email,
      case when coalesce(phone, '') = '' then 1 else 0 end as missing_phone,
      case when relationship = 'Child' and age > 26 then 1 else 0 end as child_overage_flag
    from latest l left join ages a on l.member_id = a.member_id"""
CLASS = "case encounterclass " + " ".join(
    f"when '{k}' then {v}" for k, v in seeds.VISIT_CLASS_CONCEPT.items()) + " end"
S_PERSON = f"""select {sid('patient_id')} as person_id, patient_id as person_source_value,
    date_sub('year', birthdate::date, date '2026-01-01')::int as age_year,
    case gender when 'M' then 8507 when 'F' then 8532 end as gender_concept_id,
    case lower(race) when 'white' then 8527 when 'black' then 8516 when 'asian' then 8515 when 'native' then 8657
      when 'other' then 8522 end as race_concept_id,
    case lower(ethnicity) when 'nonhispanic' then 38035 when 'hispanic' then 38036 end as ethnicity_concept_id,
    year(birthdate::date)::int as year_of_birth, strftime(birthdate::date, '%m') as month_of_birth,
    strftime(birthdate::date, '%d') as day_of_birth, city, state, zip as zip_code, deathdate::date as death_date
  from patients"""
S_CONDITION = """select patient_id as person_source_value, "start"::date as condition_start_date,
    try_cast(stop as date) as condition_end_date, c.concept::bigint as condition_concept_id,
    c.source_concept::bigint as condition_source_concept_id, x.code as condition_source_value,
    'ICD10CM' as condition_type_concept_id, 0 as condition_status_concept_id
  from conditions x left join concepts c on x.code = c.code"""
ADHERENCE = f"""
    select person_id, drug_source_value, label as drug_source_label, fill_count, first_fill_date, last_fill_end_date,
      cast(days as bigint) as total_days_on_hand, cast(window_days as int) as observation_window_days,
      least({exact_mean('days', 'window_days', 4)}, 1.0) as pdc_score,
      case when days::double / window_days >= 0.8 then 'adherent' when days::double / window_days >= 0.6
        then 'partially_adherent' else 'non_adherent' end as adherence_category
    from totals where window_days >= 30"""
TOTALS = """select person_id, drug_source_value, min(drug_source_label) as label, count(*) as fill_count,
    min(drug_exposure_start_date) as first_fill_date,
    max(coalesce(drug_exposure_end_date, drug_exposure_start_date)) as last_fill_end_date,
    {days} as days,
    greatest(max(coalesce(drug_exposure_end_date, drug_exposure_start_date)) - min(drug_exposure_start_date), 1) as window_days
  from o_drug group by 1, 2"""
SUM_DAYS = "sum(greatest(coalesce(drug_exposure_end_date, drug_exposure_start_date) - drug_exposure_start_date, 0))"
COVERED = """select person_id, drug_source_value, count(*) as covered_days, cast(sum(first_of_span) as bigint) as spans
  from (select person_id, drug_source_value, day,
          case when lag(day) over (partition by person_id, drug_source_value order by day) = day - 1 then 0 else 1 end as first_of_span
        from (select distinct person_id, drug_source_value, unnest(generate_series(drug_exposure_start_date,
                drug_exposure_end_date - 1, interval 1 day))::date as day from o_drug
              where drug_exposure_end_date > drug_exposure_start_date))
  group by 1, 2"""

ORACLES = {
    "stg_members": oracle("select * from staged"),
    "member_months": oracle(f"""
        select member_id, first_name, last_name, date_of_birth, cast({AGE} as int) as age, plan_type, metal_level, state,
          unnest(generate_series(date_trunc('month', coverage_effective_date)::date,
            date_trunc('month', coalesce(coverage_termination_date, date '{AS_OF}'))::date, interval 1 month))::date as coverage_month,
          relationship = 'Self' as is_primary, 1 as member_months
        from staged where coverage_termination_date is null or coverage_termination_date >= date '{AS_OF}'"""),
    "member_roster": oracle(ROSTER),
    "omop_person": oracle("select * from o_person"),
    "omop_visit": oracle("select * from o_visit"),
    "omop_condition": oracle("select * from o_condition"),
    "omop_drug": oracle("select * from o_drug"),
    "omop_measurement": oracle("select * from o_measurement"),
    "synthea_person": oracle("select * from s_person", s_person=S_PERSON),
    "synthea_condition": oracle("select * from s_condition", s_condition=S_CONDITION),
    "synthea_visit": oracle(f"""
        select encounter_id, patient_id, {CLASS} as visit_concept_id, "start"::timestamp as visit_start_datetime,
          stop::timestamp as visit_end_datetime, coalesce(stop::date - "start"::date, 0)::int as visit_los,
          description as visit_description, encounterclass as visit_source_value,
          case {CLASS} when 9201 then 32035 when 9203 then 32036 else 44814717 end as visit_type_concept_id
        from encounters"""),
    "condition_prevalence": oracle("""
        with cells as (
          select c.condition_source_value as condition_code,
            case when age_year < 18 then '0-17' when age_year < 30 then '18-29' when age_year < 45 then '30-44'
              when age_year < 60 then '45-59' when age_year < 75 then '60-74' else '75+' end as age_bucket,
            case gender_concept_id when 8507 then 'Male' when 8532 then 'Female' else 'Unknown' end as gender, state,
            count(distinct person_id) as patient_count, count(*) as total_occurrences,
            cast(sum(case when condition_end_date is null and (death_date is null or condition_start_date <= death_date)
              then 1 else 0 end) as bigint) as active_count,
            round(sum(dayofyear(condition_start_date))::double / count(*), 4) as avg_day_of_year
          from s_condition c join s_person p on c.person_source_value = p.person_source_value group by 1, 2, 3, 4)
        select *, round(patient_count::double / (select sum(patient_count) from cells)::double * 100, 4) as pct_of_cohort,
          cast(row_number() over (partition by age_bucket, gender order by patient_count desc, condition_code, state) as int)
            as rank_in_segment
        from cells""", s_person=S_PERSON, s_condition=S_CONDITION),
    "medication_adherence": oracle(ADHERENCE, totals=TOTALS.format(days=SUM_DAYS)),
    "medication_adherence_union": oracle(
        ADHERENCE,
        totals=f"select t.* replace (coalesce(c.covered_days, 0) as days) from ({TOTALS.format(days='0')}) t "
               "left join covered c using (person_id, drug_source_value)", covered=COVERED),
    "covered_days": oracle("select * from covered", covered=COVERED),
    "condition_drug_pairs": oracle("""
        with pairs as (
          select c.person_id, c.condition_source_value, c.ccs_category as condition_ccs_category, d.drug_source_value,
            min(d.drug_source_label) as drug_source_label, min(c.condition_start_date) as first_condition_onset,
            min(d.drug_exposure_start_date) as first_drug_for_condition,
            count(distinct d.drug_exposure_id) as drug_fills_for_condition
          from o_condition c join o_drug d on c.person_id = d.person_id
            and d.drug_exposure_start_date between c.condition_start_date and c.condition_start_date + 90
          group by 1, 2, 3, 4)
        select *, cast(first_drug_for_condition - first_condition_onset as int) as days_from_onset_to_drug,
          case when first_drug_for_condition - first_condition_onset = 0 then 'same_day'
            when first_drug_for_condition - first_condition_onset <= 7 then 'within_week'
            when first_drug_for_condition - first_condition_onset <= 30 then 'within_month'
            when first_drug_for_condition - first_condition_onset <= 90 then 'within_quarter' else 'after_quarter' end
            as treatment_lag_bucket from pairs"""),
    "prefix_join_all": oracle("""
        select code, category as ccs_category, count(*) as n
        from conditions left join prefixes on starts_with(code, prefix) group by 1, 2"""),
    "interval_join": oracle("""
        select c.patient_id, c."start"::date as onset, c.code as dx, m."start"::date as filled, m.code as rx
        from conditions c join medications m on c.patient_id = m.patient_id
          and m."start"::date between c."start"::date and c."start"::date + 14"""),
    "roster_upsert": oracle("""
        select member_id, state, case when state in ('NY', 'MA') then plan_type else 'OLD' end as plan_type,
          enrollment_status, case when state in ('NY', 'MA') then days_enrolled else days_enrolled - 1 end as days_enrolled,
          case when state in ('NY', 'MA') then hsa_eligible end as hsa_eligible from roster""", roster=ROSTER),
    "drug_utilisation": oracle("""
        select drug_code_type, count(*) as exposures, count(distinct person_id) as persons,
          count(distinct drug_source_value) as drugs from o_drug group by 1"""),
    "visit_summary": oracle("""
        select visit_concept_id, count(*) as visits, round(count(*) * 100::double / (select count(*) from o_visit), 2) as pct_of_visits,
          round(avg(visit_end_date - visit_start_date), 4) as avg_los_days from o_visit group by 1"""),
    "patient_characteristics": oracle(f"""
        select case when a < 18 then '0-17' when a < 30 then '18-29' when a < 45 then '30-44' when a < 60 then '45-59'
            when a < 75 then '60-74' else '75+' end as age_bucket, gender_concept_id, count(*) as persons
        from (select year(date '{AS_OF}') - year_of_birth as a, gender_concept_id from o_person) group by 1, 2"""),
}
