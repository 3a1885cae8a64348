"""Data-quality queries and oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelattice.functions.columns import as_of_date
from carelattice.operators import aggregates, population, quality
from carelattice.operators.windows import duplicates, unique_over
from carelattice.plans import marts, staging
from suite import warehouse as w
from suite.views import AS_OF, load, view

oracle = w.oracle
STATES = ", ".join(f"'{s}'" for s in quality.US_STATES)


def DAY():
    return as_of_date(AS_OF)


def eligibility(spark, sf):
    return view(spark, sf, "eligibility")


def model_tests(spark, sf):
    return quality.model_tests({
        "stg_members": w.stg_members(spark, sf), "omop_person": w.person(spark, sf),
        "omop_visit": w.visit(spark, sf), "member_roster": w.member_roster(spark, sf),
    })


def model_tests_facts(spark, sf):
    """The five models that ``model_tests`` leaves out."""
    condition, drug = w.condition(spark, sf), w.drug(spark, sf)
    return quality.model_tests({
        "omop_condition": condition, "omop_drug": drug, "omop_measurement": w.measurement(spark, sf),
        "medication_adherence": marts.medication_adherence(drug), "condition_drug_pairs": marts.condition_drug_pairs(condition, drug),
    })


def warehouse_checks(spark, sf):
    return quality.warehouse_checks(
        w.stg_members(spark, sf), w.person(spark, sf), w.condition(spark, sf), w.visit(spark, sf))


def contract_quality(spark, sf):
    return quality.contract_quality(eligibility(spark, sf), "eligibility", DAY())


def conforms(spark, sf):
    return quality.conforms(eligibility(spark, sf), "eligibility")


def qa_report(spark, sf):
    return quality.qa_report(contract_quality(spark, sf))


def issue_summary(spark, sf):
    flags = staging.issue_flags(eligibility(spark, sf), DAY())
    return flags.agg(*[F.sum(c).alias(c) for c in staging.ISSUES])


ORDER = lambda: [F.col("row_key")]

QUERIES = {
    "model_tests": model_tests,
    "model_tests_facts": model_tests_facts,
    "warehouse_checks": warehouse_checks,
    "contract_quality": contract_quality,
    "contract_conformance": conforms,
    "qa_report": qa_report,
    "issue_flags": lambda s, d: staging.issue_flags(eligibility(s, d), DAY()),
    "issue_summary": issue_summary,
    "clean_roster": lambda s, d: staging.clean_roster(eligibility(s, d), DAY(), ORDER()),
    "cleaning_report": lambda s, d: staging.cleaning_report(eligibility(s, d), DAY(), ORDER()),
    "failing_rows": lambda s, d: quality.failures(
        w.stg_members(s, d), quality.matches("zip_code", "^0[0-9]{4}$")),
    "duplicate_rows": lambda s, d: duplicates(eligibility(s, d), ["mem_id"]),
    "unique_flag": lambda s, d: unique_over(eligibility(s, d).select("mem_id", "row_key"), ["mem_id"]),
    "zip_issues_by_state": lambda s, d: aggregates.value_counts(
        staging.issue_flags(eligibility(s, d), DAY()).filter("zip_lost_zeros = 1"), "state"),
    "question_missing_email": lambda s, d: population.missing_email_count(eligibility(s, d)),
    "question_largest_state": lambda s, d: population.largest_state(eligibility(s, d)),
    "question_most_missing": lambda s, d: population.most_missing_fields(eligibility(s, d), ["mem_id", "row_key"]),
    "question_children_over_26": lambda s, d: population.children_over(eligibility(s, d), DAY()),
    "question_short_zips": lambda s, d: population.short_zips(eligibility(s, d)),
    "question_duplicate_ids": lambda s, d: population.duplicate_member_ids(eligibility(s, d)),
    "question_plan_breakdown": lambda s, d: population.plan_breakdown(eligibility(s, d)),
    "question_ny_without_zip": lambda s, d: population.members_without_zip(eligibility(s, d), "NY"),
}

ACTIVE = f"(termination_date = 'Active' or termination_date::date >= date '{AS_OF}')"
D = f"date '{AS_OF}'"


def row(check: str, table: str, col: str, failing: str, severity: str = "error", ratio: float = 1.0) -> str:
    return (
        f"select '{check}' as check_id, '{table}' as table_name, '{col}' as column_name, '{severity}' as severity, "
        f"count(*) filter (where {failing}) as failed_rows, count(*) as total_rows, "
        f"count(*) - count(*) filter (where {failing}) >= {ratio} * count(*) as passed from "
    )


def unique(table: str, source: str, col: str, severity: str = "error") -> str:
    return (
        f"select 'unique_{col}', '{table}', '{col}', '{severity}', count(*) - count(distinct {col}), count(*), "
        f"count(*) = count(distinct {col}) from {source}"
    )


def nulls(table: str, source: str, columns: str) -> list[str]:
    return [row(f"not_null_{c}", table, c, f"{c} is null") + source for c in columns.split()]


MODEL = [
    *nulls("stg_members", "staged", "member_id date_of_birth first_name last_name email zip_code state"),
    row("accepted_values_state", "stg_members", "state", f"state not in ({STATES})") + "staged",
    unique("stg_members", "staged", "member_id"),
    *nulls("omop_person", "o_person", "person_id gender_concept_id year_of_birth"),
    row("accepted_values_gender_concept_id", "omop_person", "gender_concept_id",
        "gender_concept_id not in (0, 8507, 8532, 44814653, 44814649)") + "o_person",
    unique("omop_person", "o_person", "person_id"),
    *nulls("omop_visit", "o_visit", "visit_occurrence_id person_id visit_concept_id visit_start_date visit_end_date"),
    row("accepted_values_visit_concept_id", "omop_visit", "visit_concept_id",
        "visit_concept_id not in (0, 9201, 9202, 9203)") + "o_visit",
    unique("omop_visit", "o_visit", "visit_occurrence_id"),
    *nulls("member_roster", "roster", "member_id"),
    row("accepted_values_enrollment_status", "member_roster", "enrollment_status",
        "enrollment_status not in ('Active', 'Inactive')") + "roster",
    row("accepted_values_age_bucket", "member_roster", "age_bucket",
        "age_bucket not in ('Minor', 'Young Adult', 'Adult', 'Middle', 'Pre-Senior', 'Senior')") + "roster",
    row("accepted_values_plan_type", "member_roster", "plan_type",
        "plan_type not in ('HMO', 'PPO', 'EPO', 'HDHP', 'POS')") + "roster",
    unique("member_roster", "roster", "member_id"),
]
FACTS = [
    *nulls("omop_condition", "o_condition", "condition_occurrence_id person_id condition_concept_id condition_start_date "
           "condition_type_concept_id ccs_category"),
    unique("omop_condition", "o_condition", "condition_occurrence_id"),
    *nulls("omop_drug", "o_drug", "drug_exposure_id person_id drug_concept_id drug_exposure_start_date "
           "drug_type_concept_id drug_source_value drug_code_type"),
    unique("omop_drug", "o_drug", "drug_exposure_id"),
    *nulls("omop_measurement", "o_measurement", "measurement_id person_id measurement_concept_id measurement_date "
           "measurement_datetime value_as_number measurement_category"),
    unique("omop_measurement", "o_measurement", "measurement_id"),
    *nulls("medication_adherence", "adhered", "person_id drug_source_value pdc_score adherence_category fill_count "
           "observation_window_days"),
    row("accepted_values_adherence_category", "medication_adherence", "adherence_category",
        "adherence_category not in ('adherent', 'partially_adherent', 'non_adherent')") + "adhered",
    *nulls("condition_drug_pairs", "pairs", "person_id condition_source_value drug_source_value first_condition_onset "
           "first_drug_for_condition days_from_onset_to_drug treatment_lag_bucket drug_fills_for_condition"),
    row("accepted_values_treatment_lag_bucket", "condition_drug_pairs", "treatment_lag_bucket",
        "treatment_lag_bucket not in ('same_day', 'within_week', 'within_month', 'within_quarter', 'after_quarter')") + "pairs",
]
WAREHOUSE = [
    *nulls("stg_members", "staged", "member_id first_name last_name date_of_birth state"),
    row("matches_zip_code", "stg_members", "zip_code", "not regexp_matches(zip_code, '^[0-9]{5}$')") + "staged",
    row("valid_state", "stg_members", "state", f"state is null or state not in ({STATES})") + "staged",
    unique("stg_members", "staged", "member_id"),
    row("accepted_values_gender_concept_id", "omop_person", "gender_concept_id",
        "gender_concept_id not in (0, 8507, 8532, 44814653, 44814649)") + "o_person",
    row("referential_person_id", "omop_condition", "person_id",
        "person_id not in (select person_id from o_person)") + "o_condition",
    row("end_not_before_start", "omop_visit", "visit_end_date", "visit_end_date < visit_start_date") + "o_visit",
    row("coverage_ccs_category", "omop_condition", "ccs_category", "ccs_category = 'unmapped'", ratio=0.5) + "o_condition",
]
BORN, BEGIN = "try_cast(dob as date)", "effective_date::date"
TERM = "try_cast(nullif(termination_date, 'Active') as date)"
CHILD = "covered_relation = 'Child'"
CONTRACT = [
    *[row(f"completeness_{c}", "eligibility", c, f"trim(coalesce({c}, '')) = ''", "fatal" if fatal else "error", ratio)
      + "eligibility" for c, (ratio, fatal) in quality.CONTRACT_COMPLETENESS.items()],
    row("dob_plausible", "eligibility", "dob", f"not ({BORN} <= {D} and {BORN} >= {D} - interval 120 year)") + "eligibility",
    row("matches_zip_code", "eligibility", "zip_code",
        "not regexp_matches(zip_code, '^[0-9]{5}(-[0-9]{4})?$')") + "eligibility",
    row("effective_not_future", "eligibility", "effective_date", f"{BEGIN} > {D}") + "eligibility",
    row("termination_after_effective", "eligibility", "termination_date", f"{TERM} < {BEGIN}") + "eligibility",
    row("child_under_26_at_start", "eligibility", "covered_relation",
        f"{CHILD} and date_sub('year', {BORN}, {BEGIN}) >= 26") + "eligibility",
    row("child_under_26", "eligibility", "covered_relation", f"{CHILD} and date_sub('year', {BORN}, {D}) >= 26") + "eligibility",
    row("plan_metal_alignment", "eligibility", "metal_level",
        "case when upper(plan_type) in ('HMO', 'EPO') then metal_level not in ('Silver', 'Gold') "
        "when upper(plan_type) = 'HDHP' then metal_level <> 'Bronze' else false end", "warning") + "eligibility",
    unique("eligibility", "eligibility", "mem_id", "fatal"),
]
CONFORMS = []
for _name, _type, _longest, _required in quality.contract_columns():
    if _name in ("subscriber_id", "employer_group"):
        continue
    if _name in ("coverage_tier", "monthly_premium"):
        CONFORMS.append(row(f"present_{_name}", "eligibility", _name, "true") + "eligibility")
        continue
    _value = f"nullif({_name}, '')"
    if _required:
        CONFORMS.append(row(f"required_{_name}", "eligibility", _name, f"{_value} is null") + "eligibility")
    if _longest:
        CONFORMS.append(row(f"length_{_name}", "eligibility", _name, f"length({_value}) > {_longest}") + "eligibility")
    if _type != "string":
        CONFORMS.append(row(f"type_{_name}", "eligibility", _name,
                            f"{_value} is not null and try_cast({_value} as {_type}) is null") + "eligibility")
    if _name in quality.CONTRACT_VALUES:
        _allowed = ", ".join(f"'{v}'" for v in quality.CONTRACT_VALUES[_name])
        CONFORMS.append(row(f"allowed_{_name}", "eligibility", _name, f"{_value} not in ({_allowed})") + "eligibility")
CONFORMS.append(row("matches_zip_code", "eligibility", "zip_code",
                    "not regexp_matches(zip_code, '^[0-9]{5}(-[0-9]{4})?$')") + "eligibility")

NUMBER = "try_cast(zip_code as int)"
FLAGGED = f"""select *, case when count(*) over (partition by mem_id) > 1 then 1 else 0 end as duplicate_id,
    case when {NUMBER} > 0 and {NUMBER} < 10000 then 1 else 0 end as zip_lost_zeros,
    case when {CHILD} and round(({D} - {BORN}) / 365.25, 1) > 26 then 1 else 0 end as child_overage,
    case when coalesce(dob, '') = '' then 1 else 0 end as missing_dob,
    case when coalesce(email, '') = '' then 1 else 0 end as missing_email,
    case when coalesce(phone, '') = '' then 1 else 0 end as missing_phone,
    case when coalesce(zip_code, '') = '' then 1 else 0 end as missing_zip from eligibility"""
GAPS = " + ".join(f"case when trim(coalesce({c}, '')) = '' then 1 else 0 end" for c in population.REQUIRED)

ORACLES = {
    "model_tests": oracle(" union all ".join(MODEL), roster=w.ROSTER),
    "model_tests_facts": oracle(
        " union all ".join(FACTS), adhered=w.ORACLES["medication_adherence"], pairs=w.ORACLES["condition_drug_pairs"]),
    "warehouse_checks": oracle(" union all ".join(WAREHOUSE)),
    "contract_quality": oracle(" union all ".join(CONTRACT)),
    "contract_conformance": oracle(" union all ".join(CONFORMS)),
    "qa_report": oracle("""
        select table_name, count(*) as checks, count(*) filter (where not passed) as failed,
          count(*) filter (where not passed and severity = 'fatal') as fatal,
          '[' || string_agg('{"check_id":"' || check_id || '","column_name":"' || column_name || '","severity":"'
            || severity || '","failed_rows":' || failed_rows || '}', ',' order by check_id, column_name)
            filter (where not passed) || ']' as failures
        from results group by 1""", results=" union all ".join(CONTRACT)),
    "issue_flags": oracle("select * from flagged", flagged=FLAGGED),
    "issue_summary": oracle(
        "select " + ", ".join(f"cast(sum({c}) as bigint) as {c}" for c in staging.ISSUES) + " from flagged",
        flagged=FLAGGED),
    "clean_roster": oracle(f"""
        select * replace (lpad(trim(zip_code), 5, '0') as zip_code) from (
          select * from eligibility qualify row_number() over (partition by mem_id order by row_key) = 1)
        where {ACTIVE} and dob <> ''"""),
    "cleaning_report": oracle(f"""
        select (select count(*) from eligibility) as input_rows, (select count(distinct mem_id) from eligibility) as distinct_members,
          (select count(*) from eligibility where {ACTIVE}) as active_rows, count(*) as clean_rows,
          round((1.0::double - count(*)::double / (select count(*) from eligibility)) * 100, 1) as error_rate_pct
        from (select * from eligibility qualify row_number() over (partition by mem_id order by row_key) = 1)
        where {ACTIVE} and dob <> ''"""),
    "failing_rows": oracle("select * from staged where not regexp_matches(zip_code, '^0[0-9]{4}$')"),
    "duplicate_rows": oracle("select * from eligibility qualify count(*) over (partition by mem_id) > 1"),
    "unique_flag": oracle("select mem_id, row_key, count(*) over (partition by mem_id) = 1 as is_unique from eligibility"),
    "zip_issues_by_state": oracle("select state, count(*) as n from flagged where zip_lost_zeros = 1 group by 1", flagged=FLAGGED),
    "question_missing_email": oracle("select count(*) as members_missing_email from eligibility where email = ''"),
    "question_largest_state": oracle("""
        select state, count(*) as members from eligibility group by 1 order by members desc, state limit 1"""),
    "question_most_missing": oracle(f"""
        select mem_id, row_key, {GAPS} as missing_fields from eligibility order by missing_fields desc, mem_id, row_key limit 10"""),
    "question_children_over_26": oracle(f"""
        select count(*) as children_over_age from eligibility where {CHILD} and ({D} - {BORN}) / 365.25 > 26"""),
    "question_short_zips": oracle(f"""
        select zip_code, count(*) as members from eligibility where {NUMBER} > 0 and {NUMBER} < 10000 group by 1"""),
    "question_duplicate_ids": oracle("""
        select count(*) as duplicate_ids, cast(sum(n) as bigint) as affected_rows
        from (select mem_id, count(*) as n from eligibility group by 1 having count(*) > 1)"""),
    "question_plan_breakdown": oracle("select upper(plan_type) as plan_type, count(*) as members from eligibility group by 1"),
    "question_ny_without_zip": oracle(
        "select * from eligibility where state = 'NY' and (trim(zip_code) = '' or length(trim(zip_code)) < 5)"),
}
