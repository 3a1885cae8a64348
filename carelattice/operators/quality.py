"""Data-quality checks.

Row checks of one table are evaluated together in one aggregation pass. Every check yields
(check_id, table_name, column_name, severity, failed_rows, total_rows, passed).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.functions.columns import age, column, missing
from carelattice.session import materialise
from carelattice.sources.seeds import METAL_LEVELS, PLAN_TYPES, RELATIONS, US_STATES
from carelattice.sources.tables import union_all

ZIP5 = "^[0-9]{5}$"
ZIP_PLUS4 = "^[0-9]{5}(-[0-9]{4})?$"


@dataclass(frozen=True)
class Check:
    """A rule on one row. ``failing`` is true for a row that breaks it; NULL counts as
    passing. The check passes when at least ``min_pass`` of the rows pass."""

    id: str
    column: str
    failing: Column
    severity: str = "error"
    min_pass: float = 1.0

    def fails(self) -> Column:
        return F.coalesce(self.failing, F.lit(False))


def not_null(*columns: str) -> list[Check]:
    return [Check(f"not_null_{c}", c, F.col(c).isNull()) for c in columns]


def accepted_values(col: str, values: Sequence, nulls_pass: bool = True) -> Check:
    bad = ~F.col(col).isin(list(values))
    return Check(f"accepted_values_{col}", col, bad if nulls_pass else F.col(col).isNull() | bad)


def matches(col: str, pattern: str, severity: str = "error") -> Check:
    return Check(f"matches_{col}", col, ~F.col(col).rlike(pattern), severity)


def row_rule(name: str, col: str, holds: Column | str, severity: str = "error") -> Check:
    """``holds`` must not be false; an unknown result passes, as in a SQL CHECK."""
    return Check(name, col, ~(F.expr(holds) if isinstance(holds, str) else holds), severity)


def completeness(col: str, min_ratio: float, fatal: bool = False) -> Check:
    return Check(f"completeness_{col}", col, missing(col), "fatal" if fatal else "error", min_ratio)


def coverage(col: str, unmapped: str, min_ratio: float) -> Check:
    return Check(f"coverage_{col}", col, F.col(col) == unmapped, "error", min_ratio)


def _result(check_id: Column, table: str, col: Column, severity: Column, failed: Column,
            total: Column, passed: Column) -> list[Column]:
    return [
        check_id.alias("check_id"), F.lit(table).alias("table_name"), col.alias("column_name"),
        severity.alias("severity"), F.coalesce(failed, F.lit(0)).cast("long").alias("failed_rows"),
        total.cast("long").alias("total_rows"), F.coalesce(passed, F.lit(False)).alias("passed"),
    ]


def evaluate(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """All checks of a table in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.sum(c.fails().cast("long")).alias(f"f{i}") for i, c in enumerate(checks)],
    )
    entries = F.array(*[
        F.struct(
            F.lit(c.id).alias("id"), F.lit(c.column).alias("column"), F.lit(c.severity).alias("severity"),
            F.lit(float(c.min_pass)).alias("min_pass"), F.coalesce(F.col(f"f{i}"), F.lit(0)).alias("failed"),
        )
        for i, c in enumerate(checks)
    ])
    rows = counted.select("total", F.explode(entries).alias("c"))
    passed = (F.col("total") - F.col("c.failed")) >= F.col("c.min_pass") * F.col("total")
    return rows.select(*_result(
        F.col("c.id"), table, F.col("c.column"), F.col("c.severity"), F.col("c.failed"),
        F.col("total"), passed,
    ))


def failures(df: DataFrame, check: Check) -> DataFrame:
    """The rows that break the rule."""
    return df.filter(check.fails())


def unique(df: DataFrame, table: str, columns: Sequence[str], severity: str = "error") -> DataFrame:
    """Fails on the rows beyond the first of each key."""
    keys = df.groupBy(*columns).count()
    totals = keys.agg(F.sum("count").alias("total"), F.sum(F.col("count") - 1).alias("failed"))
    name = "_".join(columns)
    return totals.select(*_result(
        F.lit(f"unique_{name}"), table, F.lit(name), F.lit(severity), F.col("failed"),
        F.coalesce("total", F.lit(0)), F.coalesce("failed", F.lit(0)) == 0,
    ))


def referential(child: DataFrame, parent: DataFrame, key: str, table: str) -> DataFrame:
    """Child rows without a parent. Child keys are counted before the anti join, so a hot or
    orphaned key is one row in it."""
    keys = child.groupBy(key).count()
    lost = keys.join(parent.select(key), key, "left_anti").agg(F.sum("count")).scalar()
    totals = keys.agg(F.sum("count").alias("total")).withColumn("failed", F.coalesce(lost, F.lit(0)))
    return totals.select(*_result(
        F.lit(f"referential_{key}"), table, F.lit(key), F.lit("error"), F.col("failed"),
        F.col("total"), F.col("failed") == 0,
    ))


def freshness(df: DataFrame, table: str, ts: str, as_of: Column, max_age_hours: float = 24) -> DataFrame:
    """Newest stamp against ``as_of``; with no stamp at all the result is a warning."""
    newest = df.agg(F.max(ts).cast("timestamp").alias("newest"), F.count(F.lit(1)).alias("total"))
    hours = (F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds("newest")) / 3600
    late = F.coalesce(hours > max_age_hours, F.lit(False))
    severity = F.when(F.col("newest").isNull(), "warning").otherwise("error")
    return newest.select(*_result(
        F.lit(f"freshness_{ts}"), table, F.lit(ts), severity,
        F.when(late, F.col("total")).otherwise(F.lit(0)), F.col("total"), ~late,
    ))


def volume(df: DataFrame, table: str, previous_rows: int | Column | None = None, low: int = 100,
           high: int = 10_000_000, delta_low: float = -0.10, delta_high: float = 0.25) -> DataFrame:
    """Row-count bounds and, against the previous snapshot, relative change. ``previous_rows`` may be a scalar
    subquery on stored history; where it is NULL (no earlier day) only the bounds count."""
    counted = df.agg(F.count(F.lit(1)).alias("total"))
    good = F.col("total").between(low, high)
    if previous_rows is not None:
        before = previous_rows if isinstance(previous_rows, Column) else F.lit(previous_rows)
        change = F.col("total") / F.nullif(before, F.lit(0)) - 1
        good = good & F.coalesce(change.between(delta_low, delta_high), F.lit(True))
    return counted.select(*_result(
        F.lit("volume"), table, F.lit("*"), F.lit("error"),
        F.when(good, F.lit(0)).otherwise(F.col("total")), F.col("total"), good,
    ))


def suite(*results: DataFrame) -> DataFrame:
    return union_all(results)


def qa_report(results: DataFrame) -> DataFrame:
    """One row per table: checks run, failed and the failed ones as JSON."""
    failed = ~F.col("passed")
    detail = F.struct("check_id", "column_name", "severity", "failed_rows")
    return results.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("checks"),
        F.sum(failed.cast("int")).alias("failed"),
        F.sum((failed & (F.col("severity") == "fatal")).cast("int")).alias("fatal"),
        F.to_json(F.array_sort(F.collect_list(F.when(failed, detail)))).alias("failures"),
    )


# ---- model tests ---------------------------------------------------------------------------

# Concept ids a person or a visit may carry.
GENDER_CONCEPTS = [0, 8507, 8532, 44814653, 44814649]
VISIT_CONCEPTS = [0, 9201, 9202, 9203]
NOT_NULL = {
    "stg_members": "member_id date_of_birth first_name last_name email zip_code state",
    "omop_person": "person_id gender_concept_id year_of_birth",
    "omop_condition": "condition_occurrence_id person_id condition_concept_id condition_start_date "
                      "condition_type_concept_id ccs_category",
    "omop_visit": "visit_occurrence_id person_id visit_concept_id visit_start_date visit_end_date",
    "omop_drug": "drug_exposure_id person_id drug_concept_id drug_exposure_start_date "
                 "drug_type_concept_id drug_source_value drug_code_type",
    "omop_measurement": "measurement_id person_id measurement_concept_id measurement_date "
                        "measurement_datetime value_as_number measurement_category",
    "member_roster": "member_id",
    "medication_adherence": "person_id drug_source_value pdc_score adherence_category fill_count "
                            "observation_window_days",
    "condition_drug_pairs": "person_id condition_source_value drug_source_value first_condition_onset "
                            "first_drug_for_condition days_from_onset_to_drug treatment_lag_bucket "
                            "drug_fills_for_condition",
}
UNIQUE = {
    "stg_members": "member_id", "omop_person": "person_id", "omop_condition": "condition_occurrence_id",
    "omop_visit": "visit_occurrence_id", "omop_drug": "drug_exposure_id",
    "omop_measurement": "measurement_id", "member_roster": "member_id",
}
ACCEPTED = {
    "stg_members": {"state": US_STATES},
    "omop_person": {"gender_concept_id": GENDER_CONCEPTS},
    "omop_visit": {"visit_concept_id": VISIT_CONCEPTS},
    "member_roster": {
        "enrollment_status": ["Active", "Inactive"],
        "age_bucket": ["Minor", "Young Adult", "Adult", "Middle", "Pre-Senior", "Senior"],
        "plan_type": PLAN_TYPES,
    },
    "medication_adherence": {"adherence_category": ["adherent", "partially_adherent", "non_adherent"]},
    "condition_drug_pairs": {"treatment_lag_bucket": [
        "same_day", "within_week", "within_month", "within_quarter", "after_quarter"]},
}


def model_tests(models: Mapping[str, DataFrame]) -> DataFrame:
    """not_null, accepted_values and unique tests of the models given by name.

    A model that both kinds of tests read is built once: the columns they read are written."""
    parts = []
    for name, df in models.items():
        checks = not_null(*NOT_NULL.get(name, "").split())
        checks += [accepted_values(col, values) for col, values in ACCEPTED.get(name, {}).items()]
        if checks and name in UNIQUE:
            read = dict.fromkeys([*[check.column for check in checks], UNIQUE[name]])
            df = materialise(df.select(*read), f"tests-{name}")
        if checks:
            parts.append(evaluate(df, name, checks))
        if name in UNIQUE:
            parts.append(unique(df, name, [UNIQUE[name]]))
    return suite(*parts)


def warehouse_checks(members: DataFrame, person: DataFrame, condition: DataFrame, visit: DataFrame
                     ) -> DataFrame:
    """The cross-table suite: staging columns, concept ids, orphans, date order, coverage."""
    strict_state = replace(accepted_values("state", US_STATES, nulls_pass=False), id="valid_state")
    return suite(
        evaluate(members, "stg_members", [
            *not_null("member_id", "first_name", "last_name", "date_of_birth", "state"),
            matches("zip_code", ZIP5), strict_state,
        ]),
        unique(members, "stg_members", ["member_id"]),
        evaluate(person, "omop_person", [accepted_values("gender_concept_id", GENDER_CONCEPTS)]),
        referential(condition, person, "person_id", "omop_condition"),
        evaluate(visit, "omop_visit", [
            row_rule("end_not_before_start", "visit_end_date", "visit_end_date >= visit_start_date")]),
        evaluate(condition, "omop_condition", [coverage("ccs_category", "unmapped", 0.5)]),
    )


# ---- eligibility contract ------------------------------------------------------------------

# Name, type, longest text, nullable.
CONTRACT_COLUMNS = """
mem_id string 20 required
first_name string 50 required
last_name string 50 required
dob date 0 required
email string 100 optional
phone string 20 optional
address string 200 optional
city string 100 optional
state string 2 required
zip_code string 10 required
effective_date date 0 required
termination_date string 20 required
covered_relation string 20 required
plan_type string 10 required
metal_level string 10 required
subscriber_id string 20 optional
employer_group string 100 optional
coverage_tier string 10 required
monthly_premium decimal(10,2) 0 required
"""
CONTRACT_VALUES = {
    "state": [*US_STATES, "DC"],
    "covered_relation": RELATIONS,
    "plan_type": PLAN_TYPES,
    "metal_level": METAL_LEVELS,
    "coverage_tier": ["Employee", "Employee+Spouse", "Employee+Children", "Family"],
}
CONTRACT_COMPLETENESS = {
    "mem_id": (1.0, True), "dob": (0.995, False), "email": (0.95, False), "phone": (0.90, False),
    "zip_code": (0.99, False),
}


def contract_columns() -> list[tuple[str, str, int, bool]]:
    out = []
    for line in CONTRACT_COLUMNS.strip().splitlines():
        name, type_name, longest, need = line.split()
        out.append((name, type_name, int(longest), need == "required"))
    return out


def conforms(df: DataFrame, table: str) -> DataFrame:
    """Presence, type, length, nullability, allowed values and format of the contract. A
    column the table lacks fails for every row when it is required."""
    checks = []
    for name, type_name, longest, required in contract_columns():
        if name not in df.columns:
            if required:
                checks.append(Check(f"present_{name}", name, F.lit(True)))
            continue
        value = F.nullif(column(name).cast("string"), F.lit(""))
        if required:
            checks.append(Check(f"required_{name}", name, value.isNull()))
        if longest:
            checks.append(Check(f"length_{name}", name, F.length(value) > longest))
        if type_name != "string":
            checks.append(Check(f"type_{name}", name, value.isNotNull() & value.try_cast(type_name).isNull()))
        if name in CONTRACT_VALUES:
            checks.append(Check(f"allowed_{name}", name, ~value.isin(CONTRACT_VALUES[name])))
    if "zip_code" in df.columns:
        checks.append(matches("zip_code", ZIP_PLUS4))
    return evaluate(df, table, checks)


def contract_quality(df: DataFrame, table: str, as_of: Column) -> DataFrame:
    """Completeness, accuracy, uniqueness and consistency rules of the contract."""
    born, start = F.col("dob").try_cast("date"), F.col("effective_date").try_cast("date")
    end = F.nullif(F.col("termination_date"), F.lit("Active")).try_cast("date")
    child = F.col("covered_relation") == "Child"
    checks = [completeness(c, ratio, fatal) for c, (ratio, fatal) in CONTRACT_COMPLETENESS.items()]
    checks += [
        row_rule("dob_plausible", "dob", (born <= as_of) & (born >= F.add_months(as_of, -120 * 12))),
        matches("zip_code", ZIP_PLUS4),
        row_rule("effective_not_future", "effective_date", start <= as_of),
        row_rule("termination_after_effective", "termination_date", end >= start),
        row_rule("child_under_26_at_start", "covered_relation", ~child | (age(born, start) < 26)),
        row_rule("child_under_26", "covered_relation", ~child | (age(born, as_of) < 26)),
        row_rule(
            "plan_metal_alignment", "metal_level",
            F.when(F.upper("plan_type").isin("HMO", "EPO"), F.col("metal_level").isin("Silver", "Gold"))
            .when(F.upper("plan_type") == "HDHP", F.col("metal_level") == "Bronze").otherwise(True),
            "warning",
        ),
    ]
    if "subscriber_id" in df.columns:
        checks.append(row_rule(
            "dependent_has_subscriber", "subscriber_id",
            (F.col("covered_relation") == "Self") | ~missing("subscriber_id"),
        ))
    return suite(evaluate(df, table, checks), unique(df, table, ["mem_id"], "fatal"))
