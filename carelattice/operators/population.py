"""Cohorts, per-patient summaries and the eligibility questions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.functions.columns import missing
from carelattice.operators.joins import at_least
from carelattice.operators.windows import top_k_per_group


def cohort(
    tables: Mapping[str, DataFrame], as_of: Column, *, min_age: int | None = None,
    max_age: int | None = None, gender_concept_id: int | None = None,
    ccs_categories: Sequence[str] = (), drug_classes: Sequence[str] = (),
    measurement_categories: Sequence[str] = (), adherence_categories: Sequence[str] = (),
    min_pdc: float | None = None, min_visits: int = 0, min_drugs: int = 0,
    min_measurements: int = 0, states: Sequence[str] = (),
) -> DataFrame:
    """Persons that meet every given condition. ``tables`` holds person and, as needed,
    condition, drug, measurement, visit, adherence and roster.

    Each condition is a semi join on the persons that meet it; a person's facts are reduced
    to one row per person first.
    """
    people = tables["person"].select(
        "person_id", "person_source_value", "year_of_birth", "gender_concept_id"
    )
    if min_age is not None:
        people = people.filter(F.col("year_of_birth") <= F.year(as_of) - min_age)
    if max_age is not None:
        people = people.filter(F.col("year_of_birth") >= F.year(as_of) - max_age)
    if gender_concept_id is not None:
        people = people.filter(F.col("gender_concept_id") == gender_concept_id)

    def having(table: str, condition: Column) -> None:
        nonlocal people
        found = tables[table].filter(condition).select("person_id").distinct()
        people = people.join(found, "person_id", "left_semi")

    for table, column, values in (
        ("condition", "ccs_category", ccs_categories),
        ("drug", "drug_code_type", drug_classes),
        ("measurement", "measurement_category", measurement_categories),
        ("adherence", "adherence_category", adherence_categories),
    ):
        if values:
            having(table, F.col(column).isin(list(values)))
    if min_pdc is not None:
        having("adherence", F.col("pdc_score") >= min_pdc)
    for table, n in (("visit", min_visits), ("drug", min_drugs), ("measurement", min_measurements)):
        if n > 0:
            people = at_least(people, tables[table], "person_id", n)
    if states:
        home = tables["roster"].filter(F.col("state").isin(list(states)))
        home = home.select(F.col("member_id").alias("person_source_value")).distinct()
        people = people.join(home, "person_source_value", "left_semi")
    return people.select("person_id", "year_of_birth", "gender_concept_id")


def cohort_sample(people: DataFrame, n: int = 1000) -> DataFrame:
    return people.orderBy("person_id").limit(n)


def cohort_size(people: DataFrame) -> DataFrame:
    return people.agg(F.countDistinct("person_id").alias("cohort_size"))


def _recent_list(df: DataFrame, order: Sequence[str], fields: Sequence[str], k: int, name: str) -> DataFrame:
    """The k newest rows per person as an array, newest first."""
    newest = [F.col(order[0]).desc(), *[F.col(c) for c in order[1:]]]
    best = top_k_per_group(df, ["person_id"], newest, k, rank="_rank")
    rows = F.array_sort(F.collect_list(F.struct("_rank", *fields)))
    return best.groupBy("person_id").agg(F.transform(rows, lambda r: r.dropFields("_rank")).alias(name))


def patient_360(
    person: DataFrame, conditions: DataFrame, visits: DataFrame, vitals: DataFrame | None = None,
    predictions: DataFrame | None = None, *, as_of: Column,
) -> DataFrame:
    """One row per person: demographics, 20 latest conditions, 10 latest visits, 20 latest
    vitals, latest prediction. Each list is cut to its limit before it is collected."""
    out = person.select(
        "person_id", "person_source_value", "gender_concept_id", "year_of_birth", "race_concept_id",
        (F.year(as_of) - F.col("year_of_birth")).alias("age"),
    )
    out = out.join(_recent_list(
        conditions, ["condition_start_datetime", "condition_occurrence_id"],
        ["condition_concept_id", "condition_start_datetime"], 20, "conditions",
    ), "person_id", "left")
    out = out.join(_recent_list(
        visits, ["visit_start_datetime", "visit_occurrence_id"],
        ["visit_occurrence_id", "visit_start_datetime", "visit_end_datetime", "visit_concept_id"], 10, "visits",
    ), "person_id", "left")
    if vitals is not None:
        out = out.join(_recent_list(
            vitals, ["event_time", "offset"],
            ["event_time", "heart_rate_bpm", "spo2_pct", "systolic_bp_mmHg", "source"], 20, "recent_vitals",
        ), "person_id", "left")
    if predictions is not None:
        latest = predictions.groupBy("person_id").agg(
            F.max_by(F.struct("score", "risk_band", "valid_from"), "valid_from").alias("latest_prediction")
        )
        out = out.join(latest, "person_id", "left")
    empty = [c for c in ("conditions", "visits", "recent_vitals") if c in out.columns]
    return out.withColumns({c: F.coalesce(c, F.array()) for c in empty})


def recent_predictions(predictions: DataFrame, n: int = 200, ts: str = "valid_from",
                       tie: str = "person_id") -> DataFrame:
    return predictions.orderBy(F.col(ts).desc(), tie).limit(n)


def high_risk_board(predictions: DataFrame, n: int = 200, tie: str = "person_id") -> DataFrame:
    return predictions.filter(F.col("risk_band") == "high").orderBy(F.col("score").desc(), tie).limit(n)


# ---- eligibility questions -----------------------------------------------------------------


def missing_email_count(members: DataFrame) -> DataFrame:
    return members.agg(F.sum(missing("email").cast("long")).alias("members_missing_email"))


def largest_state(members: DataFrame) -> DataFrame:
    counts = members.groupBy("state").agg(F.count(F.lit(1)).alias("members"))
    return counts.orderBy(F.desc("members"), "state").limit(1)


REQUIRED = ("first_name", "last_name", "dob", "email", "phone", "address", "city", "state", "zip_code")


def most_missing_fields(members: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    gaps = sum((missing(c).cast("int") for c in REQUIRED), F.lit(0))
    scored = members.select(*dict.fromkeys(["mem_id", *order]), gaps.alias("missing_fields"))
    return scored.orderBy(F.desc("missing_fields"), *order).limit(n)


def children_over(members: DataFrame, as_of: Column, limit_age: int = 26) -> DataFrame:
    years = F.datediff(as_of, F.col("dob").try_cast("date")) / 365.25
    over = (F.col("covered_relation") == "Child") & (years > limit_age)
    return members.agg(F.sum(F.coalesce(over, F.lit(False)).cast("long")).alias("children_over_age"))


def short_zips(members: DataFrame) -> DataFrame:
    number = F.col("zip_code").try_cast("int")
    return members.filter((number > 0) & (number < 10000)).groupBy("zip_code").agg(
        F.count(F.lit(1)).alias("members")
    )


def duplicate_member_ids(members: DataFrame) -> DataFrame:
    return members.groupBy("mem_id").count().filter("count > 1").agg(
        F.count(F.lit(1)).alias("duplicate_ids"), F.sum("count").alias("affected_rows")
    )


def plan_breakdown(members: DataFrame) -> DataFrame:
    return members.groupBy(F.upper("plan_type").alias("plan_type")).agg(F.count(F.lit(1)).alias("members"))


def members_without_zip(members: DataFrame, state: str) -> DataFrame:
    """Members of a state whose ZIP is missing or has lost digits."""
    return members.filter(F.col("state") == state).filter(
        missing("zip_code") | (F.length(F.trim("zip_code")) < 5)
    )
