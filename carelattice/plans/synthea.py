"""Second clinical mapping: concept lookups and condition prevalence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carelattice.functions import columns as c
from carelattice.operators.windows import pct_of_total
from carelattice.sources import seeds


def _concept(value: Column, name: str) -> Column:
    """Fixed lookup table as a literal map; an unknown value gives NULL."""
    table = {
        "gender": seeds.GENDER_CONCEPT, "race": seeds.RACE_CONCEPT,
        "ethnicity": seeds.ETHNICITY_CONCEPT, "visit_class": seeds.VISIT_CLASS_CONCEPT,
    }[name]
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[value]


def synthea_person(patients: DataFrame, as_of: Column) -> DataFrame:
    born = F.col("birthdate").cast("date")
    return patients.select(
        c.surrogate_id("patient_id").alias("person_id"),
        F.col("patient_id").alias("person_source_value"),
        c.age(born, as_of, "completed").alias("age_year"),
        _concept(F.col("gender"), "gender").alias("gender_concept_id"),
        _concept(F.lower("race"), "race").alias("race_concept_id"),
        _concept(F.lower("ethnicity"), "ethnicity").alias("ethnicity_concept_id"),
        F.year(born).alias("year_of_birth"),
        F.date_format(born, "MM").alias("month_of_birth"),
        F.date_format(born, "dd").alias("day_of_birth"),
        "city", "state",
        F.col("zip").alias("zip_code"),
        F.col("deathdate").try_cast("date").alias("death_date"),
    )


def synthea_condition(conditions: DataFrame) -> DataFrame:
    """Conditions with standard and source concepts; one row out per row in."""
    rows = seeds.concept_rows()
    standard = F.create_map(*[F.lit(x) for code, a, _ in rows for x in (code, a)])
    source = F.create_map(*[F.lit(x) for code, _, b in rows for x in (code, b)])
    return conditions.select(
        F.col("patient_id").alias("person_source_value"),
        F.col("start").try_cast("date").alias("condition_start_date"),
        F.col("stop").try_cast("date").alias("condition_end_date"),
        standard[F.col("code")].alias("condition_concept_id"),
        source[F.col("code")].alias("condition_source_concept_id"),
        F.col("code").alias("condition_source_value"),
        F.lit("ICD10CM").alias("condition_type_concept_id"),
        F.lit(0).alias("condition_status_concept_id"),
    )


def synthea_visit(encounters: DataFrame) -> DataFrame:
    concept = _concept(F.col("encounterclass"), "visit_class")
    start, stop = F.col("start").cast("timestamp"), F.col("stop").cast("timestamp")
    whole_days = F.floor((F.unix_seconds(stop) - F.unix_seconds(start)) / 86400)
    return encounters.select(
        "encounter_id",
        "patient_id",
        concept.alias("visit_concept_id"),
        start.alias("visit_start_datetime"),
        stop.alias("visit_end_datetime"),
        F.coalesce(whole_days, F.lit(0)).cast("int").alias("visit_los"),
        F.col("description").alias("visit_description"),
        F.col("encounterclass").alias("visit_source_value"),
        F.when(concept == 9201, 32035).when(concept == 9203, 32036).otherwise(44814717)
        .alias("visit_type_concept_id"),
    )


def condition_prevalence(conditions: DataFrame, patients: DataFrame) -> DataFrame:
    """Patients and occurrences per code, age band, gender and state, with share and rank.

    Conditions are counted per patient, code and start day before the join, so a patient or a code with
    very many rows shrinks map-side; after it the distinct count is a plain count.
    """
    days = conditions.groupBy(
        "person_source_value", F.col("condition_source_value").alias("condition_code"), "condition_start_date"
    ).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("condition_end_date").isNull()).alias("open"))
    alive = F.col("death_date").isNull() | (F.col("condition_start_date") <= F.col("death_date"))
    dated = F.when(F.col("condition_start_date").isNotNull(), F.col("n"))
    per_patient = (
        days.join(patients.select("person_source_value", "death_date"), "person_source_value")
        .groupBy("person_source_value", "condition_code")
        .agg(
            F.sum("n").alias("occurrences"),
            F.sum(F.when(alive, F.col("open")).otherwise(0)).alias("active"),
            F.sum(F.dayofyear("condition_start_date") * F.col("n")).alias("doy_sum"),
            F.coalesce(F.sum(dated), F.lit(0)).alias("doy_n"),
        )
    )
    segments = patients.select(
        "person_source_value",
        F.coalesce(c.bucket(F.col("age_year"), *c.PREVALENCE_AGE), F.lit("75+")).alias("age_bucket"),
        F.when(F.col("gender_concept_id") == 8507, "Male")
        .when(F.col("gender_concept_id") == 8532, "Female").otherwise("Unknown").alias("gender"),
        "state",
    )
    cells = (
        per_patient.join(segments, "person_source_value")
        .groupBy("condition_code", "age_bucket", "gender", "state")
        .agg(
            F.count(F.lit(1)).alias("patient_count"),
            F.sum("occurrences").alias("total_occurrences"),
            F.sum("active").alias("active_count"),
            (F.sum("doy_sum") / F.sum("doy_n")).alias("avg_day_of_year"),
        )
    )
    shared = pct_of_total(cells, "patient_count", "pct_of_cohort")
    order = [F.col("patient_count").desc(), F.col("condition_code"), F.col("state")]
    rank = F.row_number().over(Window.partitionBy("age_bucket", "gender").orderBy(*order))
    return shared.select(
        "condition_code", "age_bucket", "gender", "state", "patient_count", "total_occurrences",
        "active_count", F.round("avg_day_of_year", 4).alias("avg_day_of_year"),
        F.round("pct_of_cohort", 4).alias("pct_of_cohort"), rank.alias("rank_in_segment"),
    )
