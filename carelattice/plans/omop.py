"""Clinical records to the OMOP common data model. Load stamps are left to the writer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.functions import columns as c
from carelattice.operators.joins import prefix_lookup
from carelattice.operators.skew import ordinal
from carelattice.sources import seeds

EHR_TYPE = 32827


def null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def omop_person(patients: DataFrame) -> DataFrame:
    gender = F.upper("gender")
    born = F.col("birthdate").cast("date")
    return patients.select(
        c.surrogate_id("patient_id").alias("person_id"),
        F.col("patient_id").alias("person_source_value"),
        F.when(gender == "M", 8507).when(gender == "F", 8532).otherwise(0).alias("gender_concept_id"),
        gender.alias("gender_source_value"),
        born.alias("birth_datetime"),
        F.year(born).alias("year_of_birth"),
        F.month(born).alias("month_of_birth"),
        F.dayofmonth(born).alias("day_of_birth"),
        F.lit(0).alias("race_concept_id"),
        null("string").alias("race_source_value"),
        F.lit(0).alias("ethnicity_concept_id"),
        null("string").alias("ethnicity_source_value"),
        null("long").alias("location_id"),
        null("long").alias("provider_id"),
        null("long").alias("care_site_id"),
    )


def omop_visit(encounters: DataFrame) -> DataFrame:
    concepts = [F.lit(x) for pair in seeds.OMOP_VISIT_CONCEPT.items() for x in pair]
    concept = F.coalesce(F.create_map(*concepts)[F.upper("encounterclass")], F.lit(0))
    start, stop = F.col("start"), F.col("stop")
    return encounters.select(
        c.surrogate_id("encounter_id").alias("visit_occurrence_id"),
        c.surrogate_id("patient_id").alias("person_id"),
        concept.alias("visit_concept_id"),
        start.cast("date").alias("visit_start_date"),
        start.cast("timestamp").alias("visit_start_datetime"),
        stop.cast("date").alias("visit_end_date"),
        stop.cast("timestamp").alias("visit_end_datetime"),
        F.lit(EHR_TYPE).alias("visit_type_concept_id"),
        null("long").alias("provider_id"),
        null("long").alias("care_site_id"),
        F.col("encounter_id").alias("visit_source_value"),
        F.col("encounterclass").alias("visit_source_label"),
        F.col("description").alias("visit_source_description"),
        null("int").alias("admitted_from_concept_id"),
        null("string").alias("admitted_from_source_value"),
        null("int").alias("discharged_to_concept_id"),
        null("string").alias("discharged_to_source_value"),
    )


def ccs_category(code: Column | str) -> Column:
    return F.coalesce(prefix_lookup(c.column(code), seeds.prefix_categories()), F.lit("unmapped"))


def omop_condition(conditions: DataFrame, hot: list[int] | None = None) -> DataFrame:
    rows = conditions.select(
        "patient_id",
        F.col("start").cast("date").alias("condition_start_date"),
        F.col("code").alias("condition_source_value"),
        F.nullif(F.col("stop"), F.lit("")).cast("date").alias("condition_end_date"),
        F.col("description").alias("condition_source_label"),
    )
    key = ["patient_id", "condition_start_date", "condition_source_value"]
    numbered = ordinal(rows, key, "_n", hot)
    return numbered.select(
        c.surrogate_id(*key, "_n").alias("condition_occurrence_id"),
        c.surrogate_id("patient_id").alias("person_id"),
        c.surrogate_id("condition_source_value").alias("condition_concept_id"),
        "condition_start_date",
        F.col("condition_start_date").cast("timestamp").alias("condition_start_datetime"),
        "condition_end_date",
        F.col("condition_end_date").cast("timestamp").alias("condition_end_datetime"),
        F.lit(EHR_TYPE).alias("condition_type_concept_id"),
        null("string").alias("stop_reason"),
        null("long").alias("provider_id"),
        null("long").alias("visit_occurrence_id"),
        "condition_source_value",
        "condition_source_label",
        ccs_category("condition_source_value").alias("ccs_category"),
    )


def omop_drug(medications: DataFrame, hot: list[int] | None = None) -> DataFrame:
    code = F.nullif(F.col("code"), F.lit(""))
    rows = medications.filter(code.isNotNull()).select(
        "patient_id",
        F.col("start").cast("date").alias("drug_exposure_start_date"),
        code.alias("drug_source_value"),
        F.col("stop").cast("date").alias("drug_exposure_end_date"),
        F.col("start").cast("timestamp").alias("drug_exposure_start_datetime"),
        F.coalesce("stop", "start").cast("timestamp").alias("drug_exposure_end_datetime"),
        F.coalesce("description", F.lit("")).alias("drug_source_label"),
        F.lower("reasondescription").alias("reason_description"),
    )
    key = ["patient_id", "drug_exposure_start_date", "drug_source_value"]
    numbered = ordinal(rows, key, "_n", hot)
    return numbered.select(
        c.surrogate_id(*key, "_n").alias("drug_exposure_id"),
        c.surrogate_id("patient_id").alias("person_id"),
        c.surrogate_id(F.lower("drug_source_value")).alias("drug_concept_id"),
        "drug_exposure_start_date",
        "drug_exposure_start_datetime",
        "drug_exposure_end_date",
        "drug_exposure_end_datetime",
        F.lit(EHR_TYPE).alias("drug_type_concept_id"),
        null("string").alias("stop_reason"),
        null("int").alias("refills"),
        null("double").alias("quantity"),
        null("int").alias("days_supply"),
        null("string").alias("sig"),
        null("int").alias("route_concept_id"),
        null("string").alias("lot_number"),
        null("long").alias("provider_id"),
        null("long").alias("visit_occurrence_id"),
        "drug_source_value",
        "drug_source_label",
        F.when(F.col("drug_source_value").rlike("^[0-9]+"), "rxcui_numeric")
        .otherwise("rxcui_other").alias("drug_code_type"),
        "reason_description",
    )


def omop_measurement(observations: DataFrame, when: str = "dt", hot: list[int] | None = None
                     ) -> DataFrame:
    code = F.nullif(F.col("code"), F.lit(""))
    rows = observations.select(
        "patient_id",
        F.col(when).cast("timestamp").alias("measurement_datetime"),
        code.alias("measurement_source_value"),
        F.coalesce("description", F.lit("")).alias("measurement_source_label"),
        F.col("value").try_cast("double").alias("value_as_number"),
        F.nullif(F.col("units"), F.lit("")).alias("unit_source_value"),
    ).filter(F.col("measurement_source_value").isNotNull() & F.col("value_as_number").isNotNull())
    key = ["patient_id", "measurement_datetime", "measurement_source_value"]
    numbered = ordinal(rows, key, "_n", hot)
    stamp = F.date_format("measurement_datetime", "yyyy-MM-dd HH:mm:ss")
    return numbered.select(
        c.surrogate_id("patient_id", stamp, "measurement_source_value", "_n").alias("measurement_id"),
        c.surrogate_id("patient_id").alias("person_id"),
        c.surrogate_id(F.lower("measurement_source_value")).alias("measurement_concept_id"),
        F.to_date("measurement_datetime").alias("measurement_date"),
        "measurement_datetime",
        F.hour("measurement_datetime").alias("measurement_time"),
        "value_as_number",
        F.lit(0).alias("unit_concept_id"),
        "unit_source_value",
        F.lit(0).alias("measurement_type_concept_id"),
        null("int").alias("operator_concept_id"),
        null("int").alias("value_as_concept_id"),
        null("double").alias("range_low"),
        null("double").alias("range_high"),
        null("long").alias("provider_id"),
        null("long").alias("visit_occurrence_id"),
        "measurement_source_value",
        "measurement_source_label",
        c.classify_text("measurement_source_label", c.MEASUREMENT_RULES, "other")
        .alias("measurement_category"),
    )
