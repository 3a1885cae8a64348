"""Clinical marts over the OMOP tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.functions import columns as c
from carelattice.operators.windows import covered_days


def medication_adherence(drugs: DataFrame, min_window: int = 30, method: str = "sum") -> DataFrame:
    """Proportion of days covered per person and drug.

    ``sum`` adds up the days of all fills; ``union`` counts a day once when fills overlap.
    """
    end = F.coalesce("drug_exposure_end_date", "drug_exposure_start_date")
    fills = drugs.filter(F.col("drug_exposure_start_date").isNotNull()).select(
        "person_id", "drug_source_value", "drug_source_label", "drug_exposure_start_date",
        end.alias("last_day"),
        F.greatest(F.datediff(end, "drug_exposure_start_date"), F.lit(0)).alias("days_on_hand"),
    )
    key = ["person_id", "drug_source_value"]
    totals = fills.groupBy(*key).agg(
        F.min("drug_source_label").alias("drug_source_label"),
        F.count(F.lit(1)).alias("fill_count"),
        F.min("drug_exposure_start_date").alias("first_fill_date"),
        F.max("last_day").alias("last_fill_end_date"),
        F.sum("days_on_hand").alias("total_days_on_hand"),
    )
    if method == "union":
        covered = covered_days(fills, key, "drug_exposure_start_date", "last_day")
        totals = (
            totals.drop("total_days_on_hand")
            .join(covered, key, "left")
            .withColumn("total_days_on_hand", F.coalesce("covered_days", F.lit(0).cast("long")))
        )
    window = F.greatest(F.datediff("last_fill_end_date", "first_fill_date"), F.lit(1))
    share = F.col("total_days_on_hand").cast("double") / F.col("observation_window_days")
    return (
        totals.withColumn("observation_window_days", window)
        .filter(F.col("observation_window_days") >= min_window)
        .select(
            *key, "drug_source_label", "fill_count", "first_fill_date", "last_fill_end_date",
            "total_days_on_hand", "observation_window_days",
            F.least(
                c.exact_mean(F.col("total_days_on_hand"), F.col("observation_window_days"), 4), F.lit(1.0)
            ).alias("pdc_score"),
            F.when(share >= 0.8, "adherent").when(share >= 0.6, "partially_adherent")
            .otherwise("non_adherent").alias("adherence_category"),
        )
    )


def condition_drug_pairs(conditions: DataFrame, drugs: DataFrame, days: int = 90) -> DataFrame:
    """Drugs started within ``days`` after a condition began, per person, condition and drug.

    The pairs of single records are never built. Onsets are reduced to sets of days per
    person, condition and calendar bucket (at most two bucket widths of days each), fills to
    one row per person, drug and day; a fill looks into the one set of its bucket. The join
    key (person, bucket) spreads a person with very many records over the calendar.
    """
    width = days + 1
    onset_day = F.unix_date("condition_start_date")
    onsets = (
        conditions.filter(F.col("condition_start_date").isNotNull())
        .select("person_id", "condition_source_value", "ccs_category", onset_day.alias("onset"))
        .distinct()
        .withColumn(
            "bucket",
            F.explode(F.sequence(F.floor(F.col("onset") / width), F.floor((F.col("onset") + days) / width))),
        )
        .groupBy("person_id", "bucket", "condition_source_value", "ccs_category")
        .agg(F.collect_set("onset").alias("onsets"))
    )
    fill_day = F.unix_date("drug_exposure_start_date")
    fills = (
        drugs.filter(F.col("drug_exposure_start_date").isNotNull())
        .groupBy("person_id", "drug_source_value", fill_day.alias("filled"))
        .agg(
            F.count(F.lit(1)).alias("fills"),  # drug_exposure_id is unique
            F.min("drug_source_label").alias("label"),
        )
        .withColumn("bucket", F.floor(F.col("filled") / width))
    )
    near = F.filter("onsets", lambda d: (d <= F.col("filled")) & (d >= F.col("filled") - days))
    matched = (
        fills.join(onsets, ["person_id", "bucket"])
        .withColumn("first_onset", F.array_min(near))
        .filter(F.col("first_onset").isNotNull())
    )
    grouped = matched.groupBy(
        "person_id", "condition_source_value",
        F.col("ccs_category").alias("condition_ccs_category"), "drug_source_value",
    ).agg(
        F.min("label").alias("drug_source_label"),
        F.min("first_onset").alias("onset"),
        F.min("filled").alias("filled"),
        F.sum("fills").alias("drug_fills_for_condition"),
    )
    lag = F.col("filled") - F.col("onset")
    return grouped.select(
        "person_id", "condition_source_value", "condition_ccs_category", "drug_source_value",
        "drug_source_label",
        F.date_from_unix_date("onset").alias("first_condition_onset"),
        F.date_from_unix_date("filled").alias("first_drug_for_condition"),
        lag.alias("days_from_onset_to_drug"),
        "drug_fills_for_condition",
        c.bucket(lag, *c.TREATMENT_LAG, closed="right").alias("treatment_lag_bucket"),
    )


def drug_utilisation(drugs: DataFrame) -> DataFrame:
    """Volume by drug class: exposures, persons, distinct drugs."""
    per_person = drugs.groupBy("drug_code_type", "drug_source_value", "person_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_person.groupBy("drug_code_type").agg(
        F.sum("n").alias("exposures"),
        F.countDistinct("person_id").alias("persons"),
        F.countDistinct("drug_source_value").alias("drugs"),
    )


def visit_summary(visits: DataFrame) -> DataFrame:
    """Visits, share of all visits and mean length of stay per visit type."""
    stay = F.datediff("visit_end_date", "visit_start_date")
    total = visits.agg(F.count(F.lit(1))).scalar()
    return visits.groupBy("visit_concept_id").agg(
        F.count(F.lit(1)).alias("visits"), F.avg(stay).alias("mean_days")
    ).select(
        "visit_concept_id", "visits",
        F.round(F.col("visits") * 100 / total, 2).alias("pct_of_visits"),
        F.round("mean_days", 4).alias("avg_los_days"),
    )


def patient_characteristics(person: DataFrame, as_of: Column) -> DataFrame:
    band = c.bucket(F.year(as_of) - F.col("year_of_birth"), *c.PREVALENCE_AGE)
    return person.groupBy(band.alias("age_bucket"), "gender_concept_id").agg(
        F.count(F.lit(1)).alias("persons")
    )
