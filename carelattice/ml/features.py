"""Point-in-time features per discharge and per patient.

Everything a model sees about a discharge lies before it. Instead of a loop over patients
or a join of every discharge with every fact, facts and questions share one timeline per
patient: facts add to running counts, a question reads the counts at its moment. For a window
"last 90 days" a fact has a second row 90 days on, where it leaves the window, so that each
discharge asks once. The cost is linear in visits plus facts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.functions.columns import exact_mean, json_field
from carelattice.operators.skew import Running, hot_keys, ordered_columns

# Condition categories counted as chronic.
CHRONIC = [
    "endocrine", "circulatory", "respiratory", "digestive", "genitourinary", "musculoskeletal",
    "neoplasms", "mental_health",
]
FEATURES = [
    "feature_age", "feature_gender", "feature_race", "feature_total_visits", "feature_visits_90d",
    "feature_visits_180d", "feature_visits_365d", "feature_days_since_last", "feature_mean_los_days",
    "feature_last_visit_type", "feature_total_conditions", "feature_chronic_conditions",
    "feature_distinct_ccs", "feature_total_drugs", "feature_mean_hr_30d", "feature_mean_spo2_30d",
    "feature_mean_sbp_30d", "feature_charlson_proxy",
]
LOOKBACKS = (90, 180, 365)
NEVER = 9999
READINGS = {"hr": "heart_rate", "spo2": "spo2", "sbp": "systolic"}
DAY = 86400


def readings_from_measurements(measurements: DataFrame) -> DataFrame:
    """Heart rates of the measurement table as (person_id, ts, heart_rate). Readings may also
    have the columns spo2 and systolic; a column they lack gives the default feature."""
    return measurements.filter(F.col("measurement_category") == "vitals_hr").select(
        "person_id", F.col("measurement_datetime").alias("ts"),
        F.col("value_as_number").alias("heart_rate"),
    )


def readings_from_silver(vitals: DataFrame) -> DataFrame:
    """Readings of silver vitals rows: the person's surrogate key and the JSON payload."""
    return vitals.select(
        "person_id", F.col("event_time").alias("ts"),
        json_field("payload", "$.heart_rate_bpm", "double").alias("heart_rate"),
        json_field("payload", "$.spo2_pct", "double").alias("spo2"),
        json_field("payload", "$.systolic_bp_mmHg", "double").alias("systolic"),
    )


def visit_history(visits: DataFrame, hot: DataFrame | bool | None = None) -> DataFrame:
    """Each complete visit with what came before it and the start of the next one."""
    complete = visits.filter(
        F.col("visit_start_datetime").isNotNull() & F.col("visit_end_datetime").isNotNull()
    )
    stay = F.unix_seconds("visit_end_datetime") - F.unix_seconds("visit_start_datetime")
    return ordered_columns(
        complete, ["person_id"],
        [F.col("visit_start_datetime"), F.col("visit_occurrence_id")],
        running={
            "prior_visits": Running("rows", inclusive=False),
            "prior_stay": Running("sum", stay, inclusive=False),
            "prior_end": Running("max", F.col("visit_end_datetime"), inclusive=False),
        },
        framed={
            "prior_type": lambda w: F.lag("visit_concept_id").over(w),
            "next_start": lambda w: F.lead("visit_start_datetime").over(w),
        },
        before=1, after=1, hot=hot,
    )


def readmission_label(days: int = 30) -> Column:
    gap = F.unix_seconds("next_start") - F.unix_seconds("visit_end_datetime")
    return F.coalesce(gap <= days * DAY, F.lit(False)).cast("int")


MICRO = 1_000_000
COUNTS = ["conditions", "chronic", "ccs", "drugs"]
# Order at one instant: readings, the discharge, other facts and facts that leave a window.
READING, DISCHARGE, FACT = 0, 1, 2


def discharge_features(
    person: DataFrame, visits: DataFrame, conditions: DataFrame, drugs: DataFrame,
    readings: DataFrame, *, reading_days: int = 30, label_days: int = 30,
) -> DataFrame:
    """18 features and the label for every complete visit of a known person."""
    # Rows of the timeline at most: a visit's question and its ends of lookbacks, a condition and the first of its category,
    # a reading and its end. A few visits may have many readings.
    shares = [(visits, 1 + len(LOOKBACKS)), (conditions, 2), (drugs, 1), (readings, 2)]
    found = hot_keys(
        reduce(DataFrame.unionAll, [t.select("person_id", F.lit(n).alias("rows")) for t, n in shares]), ["person_id"], "rows")
    hot = False if found is None else found
    known = visits.select(
        "person_id", "visit_occurrence_id", "visit_start_datetime", "visit_end_datetime", "visit_concept_id"
    ).join(
        person.select("person_id", "year_of_birth", "gender_concept_id", "race_concept_id"), "person_id"
    )
    history = visit_history(known, hot)
    discharge = F.col("visit_end_datetime")
    carried = [c for c in history.columns if c != "person_id"]

    questions = history.select(
        "person_id", discharge.alias("ts"), F.lit(DISCHARGE).alias("ord"), F.col("visit_occurrence_id").alias("visit"),
        F.struct(*carried).alias("about"),
    )

    def later(ts: Column, days: int) -> Column:
        return ts + F.make_dt_interval(F.lit(days))

    def facts_of(df: DataFrame, ts: Column, order: int = FACT, **counts: Column) -> DataFrame:
        added = [value.cast("long").alias(name) for name, value in counts.items()]
        return df.select("person_id", ts.alias("ts"), F.lit(order).alias("ord"), *added).filter("ts is not null")

    onset = F.col("condition_start_datetime")
    first_seen = (
        conditions.filter(onset.isNotNull() & F.col("ccs_category").isNotNull())
        .groupBy("person_id", "ccs_category").agg(F.min(onset).alias("first_seen"))
    )
    given = {s: c for s, c in READINGS.items() if c in readings.columns}
    tallies = [*COUNTS, *[f"before_{d}" for d in LOOKBACKS], *[f"{s}_{k}" for s in given for k in ("sum", "n")]]
    read = {}
    for short, name in given.items():
        read[f"{short}_sum"] = F.round(F.col(name) * MICRO)
        read[f"{short}_n"] = F.col(name).isNotNull()
    started = F.col("visit_start_datetime")
    ends = history.select("person_id", F.inline(F.array(*[
        F.struct(later(started, d).alias("end"), *[F.lit(int(d == e)).alias(f"before_{e}") for e in LOOKBACKS]) for d in LOOKBACKS
    ])))
    parts = [
        facts_of(ends, F.col("end"), **{f"before_{d}": F.col(f"before_{d}") for d in LOOKBACKS}),
        facts_of(conditions, onset, conditions=F.lit(1), chronic=F.col("ccs_category").isin(CHRONIC)),
        facts_of(first_seen, F.col("first_seen"), ccs=F.lit(1)),
        facts_of(drugs, F.col("drug_exposure_start_datetime"), drugs=F.lit(1)),
        facts_of(readings, F.col("ts"), READING, **read),
        facts_of(readings, later(F.col("ts"), reading_days), **{name: -value.cast("long") for name, value in read.items()}),
    ]
    facts = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if found is not None:
        # A hot person's facts at one instant collapse before the shuffle.
        facts = facts.groupBy("person_id", "ts", "ord").agg(*[F.sum(t).alias(t) for t in tallies])
    timeline = questions.unionByName(facts, allowMissingColumns=True)
    counted = ordered_columns(
        timeline, ["person_id"],
        [F.col("ts"), F.col("ord"), F.col("visit")],
        running={f"r_{t}": Running("sum", F.col(t)) for t in tallies}, hot=hot,
    ).filter(F.col("about").isNotNull())
    # One row per visit, should its id come several times.
    answers = counted.groupBy("person_id", "visit").agg(
        F.min(F.struct("ts", "about")).alias("first"),
        F.max(F.struct("ts", *[F.col(f"r_{t}").alias(t) for t in tallies])).alias("last"),
    )
    flat = answers.select("person_id", "first.about.*", *[f"last.{t}" for t in tallies])
    within = {
        f"visits_{d}": F.greatest(F.col("prior_visits") - F.col(f"before_{d}"), F.lit(0)) for d in LOOKBACKS
    }
    return finish(
        flat.withColumns({**within, "moment": discharge, "label": readmission_label(label_days)}),
        ["visit_occurrence_id", "label"],
    )


def finish(df: DataFrame, keep: list[str]) -> DataFrame:
    """Raw counts at ``moment`` to the 18 features, with their defaults."""
    prior = F.col("prior_visits")
    idle = F.floor((F.unix_seconds("moment") - F.unix_seconds("prior_end")) / DAY)
    born = F.coalesce(F.nullif(F.col("year_of_birth"), F.lit(0)), F.lit(1950))
    mean = {
        s: F.coalesce(exact_mean(F.col(f"{s}_sum"), F.col(f"{s}_n") * MICRO, 2), F.lit(0.0))
        if f"{s}_n" in df.columns else F.lit(0.0)
        for s in READINGS
    }
    values = {
        "feature_age": F.greatest(F.year("moment") - born, F.lit(0)),
        "feature_gender": F.coalesce("gender_concept_id", F.lit(0)),
        "feature_race": F.coalesce("race_concept_id", F.lit(0)),
        "feature_total_visits": prior,
        **{f"feature_visits_{d}d": F.col(f"visits_{d}") for d in LOOKBACKS},
        "feature_days_since_last": F.least(F.coalesce(idle, F.lit(NEVER)), F.lit(NEVER)),
        "feature_mean_los_days": F.coalesce(exact_mean(F.col("prior_stay"), prior * DAY, 2), F.lit(0.0)),
        "feature_last_visit_type": F.coalesce("prior_type", F.lit(0)),
        "feature_total_conditions": F.col("conditions"),
        "feature_chronic_conditions": F.col("chronic"),
        "feature_distinct_ccs": F.col("ccs"),
        "feature_total_drugs": F.col("drugs"),
        "feature_mean_hr_30d": mean["hr"],
        "feature_mean_spo2_30d": mean["spo2"],
        "feature_mean_sbp_30d": mean["sbp"],
        "feature_charlson_proxy": F.col("chronic"),
    }
    whole = {k: v.cast("long") for k, v in values.items() if "mean" not in k}
    values |= whole
    return df.select("person_id", *keep, F.col("moment").alias("discharge_time"),
                     *[values[f].alias(f) for f in FEATURES])


def current_features(
    person: DataFrame, visits: DataFrame, conditions: DataFrame, drugs: DataFrame,
    readings: DataFrame, *, as_of: Column, live_hours: int = 24,
) -> DataFrame:
    """The same features for every person at one moment.

    With a single moment no ordering is needed: each table shrinks to one row per person
    before the join, which also absorbs a person with very many facts.
    """
    now = as_of.cast("timestamp")
    started, ended = F.col("visit_start_datetime"), F.col("visit_end_datetime")
    stay = F.unix_seconds(ended) - F.unix_seconds(started)
    past = visits.filter(started < now).groupBy("person_id").agg(
        F.count(F.lit(1)).alias("prior_visits"),
        F.sum(stay).alias("prior_stay"), F.max(ended).alias("prior_end"),
        F.max_by("visit_concept_id", F.struct(started, "visit_occurrence_id")).alias("prior_type"),
        *[F.count(F.when(started >= now - F.make_dt_interval(F.lit(d)), 1)).alias(f"visits_{d}") for d in LOOKBACKS],
    )
    noted = conditions.filter(F.col("condition_start_datetime") < now).groupBy("person_id", "ccs_category").agg(
        F.count(F.lit(1)).alias("n")
    ).groupBy("person_id").agg(
        F.sum("n").alias("conditions"),
        F.sum(F.when(F.col("ccs_category").isin(CHRONIC), F.col("n")).otherwise(0)).alias("chronic"),
        F.count("ccs_category").alias("ccs"),
    )
    filled = drugs.filter(F.col("drug_exposure_start_datetime") < now).groupBy("person_id").agg(
        F.count(F.lit(1)).alias("drugs")
    )
    recent = F.col("ts").between(now - F.make_dt_interval(F.lit(0), F.lit(live_hours)), now)
    read = readings.filter(recent).groupBy("person_id").agg(*[
        e for s, c in READINGS.items() if c in readings.columns for e in (
            F.sum(F.round(F.col(c) * MICRO).cast("long")).alias(f"{s}_sum"), F.count(c).alias(f"{s}_n"))
    ])
    rows = person.select("person_id", "year_of_birth", "gender_concept_id", "race_concept_id")
    for part in (past, noted, filled, read):
        rows = rows.join(part, "person_id", "left")
    counts = ["prior_visits", "conditions", "chronic", "ccs", "drugs", *[f"visits_{d}" for d in LOOKBACKS]]
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
    return finish(rows.withColumn("moment", now), [])
