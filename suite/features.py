"""Features, training and scoring: queries and oracles."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from carelattice.functions import columns as c
from carelattice.functions.columns import as_of_date
from carelattice.ml import features as f
from carelattice.ml import readmission as r
from carelattice.operators import population
from carelattice.plans import omop
from carelattice.session import materialise
from suite import warehouse as w
from suite.views import AS_OF, load, view

oracle = w.oracle


def DAY():
    return as_of_date(AS_OF)


def heart(spark, sf):
    return f.readings_from_measurements(omop.omop_measurement(*load(spark, sf, "heart_rates")))


def parts(spark, sf):
    return (w.person(spark, sf), w.visit(spark, sf), w.condition(spark, sf), w.drug(spark, sf), heart(spark, sf))


def discharge_features(spark, sf):
    return f.discharge_features(*parts(spark, sf))


def current_features(spark, sf):
    return f.current_features(*parts(spark, sf), as_of=DAY(), live_hours=24 * 90)


def visit_history(spark, sf):
    return f.visit_history(w.visit(spark, sf).select(
        "person_id", "visit_occurrence_id", "visit_start_datetime", "visit_end_datetime", "visit_concept_id"))


def labels(spark, sf):
    return visit_history(spark, sf).select(
        "person_id", "visit_occurrence_id", f.readmission_label(30).alias("label"))


def temporal_split(spark, sf):
    rows = visit_history(spark, sf).select(
        "visit_occurrence_id", F.col("visit_end_datetime").alias("discharge_time"))
    return r.temporal_split(rows)


def binary_metrics(spark, sf):
    rows = r.binary_metrics(view(spark, sf, "scored"))
    return rows.select("n", "positives", *[F.round(c, 8).alias(c) for c in rows.columns[2:]])


def temporal_parts(spark, sf):
    rows = visit_history(spark, sf).select(
        "visit_occurrence_id", F.col("visit_end_datetime").alias("discharge_time"))
    return r.temporal_split(rows, validation_size=0.25)


@lru_cache(maxsize=2)
def fitted(spark, sf):
    """Model and split rows with the library's own configuration."""
    return r.fit(discharge_features(spark, sf))


def trained(spark, sf):
    model, parted = fitted(spark, sf)
    return model, r.binary_metrics(r.score(model, parted.filter("is_test")))


def training_record(spark, sf):
    """Rows and bounds of the three parts; that boosting stopped before its limit."""
    rows = r.record(*fitted(spark, sf))
    return rows.select(
        *[c_ for c_ in rows.columns if c_.endswith(("_rows", "_until"))], "tree_limit", "stopped_early",
        (F.col("trees") >= 1).alias("has_trees"))


def model_metrics(spark, sf):
    """Exact counts of the test part; whether every measure lies in its range."""
    rows = trained(spark, sf)[1]
    measures = [c_ for c_ in rows.columns if c_ not in ("n", "positives")]
    return rows.select("n", "positives", *[F.col(m).between(0.0, 1.0).alias(f"{m}_in_range") for m in measures])


def checked(predictions):
    """Keys and validity as they are; score, band, confidence and features as facts about them."""
    score = F.col("score")
    return predictions.select(
        "person_id", "prediction_type", "model_id", "model_version", "valid_from", "valid_until",
        F.array_join("features_used", ",").alias("features_used"), score.between(0.0, 1.0).alias("score_in_range"),
        (F.col("risk_band") == c.bucket(score, *c.RISK_BAND)).alias("band_fits"),
        (F.abs(F.col("confidence") - 2 * F.abs(score - 0.5)) < 1e-9).alias("confidence_fits"))


def predictions(spark, sf):
    model, _ = trained(spark, sf)
    table = materialise(r.prediction_table(model, current_features(spark, sf), DAY(), explain=True), "predictions")  # read twice
    explained = table.select("person_id", (F.size("top_feature_contributions") == 5).alias("explained"))
    return checked(table).join(explained, "person_id")


def importances(spark, sf):
    model, _ = trained(spark, sf)
    rows = spark.createDataFrame(list(r.feature_importances(model).items()), "feature string, importance double")
    total = rows.agg(F.sum("importance")).scalar()
    return rows.select("feature", F.col("importance").between(0.0, 1.0).alias("in_range"), (F.abs(total - 1) < 1e-6).alias("sum_is_one"))


def board(spark, sf):
    """Rule-scored visits stand in for predictions, so that the board has an oracle."""
    history = visit_history(spark, sf)
    score = (F.col("visit_occurrence_id") % 100) / 100
    return history.select(
        F.col("visit_occurrence_id").alias("person_id"), score.alias("score"),
        c.bucket(score, *c.RISK_BAND).alias("risk_band"), F.col("visit_end_datetime").alias("valid_from"))


QUERIES = {
    "recent_predictions": lambda s, d: population.recent_predictions(board(s, d)),
    "high_risk_board": lambda s, d: population.high_risk_board(board(s, d)),
    "discharge_features": discharge_features,
    "current_features": current_features,
    "prior_event_windows": visit_history,
    "readmission_label": labels,
    "temporal_split": temporal_split,
    "temporal_parts": temporal_parts,
    "training_record": training_record,
    "binary_metrics": binary_metrics,
    "model_metrics": model_metrics,
    "prediction_table": predictions,
    "feature_importances": importances,
}

CHRONIC = ", ".join(f"'{c}'" for c in f.CHRONIC)
SEC = "epoch({})::bigint"
HISTORY = """select person_id, visit_occurrence_id, visit_start_datetime, visit_end_datetime, visit_concept_id,
    row_number() over o - 1 as prior_visits,
    coalesce(sum(epoch(visit_end_datetime)::bigint - epoch(visit_start_datetime)::bigint) over b, 0)::bigint as prior_stay,
    max(visit_end_datetime) over b as prior_end,
    lag(visit_concept_id) over o as prior_type, lead(visit_start_datetime) over o as next_start
  from o_visit
  window o as (partition by person_id order by visit_start_datetime, visit_occurrence_id),
    b as (partition by person_id order by visit_start_datetime, visit_occurrence_id
          rows between unbounded preceding and 1 preceding)"""


def finish(moment: str, key: str, label: str) -> str:
    """The 18 features from a row that carries the raw counts."""
    mean = w.exact_mean
    return f"""select person_id, {key} {label} {moment} as discharge_time,
      greatest(year({moment}) - coalesce(nullif(year_of_birth, 0), 1950), 0)::bigint as feature_age,
      gender_concept_id::bigint as feature_gender, race_concept_id::bigint as feature_race,
      prior_visits::bigint as feature_total_visits, v90::bigint as feature_visits_90d, v180::bigint as feature_visits_180d,
      v365::bigint as feature_visits_365d,
      least(coalesce(floor((epoch({moment}) - epoch(prior_end)) / 86400), 9999), 9999)::bigint as feature_days_since_last,
      case when prior_visits > 0 then {mean('prior_stay', 'prior_visits * 86400', 2)} else 0.0 end as feature_mean_los_days,
      coalesce(prior_type, 0)::bigint as feature_last_visit_type, conditions::bigint as feature_total_conditions,
      chronic::bigint as feature_chronic_conditions, ccs::bigint as feature_distinct_ccs, drugs::bigint as feature_total_drugs,
      case when hr_n > 0 then {mean('hr_sum', 'hr_n', 2)} else 0.0 end as feature_mean_hr_30d,
      0.0::double as feature_mean_spo2_30d, 0.0::double as feature_mean_sbp_30d, chronic::bigint as feature_charlson_proxy
    from raw"""


RAW_DISCHARGE = f"""select h.*, p.year_of_birth, p.gender_concept_id, p.race_concept_id,
    (select count(*) from history q where q.person_id = h.person_id and q.prior_visits < h.prior_visits
       and q.visit_start_datetime >= h.visit_end_datetime - interval 90 day) as v90,
    (select count(*) from history q where q.person_id = h.person_id and q.prior_visits < h.prior_visits
       and q.visit_start_datetime >= h.visit_end_datetime - interval 180 day) as v180,
    (select count(*) from history q where q.person_id = h.person_id and q.prior_visits < h.prior_visits
       and q.visit_start_datetime >= h.visit_end_datetime - interval 365 day) as v365,
    (select count(*) from o_condition c where c.person_id = h.person_id
       and c.condition_start_datetime < h.visit_end_datetime) as conditions,
    (select count(*) from o_condition c where c.person_id = h.person_id
       and c.condition_start_datetime < h.visit_end_datetime and c.ccs_category in ({CHRONIC})) as chronic,
    (select count(distinct c.ccs_category) from o_condition c where c.person_id = h.person_id
       and c.condition_start_datetime < h.visit_end_datetime) as ccs,
    (select count(*) from o_drug d where d.person_id = h.person_id
       and d.drug_exposure_start_datetime < h.visit_end_datetime) as drugs,
    (select sum(m.value_as_number::decimal(18,6)) from o_heart m where m.person_id = h.person_id and m.measurement_category = 'vitals_hr'
       and m.measurement_datetime between h.visit_end_datetime - interval 30 day and h.visit_end_datetime) as hr_sum,
    (select count(*) from o_heart m where m.person_id = h.person_id and m.measurement_category = 'vitals_hr'
       and m.measurement_datetime between h.visit_end_datetime - interval 30 day and h.visit_end_datetime) as hr_n
  from history h join o_person p on h.person_id = p.person_id"""
NOW = f"timestamp '{AS_OF} 00:00:00'"
RAW_CURRENT = f"""select p.person_id, p.year_of_birth, p.gender_concept_id, p.race_concept_id,
    coalesce(v.n, 0) as prior_visits, v.stay as prior_stay, v.last_end as prior_end, v.last_type as prior_type,
    coalesce(v.v90, 0) as v90, coalesce(v.v180, 0) as v180, coalesce(v.v365, 0) as v365,
    coalesce(c.n, 0) as conditions, coalesce(c.chronic, 0) as chronic, coalesce(c.ccs, 0) as ccs, coalesce(d.n, 0) as drugs,
    m.s as hr_sum, coalesce(m.n, 0) as hr_n
  from o_person p
    left join (select person_id, count(*) as n, sum(epoch(visit_end_datetime)::bigint - epoch(visit_start_datetime)::bigint) as stay,
        max(visit_end_datetime) as last_end, arg_max(visit_concept_id, (visit_start_datetime, visit_occurrence_id)) as last_type,
        count(*) filter (where visit_start_datetime >= {NOW} - interval 90 day) as v90,
        count(*) filter (where visit_start_datetime >= {NOW} - interval 180 day) as v180,
        count(*) filter (where visit_start_datetime >= {NOW} - interval 365 day) as v365
      from o_visit where visit_start_datetime < {NOW} group by 1) v on v.person_id = p.person_id
    left join (select person_id, count(*) as n, count(*) filter (where ccs_category in ({CHRONIC})) as chronic,
        count(distinct ccs_category) as ccs from o_condition where condition_start_datetime < {NOW} group by 1) c
      on c.person_id = p.person_id
    left join (select person_id, count(*) as n from o_drug where drug_exposure_start_datetime < {NOW} group by 1) d
      on d.person_id = p.person_id
    left join (select person_id, sum(value_as_number::decimal(18,6)) as s, count(*) as n from o_heart
      where measurement_datetime between {NOW} - interval 90 day and {NOW} group by 1) m on m.person_id = p.person_id"""

BOARD = """select visit_occurrence_id as person_id, (visit_occurrence_id % 100)::double / 100 as score,
    case when (visit_occurrence_id % 100)::double / 100 < 0.10 then 'low'
      when (visit_occurrence_id % 100)::double / 100 < 0.30 then 'medium' else 'high' end as risk_band,
    visit_end_datetime as valid_from from o_visit"""

USED = ",".join(sorted(f.FEATURES))
PREDICTED = f"""person_id, 'readmission_30d' as prediction_type, 'readmission_30d' as model_id, '1' as model_version,
    {NOW} as valid_from, {NOW} + interval 60 minute as valid_until, '{USED}' as features_used,
    true as score_in_range, true as band_fits, true as confidence_fits"""

ORACLES = {
    "model_metrics": oracle("""
        with known as (select h.*, case when epoch(next_start) - epoch(visit_end_datetime) <= 30 * 86400 then 1 else 0 end as label
          from history h join o_person p on h.person_id = p.person_id),
        tested as (select label from known qualify row_number() over (order by visit_end_datetime, visit_occurrence_id)
          > floor(count(*) over () * (1 - 0.2::double)))
        select count(*) as n, cast(sum(label) as bigint) as positives, true as roc_auc_in_range, true as average_precision_in_range,
          true as brier_in_range, true as f1_in_range, true as precision_in_range, true as recall_in_range, true as positive_rate_in_range
        from tested""", history=HISTORY),
    "prediction_table": oracle(f"select {PREDICTED}, true as explained from o_person"),
    "feature_importances": oracle(
        f"select unnest([{', '.join(repr(x) for x in f.FEATURES)}]) as feature, true as in_range, true as sum_is_one"),
    "recent_predictions": oracle("select * from board order by valid_from desc, person_id limit 200", board=BOARD),
    "high_risk_board": oracle(
        "select * from board where risk_band = 'high' order by score desc, person_id limit 200", board=BOARD),
    "discharge_features": oracle(
        finish("visit_end_datetime", "visit_occurrence_id,",
               "case when epoch(next_start) - epoch(visit_end_datetime) <= 30 * 86400 then 1 else 0 end as label,"),
        raw=RAW_DISCHARGE, history=HISTORY),
    "current_features": oracle(finish(NOW, "", ""), raw=RAW_CURRENT),
    "prior_event_windows": oracle("select * from history", history=HISTORY),
    "readmission_label": oracle("""
        select person_id, visit_occurrence_id,
          case when epoch(next_start) - epoch(visit_end_datetime) <= 30 * 86400 then 1 else 0 end as label
        from history""", history=HISTORY),
    "temporal_split": oracle("""
        select visit_occurrence_id, visit_end_datetime as discharge_time,
          row_number() over (order by visit_end_datetime, visit_occurrence_id) > floor((select count(*) from o_visit) * (1 - 0.2::double)) as is_test
        from o_visit"""),
    "temporal_parts": oracle("""
        with numbered as (select visit_occurrence_id, visit_end_datetime as discharge_time, count(*) over () as n,
          row_number() over (order by visit_end_datetime, visit_occurrence_id) as i from o_visit)
        select visit_occurrence_id, discharge_time, i > floor(n * (1 - 0.2::double)) as is_test,
          i <= floor(n * (1 - 0.2::double)) and i > floor(floor(n * (1 - 0.2::double)) * 0.75::double) as is_validation from numbered"""),
    "training_record": oracle("""
        with known as (select visit_end_datetime as t, count(*) over () as n,
          row_number() over (order by visit_end_datetime, visit_occurrence_id) as i
          from history h join o_person p on h.person_id = p.person_id),
        parts as (select t, case when i > floor(n * (1 - 0.2::double)) then 'test'
          when i > floor(floor(n * (1 - 0.2::double)) * (1 - 0.2::double)) then 'validation' else 'training' end as part from known)
        select count(*) filter (where part = 'training') as training_rows, count(*) filter (where part = 'validation') as validation_rows,
          count(*) filter (where part = 'test') as test_rows, max(t) filter (where part = 'training') as training_until,
          max(t) filter (where part = 'validation') as validation_until, max(t) filter (where part = 'test') as test_until,
          200 as tree_limit, true as stopped_early, true as has_trees from parts""", history=HISTORY),
    "binary_metrics": oracle("""
        with t as (select count(*) as n, sum(label)::double as p, count(*) - sum(label)::double as q from scored),
        ranks as (select score, label, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2.0::double as rk
          from scored),
        steps as (select score, sum(label)::double as pos, count(*)::double as n from scored group by 1),
        cum as (select *, sum(pos) over (order by score desc) as cp, sum(n) over (order by score desc) as cn from steps),
        hits as (select sum(case when score >= 0.5 then 1 else 0 end)::double as flagged,
          sum(case when score >= 0.5 then label else 0 end)::double as tp, avg((score - label) * (score - label)) as brier from scored)
        select n, cast(p as bigint) as positives,
          round((select (sum(rk) filter (where label = 1) - (select p * (p + 1) / 2 from t)) / (select p * q from t) from ranks), 8) as roc_auc,
          round((select sum(pos / (select p from t) * cp / cn) from cum), 8) as average_precision,
          round(brier, 8) as brier, round(2 * tp / (flagged + p), 8) as f1, round(tp / flagged, 8) as precision,
          round(tp / p, 8) as recall, round(p / n, 8) as positive_rate
        from t, hits"""),
}
