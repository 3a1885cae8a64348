"""Point-in-time features and the readmission model."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from carelattice.ml import features as f
from carelattice.ml import readmission as r
from carelattice.operators import skew
from suite import features as suite_features

SF = "/root/testdata/sf0.001"
T = datetime.datetime

PERSON = [(1, 1950, 8507, 0), (2, None, 8532, 0)]
VISITS = [
    (1, 11, T(2024, 1, 1), T(2024, 1, 5), 9201), (1, 12, T(2024, 1, 20), T(2024, 1, 22), 9203),
    (1, 13, T(2024, 6, 1), T(2024, 6, 2), 9202), (2, 21, T(2024, 3, 1), T(2024, 3, 2), 9201),
    (3, 31, T(2024, 3, 1), T(2024, 3, 2), 9201),
]
CONDITIONS = [
    (1, T(2023, 1, 1), "endocrine"), (1, T(2024, 1, 5), "circulatory"), (1, T(2024, 1, 6), "endocrine"),
    (1, T(2024, 5, 1), "skin"), (2, T(2025, 1, 1), "endocrine"),
]
DRUGS = [(1, T(2023, 12, 31)), (1, T(2024, 1, 22)), (1, T(2024, 2, 1))]
READINGS = [(1, T(2024, 1, 5), 70.0), (1, T(2024, 1, 22), 90.0), (1, T(2024, 1, 23), 200.0), (1, T(2023, 1, 1), 10.0)]


def tables(spark):
    readings = spark.createDataFrame(READINGS, "person_id long, ts timestamp, heart_rate double").withColumns(
        {"spo2": F.lit(None).cast("double"), "systolic": F.lit(None).cast("double")})
    return (
        spark.createDataFrame(PERSON, "person_id long, year_of_birth int, gender_concept_id int, race_concept_id int"),
        spark.createDataFrame(VISITS, "person_id long, visit_occurrence_id long, visit_start_datetime timestamp, "
                                      "visit_end_datetime timestamp, visit_concept_id int"),
        spark.createDataFrame(CONDITIONS, "person_id long, condition_start_datetime timestamp, ccs_category string"),
        spark.createDataFrame(DRUGS, "person_id long, drug_exposure_start_datetime timestamp"),
        readings,
    )


def check(rows):
    got = {row.visit_occurrence_id: row for row in rows}
    assert set(got) == {11, 12, 13, 21}  # the visit of an unknown person drops out
    a, b, c, d = got[11], got[12], got[13], got[21]
    assert (a.label, b.label, c.label, d.label) == (1, 0, 0, 0)
    assert (a.feature_total_visits, b.feature_total_visits, c.feature_total_visits) == (0, 1, 2)
    assert (a.feature_days_since_last, b.feature_days_since_last, c.feature_days_since_last) == (9999, 17, 132)
    assert (b.feature_mean_los_days, c.feature_mean_los_days, c.feature_last_visit_type) == (4.0, 3.0, 9203)
    assert (c.feature_visits_90d, c.feature_visits_180d, c.feature_visits_365d) == (0, 2, 2)
    # facts at the instant of discharge are not yet known, readings are
    assert (a.feature_total_conditions, a.feature_chronic_conditions, a.feature_distinct_ccs) == (1, 1, 1)
    assert (b.feature_total_conditions, b.feature_chronic_conditions, b.feature_distinct_ccs) == (3, 3, 2)
    assert (c.feature_total_conditions, c.feature_chronic_conditions, c.feature_distinct_ccs) == (4, 3, 3)
    assert (a.feature_total_drugs, b.feature_total_drugs, c.feature_total_drugs) == (1, 1, 3)
    assert (a.feature_mean_hr_30d, b.feature_mean_hr_30d, c.feature_mean_hr_30d) == (70.0, 80.0, 0.0)
    assert (a.feature_age, d.feature_age) == (74, 74)


def test_discharge_features(spark):
    check(f.discharge_features(*tables(spark)).collect())


def test_discharge_features_when_all_keys_are_hot(spark, every_key_hot):
    check(f.discharge_features(*tables(spark)).collect())


def test_one_question_a_discharge_on_the_timeline(spark, monkeypatch):
    """Hot persons are counted once, and of a visit's rows only the discharge itself and three ends of lookbacks."""
    seen, counts = [], []
    ordered, keys = f.ordered_columns, skew.hot_keys

    def counted(*args, **more):
        counts.append(args[1])
        return keys(*args, **more)

    monkeypatch.setattr(f, "ordered_columns", lambda df, *args, **more: seen.append(df) or ordered(df, *args, **more))
    monkeypatch.setattr(f, "hot_keys", counted)
    monkeypatch.setattr(skew, "hot_keys", counted)
    person, visits, conditions, drugs, readings = tables(spark)
    none = [t.limit(0) for t in (conditions, drugs, readings)]
    assert f.discharge_features(person, visits, *none).count() == 4
    assert counts == [["person_id"]]
    assert seen[-1].count() == 4 * 4


def test_repeated_visits_and_both_ends_of_the_windows(spark):
    person, visits, conditions, drugs, readings = tables(spark)
    edges = spark.createDataFrame(
        [(1, 90, T(2023, 1, 1), T(2023, 1, 1), 9201), (1, 91, T(2023, 4, 1), T(2023, 4, 1), 9201),
         (1, 92, T(2023, 4, 1, 0, 0, 1), T(2023, 4, 1, 0, 0, 1), 9201)], visits.schema)
    read = spark.createDataFrame([(1, T(2023, 3, 2), 50.0, None, None), (1, T(2023, 4, 1), 70.0, None, None)], readings.schema)
    rows = {r_.visit_occurrence_id: r_ for r_ in f.discharge_features(
        person, edges.union(edges.filter("visit_occurrence_id = 92")), conditions.limit(0), drugs.limit(0), read).collect()}
    assert set(rows) == {90, 91, 92}
    # 90 days and 30 days before, to the second, lie within; a second more does not
    assert (rows[91].feature_visits_90d, rows[91].feature_mean_hr_30d) == (1, 60.0)
    assert (rows[92].feature_visits_90d, rows[92].feature_visits_180d, rows[92].feature_mean_hr_30d) == (1, 2, 70.0)


def test_no_future_fact_changes_a_feature(spark):
    person, visits, conditions, drugs, readings = tables(spark)
    cut = T(2024, 1, 22)
    known = f.discharge_features(
        person, visits, conditions.filter(F.col("condition_start_datetime") < cut),
        drugs.filter(F.col("drug_exposure_start_datetime") < cut), readings.filter(F.col("ts") <= cut))
    full = f.discharge_features(*tables(spark))
    pick = lambda df: df.filter("visit_occurrence_id in (11, 12)").orderBy("visit_occurrence_id").collect()
    assert pick(known) == pick(full)


def test_current_features_equal_a_discharge_at_that_moment(spark):
    person, visits, conditions, drugs, readings = tables(spark)
    now = T(2024, 7, 1)
    probe = spark.createDataFrame([(1, 99, now, now, 0)], visits.schema)
    offline = f.discharge_features(person, visits.union(probe), conditions, drugs, readings).filter(
        "visit_occurrence_id = 99").select("person_id", *f.FEATURES).first()
    online = f.current_features(person, visits, conditions, drugs, readings, as_of=F.lit(now), live_hours=24 * 30).filter(
        "person_id = 1").select("person_id", *f.FEATURES).first()
    assert offline == online


def test_one_row_per_visit(spark):
    features = suite_features.discharge_features(spark, SF)
    visits = suite_features.visit_history(spark, SF)
    assert features.count() == visits.count() == features.select("visit_occurrence_id").distinct().count()


def synthetic(spark, n=1000, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        visits, chronic = rng.randint(0, 8), rng.randint(0, 5)
        risk = 1 / (1 + 2.718 ** -(0.5 * visits + 0.4 * chronic - 3))
        rows.append((i, T(2024, 1, 1) + datetime.timedelta(hours=rng.randint(0, 9000)), int(rng.random() < risk), visits, chronic))
    return spark.createDataFrame(rows, "visit_occurrence_id long, discharge_time timestamp, label int, "
                                       "feature_total_visits long, feature_chronic_conditions long")


def test_temporal_split_is_exact(spark):
    parted = r.temporal_split(synthetic(spark))
    sizes = {row.is_test: (row.n, row.lo, row.hi) for row in parted.groupBy("is_test").agg(
        F.count("*").alias("n"), F.min("discharge_time").alias("lo"), F.max("discharge_time").alias("hi")).collect()}
    assert (sizes[False][0], sizes[True][0]) == (800, 200)
    assert sizes[False][2] <= sizes[True][1]


@pytest.fixture(scope="module")
def trained(spark):
    return r.evaluate(synthetic(spark), r.TrainConfig(trees=10, depth=3))


def test_boosting_stops_early_and_keeps_the_floor(spark, tmp_path):
    cfg = r.TrainConfig(trees=60, depth=3, learning_rate=0.3)
    model, parted = r.fit(synthetic(spark), cfg)
    metrics = r.binary_metrics(r.score(model, parted.filter("is_test"))).first()
    assert 1 <= model.getNumTrees < 60
    assert metrics.roc_auc > 0.55 and 0 < metrics.brier < 0.5
    run = r.record(model, parted, cfg).first()
    assert (run.training_rows, run.validation_rows, run.test_rows) == (640, 160, 200)
    assert run.training_until <= run.validation_until <= run.test_until
    assert (run.trees, run.stopped_early) == (model.getNumTrees, True)
    r.save(model, str(tmp_path / "m"), r.record(model, parted, cfg))
    assert spark.read.json(str(tmp_path / "m-record")).first().trees == r.load(str(tmp_path / "m")).getNumTrees


def test_without_a_validation_part_all_trees_grow(spark):
    model, parted = r.fit(synthetic(spark, 200), r.TrainConfig(trees=3, depth=2, validation_size=0.0))
    assert model.getNumTrees == 3 and parted.filter("is_validation").isEmpty()
    assert r.train(parted.drop("is_validation"), r.TrainConfig(trees=2, depth=2)).getNumTrees == 2


def test_model_beats_chance(trained):
    metrics = trained[1].first()
    assert metrics.roc_auc > 0.55 and 0 < metrics.brier < 0.5 and metrics.n == 200


def test_scores_bands_and_missing_features(spark, trained):
    model = trained[0]
    scored = r.score(model, synthetic(spark, 50).drop("feature_chronic_conditions")).collect()
    assert len(scored) == 50 and all(0 <= s.score <= 1 for s in scored)
    for s in scored:
        assert s.risk_band == ("low" if s.score < 0.1 else "medium" if s.score < 0.3 else "high")


def test_contributions_and_importances(spark, trained):
    model = trained[0]
    rows = r.local_contributions(model, synthetic(spark, 30), "visit_occurrence_id").collect()
    assert len(rows) == 30 and all(len(row.top_feature_contributions) == 5 for row in rows)
    importances = r.feature_importances(model)
    assert len(importances) == 18
    assert max(importances, key=importances.get) in ("feature_total_visits", "feature_chronic_conditions")


def test_model_survives_saving(spark, trained, tmp_path):
    r.save(trained[0], str(tmp_path / "m"))
    rows = synthetic(spark, 20)
    one, two = r.score(trained[0], rows), r.score(r.load(str(tmp_path / "m")), rows)
    assert sorted(x.score for x in one.collect()) == sorted(x.score for x in two.collect())


def counting(df):
    """The same rows, and a count of how many were built."""
    built = df.sparkSession.sparkContext.accumulator(0)

    def through(batches):
        for batch in batches:
            built.add(batch.num_rows)
            yield batch

    return df.mapInArrow(through, df.schema), built


def test_features_are_built_once_for_training_and_once_for_predictions(spark):
    rows, built = counting(synthetic(spark, 300))
    model, parted = r.fit(rows, r.TrainConfig(trees=2, depth=2))
    assert parted.count() == 300 and built.value == 300
    people, built = counting(synthetic(spark, 40).withColumnRenamed("visit_occurrence_id", "person_id"))
    table = r.prediction_table(model, people, F.lit(T(2024, 1, 1)), explain=True)
    assert table.count() == 40 and built.value == 40
    table.collect()
    assert built.value == 40
