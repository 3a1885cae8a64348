"""Readmission model: split, train, measure, score, explain."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.functions.columns import RISK_BAND, bucket, confidence, top_contributions
from carelattice.ml.features import FEATURES
from carelattice.operators.skew import Running, sliced_running
from carelattice.session import materialise


ROWS_PER_PART = 250_000


@dataclass(frozen=True)
class TrainConfig:
    """``trees`` is a limit: boosting stops once the loss on the validation part, the latest ``validation_size`` share
    of the training rows, improves by less than ``min_gain`` of itself. ``validation_size=0`` grows all trees."""

    trees: int = 200
    depth: int = 5
    learning_rate: float = 0.1
    min_rows_per_leaf: int = 10
    test_size: float = 0.2
    validation_size: float = 0.2
    min_gain: float = 0.001
    seed: int = 42


def feature_columns(df: DataFrame) -> list[Column]:
    """The features as doubles; a column the input lacks is 0, a missing value too."""
    return [
        (F.coalesce(F.col(f).cast("double"), F.lit(0.0)) if f in df.columns else F.lit(0.0)).alias(f)
        for f in FEATURES
    ]


def temporal_split(df: DataFrame, time: str = "discharge_time", tie: str = "visit_occurrence_id",
                   test_size: float = 0.2, validation_size: float | None = None) -> DataFrame:
    """Adds ``is_test``: true for the latest ``test_size`` share of the rows, cut exactly. With ``validation_size``
    also ``is_validation``: true for the latest such share of the other rows.

    Row numbers are made per range of rows and offset by the ranges before, so no task sees all rows.
    """
    numbered = sliced_running(df, [], [F.col(time), F.col(tie)], {"_row": Running("rows")}, "_all")
    cut = F.floor(F.col("_all") * (1 - test_size))
    parted = numbered.withColumn("is_test", F.col("_row") > cut)
    if validation_size is not None:
        parted = parted.withColumn("is_validation", ~F.col("is_test") & (F.col("_row") > F.floor(cut * (1 - validation_size))))
    return parted.drop("_row", "_all")


def training_parts(rows: int, cores: int) -> int:
    """Boosting holds its rows, which take far more memory than in their file: parts of a bounded number of rows, and
    work for all cores unless the rows are few."""
    return max(1, -(-rows // ROWS_PER_PART), min(cores, rows // 10_000))


def train(df: DataFrame, cfg: TrainConfig = TrainConfig()) -> GBTClassificationModel:
    """Boosted trees. Rows marked by a boolean column ``is_validation`` choose the number of trees and grow none; without
    the column, or where it is true nowhere, ``cfg.trees`` trees grow. ``model.getNumTrees`` tells how many were kept."""
    stops = "is_validation" in df.columns and not df.filter("is_validation").isEmpty()
    kept = [F.col("is_validation")] if stops else []
    vectors = df.select(F.col("label").cast("double").alias("label"), *kept, *feature_columns(df))
    vectors = vectors.repartition(training_parts(df.count(), df.sparkSession.sparkContext.defaultParallelism))
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(vectors)
    learner = GBTClassifier(
        maxIter=cfg.trees, maxDepth=cfg.depth, stepSize=cfg.learning_rate,
        minInstancesPerNode=cfg.min_rows_per_leaf, seed=cfg.seed, validationTol=cfg.min_gain,
    )
    if stops:
        learner = learner.setValidationIndicatorCol("is_validation")
    return learner.fit(assembled.select("features", "label", *kept))


def record(model: GBTClassificationModel, parted: DataFrame, cfg: TrainConfig = TrainConfig()) -> DataFrame:
    """One row about a training run: rows and latest time of each part, the limit of trees and the number kept."""
    part = F.when(F.col("is_test"), "test").when(F.col("is_validation"), "validation").otherwise("training")
    of = lambda name, value: F.when(part == name, value)
    names = ("training", "validation", "test")
    rows = parted.agg(
        *[F.count(of(n, F.lit(1))).alias(f"{n}_rows") for n in names],
        *[F.max(of(n, F.col("discharge_time"))).alias(f"{n}_until") for n in names])
    return rows.withColumns({
        "tree_limit": F.lit(cfg.trees), "trees": F.lit(model.getNumTrees), "stopped_early": F.lit(model.getNumTrees < cfg.trees),
        "depth": F.lit(cfg.depth), "learning_rate": F.lit(cfg.learning_rate), "min_gain": F.lit(cfg.min_gain), "seed": F.lit(cfg.seed)})


def save(model: GBTClassificationModel, path: str, run: DataFrame | None = None) -> None:
    """The model, and the record of its training run beside it."""
    model.write().overwrite().save(path)
    if run is not None:
        run.write.mode("overwrite").json(f"{path.rstrip('/')}-record")


def load(path: str) -> GBTClassificationModel:
    return GBTClassificationModel.load(path)


def score(model: GBTClassificationModel | PipelineModel, df: DataFrame) -> DataFrame:
    """Adds ``score`` (probability) and ``risk_band``."""
    packed = df.withColumn("features", array_to_vector(F.array(*feature_columns(df))))
    scored = model.transform(packed).withColumn("score", vector_to_array("probability")[1])
    return scored.select(*df.columns, "score", bucket(F.col("score"), *RISK_BAND).alias("risk_band"))


def binary_metrics(scored: DataFrame, label: str = "label", prob: str = "score") -> DataFrame:
    """ROC AUC, average precision, Brier, F1, precision, recall and positive rate in one row.

    Exact: rows collapse to one per distinct score, and the counts below a score are built
    per range of them, so neither a repeated score nor the global order needs one task.
    """
    y, p = F.col(label).cast("long"), F.col(prob)
    per_score = scored.groupBy(p.alias("s")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    ranked = sliced_running(
        per_score, [], [F.col("s")],
        {
            "pos_below": Running("sum", F.col("pos"), inclusive=False),
            "neg_below": Running("sum", F.col("neg"), inclusive=False),
        },
    )
    hit = (p >= 0.5).cast("long")
    totals = scored.agg(
        F.count(F.lit(1)).alias("n"), F.sum(y).alias("positives"),
        F.avg((p - y) * (p - y)).alias("brier"),
        F.sum(hit).alias("flagged"), F.sum(hit * y).alias("true_positives"),
    )
    positives = totals.select("positives").scalar().cast("double")
    negatives = totals.select(F.col("n") - F.col("positives")).scalar().cast("double")
    at_or_above = positives - F.col("pos_below")
    precision_at = at_or_above / (at_or_above + negatives - F.col("neg_below"))
    areas = ranked.agg(
        (F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg"))) / F.nullif(positives * negatives, F.lit(0.0)))
        .alias("roc_auc"),
        (F.sum(F.col("pos") * precision_at) / F.nullif(positives, F.lit(0.0))).alias("average_precision"),
    )
    ratio = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    return totals.select(
        "n", "positives",
        F.coalesce(areas.select("roc_auc").scalar(), F.lit(0.0)).alias("roc_auc"),
        F.coalesce(areas.select("average_precision").scalar(), F.lit(0.0)).alias("average_precision"),
        "brier",
        ratio(2 * F.col("true_positives"), F.col("flagged") + F.col("positives")).alias("f1"),
        ratio(F.col("true_positives"), F.col("flagged")).alias("precision"),
        ratio(F.col("true_positives"), F.col("positives")).alias("recall"),
        ratio(F.col("positives"), F.col("n")).alias("positive_rate"),
    )


def evaluate(features: DataFrame, cfg: TrainConfig = TrainConfig()) -> tuple[GBTClassificationModel, DataFrame]:
    """Train on the earlier part, measure on the later part."""
    model, parted = fit(features, cfg)
    return model, binary_metrics(score(model, parted.filter("is_test")))


def fit(features: DataFrame, cfg: TrainConfig = TrainConfig()) -> tuple[GBTClassificationModel, DataFrame]:
    """The model and the split rows (``is_test``, ``is_validation``), which are written once: training reads them many times.

    The features are written before the split as well: drawing its ranges reads the rows twice."""
    parted = materialise(temporal_split(materialise(features, "features"), test_size=cfg.test_size, validation_size=cfg.validation_size), "training")
    return train(parted.filter(~F.col("is_test")), cfg), parted


def local_contributions(model: GBTClassificationModel, df: DataFrame, key: str | Sequence[str], k: int = 5
                        ) -> DataFrame:
    """Per row the k features that move its score most when set to the population mean.

    This is single-feature ablation, not SHAP. Each row is scored once per feature where it stands: the variants are
    columns of the row, and no row is copied or moved.
    """
    keys = [key] if isinstance(key, str) else list(key)
    names = feature_columns(df)
    means = df.agg(F.array(*[F.avg(c) for c in names]).alias("m")).scalar()
    rows = score(model, df).select(*keys, F.col("score").alias("_full"), F.array(*names).alias("_x"), means.alias("_m"))
    for i in range(len(FEATURES)):
        swapped = F.transform("_x", lambda v, j: F.when(j == i, F.col("_m")[i]).otherwise(v))  # noqa: B023
        variant = model.copy({model.featuresCol: "_v", model.probabilityCol: "_p", model.rawPredictionCol: "", model.predictionCol: ""})
        rows = variant.transform(rows.withColumn("_v", array_to_vector(swapped)))
        rows = rows.withColumn(f"_e{i}", F.col("_full") - vector_to_array("_p")[1]).drop("_v", "_p")
    entries = F.array_sort(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"_e{i}").alias("effect")) for i, f in enumerate(FEATURES)]))
    return rows.select(*keys, top_contributions(F.map_from_entries(entries), k).alias("top_feature_contributions"))


def feature_importances(model: GBTClassificationModel) -> dict[str, float]:
    return dict(zip(FEATURES, (float(v) for v in model.featureImportances.toArray())))


def prediction_event(scored: DataFrame, as_of: Column, *, model_version: str = "1", valid_minutes: int = 60
                     ) -> DataFrame:
    """Scored rows as prediction events valid for ``valid_minutes``."""
    start = as_of.cast("timestamp")
    out = scored.select(
        F.col("person_id"), F.lit("readmission_30d").alias("prediction_type"),
        F.lit("readmission_30d").alias("model_id"), F.lit(model_version).alias("model_version"),
        "score", "risk_band", confidence(F.col("score")).alias("confidence"),
        F.array_sort(F.lit(FEATURES)).alias("features_used"),
        start.alias("valid_from"),
        (start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(valid_minutes))).alias("valid_until"),
        *[c for c in scored.columns if c == "top_feature_contributions"],
    )
    return out


def prediction_table(model: GBTClassificationModel, features: DataFrame, as_of: Column, *,
                     explain: bool = False, valid_minutes: int = 60) -> DataFrame:
    """One prediction per person. The features are written when explained: means, score and effects each read them."""
    if explain:
        features = materialise(features, "current-features")
    scored = score(model, features)
    if explain:
        scored = scored.join(local_contributions(model, features, "person_id"), "person_id")
    return prediction_event(scored, as_of, valid_minutes=valid_minutes)
