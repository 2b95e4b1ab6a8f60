"""Estimators, parameter search, cross-validation and model comparison."""
from __future__ import annotations

import itertools
import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, functions as F

from cardwatch.functions.random import uniform_of
from cardwatch.operators import evaluate
from cardwatch.operators.boosting import BINS, bin_edges, packed
from cardwatch.operators.forest import MOST_ROWS, ForestFit, columns_of_node, held_out_counts
from cardwatch.operators.resample import (
    balanced_weight, class_sizes, fold_split, smote, stratified_folds, upsample,
)
from cardwatch.plans.pipeline import (
    MODEL_COLUMNS, assembler, fit_features, model_table, scaling_stages,
)
from cardwatch.schema import LABEL
from cardwatch.session import discard, saved, without_summary

SEED = 42

# Search grids, in the order their points are numbered.
LOGISTIC_SEARCH = {"C": [0.01, 0.1, 1, 10], "penalty": ["l1", "l2"], "class_weight": ["balanced"]}
LOGISTIC_GRID = {"C": [0.1, 1, 10, 100], "penalty": ["l1", "l2"]}
BOOSTING_GRID = {
    "n_estimators": [50, 100, 200], "max_depth": [3, 5, 7], "learning_rate": [0.01, 0.1, 0.2],
    "subsample": [0.8, 1.0],
}
FOREST_SEARCH = {
    "n_estimators": [50, 100, 200], "max_depth": [3, 5, 7, 10, None],
    "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4],
    "max_features": ["sqrt", "log2", 0.5], "class_weight": ["balanced", None],
}
BOOSTING_SEARCH = {
    "n_estimators": [50, 100, 200], "max_depth": [3, 5, 7, 10],
    "learning_rate": [0.01, 0.1, 0.2], "subsample": [0.6, 0.8, 1.0],
    "colsample_bytree": [0.6, 0.8, 1.0], "reg_alpha": [0, 0.1, 1], "reg_lambda": [1, 5, 10],
    "class_weight": ["balanced"],
}
# The largest forest that is trained after a search.
MAX_TREES, MAX_DEPTH = 100, 10
#: The deepest tree Spark fits; a search point without a depth gets it, only the refit is capped.
UNLIMITED_DEPTH = 30


class BareLogistic(LogisticRegression):
    """Models without a training summary: the session is not sent to the tasks that score."""

    def _fit(self, dataset: DataFrame):
        return without_summary(super()._fit(dataset))


class BareForest(RandomForestClassifier):
    """The same for forests."""

    def _fit(self, dataset: DataFrame):
        return without_summary(super()._fit(dataset))


def logistic(params: dict, n: int) -> LogisticRegression:
    """C and penalty as in 'penalty + C * summed loss'.

    Spark minimises the mean loss plus regParam times the same penalty, so regParam is 1 / (C n);
    balanced weights sum to n as well.
    """
    return BareLogistic(
        regParam=1.0 / (params.get("C", 1.0) * max(n, 1)),
        elasticNetParam=1.0 if params.get("penalty", "l2") == "l1" else 0.0,
        standardization=False, maxIter=params.get("max_iter", 100), tol=params.get("tol", 1e-6),
    )


def forest(params: dict, n: int = 0) -> RandomForestClassifier:
    share = params.get("max_features", "sqrt")
    return BareForest(
        numTrees=params.get("n_estimators", 100), maxDepth=params.get("max_depth") or UNLIMITED_DEPTH,
        minInstancesPerNode=params.get("min_samples_leaf", 1), featureSubsetStrategy=str(share),
        maxBins=params.get("max_bins", 64), seed=SEED,
    )


def boosting(params: dict, n: int = 0) -> GBTClassifier:
    """Column sampling is per node here; leaf penalties have no counterpart and are ignored.

    Balanced class weights stand for a positive-class weight of negatives / positives: the two
    differ by a factor common to all rows, which neither gains nor leaf means depend on.
    """
    columns = params.get("colsample_bytree", 1.0)
    return GBTClassifier(
        maxIter=params.get("n_estimators", 100), maxDepth=params.get("max_depth", 6),
        stepSize=params.get("learning_rate", 0.3), subsamplingRate=params.get("subsample", 1.0),
        featureSubsetStrategy="all" if columns >= 1.0 else str(columns),
        maxBins=params.get("max_bins", 64), seed=SEED,
    )


def tree(params: dict, n: int = 0) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(
        maxDepth=params.get("max_depth", 30), maxBins=params.get("max_bins", 64), seed=SEED,
    )


@dataclass(frozen=True)
class ModelKind:
    """How to build one kind of model and what to search."""

    name: str
    build: Callable
    scaled: bool = False
    params: dict = field(default_factory=dict)
    search: dict = field(default_factory=dict)


KINDS = {
    "logistic_regression": ModelKind(
        "logistic_regression", logistic, True,
        {"C": 1.0, "penalty": "l2", "class_weight": "balanced", "max_iter": 2000}, LOGISTIC_SEARCH),
    "random_forest": ModelKind(
        "random_forest", forest, False,
        {"n_estimators": 100, "max_depth": 10, "class_weight": "balanced"}, FOREST_SEARCH),
    "gradient_boosting": ModelKind(
        "gradient_boosting", boosting, False,
        {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.3, "class_weight": "balanced"},
        BOOSTING_SEARCH),
    "decision_tree": ModelKind("decision_tree", tree, False, {"max_depth": 30}),
}


def cap_forest(params: dict) -> dict:
    """Limit the number of trees and the depth; an unlimited depth becomes the limit."""
    out = dict(params)
    out["n_estimators"] = min(out.get("n_estimators") or MAX_TREES, MAX_TREES)
    out["max_depth"] = min(out.get("max_depth") or MAX_DEPTH, MAX_DEPTH)
    return out


def grid_points(grid: dict) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def draw_points(grid: dict, n: int, seed: int = SEED) -> list[dict]:
    """n grid points without replacement: those with the smallest random number."""
    points = grid_points(grid)
    order = sorted(range(len(points)), key=lambda i: (uniform_of(i, seed), i))
    return [points[i] for i in sorted(order[:n])]


def balance_rows(table: DataFrame, balance: str | None, columns: list[str] = MODEL_COLUMNS,
                 label: str = LABEL, nominal: list[str] = ()) -> DataFrame:
    """Even the classes of encoded training rows: 'smote', 'bootstrap', 'weights' or None."""
    if balance == "smote":
        return smote(table, columns, label, seed=SEED, nominal_cols=list(nominal))
    if balance == "bootstrap":
        return upsample(table, label=label, seed=SEED)
    if balance == "weights":
        return table.withColumn("weight", balanced_weight(table, label))
    if balance is None:
        return table
    raise ValueError(f"unknown balance {balance!r}")


def _head(kind: ModelKind, params: dict, rows: DataFrame, n: int, columns: list[str], label: str
          ) -> Pipeline:
    classifier = kind.build(params, n)
    if "weight" in rows.columns:
        classifier = classifier.setWeightCol("weight")
    classifier = classifier.setLabelCol(label).setFeaturesCol("features")
    if kind.scaled:
        return Pipeline(stages=[assembler(columns, "raw_features"),
                                *scaling_stages(n, len(columns)), classifier])
    return Pipeline(stages=[assembler(columns), classifier])


def fit_table(kind: ModelKind, table: DataFrame, params: dict | None = None,
              balance: str | None = None, columns: list[str] = MODEL_COLUMNS,
              label: str = LABEL) -> PipelineModel:
    """Train on encoded rows. Class weights apply when the parameters ask for them.

    The balanced rows are saved for the time of the fit: a lost executor costs a re-read, not the
    feature pipeline and the resampling once more.
    """
    params = kind.params if params is None else params
    if balance is None and params.get("class_weight") == "balanced":
        balance = "weights"
    rows = saved(balance_rows(table, balance, columns, label), "fit")
    n = rows.count()
    model = _head(kind, params, rows, n, columns, label).fit(rows)
    discard(rows)
    return model


def train(kind: ModelKind, transactions: DataFrame, params: dict | None = None,
          balance: str | None = None, features: PipelineModel | None = None) -> PipelineModel:
    """One model from raw transaction columns to probability."""
    features = features or fit_features(transactions)
    head = fit_table(kind, model_table(features, transactions), params, balance)
    return PipelineModel(stages=[*features.stages, *head.stages])


def predictions(model: PipelineModel, df: DataFrame, keep: list[str] = ("id",),
                label: str | None = LABEL, threshold: float | None = None) -> DataFrame:
    """keep..., label, score = P(class 1), prediction."""
    scored = model.transform(df)
    score = vector_to_array("probability")[1]
    prediction = (
        F.col("prediction").cast("int") if threshold is None else (score >= threshold).cast("int")
    )
    y = [F.col(label).cast("int").alias("label")] if label and label in df.columns else []
    return scored.select(*keep, *y, score.alias("score"), prediction.alias("prediction"))


def _param_map(kind: ModelKind, estimator, point: dict, n: int) -> dict:
    """The estimator's parameters for one grid point, as the cross-validator wants them."""
    built = kind.build(point, n)
    chosen = {
        p: built.getOrDefault(p) for p in built.params
        if built.isSet(p) and p.name not in ("labelCol", "featuresCol", "weightCol")
    }
    out = {estimator.getParam(p.name): v for p, v in chosen.items()}
    weight = "weight" if point.get("class_weight") == "balanced" else "unit_weight"
    out[estimator.weightCol] = weight
    return out


def _forest_means(folded: DataFrame, points: list[dict], folds: int, metric: str, columns: list[str],
                  label: str) -> list[float] | None:
    """Mean score of every point of a forest search, grown without a forest on the driver.

    None for what this does not cover: a table of more rows than a task holds (``MOST_ROWS``),
    other labels than 0 and 1, empty folds, other bins or metrics.
    """
    built = [forest(p) for p in points]
    if metric not in ("f1", "accuracy") or any(b.getMaxBins() != BINS for b in built):
        return None
    sound = F.col(label).isin(0, 1) & F.col("fold").isNotNull()
    n, good, dealt = folded.agg(F.count(F.lit(1)), F.count_if(sound), F.count_distinct("fold")).first()
    if not 0 < n <= MOST_ROWS or good < n or dealt < folds:
        return None
    edges = bin_edges(folded, columns)
    ids = F.coalesce(F.col("id").cast("bigint"), F.lit(-1).cast("bigint"))
    blocks = packed(folded.withColumn("_row", ids), columns, edges, label, "_row", "fold")
    fits = [ForestFit(b.getNumTrees(), b.getMaxDepth(), b.getMinInstancesPerNode(),
                      columns_of_node(b.getFeatureSubsetStrategy(), len(columns)),
                      p.get("class_weight") == "balanced", fold, b.getSeed())
            for p, b in zip(points, built) for fold in range(folds)]
    counts = held_out_counts(blocks, fits, len(columns))
    discard(blocks)

    def score(tn: int, fp: int, fn: int, tp: int) -> float:
        if metric == "f1":
            return 2 * tp / (2 * tp + fp + fn) if tp else 0.0
        return (tn + tp) / (tn + fp + fn + tp)

    scores = [score(*c) for c in counts]
    return [sum(scores[i:i + folds]) / folds for i in range(0, len(scores), folds)]


def search(kind: ModelKind, table: DataFrame, points: list[dict], folds: int = 3,
           metric: str = "f1", columns: list[str] = MODEL_COLUMNS, label: str = LABEL,
           parallelism: int = 4) -> tuple[list[dict], DataFrame]:
    """Cross-validate every point; returns the points best first, and the same as a table.

    ``metric`` is 'f1' (of class 1) or 'accuracy'. Features are assembled and scaled once. Forests
    over a table that a task can hold are scored tree by tree in tasks (``operators.forest``).
    """
    name = "fMeasureByLabel" if metric == "f1" else metric
    evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName=name, metricLabel=1.0)
    table = saved(table, "encoded")
    folded = stratified_folds(table, folds, label)
    if kind.build is forest:
        own = saved(folded, "folds")
        means = _forest_means(own, points, folds, metric, columns, label)
        discard(own)
        if means is not None:
            return _ranked(kind, points, means, table)
    folded = folded.withColumns({
        "weight": balanced_weight(table, label), "unit_weight": F.lit(1.0),
    })
    n = table.count()
    stages = (
        [assembler(columns, "raw_features"), *scaling_stages(n, len(columns))] if kind.scaled
        else [assembler(columns)]
    )
    matrix = Pipeline(stages=stages).fit(folded).transform(folded).select(
        "features", label, "fold", "weight", "unit_weight"
    )
    rows = saved(matrix, "search")
    estimator = kind.build({}, n).setLabelCol(label).setFeaturesCol("features")
    in_fold = n * (folds - 1) // folds
    result = CrossValidator(
        estimator=estimator, evaluator=evaluator, numFolds=folds, foldCol="fold",
        estimatorParamMaps=[_param_map(kind, estimator, p, in_fold) for p in points],
        parallelism=parallelism,
    ).fit(rows)
    return _ranked(kind, points, result.avgMetrics, table)


def _ranked(kind: ModelKind, points: list[dict], means: list[float], table: DataFrame
            ) -> tuple[list[dict], DataFrame]:
    scored = sorted(zip(means, range(len(points))), key=lambda s: (-s[0], s[1]))
    ranked = [points[i] for _, i in scored]
    report = table.sparkSession.createDataFrame(
        [(rank, kind.name, json.dumps(points[i]), float(value))
         for rank, (value, i) in enumerate(scored, 1)],
        "rank int, model string, params string, mean_score double",
    )
    return ranked, report


def random_search(kind: ModelKind, table: DataFrame, n_iter: int = 20, folds: int = 3,
                  grid: dict | None = None, **options) -> tuple[list[dict], DataFrame]:
    """F1 over seeded grid points, 3 stratified folds."""
    return search(kind, table, draw_points(grid or kind.search, n_iter), folds, "f1", **options)


def grid_search(kind: ModelKind, table: DataFrame, grid: dict, folds: int = 5, **options
                ) -> tuple[list[dict], DataFrame]:
    """Accuracy over the whole grid, 5 folds."""
    return search(kind, table, grid_points(grid), folds, "accuracy", **options)


def cross_validate(kind: ModelKind, table: DataFrame, params: dict | None = None, folds: int = 5,
                   balance: str | None = None, columns: list[str] = MODEL_COLUMNS,
                   label: str = LABEL, key: str = "id") -> DataFrame:
    """(model, fold, f1, auc, ...) with balancing inside each training part.

    The folds' fits run side by side; their validation scores form one table that is evaluated
    in one pass.
    """
    folded = saved(stratified_folds(table, folds, label, key), "folds")

    def one(fold: int) -> DataFrame:
        fit_rows, held_out = fold_split(folded, fold)
        model = fit_table(kind, fit_rows.drop("fold"), params, balance, columns, label)
        return predictions(model, held_out, [key, "fold"], label)

    with ThreadPoolExecutor(max_workers=min(folds, 4)) as pool:
        parts = list(pool.map(one, range(folds)))
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    return evaluate.full_metrics(scored, by=["fold"]).withColumn("model", F.lit(kind.name))


def full_run(kind: ModelKind, transactions: DataFrame, test: DataFrame, n_iter: int = 20,
             folds: int = 5, balance: str | None = "smote") -> tuple[PipelineModel, DataFrame]:
    """Search, cross-validate the winner, refit it on all balanced rows and report on ``test``.

    Returns the model and one row: model, params, cv_f1_mean, cv_auc_mean and the test metrics.
    Forests are capped before the refit.
    """
    features = fit_features(transactions)
    table = saved(model_table(features, transactions), "encoded")
    best = {**kind.params, **random_search(kind, table, n_iter)[0][0]}
    if kind.build is forest:
        best = cap_forest(best)
    validated = mean_scores(cross_validate(kind, table, best, folds, balance))
    head = fit_table(kind, table, best, balance)
    model = PipelineModel(stages=[*features.stages, *head.stages])
    tested = evaluate.full_metrics(predictions(model, test).withColumn("model", F.lit(kind.name)))
    report = validated.join(tested, "model").withColumn("params", F.lit(json.dumps(best)))
    return model, report


def mean_scores(fold_metrics: DataFrame) -> DataFrame:
    return fold_metrics.groupBy("model").agg(
        F.avg("f1").alias("cv_f1_mean"), F.avg("auc").alias("cv_auc_mean")
    )


def train_all(transactions: DataFrame, test: DataFrame, kinds: list[ModelKind],
              params: dict[str, dict] | None = None, balance: str | None = "smote"
              ) -> tuple[dict[str, PipelineModel], DataFrame, DataFrame]:
    """Train every kind on the same balanced rows, side by side; a failure becomes a status row.

    Returns the models, (model, status) rows, and the test scores of all models. What chooses among
    the models asks ``all_trained`` first: without a failed one the choice would be another.
    """
    features = fit_features(transactions)
    spark = transactions.sparkSession
    rows = saved(balance_rows(model_table(features, transactions), balance), "balanced")

    def one(kind: ModelKind) -> PipelineModel | str:
        wanted = {**kind.params, **(params or {}).get(kind.name, {})}
        if balance is not None:
            wanted.pop("class_weight", None)
        try:
            head = fit_table(kind, rows, wanted)
        except Exception as error:  # one model must not stop the others
            return f"error: {error}"
        return PipelineModel(stages=[*features.stages, *head.stages])

    with ThreadPoolExecutor(max_workers=max(1, min(len(kinds), 4))) as pool:
        fitted = list(zip([kind.name for kind in kinds], pool.map(one, kinds)))
    status = [(name, m if isinstance(m, str) else "ok") for name, m in fitted]
    models, scored = {name: m for name, m in fitted if not isinstance(m, str)}, None
    for name, model in models.items():
        part = predictions(model, test).withColumn("model", F.lit(name))
        scored = part if scored is None else scored.unionByName(part)
    return models, spark.createDataFrame(status, "model string, status string"), scored


def all_trained(status: DataFrame) -> None:
    """Raise if a row of ``train_all``'s status tells of a failure."""
    failed = [f"{r.model}: {r.status}" for r in status.collect() if r.status != "ok"]  # one row a model
    if failed:
        raise RuntimeError(f"not every model was trained; {'; '.join(failed)}")
