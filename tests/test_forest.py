import numpy as np
import pytest
from pyspark.ml import Pipeline

from cardwatch.operators import forest
from cardwatch.plans import pipeline, training

POINTS = [{"n_estimators": 12, "max_depth": None, "min_samples_leaf": 1, "max_features": "sqrt", "class_weight": "balanced"},
          {"n_estimators": 12, "max_depth": 4, "min_samples_leaf": 3, "max_features": 0.5, "class_weight": None}]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 4))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + 0.5 * rng.normal(size=900) > 0.8).astype(int)
    return spark.createDataFrame([(i, int(t), *map(float, r)) for i, (t, r) in enumerate(zip(y, x))],
                                 "id long, is_fraud int, a double, b double, c double, d double")


def test_a_forest_search_brings_no_forest_to_the_driver(table, monkeypatch):
    def fitted(*_):
        raise AssertionError("a forest was fitted on the driver")

    monkeypatch.setattr(training.BareForest, "_fit", fitted)
    kind = training.KINDS["random_forest"]
    ranked, report = training.search(kind, table, POINTS, 3, "accuracy", columns=["a", "b", "c", "d"])
    again = training.search(kind, table.repartition(3), POINTS, 3, "accuracy", columns=["a", "b", "c", "d"])[1]
    assert len(ranked) == 2 and report.collect() == again.collect()


def test_search_scores_are_near_those_of_sparks_forest(table, monkeypatch):
    kind = training.KINDS["random_forest"]
    found = training.search(kind, table, POINTS, 3, columns=["a", "b", "c", "d"])[1].collect()
    monkeypatch.setattr(training, "MOST_ROWS", 0)
    want = training.search(kind, table, POINTS, 3, columns=["a", "b", "c", "d"])[1].collect()
    mine, theirs = ({r.params: r.mean_score for r in rows} for rows in (found, want))
    assert mine == pytest.approx(theirs, abs=0.08)


@pytest.mark.parametrize("depth, least, balanced", [(3, 1, False), (30, 4, True), (0, 1, False)])
def test_a_tree_on_all_rows_and_columns_is_sparks(spark, depth, least, balanced):
    rng = np.random.default_rng(depth + least)
    x = rng.integers(0, 40, (500, 3))
    y = ((x[:, 0] + x[:, 1] - x[:, 2] + rng.integers(-9, 9, 500)) > 30).astype(int)
    w = (500 / (2 * (y == 0).sum()), 500 / (2 * (y == 1).sum())) if balanced else (1.0, 1.0)
    df = spark.createDataFrame([(i, int(t), float(w[t]), *map(float, r)) for i, (t, r) in enumerate(zip(y, x))],
                               "id long, is_fraud int, weight double, a double, b double, c double")
    built = training.tree({"max_depth": depth}).setLabelCol("is_fraud").setMinInstancesPerNode(least).setWeightCol("weight")
    model = Pipeline(stages=[pipeline.assembler(["a", "b", "c"]), built]).fit(df)
    want = [r.score for r in training.predictions(model, df).orderBy("id").collect()]
    fit = forest.ForestFit(1, depth, least, 3, balanced, 0)
    got = forest.tree_scores(x.T.astype(np.uint8).copy(), y, np.ones(500), np.arange(500), fit, w, np.random.default_rng(0))
    assert got == pytest.approx(want, abs=1e-9)


def test_columns_of_a_node():
    assert [forest.columns_of_node(s, 20) for s in ("all", "sqrt", "log2", "0.5", "onethird", "3", "1.0")] == [20, 5, 5, 10, 7, 3, 20]


def test_trees_are_dealt_once():
    fits = [forest.ForestFit(n, d, 1, 5, False, 0) for n in (1, 7, 200) for d in (3, 30)]
    dealt = sorted(c for task in forest._dealt(fits, 6) for c in task)
    for i, f in enumerate(fits):
        own = [(a, b) for j, a, b in dealt if j == i]
        assert own[0][0] == 0 and own[-1][1] == f.trees and all(x[1] == y[0] for x, y in zip(own, own[1:]))
