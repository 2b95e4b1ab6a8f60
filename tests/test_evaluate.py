import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwatch.operators import evaluate, gradient


def table(spark, rows):
    return spark.createDataFrame(
        [(int(y), float(s), int(s >= 0.5)) for y, s in rows], "label int, score double, prediction int"
    ).repartition(3)


def pair_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    return np.mean([1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg])


@pytest.mark.parametrize("digits", [1, 2, 12])
def test_auc_equals_pair_counting(spark, digits):
    rng = np.random.default_rng(digits)
    rows = [(int(rng.random() < 0.3), round(float(rng.random()), digits)) for _ in range(300)]
    assert evaluate.auc(table(spark, rows)).first().auc == pytest.approx(pair_auc(rows), abs=1e-12)


def test_auc_edge_cases(spark):
    assert evaluate.auc(table(spark, [(1, 0.2), (1, 0.9)])).first().auc is None
    assert evaluate.auc(table(spark, [(1, 0.4), (0, 0.4), (0, 0.4)])).first().auc == 0.5
    assert evaluate.auc(table(spark, [(1, 0.4)]).where("label = 5"), by=["prediction"]).count() == 0


def test_rates_without_predicted_positives(spark):
    row = evaluate.metrics(table(spark, [(1, 0.1), (0, 0.2)])).first()
    assert (row.precision, row.recall, row.f1, row.accuracy) == (0.0, 0.0, 0.0, 0.5)
    assert row.tn + row.fp + row.fn + row.tp == 2


def reference_roc(rows, drop):
    scores = sorted({s for _, s in rows}, reverse=True)
    tps = [sum(1 for y, s in rows if s >= t and y == 1) for t in scores]
    fps = [sum(1 for y, s in rows if s >= t and y == 0) for t in scores]
    keep = list(range(len(scores)))
    if drop and len(scores) > 2:
        bends = (np.diff(fps, 2) != 0) | (np.diff(tps, 2) != 0)
        keep = [0, *[i + 1 for i in np.nonzero(bends)[0]], len(scores) - 1]
    return [(0.0, 0.0)] + [(fps[i] / fps[-1], tps[i] / tps[-1]) for i in keep]


@pytest.mark.parametrize("drop", [True, False])
def test_roc_points(spark, drop):
    rng = np.random.default_rng(3)
    rows = [(int(rng.random() < 0.4), round(float(rng.random()), 2)) for _ in range(250)]
    found = evaluate.roc_curve(table(spark, rows), drop_collinear=drop).orderBy(F.desc("threshold")).collect()
    assert [(r.fpr, r.tpr) for r in found] == reference_roc(rows, drop)
    assert found[0].threshold == float("inf")


def test_roc_per_group(spark):
    rows = [(i % 2, (i * 37 % 100) / 100) for i in range(100)]
    both = table(spark, rows).withColumn("model", F.lit("a")).union(
        table(spark, [(y, 1 - s) for y, s in rows]).withColumn("model", F.lit("b")))
    found = evaluate.roc_curve(both, by=["model"]).where("model = 'b'").orderBy(F.desc("threshold")).collect()
    assert [(r.fpr, r.tpr) for r in found] == reference_roc([(y, 1 - s) for y, s in rows], True)


def test_threshold_sweep_agrees_with_metrics(spark):
    rows = [(i % 3 == 0, (i * 31 % 101) / 101) for i in range(101)]
    df = table(spark, rows)
    for r in evaluate.threshold_sweep(df, [0.2, 0.5, 0.8]).collect():
        at = df.withColumn("prediction", (F.col("score") >= r.threshold).cast("int"))
        m = evaluate.metrics(at).first()
        assert (r.tn, r.fp, r.fn, r.tp, r.f1) == (m.tn, m.fp, m.fn, m.tp, m.f1)


def test_report_and_gap(spark):
    df = table(spark, [(1, 0.9), (1, 0.1), (0, 0.2), (0, 0.8), (0, 0.3)])
    report = {r.row: r for r in evaluate.classification_report(df).collect()}
    assert report["0"].precision == pytest.approx(2 / 3) and report["1"].recall == 0.5
    assert report["accuracy"].f1 == pytest.approx(0.6) and report["macro avg"].support == 5
    assert report["weighted avg"].recall == pytest.approx(0.6)
    split = df.withColumn("split", F.lit("train")).union(df.withColumn("split", F.lit("test")))
    assert evaluate.generalisation_gap(split).first().gap_f1 == 0.0
    assert evaluate.type2_share(df).first().type2_share == pytest.approx(0.2)


def test_best_model_prefers_the_first_name_on_ties(spark):
    results = spark.createDataFrame(
        [(m, 0.5, 0.5, 0.5, 0.5, 0.5, 1, 1, 1, 1) for m in ("b_model", "a_model")],
        "model string, accuracy double, f1 double, auc double, precision double, recall double, "
        "fn long, fp long, tp long, tn long")
    best = evaluate.best_model(results).first()
    assert (best.model, best.name, best.score) == ("a_model", "A Model", pytest.approx(0.5))


def test_gradient_ascent_matches_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(80, 3))
    y = (x[:, 0] + 0.3 * rng.normal(size=80) > 0).astype(float)
    df = spark.createDataFrame([(float(t), *map(float, r)) for t, r in zip(y, x)], "y double, a double, b double, c double")
    found = gradient.gradient_ascent(df, ["a", "b", "c"], "y", [0.0, 4.0], step=1e-2, iterations=7).collect()
    for penalty in (0.0, 4.0):
        w = np.zeros(3)
        for _ in range(7):
            slope = (y - 1 / (1 + np.exp(-x @ w))) @ x - 2 * penalty * w * [0, 1, 1]
            w = w + 1e-2 * slope
        assert [r.coefficient for r in found if r.penalty == penalty] == pytest.approx(list(w))
    weights = dict(zip("abc", w))
    s = x @ w
    expected = ((y - 1) * s - np.log1p(np.exp(-s))).sum() - 4.0 * (w[1:] ** 2).sum()
    got = gradient.log_likelihood(df, weights, "y", 4.0, ["a"]).first().log_likelihood
    assert got == pytest.approx(expected)


def test_log_likelihood_does_not_overflow(spark):
    df = spark.createDataFrame([(1, -5000.0), (0, 5000.0)], "y int, a double")
    assert gradient.log_likelihood(df, {"a": 1.0}, "y").first().log_likelihood == -10000.0
