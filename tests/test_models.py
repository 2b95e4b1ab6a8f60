import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import Observation, functions as F

from cardwatch.operators import evaluate, explain
from cardwatch.plans import catalog, pipeline, scoring, training
from cardwatch.session import scratch_path
from cardwatch.sources import store
from cardwatch.sources.tables import split_of
from cardwatch.streaming import score as stream


@pytest.fixture(scope="module")
def parts(view):
    return split_of(view, "train"), split_of(view, "test")


@pytest.fixture(scope="module")
def logistic(parts):
    return training.train(training.KINDS["logistic_regression"], parts[0])


def test_encoder_order_and_vector(parts, logistic):
    row = logistic.transform(parts[1]).orderBy("id").first()
    assert row.raw_features.size == len(pipeline.MODEL_COLUMNS) == 20
    labels = next(s for s in logistic.stages if isinstance(s, StringIndexerModel)).labelsArray
    assert [sorted(l) for l in labels] == [list(l) for l in labels]


def test_scaled_features_have_population_unit_variance(parts, logistic):
    x = np.array([r.features.toArray() for r in logistic.transform(parts[0]).select("features").collect()])
    assert x.mean(axis=0) == pytest.approx(np.zeros(20), abs=1e-9)
    assert np.all(np.isclose(x.std(axis=0), 1.0) | np.isclose(x.std(axis=0), 0.0))


def test_logistic_minimises_the_stated_objective(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(120, 2))
    y = (x @ [1.5, -1.0] + 0.5 + rng.normal(size=120) > 0).astype(float)
    df = spark.createDataFrame([(int(t), *map(float, r)) for t, r in zip(y, x)], "is_fraud int, a double, b double")
    built = training.logistic({"C": 0.5, "penalty": "l2", "tol": 1e-12, "max_iter": 500}, 120)
    model = Pipeline(stages=[pipeline.assembler(["a", "b"]), built.setLabelCol("is_fraud")]).fit(df).stages[-1]
    w, b = model.coefficients.toArray(), model.intercept
    # gradient of |w|^2 / 2 + C * sum of losses is zero
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert w + 0.5 * ((p - y) @ x) == pytest.approx([0, 0], abs=1e-4)
    assert (p - y).sum() == pytest.approx(0, abs=1e-4)


def test_model_beats_the_base_rate(parts, logistic):
    scored = training.predictions(logistic, parts[1])
    assert evaluate.auc(scored).first().auc > 0.8


def test_saved_model_scores_the_same(spark, parts, logistic):
    root = scratch_path(spark, "models")
    store.save_model(logistic, root, "r", "m")
    loaded = store.load_model(root, "r", "m")
    a = sorted(training.predictions(logistic, parts[1]).collect())
    assert a == sorted(training.predictions(loaded, parts[1]).collect())
    info = store.model_info(loaded, pipeline.MODEL_COLUMNS)
    assert info["scaler_available"] and info["num_features"] == 20 and len(info["features"]) == 10


def test_unseen_category_is_kept_at_scoring(parts, logistic):
    odd = parts[1].withColumn("category", F.lit("never seen")).withColumn("gender", F.lit(None).cast("string"))
    scored = scoring.score(logistic, odd)
    assert scored.count() == parts[1].count()
    assert scored.where("fraud_probability IS NULL OR isnan(fraud_probability)").count() == 0


def test_stream_equals_batch_and_restarts(spark, parts, logistic):
    folder = scratch_path(spark, "arrivals")
    split = parts[1].withColumn("part", F.col("id") % 4)
    for i in range(3):
        split.where(F.col("part") == i).drop("part").coalesce(1).write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema
    out, state = scratch_path(spark, "out"), scratch_path(spark, "state")

    def drained():
        source = stream.file_stream(spark, folder, schema, files_per_batch=1)
        return stream.drain(stream.score_stream(source, lambda d: scoring.score(logistic, d)), out, state)

    first = drained().count()
    split.where(F.col("part") == 3).drop("part").coalesce(1).write.mode("append").parquet(folder)
    final = drained()
    assert first < final.count()
    assert sorted(final.collect()) == sorted(scoring.score(logistic, parts[1]).collect())


def test_late_rows_are_dropped_from_hourly_rates(spark):
    import datetime as dt
    folder = scratch_path(spark, "events")
    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    batches = [[(at(0), 1), (at(0, 30), 0), (at(1), 1)], [(at(6), 0)], [(at(0, 10), 1), (at(6, 5), 1)], [(at(9), 0)]]
    for rows in batches:
        spark.createDataFrame(rows, "ts timestamp_ntz, flag int").coalesce(1).write.mode("append").parquet(folder)
        out = stream.drain(
            stream.hourly_rate(stream.file_stream(spark, folder, spark.read.parquet(folder).schema), "ts", "flag"),
            f"{folder}-out", f"{folder}-state")
    rows = {r.window_start.hour: (r.n, r.n_flagged) for r in out.collect()}
    assert rows == {0: (2, 1), 1: (1, 1), 6: (2, 1)}


def test_random_draws_and_caps():
    grid = training.FOREST_SEARCH
    assert len(training.grid_points(grid)) == 810
    assert len(training.grid_points(training.BOOSTING_GRID)) == 54
    assert len(training.grid_points(training.BOOSTING_SEARCH)) == 2916
    drawn = training.draw_points(grid, 20)
    assert len(drawn) == 20 and drawn == training.draw_points(grid, 20)
    assert training.draw_points(training.LOGISTIC_SEARCH, 10) == training.grid_points(training.LOGISTIC_SEARCH)
    assert training.cap_forest({"n_estimators": 200, "max_depth": None}) == {"n_estimators": 100, "max_depth": 10}


def test_search_and_cross_validation(parts):
    table = pipeline.model_table(pipeline.fit_features(parts[0]), parts[0])
    boosted = {"n_estimators": [2], "max_depth": [2, 3], "learning_rate": [0.1], "subsample": [0.8]}
    report = training.grid_search(training.KINDS["gradient_boosting"], table, boosted, 2)[1]
    assert report.count() == 2 and report.where("mean_score > 0.5").count() == 2
    kind = training.KINDS["decision_tree"]
    ranked, report = training.search(kind, table, [{"max_depth": 2}, {"max_depth": 5}], 2)
    assert report.count() == 2 and ranked[0]["max_depth"] in (2, 5)
    folds = training.cross_validate(kind, table, {"max_depth": 4}, 2, "bootstrap").collect()
    assert sorted(r.fold for r in folds) == [0, 1]
    assert sum(r.tn + r.fp + r.fn + r.tp for r in folds) == table.count()


def test_one_failing_model_does_not_stop_the_others(parts):
    def broken(params, n):
        raise RuntimeError("no such model")

    kinds = [training.ModelKind("broken", broken), training.KINDS["decision_tree"]]
    models, status, scored = training.train_all(*parts, kinds, {"decision_tree": {"max_depth": 3}}, "bootstrap")
    assert {r.model: r.status[:5] for r in status.collect()} == {"broken": "error", "decision_tree": "ok"}
    assert list(models) == ["decision_tree"] and scored.count() == parts[1].count()


def test_a_ranking_fails_if_a_model_does(spark, parts, monkeypatch):
    def broken(params, n):
        raise RuntimeError("no such model")

    small = {"n_estimators": 2, "max_depth": 2}
    monkeypatch.setattr(catalog, "_parts", lambda *_: parts)
    monkeypatch.setitem(training.KINDS, "random_forest", training.ModelKind("random_forest", training.forest, params=small))
    monkeypatch.setitem(training.KINDS, "gradient_boosting", training.ModelKind("gradient_boosting", broken))
    with pytest.raises(RuntimeError, match="gradient_boosting: error: no such model"):
        catalog.CATALOG["x_ranking"](spark, "unused")
    rows = {r.model: r.status[:5] for r in catalog.CATALOG["e_train_all"](spark, "unused").collect()}
    assert rows == {"logistic_regression": "ok", "random_forest": "ok", "gradient_boosting": "error"}


def test_kinds_are_trained_side_by_side(parts):
    import threading
    both = threading.Barrier(2, timeout=60)

    def waiting(params, n):
        both.wait()
        return training.tree(params, n)

    kinds = [training.ModelKind(name, waiting, params={"max_depth": 1}) for name in ("one", "two")]
    models, status, _ = training.train_all(*parts, kinds, balance=None)
    assert list(models) == ["one", "two"] and {r.status for r in status.collect()} == {"ok"}


def brute_force_shap(trees, x, width):
    """Average over all orders of the expected value with a growing set of known features."""
    import itertools
    import math

    def expected(node, known):
        if "value" in node:
            return node["value"]
        if node["feature"] in known:
            return expected(node["left" if x[node["feature"]] <= node["cut"] else "right"], known)
        share = node["left"]["cover"] / node["cover"]
        return share * expected(node["left"], known) + (1 - share) * expected(node["right"], known)

    value = lambda known: sum(w * expected(t, known) for w, t in trees)
    phi = np.zeros(width)
    for order in itertools.permutations(range(width)):
        known = set()
        for f in order:
            before = value(known)
            known.add(f)
            phi[f] += value(known) - before
    return phi / math.factorial(width), value(set())


@pytest.mark.parametrize("boosted", [True, False])
def test_tree_shap_matches_all_orders_and_adds_up(spark, boosted):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(150, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] * x[:, 2] > 0.2)).astype(int)
    df = spark.createDataFrame([(i, int(t), *map(float, r)) for i, (t, r) in enumerate(zip(y, x))],
                               "id long, label int, a double, b double, c double, d double")
    names = ["a", "b", "c", "d"]
    build = (GBTClassifier(maxIter=3, maxDepth=3, seed=1) if boosted
             else RandomForestClassifier(numTrees=3, maxDepth=3, seed=1))
    model = Pipeline(stages=[pipeline.assembler(names), build]).fit(df)
    rows = explain.tree_shap(model, df, names, rows=12).collect()
    last = model.stages[-1]

    def convert(node):
        stats = list(node.impurityStats().stats())
        cover = stats[0] if boosted else sum(stats)
        if node.getClass().getSimpleName() == "LeafNode":
            return {"cover": cover, "value": node.prediction() if boosted else stats[1] / sum(stats)}
        return {"cover": cover, "feature": node.split().featureIndex(), "cut": node.split().threshold(),
                "left": convert(node.leftChild()), "right": convert(node.rightChild())}

    weights = last.treeWeights if boosted else [1 / 3] * 3
    trees = [(w, convert(t._java_obj.rootNode())) for w, t in zip(weights, last.trees)]
    for i in range(12):
        mine = {r.feature: r for r in rows if r.id == i}
        phi, base = brute_force_shap(trees, x[i], 4)
        assert [mine[n].phi for n in names] == pytest.approx(list(phi), abs=1e-9)
        assert mine["a"].base == pytest.approx(base)
        assert base + phi.sum() == pytest.approx(mine["a"].output)


def test_linear_shap_adds_up(view):
    weights = {"amt": 0.3, "city_pop": -1e-5}
    rows = explain.linear_shap(view, weights, 0.7).groupBy("id").agg(
        F.sum("phi").alias("phi"), F.first("base").alias("base"))
    joined = rows.join(view, "id").withColumn("s", F.col("amt") * 0.3 - F.col("city_pop") * 1e-5 + 0.7)
    assert joined.where(F.abs(F.col("phi") + F.col("base") - F.col("s")) > 1e-9).count() == 0
    assert explain.linear_shap(view, weights, rows=200).count() == 400


def test_upserted_hours_hold_open_hours_and_replayed_batches(spark):
    import datetime as dt
    folder = scratch_path(spark, "feed")
    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    for rows in ([(at(0), 1), (at(0, 30), 0), (at(1), 1)], [(at(1, 20), 0), (at(2), 1)]):
        spark.createDataFrame(rows, "ts timestamp_ntz, flag int").coalesce(1).write.mode("append").parquet(folder)
        rates = stream.hourly_rate(stream.file_stream(spark, folder, "ts timestamp_ntz, flag int"), "ts", "flag")
        out = stream.upsert_hours(rates, f"{folder}-out", f"{folder}-state")
    want = {0: (2, 1), 1: (2, 1), 2: (1, 1)}
    assert {r.window_start.hour: (r.n, r.n_flagged) for r in out.collect()} == want
    again = stream.hours_so_far(spark, f"{folder}-out", rates.schema)
    again.where("hour(window_start) >= 1").write.mode("overwrite").parquet(f"{folder}-out/batch=1")  # batch 1 once more
    assert {r.window_start.hour: (r.n, r.n_flagged) for r in stream.hours_so_far(spark, f"{folder}-out", rates.schema).collect()} == want
    assert stream.hours_so_far(spark, f"{folder}-none", rates.schema).count() == 0


def test_attributions_of_deep_forests_add_up(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(260, 16))
    y = ((x[:, :8].sum(axis=1) + rng.normal(size=260)) > 0).astype(int)
    names = [f"c{i}" for i in range(16)]
    df = spark.createDataFrame([(i, int(t), *map(float, r)) for i, (t, r) in enumerate(zip(y, x))],
                               "id long, label int, " + ", ".join(f"{n} double" for n in names))
    build = RandomForestClassifier(numTrees=100, maxDepth=30, featureSubsetStrategy="onethird", seed=1)
    model = Pipeline(stages=[pipeline.assembler(names), build]).fit(df)
    assert max(t.depth for t in model.stages[-1].trees) > 8
    rows = explain.tree_shap(model, df, names, rows=40).groupBy("id").agg(
        F.sum("phi").alias("phi"), F.max("base").alias("base"), F.max("output").alias("output"), F.count("*").alias("n"))
    assert rows.count() == 40
    assert rows.where("n != 16 OR abs(base + phi - output) > 1e-9").count() == 0


def test_patterns_of_many_features_are_those_that_occur():
    rng = np.random.default_rng(3)
    for size in (3, 10, 11, 70):
        hits = rng.random((4, 50, size)) < 0.02
        leaf, bits, cell = explain._distinct(hits)
        assert len(set(zip(leaf.tolist(), map(tuple, bits.astype(int).tolist())))) == len(leaf)
        for i in range(4):
            assert (leaf[cell[i]] == i).all() and (bits[cell[i]].astype(bool) == hits[i]).all()


def _observe(spark):
    """From here on a session cannot be written."""
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3


def _written(spark, model) -> bytes:
    out = spark._jvm.java.io.ByteArrayOutputStream()
    spark._jvm.java.io.ObjectOutputStream(out).writeObject(model._java_obj)
    return bytes(out.toByteArray())


@pytest.mark.parametrize("kind", ["logistic_regression", "random_forest"])
def test_tasks_get_no_session_with_a_model(spark, parts, kind):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, int(a > 0), float(a)) for i, a in enumerate(rng.normal(size=60))], "id long, is_fraud int, a double")
    _observe(spark)
    built = training.KINDS[kind].build({"n_estimators": 2, "max_depth": 2}, 60).setLabelCol("is_fraud")
    model = Pipeline(stages=[pipeline.assembler(["a"]), built]).fit(df)
    assert not model.stages[-1].hasSummary and b"SparkSession" not in _written(spark, model.stages[-1])
    assert model.transform(df).where("prediction = is_fraud").count() > 50
    ranked, _ = training.search(training.KINDS[kind], df, [{"n_estimators": 2, "max_depth": 2}], 2, columns=["a"])
    assert len(ranked) == 1


def test_attributions_of_a_model_with_a_summary(spark):
    df = spark.createDataFrame([(i, int(i > 20), float(i)) for i in range(40)], "id long, label int, a double")
    _observe(spark)
    model = Pipeline(stages=[pipeline.assembler(["a"]), RandomForestClassifier(numTrees=2, maxDepth=2, seed=1)]).fit(df)
    assert model.stages[-1].hasSummary
    assert explain.tree_shap(model, df, ["a"]).count() == 40
    assert model.stages[-1].hasSummary
