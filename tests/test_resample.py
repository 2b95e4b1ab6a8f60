import itertools
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardwatch.functions.random import uniform, uniform_of
from cardwatch.operators import encode, knn, resample


def test_uniform_is_the_same_on_driver_and_cluster(spark):
    rows = spark.range(50).select("id", uniform("id", 42).alias("u")).collect()
    assert all(r.u == uniform_of(r.id, 42) for r in rows)
    assert uniform_of(7, 42) == 1423327689 / 2**32


def brute_force(points, k):
    out = {}
    for i, x in points:
        far = []
        for j, y in points:
            if i != j:
                total = 0.0
                for a, b in zip(x, y):
                    total += (a - b) * (a - b)
                far.append((total, j))
        out[i] = [(r + 1, j, d) for r, (d, j) in enumerate(sorted(far)[:k])]
    return out


@pytest.mark.parametrize("leaf_size, kind", list(itertools.product([8, 40, 4096], ["normal", "lattice", "copies"])))
def test_neighbours_match_brute_force(spark, leaf_size, kind):
    rng = np.random.default_rng(7)
    if kind == "normal":
        data = rng.normal(size=(220, 3)) * [1, 10, 0.1]
    elif kind == "lattice":  # many equal distances
        data = rng.integers(0, 4, size=(220, 3)).astype(float)
    else:  # a third of all rows are the same vector
        data = rng.normal(size=(220, 3))
        data[::3] = 0.0
    points = [(int(i * 7 % 220), tuple(map(float, x))) for i, x in enumerate(data)]
    df = spark.createDataFrame([(i, *x) for i, x in points], "id long, a double, b double, c double")
    found = {}
    for r in knn.nearest_neighbours(df, "id", ["a", "b", "c"], 5, leaf_size).collect():
        found.setdefault(r.id, []).append((r.rank, r.neighbour_id, r.distance2))
    expected = brute_force(points, 5)
    assert {i: sorted(v) for i, v in found.items()} == expected


def test_fewer_rows_than_neighbours(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, 5.0)], "id long, x double")
    found = sorted((r.id, r.rank, r.neighbour_id) for r in knn.nearest_neighbours(df, "id", ["x"], 5).collect())
    assert found == [(1, 1, 2), (1, 2, 3), (2, 1, 1), (2, 2, 3), (3, 1, 2), (3, 2, 1)]


def test_folds_are_even_and_do_not_depend_on_partitions(spark, view):
    one = resample.stratified_folds(view.repartition(1), 5).select("id", "fold")
    many = resample.stratified_folds(view.repartition(9), 5).select("id", "fold")
    assert sorted(one.collect()) == sorted(many.collect())
    counts = resample.stratified_folds(view, 5).groupBy("is_fraud", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in counts if r.is_fraud == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_bootstrap_has_the_exact_size(view):
    n0, _ = resample.class_sizes(view)
    assert resample.bootstrap(view).count() == n0
    assert resample.bootstrap(view, 17).count() == 17
    up = resample.upsample(view)
    assert resample.class_sizes(up) == (n0, n0)
    assert set(up.columns) == set(view.columns)


def test_synthetic_rows_lie_between_two_minority_rows(view):
    columns = ["amt", "city_pop", "lat"]
    made = resample.smote_samples(view, columns).toPandas()
    rows = view.where("is_fraud = 1").toPandas().set_index("id")
    n0, n1 = resample.class_sizes(view)
    assert len(made) == n0 - n1
    for r in made.itertuples():
        a, b = rows.loc[r.base_id], rows.loc[r.neighbour_id]
        for c in ("amt", "lat"):
            assert getattr(r, c) == pytest.approx(a[c] + r.step * (b[c] - a[c]), abs=1e-9)
        assert float(r.city_pop).is_integer()
    balanced = resample.smote(view, columns)
    assert resample.class_sizes(balanced) == (n0, n0)


def test_smote_without_neighbours_adds_nothing(spark):
    df = spark.createDataFrame([(1, 1.0, 1), (2, 2.0, 0), (3, 3.0, 0)], "id long, x double, is_fraud int")
    assert resample.smote_samples(df, ["x"]).count() == 0


def test_nominal_columns_take_the_common_value(spark):
    df = spark.createDataFrame(
        [(i, float(i), 7 if i else 3, 1) for i in range(6)] + [(10 + i, 0.0, 1, 0) for i in range(20)],
        "id long, x double, g int, is_fraud int")
    made = resample.smote_samples(df, ["x", "g"], distance_cols=["x"], nominal_cols=["g"])
    assert {r.g for r in made.select("g").distinct().collect()} <= {3, 7}
    assert made.where("base_id = 0 and g <> 7").count() == 0


def test_label_codes(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    test = spark.createDataFrame([("c",), ("a",)], "c string")
    codes = encode.dictionary("c", train, test)
    assert {r.value: r.code for r in codes.collect()} == {"a": 0, "b": 1, "c": 2}
    kept = encode.apply_dictionary(train, "c", codes, invalid="keep").collect()
    assert sorted(r.c for r in kept) == [0, 1, 3]
    with pytest.raises(Exception, match="unseen label"):
        encode.apply_dictionary(train, "c", codes).collect()
    only_train = encode.dictionary("c", train)
    with pytest.raises(Exception, match="unseen label"):
        encode.apply_dictionary(test, "c", only_train).collect()


def test_large_dictionaries_give_the_same_codes(spark, monkeypatch):
    df = spark.range(3000).select(F.concat(F.lit("v"), (F.col("id") * 37 % 2500).cast("string")).alias("c"))
    expected = {r.value: r.code for r in encode.dictionary("c", df).collect()}
    monkeypatch.setattr(encode, "SMALL_DICTIONARY", 10)
    assert {r.value: r.code for r in encode.dictionary("c", df).collect()} == expected
    assert sorted(expected.values()) == list(range(2500))


def test_one_hot_drops_the_first_level_and_keeps_columns(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "g string")
    test = spark.createDataFrame([("b",), (None,), ("z",)], "g string")
    levels = {"g": encode.category_levels(train, "g")}
    assert [tuple(r) for r in encode.one_hot(train, ["g"], levels).collect()] == [(0, 0), (1, 0), (0, 1)]
    assert [tuple(r) for r in encode.one_hot(test, ["g"], levels).collect()] == [(1, 0), (0, 0), (0, 0)]


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(float(i), 5.0) for i in range(1, 5)], "x double, k double")
    rows = encode.standardise(df, ["x", "k"]).orderBy("x").collect()
    values = np.array([1.0, 2, 3, 4])
    assert [r.x for r in rows] == pytest.approx(list((values - 2.5) / values.std()))
    assert [r.k for r in rows] == [0.0] * 4


def test_neighbours_in_many_columns_visit_few_boxes(spark):
    import numpy as np

    draw = np.random.default_rng(8)
    centres = draw.normal(size=(40, 20)) * 3
    x = centres[draw.integers(0, 40, 3000)] + draw.normal(size=(3000, 20)) * 0.4
    x[:30] = x[0]
    x = (x - x.mean(0)) / x.std(0)
    names = [f"c{i}" for i in range(20)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, " + ", ".join(f"{n} double" for n in names))
    visited = []
    got = knn.nearest_neighbours(df, "id", names, 5, leaf_size=30, visited=visited).collect()
    assert sum(visited) < 3000 * 100 / 5 and visited[-1] == 0 and len(visited) > 2
    far = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2)
    np.fill_diagonal(far, np.inf)
    for i in range(0, 3000, 50):
        mine = [r.neighbour_id for r in sorted((r for r in got if r.id == i), key=lambda r: r.rank)]
        assert sorted(far[i][mine]) == pytest.approx(sorted(far[i])[:5]) and mine == sorted(mine, key=lambda j: (round(far[i][j], 9), j))


def test_neighbour_search_holds_few_distances_at_once():
    import tracemalloc

    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 3))
    ids = pd.Series([[i] for i in range(3000)])
    boxes = knn.cut_boxes(x, 1024)
    part = pd.DataFrame({"vid": range(3000), "x": list(x), "leaf": boxes.locate(x), "radius": 0.01})
    tracemalloc.start()
    found = sum(len(row) for row, _, _ in knn._best(x, x, ids, 6))
    asked = sum(len(out) for out in knn._next_boxes(SimpleNamespace(value=boxes), 0, 4)([part]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 18000 and asked == 3000
    assert peak < 48 << 20
