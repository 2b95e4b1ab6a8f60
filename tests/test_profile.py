import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardwatch.operators import eda, ordering, profile


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (1.0,), (None,), (None,)], "a double")
    assert profile.duplicate_count(df).first().duplicates == 3
    swapped = spark.createDataFrame([(1, None), (None, 1)], "a int, b int")
    assert profile.duplicate_count(swapped).first().duplicates == 0


def test_imbalance_is_null_without_positives(spark):
    row = profile.class_balance(spark.createDataFrame([(0,), (0,)], "is_fraud int")).first()
    assert row.positive_rate == 0 and row.imbalance_ratio is None and row.scale_pos_weight is None


def test_empty_tables(spark, view):
    empty = view.where("id < 0")
    assert profile.class_balance(empty).first().n == 0
    assert profile.duplicate_count(empty).first().duplicates == 0
    assert profile.describe(empty, "amt").first()["p50"] is None
    assert eda.histogram(empty, "amt").count() == 0
    assert eda.density_curve(empty, "amt").count() == 0
    assert eda.rate_by(empty, "gender").count() == 0
    assert profile.quality_report({"empty": empty}).first().missing_values == 0


@pytest.mark.parametrize("data", [
    [1.0, 2.0, 3.0, 4.0], [5.0], [2.0] * 7 + [9.0], list(np.random.default_rng(1).normal(size=501)),
])
def test_quantiles_match_pandas(spark, data):
    df = spark.createDataFrame([(float(x),) for x in data], "x double").repartition(4)
    found = {r.q: r.value for r in ordering.exact_quantiles(df, "x", [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    for q, value in found.items():
        assert value == pytest.approx(pd.Series(data).quantile(q), rel=1e-12)


def test_describe_matches_pandas_by_group(spark, view):
    expected = view.toPandas().groupby("is_fraud")["amt"].describe()
    for row in profile.describe(view, "amt", ["is_fraud"]).collect():
        e = expected.loc[row.is_fraud]
        assert [row["count"], row["mean"], row["std"], row["p25"], row["p50"], row["p75"]] == pytest.approx(
            [e["count"], e["mean"], e["std"], e["25%"], e["50%"], e["75%"]])


def test_dense_index_is_gapless_with_a_hot_range(spark):
    df = spark.range(0, 900).union(spark.range(10**12, 10**12 + 3)).repartition(5)
    rows = ordering.dense_index(df, "id").orderBy("id").collect()
    assert [r.rn for r in rows] == list(range(903))


def test_running_totals_descending(spark):
    df = spark.createDataFrame([(float(i), i) for i in range(100)], "x double, n long")
    rows = ordering.running_totals(df, "x", ["n"], descending=True).orderBy(F.desc("x")).collect()
    assert [r.cum_n for r in rows] == list(np.cumsum(range(99, -1, -1)))


def test_no_single_task_window_over_the_rows(spark, view):
    plan = ordering.dense_index(view.select("id"), "id")._jdf.queryExecution().executedPlan().toString()
    heads = [line for line in plan.splitlines() if "Window [" in line and "_in_" in line]
    assert heads and all("[_key" in line for line in heads)


def test_histogram_matches_numpy(spark, view):
    pdf = view.toPandas()
    for column, by in (("amt", None), ("amt", "is_fraud"), ("city_pop", None)):
        rows = eda.histogram(view, column, 50, by, density=True).collect()
        for key, part in (pdf.groupby(by) if by else [(None, pdf)]):
            counts, edges = np.histogram(part[column].astype(float), bins=50)
            mine = sorted((r for r in rows if by is None or r[by] == key), key=lambda r: r.bin)
            assert [r.n for r in mine] == list(counts)
            assert [r.bin_start for r in mine] == pytest.approx(list(edges[:-1]))
            density, _ = np.histogram(part[column].astype(float), bins=50, density=True)
            assert [r.density for r in mine] == pytest.approx(list(density))


def test_histogram_of_a_constant(spark):
    rows = eda.histogram(spark.createDataFrame([(3.0,)] * 4, "x double"), "x", 50).collect()
    counts, _ = np.histogram([3.0] * 4, bins=50)
    assert [r.n for r in sorted(rows, key=lambda r: r.bin)] == list(counts)


def test_density_integrates_to_about_one(spark, view):
    rows = eda.density_curve(view, "amt", points=400, cut=4.0).orderBy("point").collect()
    assert np.trapezoid([r.density for r in rows], [r.x for r in rows]) == pytest.approx(1.0, abs=1e-3)


def test_correlation_skips_missing_pairs(spark):
    pdf = pd.DataFrame({"a": [1, 2, None, 4, 5, 7.5], "b": [2, None, 1, 8, 9, 1.0], "c": [1e9, 1e9 + 1, 1e9 + 5, 1e9, 1e9 + 2, 1e9 + 9]})
    df = spark.createDataFrame([tuple(None if pd.isna(v) else float(v) for v in r) for r in pdf.to_numpy()], "a double, b double, c double")
    found = {(r.column_a, r.column_b): r.r for r in eda.correlations(df, ["a", "b", "c"]).collect()}
    expected = pdf.assign(c=pdf.c - 1e9).corr()  # the offset costs pandas digits
    for (i, j), r in found.items():
        assert r == pytest.approx(expected.loc[i, j], abs=1e-9)
    lower = eda.correlations(df, ["a", "b", "c"], lower_only=True).collect()
    assert {(r.column_a, r.column_b) for r in lower} == {("b", "a"), ("c", "a"), ("c", "b")}


def test_vif_equals_regression_without_intercept(spark, view):
    columns = ["amt", "city_pop", "lat"]
    x = view.select(columns).toPandas().to_numpy(float)
    for row in eda.variance_inflation(view, columns).collect():
        i = columns.index(row.feature)
        others = np.delete(x, i, axis=1)
        fit = others @ np.linalg.lstsq(others, x[:, i], rcond=None)[0]
        r2 = 1 - ((x[:, i] - fit) ** 2).sum() / (x[:, i] ** 2).sum()
        assert row.vif == pytest.approx(1 / (1 - r2), rel=1e-8)


def test_rate_is_null_when_a_class_is_absent(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (3, 1), (None, 1)], "h int, is_fraud int")
    assert {r.h: r.fraud_rate for r in eda.rate_by(df, "h").collect()} == {1: None, 2: None, 3: 0.5}
    assert {r.h: r.share_1 for r in eda.crosstab_rate(df, "h").collect()} == {1: 1.0, 2: 0.0, 3: 0.5}


def test_one_hot_vectors_of_any_number_of_levels(spark):
    from cardwatch.operators import encode

    df = spark.range(100_000).selectExpr("id", "concat('v', lpad(id, 6, '0')) AS level")
    codes = encode.dictionary("level", df)
    asked = spark.createDataFrame([(1, "v000000"), (2, "v000001"), (3, "v099999"), (4, None), (5, "new")], "id long, level string")
    rows = {r.id: r.level_vector for r in encode.one_hot_vector(asked, "level", codes).collect()}
    assert all(v.size == 99_999 for v in rows.values())
    assert {i: v.indices.tolist() for i, v in rows.items()} == {1: [], 2: [0], 3: [99_998], 4: [], 5: []}
    one = encode.one_hot_vector(asked, "level", codes.limit(0)).collect()
    assert len(one) == 5 and one[0].level_vector.size == 0


def test_density_of_shared_out_values_keeps_its_bound(spark):
    import numpy as np

    x = np.random.default_rng(1).gamma(2.0, 3.0, 4000)
    df = spark.createDataFrame([(float(v),) for v in x], "v double").repartition(3)
    h = 4000 ** -0.2 * x.std(ddof=1)
    for nodes in (200, 2000):
        apart = (x.max() - x.min()) / (nodes - 1)
        for r in eda.density_curve(df, "v", points=50, nodes=nodes).collect():
            exact = np.exp(-0.5 * ((r.x - x) / h) ** 2).sum() / (4000 * h * np.sqrt(2 * np.pi))
            assert abs(r.density - exact) <= 0.05 * apart**2 / h**3
