"""Boosted trees against a plain version, searches against fits one by one."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwatch.operators import boosting
from cardwatch.operators.boosting import Fit, Params


def plain_round(x, y, w, margin, columns, p, level, rows):
    """One tree by trying every cut of every column; x is (row, column), NaN is missing."""
    g, h = (1 / (1 + np.exp(-margin)) - y) * w, np.maximum((q := 1 / (1 + np.exp(-margin))) * (1 - q), 1e-16) * w
    shrunk = lambda s: np.sign(s) * max(abs(s) - p.reg_alpha, 0)
    score = lambda s, t: shrunk(s) ** 2 / (t + p.reg_lambda)
    value = -p.learning_rate * shrunk(g[rows].sum()) / (h[rows].sum() + p.reg_lambda)
    best = None
    if level < p.max_depth:
        for c in columns:
            for cut in np.unique(x[:, c][~np.isnan(x[:, c])]):
                for side in (False, True):
                    left = (x[:, c] <= cut) | (np.isnan(x[:, c]) & side)
                    a, b = rows & left, rows & ~left
                    if min(h[a].sum(), h[b].sum()) < p.min_child_weight:
                        continue
                    gain = score(g[a].sum(), h[a].sum()) + score(g[b].sum(), h[b].sum()) - score(g[rows].sum(), h[rows].sum())
                    if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                        best = gain, left
    if best is None:
        return np.full(len(y), value)
    left, right = (plain_round(x, y, w, margin, columns, p, level + 1, rows & s) for s in (best[1], ~best[1]))
    return np.where(best[1], left, right)


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 12, (400, 4)).astype(float)
    x[rng.random((400, 4)) < 0.05] = np.nan
    y = ((np.nan_to_num(x[:, 0]) > 6) ^ (np.nan_to_num(x[:, 1]) * x[:, 2] > 30) ^ (rng.random(400) < 0.1)).astype(int)
    rows = [(i, int(t), i % 3, *[None if np.isnan(v) else float(v) for v in r]) for i, (t, r) in enumerate(zip(y, x))]
    df = spark.createDataFrame(rows, "id long, is_fraud int, fold int, a double, b double, c double, d double")
    return df.repartition(5), x, y


NAMES = ["a", "b", "c", "d"]


@pytest.mark.parametrize("params", [
    Params(n_estimators=3, max_depth=3), Params(n_estimators=6, max_depth=2, reg_alpha=1.5, reg_lambda=5, scale_pos_weight=3.0),
    Params(n_estimators=2, max_depth=6, learning_rate=0.1, reg_lambda=0, min_child_weight=3),
    Params(n_estimators=5, max_depth=3, colsample_bytree=0.5, subsample=0.6),
])
def test_trees_equal_a_plain_version(spark, sample, params):
    df, x, y = sample
    model = boosting.fit_boosted(df, NAMES, params)
    margin, w = np.zeros(len(y)), np.where(y == 1, params.scale_pos_weight, 1.0)
    for n in range(params.n_estimators):
        fit = Fit(params)
        fit.trees = [None] * n
        rows = np.ones(len(y), bool)
        if params.subsample < 1:
            rows = boosting.uniforms(np.arange(len(y)), n, params.seed) < params.subsample
        margin = margin + plain_round(x, y, w, margin, fit.columns(4), params, 0, rows)
    got = {r.id: r.score for r in model.predictions(df).collect()}
    assert [got[i] for i in range(len(y))] == pytest.approx(list(1 / (1 + np.exp(-margin))), abs=1e-9)
    path = f"{df.sparkSession.sparkContext._jvm.java.lang.System.getProperty('java.io.tmpdir')}/model-{np.random.randint(1 << 40)}"
    model.save(spark, path)
    assert boosting.BoostedModel.load(spark, path).to_json() == model.to_json()


def test_fits_side_by_side_equal_fits_alone(sample, monkeypatch):
    df, x, y = sample
    edges = boosting.bin_edges(df, NAMES)
    points = [Params(n_estimators=9, max_depth=4), Params(n_estimators=2, max_depth=2, reg_alpha=1, subsample=0.7),
              Params(n_estimators=6, max_depth=3, colsample_bytree=0.5)]
    blocks = boosting.packed(df, NAMES, edges, fold="fold", block=64)
    together = [Fit(p, fold, (2, p.n_estimators)) for p in points for fold in range(3)]
    told = []
    cells = boosting.Cells(edges)
    boosting.grow(blocks, together, cells, told.append)
    assert sorted(told) == list(range(9))
    # sums instead of rows, of one node at a time, and margins saved after each tree change nothing
    monkeypatch.setattr(boosting, "SUMS", 24 * cells.count)
    monkeypatch.setattr(boosting, "AHEAD", 1)
    for f, small in ((together[0], 0), (together[4], 0), (together[8], 60)):
        alone = Fit(f.params, f.fold, tuple(f.stages))
        boosting.grow(blocks, [alone], cells, small=small)
        assert alone.stages == f.stages and len(alone.trees) == f.params.n_estimators
        model, plain = (boosting.BoostedModel.of(m, NAMES, edges) for m in (f, alone))
        assert [sorted(zip(t.feature, t.cut)) for t in alone.trees] == [sorted(zip(t.feature, t.cut)) for t in f.trees]
        assert plain.margins(x.T) == pytest.approx(model.margins(x.T), abs=1e-9)
        for n, counts in f.stages.items():
            out = np.arange(len(y)) % 3 == f.fold
            told = model.margins(x.T, n)[out] > 0
            assert counts == [int((told == a)[y[out] == b].sum()) for a, b in ((False, 0), (True, 0), (False, 1), (True, 1))]


def test_small_tables_need_no_passes(sample, monkeypatch):
    df, x, y = sample
    edges = boosting.bin_edges(df, NAMES)
    cells, blocks = boosting.Cells(edges), boosting.packed(df, NAMES, edges, fold="fold", block=64)
    passes, sums, told = [], boosting._sums, []
    monkeypatch.setattr(boosting, "_sums", lambda *a: (passes.append(1), sums(*a))[1])
    monkeypatch.setattr(boosting, "TURNS", 0.25)  # several jobs
    points = [Params(n_estimators=7, max_depth=3, colsample_bytree=0.5), Params(n_estimators=3, max_depth=2, subsample=0.6)]
    fits = [[Fit(p, fold, (1, p.n_estimators)) for p in points for fold in range(3)] for _ in range(3)]
    boosting.grow(blocks, fits[0], cells, told.append)
    boosting.grow(blocks, fits[1], cells, keep=False)
    assert not passes and sorted(told) == list(range(6))
    boosting.grow(blocks, fits[2], cells, small=0)
    assert passes
    for whole, scored, passed in zip(*fits):
        assert whole.stages == scored.stages == passed.stages and not scored.trees
        assert [sorted(zip(t.feature, t.cut)) for t in whole.trees] == [sorted(zip(t.feature, t.cut)) for t in passed.trees]
        assert [sorted(t.value) for t in whole.trees] == [pytest.approx(sorted(t.value)) for t in passed.trees]


def test_edges_and_odd_tables(spark):
    df = spark.range(5000).selectExpr("id", "cast(id % 2 as int) is_fraud", "cast(id % 7 as double) few", "id / 10 many",
                                      "cast(null as double) none", "if(id % 9 = 0, double('NaN'), 1.0D) gaps")
    edges = boosting.bin_edges(df.repartition(7), ["few", "many", "none", "gaps"])
    assert edges[0].tolist() == list(range(7)) and len(edges[2]) == 0 and edges[3].tolist() == [1.0]
    assert 50 <= len(edges[1]) <= 62 and (np.diff(edges[1]) < 40).all()
    model = boosting.fit_boosted(df.limit(0), ["few", "many"], Params(n_estimators=2))
    assert [t["feature"] for t in model.trees] == [[-1], [-1]]
    assert model.predictions(df.limit(3)).select("score").distinct().collect()[0][0] == 0.5
    one_class = boosting.fit_boosted(df.withColumn("is_fraud", F.lit(1)), ["few"], Params(n_estimators=2, scale_pos_weight=None))
    assert one_class.predictions(df).agg(F.min("score")).first()[0] > 0.5


def test_search_scores_prefixes_and_goes_on_from_its_ledger(spark, sample, monkeypatch):
    from cardwatch.operators.resample import stratified_folds
    from cardwatch.plans import boosted
    from cardwatch.session import scratch_path

    df, ledger = sample[0].drop("fold"), scratch_path(spark, "ledger")
    points = [{"n_estimators": n, "max_depth": d, "learning_rate": 0.2, "class_weight": "balanced"} for d in (1, 3) for n in (2, 5)]
    grown = []
    grow = boosting.grow
    monkeypatch.setattr(boosting, "grow", lambda blocks, fits, *rest, **more: (grown.append(len(fits)), grow(blocks, fits, *rest, **more)))
    options = {"folds": 2, "columns": NAMES, "ledger": ledger}
    ranked, report = boosted.search(df, points[:3], **options)
    again, more = boosted.search(df, points, **options)
    assert grown == [4, 2]  # two shared fits a fold; then only what the ledger does not have
    assert boosted.search(df, points, **options)[1].collect() == more.collect() and grown == [4, 2]
    scores = {r.params: r.mean_score for r in more.collect()}
    assert all(scores[r.params] == r.mean_score for r in report.collect()) and len(scores) == 4 and again[0] in points

    folded = stratified_folds(df, 2).cache()
    want = []
    for fold in range(2):
        weight = df.where("is_fraud = 0").count() / df.where("is_fraud = 1").count()
        own = boosted.params_of(points[3])
        model = boosting.fit_boosted(folded.where(F.col("fold") != fold), NAMES, boosting.resolved(own, weight))
        row = model.predictions(folded.where(F.col("fold") == fold)).selectExpr(
            "2 * count_if(prediction = 1 AND label = 1) / (count_if(prediction = 1) + count_if(label = 1)) AS f1").first()
        want.append(row.f1)
    import json
    assert scores[json.dumps(points[3])] == pytest.approx(np.mean(want), abs=1e-9)
    folds = boosted.cross_validate(df, own, 2, NAMES).orderBy("fold").collect()
    assert [r.f1 for r in folds] == pytest.approx(want, abs=1e-9)


def test_a_table_of_several_nodes_rows_needs_no_passes(sample, monkeypatch):
    df, x, y = sample
    edges = boosting.bin_edges(df, NAMES)
    blocks = boosting.packed(df, NAMES, edges, fold="fold", block=64)
    passes, sums = [], boosting._sums
    monkeypatch.setattr(boosting, "PLAIN", 0)  # sums are exact, as in a table of many rows
    monkeypatch.setattr(boosting, "_sums", lambda *a: (passes.append(1), sums(*a))[1])
    fits = [[Fit(Params(n_estimators=4, max_depth=5, subsample=0.7), fold, (4,)) for fold in range(3)] for _ in range(2)]
    boosting.grow(blocks, fits[0], boosting.Cells(edges), small=100)
    assert not passes
    boosting.grow(blocks, fits[1], boosting.Cells(edges), small=99)
    assert passes
    for whole, passed in zip(*fits):
        assert whole.stages == passed.stages
        assert [sorted(zip(t.feature, t.cut, t.value)) for t in whole.trees] == [sorted(zip(t.feature, t.cut, t.value)) for t in passed.trees]


def test_columns_share_codes_and_keep_their_bins(monkeypatch):
    rng = np.random.default_rng(1)
    hour, day = rng.integers(0, 24, 9000), rng.integers(0, 7, 9000)
    bins = np.stack([hour, (hour + 3) // 2, rng.integers(0, 63, 9000), hour > 21, day, day > 4, np.full(9000, 63)]).astype(np.uint8)
    bins[0][::50] = 63  # missing
    monkeypatch.setattr(boosting, "SHARED", 1)
    codes, owner, meaning = boosting.coded(bins)
    assert len(codes) < 4 and codes.dtype == np.uint8
    assert (np.stack([m[codes[k]] for k, m in zip(owner, meaning)]) == bins).all()
    cells = boosting.Cells([np.arange(n) for n in (24, 14, 62, 2, 7, 2, 0)])
    rows, g = np.flatnonzero(hour % 3), rng.normal(size=9000)
    slot = day[rows] % 2
    got = cells.sums(codes, cells.tables(owner, meaning), rows, slot, 2, g[rows], None)
    for c, (a, b) in enumerate(zip(cells.starts, cells.starts[1:])):
        for s in range(2):
            at = np.where(bins[c] == 63, b - a - 1, bins[c])[rows[slot == s]]
            assert got[0, s, a:b] == pytest.approx(np.bincount(at, g[rows[slot == s]], b - a))
            assert got[1, s, a:b].tolist() == np.bincount(at, minlength=b - a).tolist()


def test_blocks_are_read_some_at_a_time(sample, monkeypatch):
    import glob

    import pyarrow.parquet as pq

    df = sample[0].coalesce(1)
    monkeypatch.setitem(boosting.GROUPS, "parquet.block.size", 4000)
    blocks = boosting.packed(df, NAMES, boosting.bin_edges(df, NAMES), block=1)
    found = [pq.ParquetFile(f).metadata for f in glob.glob(f"{blocks._saved_path}/*.parquet")]
    files = [f for f in found if f.num_rows > 4]
    assert files and all(f.num_row_groups > 1 for f in files)
