"""Hard negatives against brute force: exact scores, bounds, ties, odd rows."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwatch.llm import hardneg


def test_scores_are_inner_products():
    draw = np.random.default_rng(1)
    for reach, width in ((1, 8), (200, 64), (1 << 20, 24)):
        x, a = draw.integers(-reach, reach + 1, (300, width)), draw.integers(-reach, reach + 1, (7, width))
        assert (hardneg.scores(hardneg.bit_planes(x), hardneg.subset_sums(a)) == x @ a.T).all()
    zeros = np.zeros((3, 8), np.int64)
    assert (hardneg.scores(hardneg.bit_planes(zeros), hardneg.subset_sums(zeros)) == 0).all()


def _brute(rows, anchors, positives, negatives, low, high):
    out = []
    for i, label, x in anchors:
        scored = [(-sum(p * q for p, q in zip(x, y)), j, other) for j, other, y in rows if j != i]
        for s, j, _ in sorted(r for r in scored if r[2] == label)[:positives]:
            near = sorted(r for r in scored if r[2] != label and low * -s <= 100 * -r[0] <= high * -s)
            out += [(i, j, rank, k, -s, -t) for rank, (t, k, _) in enumerate(near[:negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize("block,meeting,group", [(50, 1, 7), (2048, 2, 8192)])
def test_mining_against_brute_force(spark, block, meeting, group):
    draw = np.random.default_rng(7)
    rows = []
    for i in range(900):
        label = 0 if draw.random() < 0.4 else int(draw.integers(1, 5))
        centre = np.array([40, 10, 0, 0, 5, 5, 9, 1, 0, 3][:10])
        rows.append((i, label, [int(v) for v in centre + draw.integers(-8, 9, 10)]))
    for i in range(300, 500):  # one vector very often
        rows[i] = (i, rows[i][1], rows[300][2])
    df = spark.createDataFrame(rows, "id long, label long, x array<long>").repartition(5)
    got = hardneg.mine(df, df.filter("id % 20 = 0"), 4, 6, 50, 97, block, meeting, group)
    assert sorted(tuple(r) for r in got.collect()) == _brute(rows, [r for r in rows if r[0] % 20 == 0], 4, 6, 50, 97)


def test_mining_odd_rows(spark):
    rows = [(0, 1, [3, 1]), (1, 1, [3, 2]), (1, 1, [3, 2]), (2, 2, [2, 1]), (3, 2, [2]), (4, None, [3, 1]), (5, 1, None),
            (6, 2, []), (None, 2, [2, 1]), (7, 2, [-5, -5]), (0, 1, [3, 1])]
    df = spark.createDataFrame(rows, "id long, label long, x array<long>").withColumns({c: F.lit(1) for c in ("key", "slot", "p", "n")})
    got = sorted(tuple(r) for r in hardneg.mine(df, df.filter("id = 0")).collect())
    # the repeated positive stands twice, row 3 counts as (2, 0); 6 and 7 score too little
    assert got == sorted(2 * [(0, 1, 1, 2, 11, 7), (0, 1, 2, 3, 11, 6)])
    assert hardneg.mine(df.limit(0), df.limit(0)).count() == 0 and hardneg.mine(df, df.limit(0)).count() == 0
    bad = spark.createDataFrame([([1.0, None],), ([float("nan")],), ([float("inf")],), (None,), ([0.5, -0.001],)], "v array<double>")
    assert [r[0] for r in bad.select(hardneg.whole(F.col("v"))).collect()] == [None, None, None, None, [128, -1]]
    with pytest.raises(Exception, match="inner products may reach"):
        hardneg.mine(*[spark.createDataFrame([(0, 1, [1 << 40]), (1, 1, [1 << 40])], "id long, label long, x array<long>")] * 2).collect()
