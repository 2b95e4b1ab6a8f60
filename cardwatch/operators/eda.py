"""Exploratory reports: rates, counts, histograms, densities, correlation, collinearity."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cardwatch.functions import features as feat
from cardwatch.functions.checks import is_missing, ratio
from cardwatch.schema import LABEL


def rate_by(df: DataFrame, column: str, label: str = LABEL) -> DataFrame:
    """Positive rate per value; null where one of the classes does not occur."""
    n1, n0 = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return (
        df.where(F.col(column).isNotNull()).groupBy(column)
        .agg(n1.alias("_n1"), n0.alias("_n0"))
        .select(column, F.when((F.col("_n1") > 0) & (F.col("_n0") > 0),
                               ratio(F.col("_n1"), F.col("_n1") + F.col("_n0"))).alias("fraud_rate"))
    )


def crosstab_rate(df: DataFrame, column: str, label: str = LABEL) -> DataFrame:
    """Row-normalised cross table of a column and the 0/1 label, without null groups."""
    share = [
        ratio(F.count_if(F.col(label) == v), F.count(label)).alias(f"share_{v}") for v in (0, 1)
    ]
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(*share)


# Value order of the bounded dimensions; the others list the values they hold.
COUNT_ORDER = {
    "period_of_day": feat.PERIODS,
    "age_band": feat.AGE_BAND_LABELS,
    "city_pop_group": feat.CITY_GROUP_LABELS,
}
COUNT_DIMENSIONS = [
    "category", "gender", "trans_month", "period_of_day", "age_band", "state_region",
    "city_pop_group",
]


def positive_counts(df: DataFrame, dimensions=None, order=None, label: str = LABEL) -> DataFrame:
    """Positives per value of several dimensions in one pass; listed values may count 0."""
    dimensions = dimensions or COUNT_DIMENSIONS
    order = COUNT_ORDER if order is None else order
    pairs = df.where(F.col(label) == 1).select(F.explode(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"))
        for d in dimensions
    ])).alias("p")).select("p.*").where("value IS NOT NULL")
    counts = pairs.groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("n"))
    listed = [(d, v, i) for d in dimensions for i, v in enumerate(order.get(d, []))]
    slots = df.sparkSession.createDataFrame(
        listed, "dimension string, value string, position int"
    )
    return (
        counts.join(slots, ["dimension", "value"], "full")
        .select("dimension", "value", "position", F.coalesce("n", F.lit(0)).alias("n"))
    )


def histogram(
    df: DataFrame, column: str, bins: int = 50, by: str | None = None, density: bool = False
) -> DataFrame:
    """Equal-width histogram per group, all bins listed, the last bin closed on the right.

    Two passes over one or two columns: the range, then a map-side combined count per bin.
    """
    keys = [by] if by else []
    rows = df.where(~is_missing(df, column)).select(*keys, F.col(column).cast("double").alias("x"))
    if by:
        rows = rows.where(F.col(by).isNotNull())
    flat = F.min("x") == F.max("x")
    limits = F.struct(
        F.when(flat, F.min("x") - 0.5).otherwise(F.min("x")).alias("lo"),
        F.when(flat, F.max("x") + 0.5).otherwise(F.max("x")).alias("hi"),
        F.count("x").alias("n"),
    )
    groups = rows.groupBy(*keys).agg(limits.alias("s")).where("s.n > 0")
    fitted = rows.join(groups, by) if by else rows.withColumn("s", rows.agg(limits.alias("s")).scalar())
    low, width = F.col("s.lo"), (F.col("s.hi") - F.col("s.lo")) / bins
    first_guess = F.least(
        F.floor((F.col("x") - low) * (F.lit(float(bins)) / (F.col("s.hi") - low))),
        F.lit(bins - 1).cast("bigint"),
    )
    # The guess may miss by one through rounding; the edges decide, so bin and edge always agree.
    bin_of = (
        F.when(F.col("x") < low + F.col("b") * width, F.col("b") - 1)
        .when((F.col("b") < bins - 1) & (F.col("x") >= low + (F.col("b") + 1) * width),
              F.col("b") + 1)
        .otherwise(F.col("b"))
    )
    counts = (
        fitted.withColumn("b", first_guess).withColumn("bin", bin_of.cast("int"))
        .groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    )
    slots = groups.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    full = slots.join(counts, [*keys, "bin"], "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    out = [
        *keys, "bin", (low + F.col("bin") * width).alias("bin_start"),
        F.when(F.col("bin") == bins - 1, F.col("s.hi"))
        .otherwise(low + (F.col("bin") + 1) * width).alias("bin_end"),
        n.alias("n"),
    ]
    if density:
        out.append((n / (F.col("s.n") * width)).alias("density"))
    return full.select(*out)


#: Nodes that values are shared out to, and how many nodes' kernels are evaluated together.
NODES, KERNEL_ROWS = 262_144, 4096


def _kernel_sums(points: int, cut: float, nodes: int):
    """Task function: the grid and the sum of kernels at each of its points over one partition."""
    def partition(batches):
        weight = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x, n, low, high, width = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            n, low, high, h = n[0], low[0], high[0], width[0]
            step = (high - low + h * (2 * cut)) / (points - 1)
            if not (h > 0 and step > 0):
                continue
            if weight is None:
                weight, apart = np.zeros(nodes + 1), (high - low) / (nodes - 1)
            place = (x - low) / apart
            node = np.minimum(place.astype(np.int64), nodes - 1)
            share = place - node
            weight += np.bincount(node, 1 - share, nodes + 1) + np.bincount(node + 1, share, nodes + 1)
        if weight is not None:
            grid, total = low - h * cut + np.arange(points) * step, np.zeros(points)
            held = np.flatnonzero(weight)
            for start in range(0, len(held), KERNEL_ROWS):
                some = held[start:start + KERNEL_ROWS]
                z = (grid[:, None] - (low + some * apart)) / h
                total += np.exp(-0.5 * z * z) @ weight[some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(points, dtype="int32")), pa.array(grid), pa.array(total),
                 pa.array(np.full(points, n * h * np.sqrt(2 * np.pi)))], names=["point", "x", "k", "norm"],
            )

    return partition


def density_curve(
    df: DataFrame, column: str, points: int = 200, cut: float = 0.0, nodes: int = NODES
) -> DataFrame:
    """Gaussian kernel density on an even grid, bandwidth n^(-1/5) times the sample deviation.

    A value is shared out to the two nearest of ``nodes`` even nodes, in proportion to its nearness,
    and kernels are evaluated once per node and task: the work a row is constant, and a task sends
    one row per grid point. For nodes d apart and bandwidth h a density is off by at most
    0.05 d^2 / h^3; where the density is smooth, by about d^2 / 12 times its second derivative.
    """
    rows = df.where(~is_missing(df, column)).select(F.col(column).cast("double").alias("x"))
    moments = rows.agg(F.struct(
        F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"),
        (F.pow(F.count("x").cast("double"), F.lit(-0.2)) * F.stddev_samp("x")).alias("h"),
    ).alias("s")).scalar()
    fitted = rows.withColumn("s", moments).select("x", "s.*")
    sums = fitted.mapInArrow(_kernel_sums(points, cut, nodes), "point int, x double, k double, norm double")
    return sums.groupBy("point").agg(
        F.first("x").alias("x"), (F.sum("k") / F.first("norm")).alias("density")
    )


def _pair_sums(batches):
    """Sums over the rows both columns of a pair have, for all pairs of one partition."""
    total = None
    for batch in batches:
        x = np.column_stack([
            c.to_numpy(zero_copy_only=False).astype("float64") for c in batch.columns
        ])
        present = ~np.isnan(x)
        value, mask = np.where(present, x, 0.0), present.astype("float64")
        sums = np.stack([
            mask.T @ mask, value.T @ mask, mask.T @ value, (value * value).T @ mask,
            mask.T @ (value * value), value.T @ value,
        ])
        total = sums if total is None else total + sums
    if total is not None:
        i, j = np.triu_indices(total.shape[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(i), pa.array(j), *[pa.array(t[i, j]) for t in total]],
            names=["i", "j", *_PAIR_SUMS],
        )


_PAIR_SUMS = ["n", "sx", "sy", "sxx", "syy", "sxy"]


def pair_moments(df: DataFrame, columns: list[str], centred: bool = True) -> DataFrame:
    """n, sum x, sum y, sum x2, sum y2, sum xy for every column pair i <= j in one pass.

    Hundreds of separate ``corr`` aggregates fall out of code generation; one matrix product per
    Arrow batch does not. A task emits one row per pair, whatever its number of input rows.
    """
    plain = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    if centred:
        means = plain.agg(F.struct(*[F.avg(F.nanvl(c, F.lit(None))).alias(c) for c in columns])
                          .alias("m")).scalar()
        plain = plain.withColumn("_m", means).select(
            *[(F.col(c) - F.coalesce(F.col(f"_m.{c}"), F.lit(0.0))).alias(c) for c in columns]
        )
    schema = "i bigint, j bigint, " + ", ".join(f"{s} double" for s in _PAIR_SUMS)
    return plain.mapInArrow(_pair_sums, schema).groupBy("i", "j").agg(
        *[F.sum(s).alias(s) for s in _PAIR_SUMS]
    )


def correlations(df: DataFrame, columns: list[str], lower_only: bool = False) -> DataFrame:
    """Pearson correlation of every pair over the rows where both are present, in long form."""
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    vx = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")
    vy = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    r = F.when((F.col("n") > 1) & (vx > 0) & (vy > 0), cov / F.sqrt(vx * vy))
    half = pair_moments(df, columns).select("i", "j", r.alias("r"))
    names = F.array(*[F.lit(c) for c in columns])
    if lower_only:
        pairs = half.where("i < j").select(F.col("j").alias("i"), F.col("i").alias("j"), "r")
    else:
        both = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
            F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))
        )
        pairs = half.select(F.explode(both).alias("p"), "r").select("p.i", "p.j", "r")
    return pairs.select(
        names[F.col("i")].alias("column_a"), names[F.col("j")].alias("column_b"), "r"
    )


def variance_inflation(df: DataFrame, columns: list[str], keep_below: float = 10.0) -> DataFrame:
    """Variance inflation factor of each column against the others, without an intercept.

    VIF_i = G_ii * inv(G)_ii for the Gram matrix G, which one pass delivers; the p x p inverse is
    the only driver step.
    """
    complete = df.dropna(subset=columns)
    sums = pair_moments(complete, columns, centred=False).select("i", "j", "sxy").collect()
    gram = np.zeros((len(columns), len(columns)))
    for row in sums:
        gram[row.i, row.j] = gram[row.j, row.i] = row.sxy
    scale = np.sqrt(np.diag(gram))
    scale[scale == 0] = 1.0
    unit = gram / np.outer(scale, scale)
    try:
        inverse = np.linalg.inv(unit)
        vif = [float(v) for v in np.diag(unit) * np.diag(inverse)]
    except np.linalg.LinAlgError:  # exactly collinear columns
        vif = [float("inf")] * len(columns)
    return df.sparkSession.createDataFrame(
        [(c, v, v <= keep_below) for c, v in zip(columns, vif)],
        "feature string, vif double, keep boolean",
    )
