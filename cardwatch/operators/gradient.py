"""Logistic regression by batch gradient ascent, and its penalised likelihood."""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cardwatch.functions.features import linear_score, sigmoid
from cardwatch.session import saved

# Step, iterations and penalties of the exploratory analysis.
STEP_SIZE = 5e-6
ITERATIONS = 10
PENALTIES = [0.0, 4.0, 10.0, 1000.0]


def stable_log_likelihood(score: Column, label: Column) -> Column:
    """(y - 1) s - ln(1 + e^-s) without overflow for very negative scores."""
    softplus = F.when(score >= 0, F.log1p(F.exp(-score))).otherwise(
        F.log1p(F.exp(score)) - score
    )
    return (label - 1) * score - softplus


def log_likelihood(
    df: DataFrame, weights: dict[str, float], label: str, penalty: float = 0.0,
    unpenalised: list[str] = (),
) -> DataFrame:
    """Sum over all rows minus penalty * sum of squared weights (except the unpenalised ones)."""
    score = linear_score(weights)
    held = penalty * math.fsum(w * w for c, w in weights.items() if c not in unpenalised)
    return df.agg(
        (F.sum(stable_log_likelihood(score, F.col(label).cast("double"))) - F.lit(held))
        .alias("log_likelihood")
    )


def _slopes(weights: np.ndarray):
    """Task function: sum of error x feature per penalty and feature, over one partition.

    A task returns penalties x features numbers, whatever its number of rows. As one matrix
    product per Arrow batch it is also faster than as many generated sums, which outgrow what
    the JVM compiles.
    """
    def partition(batches):
        total = None
        for batch in batches:
            rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            y, x = rows[:, :1], rows[:, 1:]
            error = y - 1.0 / (1.0 + np.exp(-(x @ weights.T)))
            total = error.T @ x if total is None else total + error.T @ x
        if total is not None:
            i, j = (index.ravel() for index in np.indices(total.shape))
            yield pa.RecordBatch.from_arrays(
                [pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "slope"]
            )

    return partition


def gradient_ascent(
    df: DataFrame,
    features: list[str],
    label: str,
    penalties: list[float] = (0.0,),
    step: float = STEP_SIZE,
    iterations: int = ITERATIONS,
    unpenalised: list[str] | None = None,
) -> DataFrame:
    """(penalty, feature, coefficient) after a fixed number of full-batch steps from zero.

    All penalties share each pass over the data, and the driver keeps features x penalties
    numbers. The first feature is not penalised unless ``unpenalised`` says otherwise.
    """
    free = set(features[:1] if unpenalised is None else unpenalised)
    shrink = np.outer(penalties, [0.0 if c in free else 2.0 for c in features])
    weights = np.zeros(shrink.shape)
    rows = df.select(F.col(label).cast("double").alias("_y"),
                     *[F.col(c).cast("double").alias(c) for c in features])
    rows = saved(rows, "ascent")
    for _ in range(iterations):
        slopes = np.zeros(shrink.shape)
        sums = rows.mapInArrow(_slopes(weights), "i bigint, j bigint, slope double")
        for r in sums.groupBy("i", "j").agg(F.sum("slope").alias("slope")).collect():
            slopes[r.i, r.j] = r.slope
        weights = weights + step * (slopes - shrink * weights)
    return df.sparkSession.createDataFrame(
        [(float(p), c, float(weights[i, j])) for i, p in enumerate(penalties)
         for j, c in enumerate(features)],
        "penalty double, feature string, coefficient double",
    )


def score_with_penalties(
    df: DataFrame, coefficients: DataFrame, features: list[str], keep: list[str]
) -> DataFrame:
    """Long table (keep..., penalty, score) of the fitted models on another table."""
    fitted: dict[float, dict[str, float]] = {}
    for row in coefficients.collect():  # features x penalties rows
        fitted.setdefault(row.penalty, {})[row.feature] = row.coefficient
    scores = F.array(*[
        F.struct(F.lit(p).alias("penalty"),
                 sigmoid(linear_score({c: w[c] for c in features})).alias("score"))
        for p, w in sorted(fitted.items())
    ])
    return df.select(*keep, F.explode(scores).alias("s")).select(*keep, "s.penalty", "s.score")
