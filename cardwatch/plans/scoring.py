"""Scoring tables: probability, decision, risk band. Batch and stream use the same functions."""
from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from cardwatch.functions.checks import ratio
from cardwatch.functions.features import linear_score, over_threshold, risk_level, sigmoid
from cardwatch.operators.project import request_features


def with_decision(df: DataFrame, probability: Column, keep: list[str]) -> DataFrame:
    """keep..., is_fraud, fraud_probability, risk_level."""
    return df.withColumn("fraud_probability", probability).select(
        *keep, over_threshold(F.col("fraud_probability")).cast("boolean").alias("is_fraud"),
        "fraud_probability", risk_level(F.col("fraud_probability")).alias("risk_level"),
    )


def score(model: PipelineModel, df: DataFrame, keep: list[str] = ("id",)) -> DataFrame:
    """Score any batch or streaming table that has the model's raw columns."""
    scored = model.transform(df)
    return with_decision(scored, vector_to_array("probability")[1], list(keep))


def preprocess(df: DataFrame, features: list[str], means: dict[str, float] | None = None,
               stds: dict[str, float] | None = None, keep: list[str] = ()) -> DataFrame:
    """Request rows in training order, absent features 0, scaled when a scaler is given."""
    rows = request_features(df, features, list(keep))
    if means is None:
        return rows
    return rows.select(*keep, *[
        (F.lit(0.0) if not stds[c] else (F.col(c).cast("double") - means[c]) / stds[c]).alias(c)
        for c in features
    ])


def score_linear(df: DataFrame, weights: dict[str, float], intercept: float,
                 keep: list[str] = ("id",)) -> DataFrame:
    """Score with given coefficients (an exported logistic model)."""
    return with_decision(df, sigmoid(linear_score(weights, intercept)), list(keep))


def risk_summary(scored: DataFrame) -> DataFrame:
    """Rows, share and mean probability per risk band."""
    bands = scored.groupBy("risk_level").agg(
        F.count(F.lit(1)).alias("n"), F.avg("fraud_probability").alias("mean_probability")
    )
    total = bands.agg(F.sum("n").alias("t")).scalar()
    return bands.withColumn("share", ratio(F.col("n"), total))


def write_scores(scored: DataFrame, path: str) -> None:
    """Save scored rows by risk band, so that reading one band skips the others' files."""
    scored.write.mode("overwrite").partitionBy("risk_level").parquet(path)
