"""Keyed versions of the alignments that a row index would do implicitly.

No join here carries a broadcast hint: AQE measures the sides and splits skewed partitions.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def assign_by_key(
    left: DataFrame, right: DataFrame, key: str, column: str, name: str | None = None
) -> DataFrame:
    """Bring one column of ``right`` onto ``left``; rows without a partner get null."""
    name = name or column
    other = right.select(F.col(key).alias("_key"), F.col(column).alias("_value"))
    base = left.drop(name)
    return base.join(other, F.col(key) == F.col("_key"), "left").select(
        *base.columns, F.col("_value").alias(name)
    )


def combine_coefficients(
    long: DataFrame, penalties: list[float], prefix: str = "penalty_"
) -> DataFrame:
    """Coefficient tables side by side: one row per feature, one column per penalty."""
    wide = long.groupBy("feature").pivot("penalty", penalties).agg(F.first("coefficient"))
    return wide.select(
        "feature", *[F.col(f"`{p}`").alias(f"{prefix}{p:g}") for p in penalties]
    )


def union_all(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out
