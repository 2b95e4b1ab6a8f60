"""Small column helpers shared by the reports."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN for floating columns."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient as a double, null when the bottom is zero (ANSI mode raises on a plain `/`)."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(ratio(top, bottom), F.lit(0.0))


def columns_of(df: DataFrame, *kinds) -> list[str]:
    """Column names whose type is one of the given Spark type classes."""
    return [f.name for f in df.schema if isinstance(f.dataType, kinds)]


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of(df, T.NumericType)


def text_columns(df: DataFrame) -> list[str]:
    return columns_of(df, T.StringType)
