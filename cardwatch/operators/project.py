"""Column selection, alignment and request filling."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from cardwatch.schema import LABEL, REQUEST_DEFAULTS


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop the listed columns; names that are absent are ignored."""
    return df.drop(*names)


def of_class(df: DataFrame, value: int, label: str = LABEL) -> DataFrame:
    return df.where(F.col(label) == value)


def zero_for(data_type: T.DataType) -> Column:
    return F.lit(0).cast(data_type) if isinstance(data_type, T.NumericType) else F.lit(0)


def with_missing_as_zero(df: DataFrame, like: DataFrame, label: str = LABEL) -> DataFrame:
    """Add the other table's columns as 0, except the label."""
    absent = [f for f in like.schema if f.name not in df.columns and f.name != label]
    return df.withColumns({f.name: zero_for(f.dataType) for f in absent}) if absent else df


def label_last(df: DataFrame, features: list[str], label: str = LABEL) -> DataFrame:
    return df.select(*features, *([label] if label in df.columns else []))


def align(train: DataFrame, test: DataFrame, label: str = LABEL) -> tuple[DataFrame, DataFrame]:
    """Give both tables the same columns in the same order, the label at the end."""
    wide_train = with_missing_as_zero(train, test, label)
    wide_test = with_missing_as_zero(test, train, label)
    features = [c for c in wide_train.columns if c != label]
    return label_last(wide_train, features, label), label_last(wide_test, features, label)


def split_xy(df: DataFrame, features: list[str], key: str = "id", label: str = LABEL) -> DataFrame:
    """Key, features as one double array, and the label (null where the table has none)."""
    y = F.col(label).cast("double") if label in df.columns else F.lit(None).cast("double")
    return df.select(
        key, F.array(*[F.col(c).cast("double") for c in features]).alias("features"),
        y.alias("label"),
    )


def request_features(df: DataFrame, features: list[str], keep: list[str] = ()) -> DataFrame:
    """The model's features in training order; a feature the request lacks is 0."""
    return df.select(
        *keep, *[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in features]
    )


def request_defaults(df: DataFrame, defaults: dict[str, float] | None = None) -> DataFrame:
    """Replace null or absent optional fields by their default."""
    defaults = REQUEST_DEFAULTS if defaults is None else defaults
    filled = {}
    for name, value in defaults.items():
        if name in df.columns:
            filled[name] = F.coalesce(F.col(name), F.lit(value).cast(df.schema[name].dataType))
        else:
            filled[name] = F.lit(value)
    return df.withColumns(filled)
