"""From raw transaction columns to a feature vector, as one persistable pipeline.

The stages hold the same SQL expressions as ``functions.features``. Resampling is not a stage:
it belongs to training data only.
"""
from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    ElementwiseProduct, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

from cardwatch.functions.features import DEMOGRAPHIC, GEOGRAPHIC, TEMPORAL, Layers, enrich
from cardwatch.operators import project
from cardwatch.operators.encode import encode_labels
from cardwatch.schema import CATEGORICAL, FEATURES, LABEL, NOT_MODELLED

#: Model columns in training order; label-coded features carry the suffix.
MODEL_COLUMNS = [f"{c}_code" if c in CATEGORICAL else c for c in FEATURES]
_WHOLE = [c for c in MODEL_COLUMNS if c not in
          ("amt", "hour_sin", "hour_cos", "month_sin", "month_cos")]


def sql_stages(layers: Layers) -> list[SQLTransformer]:
    return [
        SQLTransformer(statement="SELECT *, " + ", ".join(
            f"{sql} AS {name}" for name, sql in layer.items()) + " FROM __THIS__")
        for layer in layers
    ]


def feature_pipeline(invalid: str = "keep") -> Pipeline:
    """Derive, label-code in alphabetical order, and assemble."""
    codes = StringIndexer(
        inputCols=CATEGORICAL, outputCols=[f"{c}_code" for c in CATEGORICAL],
        stringOrderType="alphabetAsc", handleInvalid=invalid,
    )
    numeric = [c for c in FEATURES if c not in CATEGORICAL]
    absent_as_zero = SQLTransformer(statement=(
        f"SELECT * EXCEPT ({', '.join(numeric)}), "
        + ", ".join(f"coalesce({c}, 0) AS {c}" for c in numeric) + " FROM __THIS__"
    ))
    return Pipeline(stages=[
        *sql_stages(TEMPORAL + DEMOGRAPHIC + GEOGRAPHIC), absent_as_zero, codes,
    ])


def fit_features(train: DataFrame, *others: DataFrame, invalid: str = "keep") -> PipelineModel:
    """Fit the encoder on the training rows, or on their union with other tables."""
    rows = train
    for other in others:
        rows = rows.unionByName(other, allowMissingColumns=True)
    return feature_pipeline(invalid).fit(rows)


def model_table(
    features: PipelineModel, df: DataFrame, keep: list[str] = ("id", LABEL)
) -> DataFrame:
    """Encoded numeric columns in training order, whole numbers as integers."""
    return features.transform(df).select(*keep, *[
        F.col(c).cast("bigint") if c in _WHOLE
        else F.col(c).cast("double") for c in MODEL_COLUMNS
    ])


def assembler(columns: list[str] = MODEL_COLUMNS, output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol=output, handleInvalid="keep")


def scaling_stages(n: int, width: int) -> list:
    """Standardise with the population deviation.

    The built-in scaler divides by the sample deviation; the second stage turns that into the
    population one for the n rows the scaler was fitted on.
    """
    factor = (n / (n - 1)) ** 0.5 if n > 1 else 1.0
    return [
        StandardScaler(inputCol="raw_features", outputCol="sample_scaled", withMean=True, withStd=True),
        ElementwiseProduct(inputCol="sample_scaled", outputCol="features",
                           scalingVec=Vectors.dense([factor] * width)),
    ]


def coded(train: DataFrame, test: DataFrame, invalid: str = "error", keep: list[str] = ("id",)
          ) -> tuple[DataFrame, DataFrame]:
    """keep..., features, label of both tables, label-coded on their union; DataFrames only."""
    wide = [
        project.label_last(enrich(t), [*keep, *FEATURES], LABEL) for t in (train, test)
    ]
    return encode_labels(wide[0], wide[1], CATEGORICAL, invalid)


def engineered(train: DataFrame, test: DataFrame, invalid: str = "error"
               ) -> tuple[DataFrame, DataFrame]:
    """The feature tables of both parts: modelled columns only, aligned, label last."""
    parts = [project.drop_columns(t, NOT_MODELLED) for t in coded(train, test, invalid)]
    return project.align(*parts)
