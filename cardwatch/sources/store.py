"""Saved models, run summaries and the model registry."""
from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StandardScalerModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardwatch.session import exists


def save_model(model: PipelineModel, root: str, run_id: str, name: str) -> str:
    """Encoder, scaler and classifier in one directory, so that they cannot drift apart."""
    path = f"{root}/models/run_id={run_id}/{name}"
    model.write().overwrite().save(path)
    return path


def load_model(root: str, run_id: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{root}/models/run_id={run_id}/{name}")


def model_info(model: PipelineModel, features: list[str]) -> dict:
    """Type, number of features, the first ten names, and whether a scaler is part of it."""
    return {
        "model_type": type(model.stages[-1]).__name__,
        "num_features": len(features),
        "features": list(features[:10]),
        "scaler_available": any(isinstance(s, StandardScalerModel) for s in model.stages),
    }


def write_summary(comparison: DataFrame, infos: dict[str, dict], best: str, root: str, run_id: str,
                  ) -> bool:
    """One JSON row per model of a run: its metrics, its description, and whether it won.

    A run is written once: rows go to the run's own partition, in place of those of an attempt that
    died, and the run counts from the moment its commit marker stands. Returns False, and writes
    nothing, if the run is committed already.
    """
    spark = comparison.sparkSession
    if commits(spark, root).where(F.col("run_id") == run_id).count():
        return False
    described = spark.createDataFrame(
        [(m, i["model_type"], i["num_features"], i["features"], i["scaler_available"], m == best)
         for m, i in infos.items()],
        "model string, model_type string, num_features int, features array<string>, "
        "scaler_available boolean, is_best boolean",
    )
    rows = comparison.join(described, "model", "left").withColumns(
        {"run_id": F.lit(run_id), "saved_at": F.current_timestamp()})
    _put(rows, f"{root}/runs")
    _put(spark.createDataFrame([(len(infos), run_id)], "models int, run_id string"), f"{root}/commits")
    return True


def _put(rows: DataFrame, path: str) -> None:
    """Replace the partitions of the runs that ``rows`` holds, and no others."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").json(path))


def commits(spark: SparkSession, root: str) -> DataFrame:
    """(models, run_id) of every committed run."""
    schema = "models int, run_id string"
    if not exists(spark, f"{root}/commits"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{root}/commits")


SUMMARY_SCHEMA = (
    "model string, name string, accuracy double, f1 double, auc double, precision double, "
    "recall double, false_negatives bigint, false_positives bigint, true_positives bigint, "
    "true_negatives bigint, score double, model_type string, num_features int, "
    "features array<string>, scaler_available boolean, is_best boolean, saved_at timestamp, "
    "run_id string"
)


def registry(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all committed runs."""
    committed = commits(spark, root).select("run_id")
    if not exists(spark, f"{root}/runs"):
        return spark.createDataFrame([], SUMMARY_SCHEMA)
    return spark.read.schema(SUMMARY_SCHEMA).json(f"{root}/runs").join(committed, "run_id", "left_semi")


def latest_runs(runs: DataFrame) -> DataFrame:
    """The newest row of each model."""
    columns = [c for c in runs.columns if c != "model"]
    return runs.groupBy("model").agg(
        F.max_by(F.struct(*columns), F.struct("saved_at", "run_id")).alias("r")
    ).select("model", "r.*")
