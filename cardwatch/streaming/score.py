"""Scoring and hourly rates over a stream of files."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from cardwatch.functions.checks import ratio
from cardwatch.session import exists, scratch_path


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType | str, pattern: str = "*.parquet",
    files_per_batch: int = 1000,
) -> DataFrame:
    """Parquet files of a folder as a stream; the schema is declared, never inferred."""
    return (
        spark.readStream.schema(schema)
        .options(pathGlobFilter=pattern, maxFilesPerTrigger=files_per_batch)
        .parquet(folder)
    )


def score_stream(stream: DataFrame, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply a batch scorer, such as ``functools.partial(score, model)``; no state is kept."""
    return scorer(stream)


def hourly_rate(
    stream: DataFrame, time: str, flag: str, delay: str = "1 hour", width: str = "1 hour"
) -> DataFrame:
    """Rows and share of flagged rows per event-time window.

    Rows later than the delay are dropped and finished windows leave the state, so the state
    holds the open windows only. Counts combine on the map side before the shuffle.
    """
    # Watermarks need an instant. A timestamp without a zone is counted from the epoch as it
    # reads, so the windows do not move with the session's time zone.
    wall = isinstance(stream.schema[time].dataType, T.TimestampNTZType)
    if wall:
        since = f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {time})"
        stream = stream.withColumn(time, F.expr(f"timestamp_micros({since})"))

    def edge(name: str):
        if not wall:
            return F.col(name)
        return F.expr(
            f"timestampadd(MICROSECOND, unix_micros({name}), TIMESTAMP_NTZ'1970-01-01 00:00:00')"
        )

    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, width).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(flag) == 1).alias("n_flagged"))
        .select(edge("w.start").alias("window_start"), edge("w.end").alias("window_end"),
                "n", "n_flagged", ratio(F.col("n_flagged"), F.col("n")).alias("rate"))
    )


def drain(stream: DataFrame, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process what is available to a Parquet sink and read it back.

    The sink and its checkpoint live in the shared folder, so a restarted query goes on where it
    stopped and writes each batch once.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, "stream-out")
    checkpoint = checkpoint or scratch_path(spark, "stream-state")
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def upsert_hours(rates: DataFrame, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process what is available of an hourly rate and return every hour so far, open ones included.

    Each micro-batch writes the hours it changed to a folder of its own number. A batch that is run
    again after a failure replaces that folder, so it changes nothing; the newest batch of an hour
    holds. Later runs with the same folders go on where the last one stopped.
    """
    spark = rates.sparkSession
    path = path or scratch_path(spark, "hours")
    checkpoint = checkpoint or scratch_path(spark, "hours-state")

    def put(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    query = (
        rates.writeStream.outputMode("update").foreachBatch(put)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return hours_so_far(spark, path, rates.schema)


def hours_so_far(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest row of every hour that the batches have written."""
    columns = [f.name for f in schema if f.name != "window_start"]
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    written = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
    return written.groupBy("window_start").agg(F.max_by(F.struct(*columns), "batch").alias("r")).select(
        "window_start", "r.*")
