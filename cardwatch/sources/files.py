"""Reading transaction files and setting bad rows aside."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from cardwatch.schema import TRANSACTION

CORRUPT, ERRORS = "_corrupt_record", "_errors"
# Text formats of the source files.
FILE_TIMESTAMP, FILE_DATE = "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"


def load_transactions(
    spark: SparkSession, path: str, schema: T.StructType = TRANSACTION, form: str | None = None
) -> DataFrame:
    """Read CSV (with header) or Parquet with a declared schema.

    The schema names the columns by position, so the nameless first CSV column becomes ``id``.
    Nothing is inferred: inference would read all the data once more.
    """
    form = form or ("parquet" if path.rstrip("/").endswith("parquet") else "csv")
    if form == "parquet":
        return spark.read.schema(schema).parquet(path)
    return (
        spark.read.schema(schema)
        .options(header=True, timestampNTZFormat=FILE_TIMESTAMP, dateFormat=FILE_DATE)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Write a table in the source files' own format; the first header field stays empty."""
    renamed = df.withColumnRenamed(df.columns[0], " ")
    (
        renamed.write.mode("overwrite")
        .options(header=True, timestampNTZFormat=FILE_TIMESTAMP, dateFormat=FILE_DATE)
        .csv(path)
    )


def rename_first(df: DataFrame) -> DataFrame:
    """For files read without a schema: the nameless first column is ``_c0`` and becomes ``id``."""
    return df.withColumnRenamed("_c0", "id")


def _wall_clock(text: Column) -> Column:
    """Text in FILE_TIMESTAMP's form as a timestamp without zone, null otherwise. Never by way of an
    instant: hours that the session's zone skips are times like any other."""
    return F.when(text.rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$"), text.try_cast("timestamp_ntz"))


def _day(text: Column) -> Column:
    """Text in FILE_DATE's form as a date, null otherwise."""
    return F.when(text.rlike(r"^\d{4}-\d\d-\d\d$"), text.try_cast("date"))


def parse_times(
    df: DataFrame, timestamps=("trans_date_trans_time",), dates=("dob",)
) -> DataFrame:
    """Parse text columns to timestamps and dates; text that does not parse becomes null."""
    parsed = {c: _wall_clock(F.col(c)) for c in timestamps} | {c: _day(F.col(c)) for c in dates}
    return df.withColumns(parsed)


def count_failures(raw: DataFrame, timestamps=("trans_date_trans_time",), dates=("dob",)) -> DataFrame:
    """(column, failed): texts that are present but do not parse, in one pass over the rows."""
    broken = {c: F.col(c).isNotNull() & _wall_clock(F.col(c)).isNull() for c in timestamps}
    broken |= {c: F.col(c).isNotNull() & _day(F.col(c)).isNull() for c in dates}
    counted = raw.agg(*[F.count_if(b).alias(c) for c, b in broken.items()])
    return counted.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("failed")) for c in broken
    ])).alias("r")).select("r.*")


def parse_failures(raw: DataFrame, parsed: DataFrame, columns: list[str], key: str = "id"
                   ) -> DataFrame:
    """Texts that were present but did not parse, counted per column."""
    before = raw.agg(*[F.count(c).alias(c) for c in columns]).select(F.struct("*").alias("s")).scalar()
    after = parsed.agg(*[F.count(c).alias(c) for c in columns])
    return after.withColumn("_b", before).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), (F.col(f"_b.{c}") - F.col(c)).alias("failed"))
        for c in columns
    ])).alias("r")).select("r.*")


def _typed(name: str, kind: T.DataType) -> Column:
    """The text column as its declared type, null where it does not parse."""
    if isinstance(kind, T.StringType):
        return F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return _wall_clock(F.col(name)).cast(kind)
    if isinstance(kind, T.DateType):
        return _day(F.col(name)).cast(kind)
    return F.col(name).try_cast(kind)


def read_checked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read CSV with a declared schema and name the fields of each row that break it.

    Fields are read as text and converted here. A parser that converts by itself skips the
    columns a query does not ask for, and would pass their bad values as good; the ``_errors``
    column depends on every field whatever is selected later.
    """
    texts = T.StructType([
        *[T.StructField(f.name, T.StringType()) for f in schema], T.StructField(CORRUPT, T.StringType())
    ])
    raw = (
        spark.read.schema(texts)
        .options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT,
                 columnPruning=False)
        .csv(path)
    )
    errors = F.array_compact(F.array(
        F.when(F.col(CORRUPT).isNotNull(), F.lit(CORRUPT)),
        *[F.when(F.col(f.name).isNotNull() & _typed(f.name, f.dataType).isNull(), F.lit(f.name))
          for f in schema if not isinstance(f.dataType, T.StringType)],
    ))
    fields = F.concat_ws(",", *[F.coalesce(f.name, F.lit("")) for f in schema])
    return raw.select(
        *[_typed(f.name, f.dataType).alias(f.name) for f in schema],
        errors.alias(ERRORS), F.coalesce(CORRUPT, fields).alias(CORRUPT),
    )


def quarantine(checked: DataFrame, required: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with their text: broken values or missing required fields."""
    bad = _is_bad(required)
    return checked.where(~bad).drop(CORRUPT, ERRORS), checked.where(bad)


def _is_bad(required: list[str]) -> Column:
    bad = F.size(ERRORS) > 0
    for c in required:
        bad = bad | F.col(c).isNull()
    return bad


def set_aside(checked: DataFrame, path: str, required: list[str] = ()) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Good and bad rows as ``quarantine`` gives them, and their numbers, from one read of the source.

    The rows are parsed and written once, in a folder per status, and counted as they pass; both
    results read what was written.
    """
    seen = Observation()
    status = F.when(_is_bad(required), "bad").otherwise("good")
    marked = checked.withColumn("_status", status).observe(
        seen, F.count_if(F.col("_status") == "good").alias("good"), F.count_if(F.col("_status") == "bad").alias("bad"))
    marked.write.mode("overwrite").partitionBy("_status").parquet(path)
    schema = T.StructType([*checked.schema.fields, T.StructField("_status", T.StringType())])
    written = checked.sparkSession.read.schema(schema).parquet(path)
    good = written.where("_status = 'good'").drop(CORRUPT, ERRORS, "_status")
    return good, written.where("_status = 'bad'").drop("_status"), dict(seen.get)
