"""Profiling and data quality reports."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardwatch.functions.checks import is_missing, ratio, text_columns
from cardwatch.operators.ordering import exact_quantiles
from cardwatch.schema import LABEL


def _long_form(wide: DataFrame, columns: list[str], **measures: str) -> DataFrame:
    """Turn one row of ``<measure prefix><column>`` values into one row per column."""
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(f"{prefix}{c}").alias(out) for out, prefix in measures.items()],
        )
        for c in columns
    ])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def shape(named: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table, and its size relative to the first."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(i).alias("position"), F.lit(name).alias("dataset"), "n_rows",
            F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        )
        for i, (name, df) in enumerate(named.items())
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    base = F.first("n_rows").over(Window.orderBy("position"))  # one row per table
    return union.withColumn("share_of_first", ratio(F.col("n_rows"), base)).drop("position")


def missing_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, in one pass."""
    wide = df.agg(*[F.count_if(is_missing(df, c)).alias(f"m_{c}") for c in df.columns])
    return _long_form(wide, df.columns, missing="m_")


def total_missing(df: DataFrame) -> Column:
    total = F.lit(0).cast("bigint")
    for c in df.columns:
        total = total + F.count_if(is_missing(df, c))
    return total


def _copies(df: DataFrame) -> DataFrame:
    """Distinct rows and how often each occurs (nulls equal); copies collapse on the map side, so
    the only shuffle carries a repeated row once per task."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))


def _surplus() -> Column:
    return F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicates")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows equal to an earlier row (nulls equal)."""
    return _copies(df).agg(_surplus())


def class_balance(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Positive rate, negatives per positive, and the positive-class weight."""
    y = F.col(label)
    return df.agg(
        F.count(y).alias("n"),
        F.count_if(y == 0).alias("n_negative"),
        F.count_if(y == 1).alias("n_positive"),
        F.avg(y).alias("positive_rate"),
    ).withColumns({
        "imbalance_ratio": ratio(1 - F.col("positive_rate"), F.col("positive_rate")),
        "scale_pos_weight": ratio(F.col("n_negative"), F.col("n_positive")),
    })


def quality_report(named: dict[str, DataFrame], label: str = LABEL) -> DataFrame:
    """One row per table: missing values, duplicates, positive rate (null without a label).

    All three come from the distinct rows and their counts, so a table is read once.
    """
    report = None
    for name, df in named.items():
        n, missing = F.col("_n"), F.lit(0)
        for c in df.columns:
            missing = missing + is_missing(df, c).cast("int")
        rate = (
            ratio(F.sum(F.col(label) * n), F.sum(F.when(F.col(label).isNotNull(), n)))
            if label in df.columns else F.lit(None).cast("double")
        )
        part = _copies(df).agg(
            F.lit(name).alias("dataset"),
            F.coalesce(F.sum(missing * n), F.lit(0)).cast("bigint").alias("missing_values"),
            _surplus(), rate.alias("fraud_rate"),
        )
        report = part if report is None else report.unionByName(part)
    return report


def distinct_counts(df: DataFrame, columns: list[str] | None = None, approximate: bool = False,
                    ) -> DataFrame:
    """Distinct values of every non-string column, with the key and constant checks."""
    strings = set(text_columns(df))
    columns = columns or [c for c in df.columns if c not in strings]
    counter = (lambda c: F.approx_count_distinct(c, 0.01)) if approximate else F.count_distinct
    wide = df.agg(
        F.count(F.lit(1)).alias("n_rows"), *[counter(F.col(c)).alias(f"d_{c}") for c in columns]
    )
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"d_{c}").alias("n_distinct")) for c in columns
    ])
    return wide.select("n_rows", F.explode(rows).alias("r")).select(
        "r.column", "r.n_distinct",
        (F.col("r.n_distinct") == F.col("n_rows")).alias("is_key"),
        (F.col("r.n_distinct") <= 1).alias("is_constant"),
    )


def value_counts(df: DataFrame, column: str, sort_by_value: bool = False) -> DataFrame:
    """Rows per value without nulls; most frequent first, or in value order."""
    counts = (
        df.where(~is_missing(df, column)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.orderBy(column) if sort_by_value else counts.orderBy(F.desc("n"), column)


def describe(df: DataFrame, column: str, by: list[str] = ()) -> DataFrame:
    """count, mean, std (n - 1), min, quartiles, max; quartiles are exact and distributed."""
    by = list(by)
    present = df.where(~is_missing(df, column)).select(*by, F.col(column).cast("double").alias("x"))
    moments = present.groupBy(*by).agg(
        F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"), F.max("x").alias("max"),
    )
    quartiles = exact_quantiles(present, "x", [0.25, 0.5, 0.75], by=by)
    spread = quartiles.groupBy(*by).agg(*[
        F.max(F.when(F.col("q") == q, F.col("value"))).alias(name)
        for q, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
    ])
    out = (
        moments.join(spread, by, "left") if by
        else moments.withColumn("_q", spread.select(F.struct("p25", "p50", "p75")).scalar())
        .select("*", "_q.*")
    )
    return out.select(*by, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def info(df: DataFrame) -> DataFrame:
    """Name, type and non-null count of every column."""
    wide = df.agg(*[F.count(c).alias(f"n_{c}") for c in df.columns])
    types = F.create_map(*[
        F.lit(v) for f in df.schema for v in (f.name, f.dataType.simpleString())
    ])
    position = F.create_map(*[F.lit(v) for i, c in enumerate(df.columns) for v in (c, i)])
    return _long_form(wide, df.columns, non_null="n_").select(
        position[F.col("column")].cast("bigint").alias("position"), "column",
        types[F.col("column")].alias("type"), "non_null",
    )


def share(df: DataFrame, column: str) -> DataFrame:
    """Percent of the non-null rows per value; the window sees one row per value only."""
    counts = (
        df.where(~is_missing(df, column)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    )
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.withColumn("percent", ratio(F.col("n") * 100, total))


def preview(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    """First n rows in key order (top-n, no full sort)."""
    return df.orderBy(key).limit(n)
