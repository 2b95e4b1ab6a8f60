"""Global order without a single-task window.

A window without PARTITION BY moves every row to one task. These helpers cut the ordered column
into ranges first, take one small total per range, turn the totals into offsets, and let the
window run inside each range. Only the per-range totals (a few numbers per range) meet in one
place. The range limits are fitted from a quantile sketch; they steer the load, not the result.
"""
from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

MAX_RANGES = 65536


def range_count(df: DataFrame) -> int:
    """Ranges to cut: a few per shuffle task, so a range stays well below a task's memory."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(8, min(4 * tasks, MAX_RANGES))


def quantile_limits(df: DataFrame, column: str, ranges: int) -> list[float]:
    """Strictly increasing inner limits from one pass of a mergeable quantile sketch.

    An error of one range's share is enough for limits that only steer the load; the sketch a task
    keeps grows with its inverse.
    """
    if ranges < 2:
        return []
    steps = [i / ranges for i in range(1, ranges)]
    found = df.select(F.col(column).cast("double").alias("v")).approxQuantile(
        "v", steps, 1.0 / ranges
    )
    return sorted(set(found))


def with_range(df: DataFrame, column: str, limits: list[float], name: str = "_range") -> DataFrame:
    """Number of the range a value falls in; NaN sorts last, as in Spark's own order."""
    if not limits:
        return df.withColumn(name, F.lit(0))
    cut = Bucketizer(
        splits=[float("-inf"), *limits, float("inf")], inputCol="_cut", outputCol=name,
        handleInvalid="keep",
    )
    return (
        cut.transform(df.withColumn("_cut", F.col(column).cast("double")))
        .withColumn(name, F.col(name).cast("int"))
        .drop("_cut")
    )


def keyed_ranges(df: DataFrame, order: str, limits: list[float], by: list[str]) -> DataFrame:
    """Add ``_range`` and the never-null ``_key`` (group, range).

    Windows, totals and joins all use this one key, so the rows are shuffled once. A struct
    compares null group values as equal, and no group, however large, shares a single key.
    """
    return with_range(df, order, limits).withColumn("_key", F.struct(*by, "_range"))


def running_totals(
    df: DataFrame,
    order: str,
    values: list[str],
    by: list[str] = (),
    descending: bool = False,
    limits: list[float] | None = None,
    ties: list[str] = (),
) -> DataFrame:
    """Add ``cum_<value>``, the inclusive prefix sum along ``order`` within ``by``, and
    ``all_<value>``, the group's total."""
    by, ties = list(by), list(ties)
    if limits is None:
        limits = quantile_limits(df, order, range_count(df))
    cut = keyed_ranges(df, order, limits, by)
    per_range = cut.groupBy("_key").agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
    direction = F.desc if descending else F.asc
    group = Window.partitionBy(*[f"_key.{b}" for b in by])
    before = group.orderBy(direction("_key._range")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        "_key",
        *[F.coalesce(F.sum(f"_sum_{v}").over(before), F.lit(0)).alias(f"_off_{v}") for v in values],
        *[F.sum(f"_sum_{v}").over(group).alias(f"all_{v}") for v in values],
    )
    if not by:
        offsets = F.broadcast(offsets)  # at most MAX_RANGES + 1 rows of a few numbers
    inside = (
        Window.partitionBy("_key").orderBy(direction(order), *[F.asc(t) for t in ties])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        cut.withColumns({f"_in_{v}": F.sum(v).over(inside) for v in values})
        .join(offsets, "_key")
        .withColumns({f"cum_{v}": F.col(f"_off_{v}") + F.col(f"_in_{v}") for v in values})
        .drop("_key", "_range", *[f"{p}_{v}" for v in values for p in ("_off", "_in")])
    )


def dense_index(df: DataFrame, order: str, name: str = "rn", by: list[str] = ()) -> DataFrame:
    """Add 0, 1, 2, ... along a unique numeric column."""
    counted = running_totals(df.withColumn("_one", F.lit(1).cast("bigint")), order, ["_one"], by=by)
    return counted.withColumn(name, F.col("cum__one") - 1).drop("_one", "cum__one", "all__one")


def exact_quantiles(
    df: DataFrame, column: str, fractions: list[float], by: list[str] = ()
) -> DataFrame:
    """Interpolated quantiles, one row per group and fraction.

    Rows are first counted per distinct value, so repeated values shrink before the shuffle, and
    the two neighbours of every wanted rank are picked from the running count. No task holds more
    than one range of values.
    """
    by = list(by)
    value = F.col(column).cast("double")
    present = df.where(value.isNotNull() & ~F.isnan(value)).select(*by, value.alias("v"))
    limits = quantile_limits(present, "v", range_count(df))
    counted = present.groupBy(*by, "v").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counted, "v", ["n"], by=by, limits=limits)

    def holds(rank):
        return (rank >= F.col("cum_n") - F.col("n")) & (rank < F.col("cum_n"))

    def wanted(fraction):
        position = (F.col("all_n") - 1) * F.lit(float(fraction))
        return F.struct(
            F.lit(float(fraction)).alias("q"), F.floor(position).alias("low"),
            F.ceil(position).alias("high"), (position - F.floor(position)).alias("share"),
        )

    hits = ranked.withColumn("w", F.explode(F.filter(
        F.array(*[wanted(q) for q in fractions]), lambda w: holds(w["low"]) | holds(w["high"])
    )))
    return (
        hits.groupBy(*by, F.col("w.q").alias("q"))
        .agg(
            F.min(F.when(holds(F.col("w.low")), F.col("v"))).alias("_a"),
            F.max(F.when(holds(F.col("w.high")), F.col("v"))).alias("_b"),
            F.first("w.share").alias("_share"),
        )
        .select(*by, "q", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_share")).alias("value"))
    )
