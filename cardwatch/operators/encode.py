"""Label codes, one-hot columns and scaling."""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window, functions as F

from cardwatch.operators.ordering import range_count

#: Dictionaries up to this many values are numbered in one small task or kept as literals.
SMALL_DICTIONARY = 10_000
#: Ranges a larger dictionary is cut into; the sample that fixes them holds about 64 values each.
MAX_TEXT_RANGES = 4096


def _values(column: str, tables) -> DataFrame:
    values = tables[0].select(F.col(column).cast("string").alias("value"))
    for table in tables[1:]:
        values = values.unionAll(table.select(F.col(column).cast("string").alias("value")))
    return values.where("value IS NOT NULL")


def dictionaries(columns: list[str], *tables: DataFrame) -> dict[str, DataFrame]:
    """Codes 0, 1, 2, ... in alphabetical order over the non-null values of all tables.

    One pass finds the values of all columns. Its result is fetched only up to a fixed size; when
    everything fits, the dictionaries are local tables whose size Spark knows when it plans the joins. Otherwise
    each large column is numbered where it is.
    """
    limit = SMALL_DICTIONARY * len(columns)
    pairs = None
    for table in tables:
        part = table.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in columns
        ])).alias("p")).select("p.*")
        pairs = part if pairs is None else pairs.unionAll(part)
    found = pairs.where("value IS NOT NULL").distinct().limit(limit + 1).collect()
    spark = tables[0].sparkSession
    if len(found) <= limit:
        out = {}
        for c in columns:
            ordered = sorted(r.value for r in found if r.column == c)
            local = pd.DataFrame({"value": pd.Series(ordered, dtype=object),
                                  "code": range(len(ordered))})
            out[c] = spark.createDataFrame(local, "value string, code int")
        return out
    if len(columns) > 1:
        return {c: dictionaries([c], *tables)[c] for c in columns}
    return {columns[0]: _large_dictionary(_values(columns[0], tables).distinct())}


def dictionary(column: str, *tables: DataFrame) -> DataFrame:
    return dictionaries([column], *tables)[column]


def _large_dictionary(values: DataFrame) -> DataFrame:
    """The same numbering for any size: cut by text ranges, offset by the ranges before."""
    ranges = min(range_count(values), MAX_TEXT_RANGES)
    wanted = 64 * ranges
    step = max(1, values.count() // wanted)
    # A hash-chosen sample of about 64 values per range fixes the limits, nothing else.
    sample = [
        r.value for r in values.where(F.pmod(F.xxhash64("value"), F.lit(step)) == 0)
        .orderBy(F.xxhash64("value")).limit(2 * wanted).collect()
    ]
    ordered = np.array(sorted(sample), dtype=object)
    limits = ordered[:: max(1, len(ordered) // ranges)]

    @F.pandas_udf("int")
    def range_of(text: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(limits, text.to_numpy(dtype=object), side="right"))

    cut = values.withColumn("_range", range_of("value"))
    sizes = cut.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(sizes.select(  # one row per range
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    ))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy("value"))
    return (
        cut.withColumn("_i", inside).join(offsets, "_range")
        .select("value", (F.col("_offset") + F.col("_i") - 1).cast("int").alias("code"))
    )


def apply_dictionary(
    df: DataFrame, column: str, codes: DataFrame, invalid: str = "error", name: str | None = None
) -> DataFrame:
    """Replace a column by its code. Unseen or null values raise, or share one extra code."""
    name = name or column
    pairs = codes.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    joined = df.join(pairs, F.col(column).cast("string") == F.col("_value"), "left")
    if invalid == "keep":
        code = F.coalesce("_code", codes.agg(F.count(F.lit(1)).cast("int")).scalar())
    else:
        code = F.coalesce("_code", F.raise_error(F.concat(
            F.lit(f"{column}: unseen label "), F.coalesce(F.col(column).cast("string"), F.lit("null"))
        )).cast("int"))
    return joined.withColumn("_out", code).select(
        *[F.col("_out").alias(name) if c == name else F.col(c) for c in df.columns],
        *([] if name in df.columns else [F.col("_out").alias(name)]),
    )


def encode_labels(
    train: DataFrame, test: DataFrame, columns: list[str], invalid: str = "error"
) -> tuple[DataFrame, DataFrame]:
    """Encode both tables with dictionaries fitted on their union."""
    for column, codes in dictionaries(columns, train, test).items():
        train = apply_dictionary(train, column, codes, invalid)
        test = apply_dictionary(test, column, codes, invalid)
    return train, test


def category_levels(df: DataFrame, column: str) -> list[str]:
    """The sorted values of a column that becomes dummy columns (a schema-sized list)."""
    found = df.where(F.col(column).isNotNull()).select(column).distinct().limit(
        SMALL_DICTIONARY + 1
    ).collect()
    if len(found) > SMALL_DICTIONARY:
        raise ValueError(f"{column} has more than {SMALL_DICTIONARY} levels; use label codes")
    return sorted(r[0] for r in found)


def one_hot(
    df: DataFrame, columns: list[str], levels: dict[str, list[str]] | None = None
) -> DataFrame:
    """0/1 columns ``<column>_<level>`` without the first level; null is all zeros.

    Pass the training table's ``levels`` to give another table the same columns.
    """
    levels = levels or {c: category_levels(df, c) for c in columns}
    dummies = {
        f"{c}_{level}": F.coalesce((F.col(c) == level).cast("int"), F.lit(0))
        for c in columns for level in levels[c][1:]
    }
    return df.withColumns(dummies).drop(*columns)


def one_hot_vector(df: DataFrame, column: str, codes: DataFrame, name: str | None = None) -> DataFrame:
    """One sparse vector of the column's dummies, for any number of levels.

    ``codes`` is the column's dictionary; place j of the vector is the level of code j + 1, the first
    level, nulls and unseen values are all zeros. The levels stay a distributed table that is joined;
    the driver learns their number only.
    """
    from pyspark.ml.feature import OneHotEncoder

    name, levels = name or f"{column}_vector", codes.count()
    coded = apply_dictionary(df, column, codes, "keep", "_code_of")
    if levels < 2:
        empty = array_to_vector(F.array().cast("array<double>"))
        return coded.withColumn(name, empty).drop("_code_of")
    # whatever is no dummy goes to the extra place that the encoder adds for the unknown, and drops
    place = F.when(F.col("_code_of").between(1, levels - 1), F.col("_code_of") - 1).otherwise(levels - 1)
    encoder = OneHotEncoder(inputCol="_place", outputCol=name, handleInvalid="keep", dropLast=True)
    sizes = df.sparkSession.createDataFrame([(float(levels - 2),)], "_place double")
    return encoder.fit(sizes).transform(coded.withColumn("_place", place.cast("double"))).drop("_place", "_code_of")


def scaler(df: DataFrame, columns: list[str]) -> Column:
    """Mean and population deviation of each column as one fitted struct."""
    return df.agg(F.struct(*[
        F.struct(F.avg(F.col(c).cast("double")).alias("mean"),
                 F.stddev_pop(F.col(c).cast("double")).alias("std")).alias(c)
        for c in columns
    ]).alias("fitted")).scalar()


def standardise(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std with statistics of ``fit_on``; a constant column becomes 0."""
    fitted = df.withColumn("_fit", scaler(fit_on or df, columns))
    scaled = {}
    for c in columns:
        mean, std = F.col(f"_fit.{c}.mean"), F.col(f"_fit.{c}.std")
        centred = F.col(c).cast("double") - mean
        scaled[c] = F.when(F.col(c).isNotNull(), F.coalesce(F.try_divide(centred, std), F.lit(0.0)))
    return fitted.withColumns(scaled).drop("_fit")


def assemble(df: DataFrame, columns: list[str], invalid: str = "error") -> DataFrame:
    """The feature matrix: one ML vector per row."""
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(
        inputCols=columns, outputCol="features", handleInvalid=invalid
    ).transform(df)

