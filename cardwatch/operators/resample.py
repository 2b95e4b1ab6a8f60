"""Class balancing and folds with reproducible draws.

Every draw is a function of its own number and the seed, so the result does not depend on the
partitioning and a lost task redraws the same rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from cardwatch.functions.checks import ratio
from cardwatch.functions.random import uniform
from cardwatch.operators.knn import nearest_neighbours
from cardwatch.operators.ordering import dense_index, range_count, running_totals
from cardwatch.schema import LABEL
from cardwatch.session import checkpointed


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weight n / (2 n_c) of each class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.withColumn("weight", ratio(total, F.col("n") * 2))


def balanced_weight(df: DataFrame, label: str = LABEL) -> Column:
    """The balanced weight of a row's own class, from one scalar subquery."""
    sizes = df.agg(F.struct(
        F.count(label).alias("n"), F.count_if(F.col(label) == 1).alias("n1")
    ).alias("s")).scalar()
    own = F.when(F.col(label) == 1, sizes["n1"]).otherwise(sizes["n"] - sizes["n1"])
    return ratio(sizes["n"], own * 2)


def stratified_folds(
    df: DataFrame, k: int, label: str = LABEL, key: str = "id", seed: int = 42
) -> DataFrame:
    """Add ``fold``: rows of each class in random order, dealt out in turn.

    The random number is uniform, so even ranges of it hold even shares of every class; the class
    that has most of the rows is spread over all of them.
    """
    ranges = range_count(df)
    limits = [i / ranges for i in range(1, ranges)]
    drawn = df.withColumns({"_u": uniform(key, seed), "_one": F.lit(1).cast("bigint")})
    counted = running_totals(drawn, "_u", ["_one"], by=[label], limits=limits, ties=[key])
    fold = F.pmod(F.col("cum__one") - 1, F.lit(k)).cast("int")
    return counted.withColumn("fold", fold).drop("_u", "_one", "cum__one", "all__one")


def fold_split(df: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """Training rows and validation rows of one fold."""
    return df.where(F.col("fold") != fold), df.where(F.col("fold") == fold)


def fold_sizes(folded: DataFrame, label: str = LABEL) -> DataFrame:
    """(fold, part, n, n1): rows and positives of both parts of every fold, from one pass."""
    own = folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("n1"))
    everything = Window.partitionBy(F.lit(0))  # one row per fold
    rest = {f"rest_{c}": F.sum(c).over(everything) - F.col(c) for c in ("n", "n1")}
    parts = F.array(
        F.struct(F.lit("train").alias("part"), F.col("rest_n").alias("n"), F.col("rest_n1").alias("n1")),
        F.struct(F.lit("validation").alias("part"), F.col("n").alias("n"), F.col("n1").alias("n1")))
    return own.withColumns(rest).select("fold", F.explode(parts).alias("p")).select("fold", "p.*")


def class_sizes(df: DataFrame, label: str = LABEL) -> tuple[int, int]:
    row = df.agg(
        F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")
    ).first()
    return row.n0, row.n1


def bootstrap(
    df: DataFrame, n: int | None = None, label: str = LABEL, key: str = "id", seed: int = 42
) -> DataFrame:
    """Draw exactly n minority rows with replacement (default: as many as the majority has).

    Only draw numbers are shuffled to the numbered minority rows; a minority of very few rows is
    small enough for AQE to send it to the draws instead.
    """
    n0, n1 = class_sizes(df, label)
    n = n0 if n is None else n
    numbered = dense_index(df.where(F.col(label) == 1), key)
    draws = df.sparkSession.range(n if n1 else 0).withColumnRenamed("id", "draw").withColumn(
        "rn", F.floor(uniform("draw", seed) * n1)
    )
    return draws.join(numbered, "rn").drop("rn")


def upsample(
    df: DataFrame, n: int | None = None, label: str = LABEL, key: str = "id", seed: int = 42
) -> DataFrame:
    """Majority rows plus the bootstrapped minority."""
    majority = df.where(F.col(label) == 0)
    return majority.unionByName(bootstrap(df, n, label, key, seed).drop("draw"))


def smote_samples(
    df: DataFrame,
    features: list[str],
    label: str = LABEL,
    key: str = "id",
    k: int = 5,
    seed: int = 42,
    n: int | None = None,
    distance_cols: list[str] | None = None,
    nominal_cols: list[str] = (),
) -> DataFrame:
    """Synthetic minority rows: (draw, base_id, neighbour_id, step, features...).

    A draw picks a base row, one of its k neighbours and a step; each feature moves that share of
    the way to the neighbour. Whole-number features are cut back to whole numbers; nominal ones
    take the most frequent value among the neighbours. The large table is read once: neighbours
    and end points work on the saved minority rows.
    """
    n0, n1 = class_sizes(df, label)
    n = max(0, n0 - n1) if n is None else n
    k = min(k, n1 - 1)
    minority = checkpointed(
        df.where(F.col(label) == 1).select(F.col(key).cast("bigint").alias(key), *features)
    )
    if k < 1:
        n, k = 0, 1  # a single row has no neighbour to move towards
    neighbours = nearest_neighbours(minority, key, distance_cols or features, k)
    numbered = dense_index(minority.select(key), key)
    ends = minority.select(F.col(key).alias("neighbour_id"), F.struct(*features).alias("b"))
    edges = (
        neighbours.join(minority.select(F.col(key).alias("id"), F.struct(*features).alias("a")), "id")
        .join(numbered.select(F.col(key).alias("id"), "rn"), "id")
        .join(ends, "neighbour_id")
    )
    if nominal_cols:
        common = edges.groupBy("id").agg(*[
            F.mode(f"b.{c}", True).alias(f"_mode_{c}") for c in nominal_cols
        ])
        edges = edges.join(common, "id")
    pick = F.floor(uniform("draw", seed) * n1 * k)
    draws = df.sparkSession.range(n).withColumnRenamed("id", "draw").select(
        "draw", F.floor(pick / k).alias("rn"),
        (F.pmod(pick, F.lit(k)) + 1).cast("int").alias("rank"),
        uniform("draw", seed + 1).alias("step"),
    )
    whole = (T.IntegerType, T.LongType, T.ShortType, T.ByteType)
    out = []
    for c in features:
        if c in nominal_cols:
            out.append(F.col(f"_mode_{c}").alias(c))
            continue
        a, b = F.col(f"a.{c}").cast("double"), F.col(f"b.{c}").cast("double")
        moved = a + F.col("step") * (b - a)
        kind = df.schema[c].dataType
        out.append((moved.cast("bigint").cast(kind) if isinstance(kind, whole) else moved).alias(c))
    return draws.join(edges, ["rn", "rank"]).select(
        "draw", F.col("id").alias("base_id"), "neighbour_id", "step", *out
    )


def smote(df: DataFrame, features: list[str], label: str = LABEL, key: str = "id",
          **options) -> DataFrame:
    """The table's features and label plus enough synthetic minority rows to even the classes."""
    made = smote_samples(df, features, label, key, **options)
    original = df.select(*features, label)
    return original.unionByName(
        made.select(*features, F.lit(1).cast(df.schema[label].dataType).alias(label))
    )
