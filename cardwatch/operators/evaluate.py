"""Classification reports from a table of label, prediction and score.

Everything is grouped: ``by`` may hold model, fold, split or penalty, so one pass evaluates all
of them.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardwatch.functions.checks import ratio, ratio_or_zero
from cardwatch.functions.features import composite_score, display_name
from cardwatch.operators.ordering import (
    keyed_ranges, quantile_limits, range_count, running_totals,
)
from cardwatch.operators.ranking import arg_max
from cardwatch.session import saved


def confusion(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: list[str] = ()
) -> DataFrame:
    y, p = F.col(label), F.col(prediction)
    return df.groupBy(*by).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def _rates(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    return {
        "accuracy": ratio_or_zero(tp + tn, tn + fp + fn + tp),
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(tp * 2, tp * 2 + fp + fn),
    }


def with_rates(counts: DataFrame) -> DataFrame:
    return counts.withColumns(_rates(*[F.col(c) for c in ("tn", "fp", "fn", "tp")]))


def metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: list[str] = ()
) -> DataFrame:
    """Confusion counts with accuracy, precision, recall and F1 of class 1 (0 when undefined)."""
    return with_rates(confusion(df, label, prediction, by))


def _score_counts(df: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    """One row per distinct score: repeated scores shrink before any ordering."""
    return (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*by, F.col(score).alias("threshold"))
        .agg(F.count_if(F.col(label) == 1).alias("n1"), F.count_if(F.col(label) == 0).alias("n0"))
    )


def auc(
    df: DataFrame, label: str = "label", score: str = "score", by: list[str] = ()
) -> DataFrame:
    """Area under the ROC curve with ties counted half; null when a class is absent."""
    by = list(by)
    limits = quantile_limits(df, score, range_count(df))
    return _area(_score_counts(df, label, score, by), by, limits)


def _area(counts: DataFrame, by: list[str], limits: list[float]) -> DataFrame:
    ranked = running_totals(counts, "threshold", ["n0"], by=by, limits=limits)
    # doubles: pair counts of a large table do not fit a 64-bit integer
    wins = F.sum(F.col("n1").cast("double") * (F.col("cum_n0") - F.col("n0") / 2.0))
    pairs = F.sum("n1").cast("double") * F.sum("n0")
    return ranked.groupBy(*by).agg(ratio(wins, pairs).alias("auc"))


def roc_curve(
    df: DataFrame, label: str = "label", score: str = "score", by: list[str] = (),
    drop_collinear: bool = True,
) -> DataFrame:
    """(threshold, fpr, tpr) from (infinity, 0, 0) down the scores.

    A point is collinear when the step to it and the step after it have the same counts. The
    next step may lie in the next score range, so each range hands its first step to the one
    before it; no task sees more than one range.
    """
    by = list(by)
    limits = quantile_limits(df, score, range_count(df))
    counts = _score_counts(df, label, score, by)
    ranked = running_totals(counts, "threshold", ["n0", "n1"], by=by, descending=True, limits=limits)
    if drop_collinear:
        ranked = _turning_points(ranked, by, limits)
    points = ranked.select(
        *by, F.col("threshold").cast("double").alias("threshold"),
        ratio(F.col("cum_n0"), F.col("all_n0")).alias("fpr"),
        ratio(F.col("cum_n1"), F.col("all_n1")).alias("tpr"),
    )
    origin = counts.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(
        *by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return origin.unionByName(points)


def _turning_points(ranked: DataFrame, by: list[str], limits: list[float]) -> DataFrame:
    cut = keyed_ranges(ranked, "threshold", limits, by)
    step = F.struct("n0", "n1")
    heads = cut.groupBy("_key").agg(F.max_by(step, "threshold").alias("_head"))
    down = Window.partitionBy(*[f"_key.{b}" for b in by]).orderBy(F.desc("_key._range"))
    next_heads = heads.select("_key", F.lead("_head").over(down).alias("_next_head"))
    inside = Window.partitionBy("_key").orderBy(F.desc("threshold"))
    first = (F.col("cum_n0") == F.col("n0")) & (F.col("cum_n1") == F.col("n1"))
    keep = first | F.col("_next").isNull() | (F.col("_next") != step)
    return (
        cut.withColumn("_lead", F.lead(step).over(inside)).join(next_heads, "_key")
        .withColumn("_next", F.coalesce("_lead", "_next_head")).where(keep)
        .drop("_key", "_range", "_lead", "_next", "_next_head")
    )


def full_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score",
    by: list[str] = ("model",),
) -> DataFrame:
    """Counts, rates and AUC per group.

    The rows, often a model's output, are evaluated once: into a saved table of class counts for
    each score and prediction, from which everything else follows.
    """
    by, y = list(by), F.col(label)
    counted = saved(
        df.groupBy(*by, F.col(score).alias("threshold"), F.col(prediction).alias("_p"))
        .agg(F.count_if(y == 1).alias("n1"), F.count_if(y == 0).alias("n0")), "scores",
    )

    def total(count: str, predicted: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_p") == predicted, F.col(count))), F.lit(0))

    counts = counted.groupBy(*by).agg(
        total("n0", 0).alias("tn"), total("n0", 1).alias("fp"),
        total("n1", 0).alias("fn"), total("n1", 1).alias("tp"),
    )
    present = counted.where("threshold IS NOT NULL").groupBy(*by, "threshold").agg(
        F.sum("n1").alias("n1"), F.sum("n0").alias("n0")
    )
    limits = quantile_limits(counted, "threshold", range_count(counted))
    return with_rates(counts).join(_area(present, by, limits), by, "left")


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: list[str] = ()
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted average."""
    by = list(by)
    wide = confusion(df, label, prediction, by)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def line(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("row"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"), support.cast("bigint").alias("support"),
        )

    n0, n1, n = tn + fp, fn + tp, tn + fp + fn + tp
    neg, pos = _rates(tp, fn, fp, tn), _rates(tn, fp, fn, tp)  # class 0 swaps the roles
    accuracy = pos["accuracy"]
    names = ("precision", "recall", "f1")
    macro = [(neg[m] + pos[m]) / 2 for m in names]
    weighted = [ratio_or_zero(neg[m] * n0 + pos[m] * n1, n) for m in names]
    rows = F.array(
        line("0", *[neg[m] for m in names], n0), line("1", *[pos[m] for m in names], n1),
        line("accuracy", accuracy, accuracy, accuracy, n),
        line("macro avg", *macro, n), line("weighted avg", *weighted, n),
    )
    return wide.select(*by, F.explode(rows).alias("r")).select(*by, "r.*")


def comparison(results: DataFrame) -> DataFrame:
    """The ten-column model table from one metrics row per model."""
    return results.select(
        F.col("model"), display_name(F.col("model")).alias("name"), "accuracy", "f1", "auc",
        "precision", "recall", F.col("fn").alias("false_negatives"),
        F.col("fp").alias("false_positives"), F.col("tp").alias("true_positives"),
        F.col("tn").alias("true_negatives"),
        composite_score(F.col("recall"), F.col("f1"), F.col("auc")).alias("score"),
    )


def best_model(results: DataFrame) -> DataFrame:
    """The model with the highest weighted score."""
    return arg_max(comparison(results), "score", "model")


def generalisation_gap(
    df: DataFrame, label: str = "label", prediction: str = "prediction", split: str = "split",
    by: list[str] = (),
) -> DataFrame:
    """Rates on train and test side by side, and train minus test."""
    by = list(by)
    parts = metrics(df, label, prediction, [*by, split])
    rates = ("accuracy", "precision", "recall", "f1")
    wide = parts.groupBy(*by).agg(*[
        F.max(F.when(F.col(split) == s, F.col(m))).alias(f"{s}_{m}")
        for m in rates for s in ("train", "test")
    ])
    return wide.withColumns({f"gap_{m}": F.col(f"train_{m}") - F.col(f"test_{m}") for m in rates})


def type2_share(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: list[str] = ()
) -> DataFrame:
    """False negatives, and their share of all rows."""
    counts = confusion(df, label, prediction, by)
    return counts.select(
        *by, F.col("fn").alias("false_negatives"),
        ratio(F.col("fn"), F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("type2_share"),
    )


def threshold_sweep(
    df: DataFrame, thresholds: list[float], label: str = "label", score: str = "score",
    by: list[str] = (),
) -> DataFrame:
    """Metrics at each threshold.

    A row lands in the slot of the highest threshold it reaches, one count per slot is shuffled,
    and the counts add up over the slots: the data is neither copied per threshold nor ordered.
    """
    by, steps = list(by), sorted(float(t) for t in thresholds)
    slot = F.lit(0)
    for i, t in enumerate(steps):
        slot = F.when(F.col(score) >= t, i + 1).otherwise(slot)
    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    counts = rows.groupBy(*by, slot.alias("slot")).agg(
        F.count_if(F.col(label) == 1).alias("n1"), F.count_if(F.col(label) == 0).alias("n0")
    )
    reached = F.col("slot")
    wide = counts.groupBy(*by).agg(*[
        F.coalesce(F.sum(F.when(reached > i, F.col(c))), F.lit(0)).alias(f"{c}_{i}")
        for i in range(len(steps)) for c in ("n1", "n0")
    ], F.sum("n1").alias("all1"), F.sum("n0").alias("all0"))
    cells = F.array(*[
        F.struct(F.lit(t).alias("threshold"), (F.col("all0") - F.col(f"n0_{i}")).alias("tn"),
                 F.col(f"n0_{i}").alias("fp"), (F.col("all1") - F.col(f"n1_{i}")).alias("fn"),
                 F.col(f"n1_{i}").alias("tp"))
        for i, t in enumerate(steps)
    ])
    return with_rates(wide.where("all1 IS NOT NULL").select(*by, F.explode(cells).alias("c")).select(*by, "c.*"))
