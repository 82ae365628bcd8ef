"""Evaluation of binary predictions as aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anagrove.operators.ranking import running_totals


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and F1 in one pass; F1 is 0 when nothing is or was found positive."""
    positive, found = F.col(label) == 1, F.col(prediction) == 1
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(label) == F.col(prediction)).alias("right"),
        F.count_if(positive & found).alias("tp"),
        F.count_if(positive).alias("p"),
        F.count_if(found).alias("f"),
    )
    f1 = F.try_divide(2.0 * F.col("tp"), F.col("p") + F.col("f"))
    return counts.select(
        "n",
        F.try_divide(F.col("right"), F.col("n")).alias("accuracy"),
        F.coalesce(f1, F.lit(0.0)).alias("f1"),
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve, ties counting one half.

    Rows are folded to one per distinct score before they are put in order.
    Counts are multiplied as doubles, since positives times negatives may pass
    the range of a long.
    """
    levels = df.groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg")
    )
    ordered = running_totals(levels, [F.col(score)], {"_neg_before": F.col("_neg")})
    won = F.sum(F.col("_pos").cast("double") * (F.col("_neg_before") + F.col("_neg") / 2.0))
    pairs = F.sum("_pos").cast("double") * F.sum("_neg")
    return ordered.agg(F.try_divide(won, pairs).alias("auc"))


def error_slices(
    df: DataFrame, key: str, label: str = "label", prediction: str = "prediction", size: int = 5
) -> DataFrame:
    """First ``size`` rows by key of each (label, prediction) pair.

    The row-number filter becomes a group limit before the shuffle, so each task
    sends at most ``size`` rows per pair.
    """
    window = Window.partitionBy(label, prediction).orderBy(key)
    ranked = df.withColumn("position", F.row_number().over(window))
    actual, guess = F.col(label) == 1, F.col(prediction) == 1
    kind = (
        F.when(actual & ~guess, "FN").when(~actual & ~guess, "TN").when(~actual & guess, "FP")
    ).otherwise("TP")
    return ranked.filter(F.col("position") <= size).withColumn("slice", kind)
