"""Features, label splits and the figures that training needs."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anagrove.functions import concat_features, log_frequency


def labeled(states: DataFrame) -> DataFrame:
    return states.filter(F.col("label").isNotNull())


def unlabeled(states: DataFrame) -> DataFrame:
    return states.filter(F.col("label").isNull())


def with_log_frequency(states: DataFrame) -> DataFrame:
    return states.withColumn("log_frequency", log_frequency(F.col("frequency")))


def features_v1(states: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Features and label, next to the key so that rows stay identified."""
    features = concat_features(F.col("log_frequency"), F.col("embedding"))
    return states.select(*(keep or ["word"]), features.alias("features"), "label")


def label_split_counts(states: DataFrame) -> DataFrame:
    return states.agg(
        F.count_if(F.col("label").isNotNull()).alias("truth"),
        F.count_if(F.col("label").isNull()).alias("model"),
    )


def stratified_split(
    df: DataFrame, key: str, label: str = "label", test_share: float = 0.33, seed: int = 0
) -> DataFrame:
    """Mark ``round(n * test_share)`` rows of every class as test, reproducibly.

    Rows are ordered by a seeded digest of their key. The first four hex digits
    cut each class into 65,536 even buckets whatever the data; counts per bucket
    (two small columns) turn bucket positions into class ranks.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    hashed = df.withColumn("_digest", digest).withColumn("_bucket", F.substring("_digest", 1, 4))
    sizes = hashed.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    by_class = Window.partitionBy(label)
    before = by_class.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        label,
        "_bucket",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.round(F.sum("_n").over(by_class) * test_share).alias("_quota"),
    )
    position = F.row_number().over(Window.partitionBy(label, "_bucket").orderBy("_digest", key))
    sizes = sizes.withColumnRenamed(label, "_label")
    same_class = F.col(label).eqNullSafe(F.col("_label"))  # rows without a label are a class of their own
    joined = hashed.withColumn("_position", position).withColumnRenamed("_bucket", "_own_bucket")
    ranked = joined.join(sizes, same_class & (F.col("_own_bucket") == F.col("_bucket")))
    is_test = F.col("_position") + F.col("_before") <= F.col("_quota")
    return ranked.select(*df.columns, is_test.alias("is_test"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight of each class: n / (classes * n_class)."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = sizes.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    share = totals.select(F.col("n") / F.col("k")).scalar()
    return sizes.select(label, "n", (share / F.col("n")).alias("weight"))


def class_statistics(df: DataFrame, label: str = "label", features: str = "features") -> DataFrame:
    """Mean and population variance of every feature within each class.

    The summary is one buffer per class and task, merged after the map side.
    """
    stats = df.groupBy(label).agg(
        Summarizer.metrics("mean", "variance", "count")
        .summary(array_to_vector(F.col(features)))
        .alias("s")
    )
    count = F.col("s.count").cast("double")
    long = stats.select(
        label,
        F.col("s.count").alias("n"),
        (F.when(count > 1, (count - 1) / count).otherwise(0.0)).alias("_shrink"),
        F.posexplode(
            F.arrays_zip(
                vector_to_array("s.mean").alias("mean"),
                vector_to_array("s.variance").alias("variance"),
            )
        ).alias("feature", "_stat"),
    )
    return long.select(
        label,
        "feature",
        "n",
        F.col("_stat.mean").alias("mean"),
        (F.col("_stat.variance") * F.col("_shrink")).alias("variance"),
    )


def probabilities(
    states: DataFrame, scored: DataFrame, batch_id: str, model_version: int
) -> DataFrame:
    """Truth rows with their label next to scored rows with their estimate.

    ``scored`` holds the undecided words with ``probability``; the wide columns
    are dropped on both sides before the union.
    """
    kept = ["word", "letter_set", "last_seen_on"]
    truth = labeled(states).select(
        *kept,
        F.col("label").cast("float").alias("probability"),
        F.lit("truth").alias("source"),
        F.lit(None).cast("int").alias("model_version"),
    )
    model = scored.select(
        *kept,
        F.col("probability").cast("float").alias("probability"),
        F.lit("model").alias("source"),
        F.lit(model_version).cast("int").alias("model_version"),
    )
    return truth.unionByName(model).withColumn("batch_id", F.lit(batch_id))


def score_with_column(states: DataFrame, probability: Column) -> DataFrame:
    """Undecided words scored by a column expression."""
    return unlabeled(states).withColumn("probability", probability.cast("float"))
