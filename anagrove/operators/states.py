"""Current state per word: latest decision, new words and the merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATE_COLUMNS = [
    "word",
    "letter_set",
    "last_seen_on",
    "frequency",
    "embedding",
    "label",
    "batch_id",
]


def init_states(words: DataFrame, batch_id: str) -> DataFrame:
    """States before any puzzle: undecided, last seen when added."""
    return (
        words.withColumnRenamed("date_added", "last_seen_on")
        .withColumn("label", F.lit(None).cast("float"))
        .withColumn("batch_id", F.lit(batch_id))
        .select(*STATE_COLUMNS)
    )


def latest_decisions(decisions: DataFrame) -> DataFrame:
    """Most recent decision per word; on the same date an acceptance wins.

    ``row_number() = 1`` plans a group limit before the shuffle, so each map task
    sends at most one row per word, however hot the word.
    """
    order = [F.col("puzzle_date").desc(), F.col("accepted").desc(), "center_letter", "outer_letters"]
    ranked = decisions.withColumn(
        "_rn", F.row_number().over(Window.partitionBy("word").orderBy(*order))
    )
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def decisions_as_updates(decisions: DataFrame, batch_id: str) -> DataFrame:
    """Latest decisions in the shape the merge takes."""
    return latest_decisions(decisions).select(
        "word",
        F.col("puzzle_date").alias("last_seen_on"),
        F.col("accepted").cast("float").alias("label"),
        F.lit(batch_id).alias("batch_id"),
    )


def distinct_words(decisions: DataFrame) -> DataFrame:
    """Number of distinct words (combined per task before the shuffle)."""
    return decisions.select("word").distinct().agg(F.count(F.lit(1)).alias("n"))


def new_words(source: DataFrame, target: DataFrame) -> DataFrame:
    """Words of ``source`` that ``target`` does not hold."""
    return source.select("word").distinct().join(target.select("word"), "word", "left_anti")


def enrich_new_words(source: DataFrame, target: DataFrame, words: DataFrame) -> DataFrame:
    """Give the new words of ``source`` their letter set, embedding and frequency.

    One plan serves both cases: without new words the semi join is empty and the
    added columns are typed nulls.
    """
    fresh = new_words(source, target)
    data = words.join(fresh, "word", "left_semi").select(
        "word",
        "letter_set",
        "embedding",
        F.col("frequency").cast("double").alias("frequency"),
    )
    return source.join(data, "word", "left")


def once_per_word(source: DataFrame) -> DataFrame:
    """Stop the job when two source rows would update the same word.

    The window shares the join's distribution and sort, so it adds no shuffle.
    """
    rows = F.count(F.lit(1)).over(Window.partitionBy("word"))
    message = F.lit("several source rows match one word")
    counted = source.withColumn("_rows", rows)
    return counted.filter(
        F.when(F.col("_rows") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    ).drop("_rows")


def merge_states(target: DataFrame, source: DataFrame, batch_id: str) -> DataFrame:
    """Conditional upsert and delete, as a new snapshot of the target.

    Matched: label, date and batch change unless the target is newer. Only in
    the source: inserted. Only in the target: dropped when written by
    ``batch_id`` (a rerun of that batch), else kept.
    """
    old = target.select(
        "word", *[F.col(c).alias(f"_t_{c}") for c in STATE_COLUMNS if c != "word"], F.lit(True).alias("_t")
    )
    new = once_per_word(source).select(
        "word", *[F.col(c).alias(f"_s_{c}") for c in STATE_COLUMNS if c != "word"], F.lit(True).alias("_s")
    )
    both = old.join(new, "word", "full_outer")
    in_target, in_source = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    newer = F.col("_t_last_seen_on").isNull() | (
        F.col("_s_last_seen_on") >= F.col("_t_last_seen_on")
    )
    updates = in_target & in_source & F.coalesce(newer, F.lit(False))
    stale = in_target & ~in_source & F.col("_t_batch_id").eqNullSafe(F.lit(batch_id))

    def merged(name: str, updated: bool) -> Column:
        from_source = ~in_target | updates if updated else ~in_target
        chosen = F.when(from_source, F.col(f"_s_{name}")).otherwise(F.col(f"_t_{name}"))
        return chosen.alias(name)

    changing = {"label", "last_seen_on", "batch_id"}
    return both.filter(~stale).select(
        "word", *[merged(c, c in changing) for c in STATE_COLUMNS if c != "word"]
    )
