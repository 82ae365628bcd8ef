"""The stages of the word-puzzle warehouse, from puzzles to export."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anagrove.operators.features import probabilities, stratified_split
from anagrove.operators.hybrid import BandSpec, WordModel, score_unlabeled, train, training_rows
from anagrove.operators.matching import month_counts, split_documents, with_decision_dates, word_decisions
from anagrove.operators.metrics import binary_metrics, roc_auc
from anagrove.operators.serving import export_rows, letter_set_groups
from anagrove.operators.states import decisions_as_updates, enrich_new_words, merge_states
from anagrove.operators.thresholds import best_thresholds, threshold_grid
from anagrove.session import materialise
from anagrove.sinks.export import publish_export
from anagrove.sinks.tables import publish_snapshot, replace_keys, replace_where

DECISION_PARTITIONS = ["year", "month"]


def backfill_year(documents: DataFrame, words: DataFrame, db: str, year: int) -> DataFrame:
    """Decisions of a whole year in one job, replacing that year's months.

    ``words`` are all known ones, listed and new. Months without puzzles end up
    empty. Returns the count of every month.
    """
    spark = words.sparkSession
    if "year" in documents.columns:
        documents = documents.filter(F.col("year") == year)  # prunes to the year's folders
    puzzles, answers = split_documents(documents)
    of_year = F.year("puzzle_date") == year
    found = word_decisions(puzzles.filter(of_year), answers.filter(of_year), words)
    replace_where(
        with_decision_dates(found), "word_decisions", db, {"year": year}, DECISION_PARTITIONS
    )
    name = f"{db}.word_decisions"
    return month_counts(spark.table(name).filter(F.col("year") == year))


def update_states(
    spark: SparkSession, db: str, decisions: DataFrame, batch_id: str, buckets: int | None = None
) -> None:
    """Merge the latest decisions into the view ``word_states``."""
    states, words = spark.table(f"{db}.word_states"), spark.table(f"{db}.words")
    updates = enrich_new_words(decisions_as_updates(decisions, batch_id), states, words)
    publish_snapshot(merge_states(states, updates, batch_id), "word_states", db, buckets)


def train_on_states(
    states: DataFrame, components: int, bands: dict[str, BandSpec] | None = None
) -> WordModel:
    """Search the band edges on the training rows, then fit on the same rows."""
    rows = materialise(training_rows(states))
    edges = best_thresholds(threshold_grid(rows)).first()
    return train(rows, (edges.low, edges.high), components, bands)


def evaluate_on_holdout(states: DataFrame, components: int, bands: dict[str, BandSpec] | None = None) -> DataFrame:
    """Test rows per label with the metrics of a model that never saw them.

    Decided words are split by class; edges, projection and models come from the
    training part alone.
    """
    rows = materialise(stratified_split(training_rows(states), "word"))
    seen = rows.filter(~F.col("is_test")).drop("is_test")
    edges = best_thresholds(threshold_grid(seen)).first()
    model = train(seen, (edges.low, edges.high), components, bands)
    scored = materialise(model.transform(rows.filter("is_test")).select("word", "label", "prediction", "probability"))
    measured = binary_metrics(scored).select("accuracy", "f1")
    area = roc_auc(scored.withColumnRenamed("probability", "score"))
    sizes = scored.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    one = {"accuracy": measured.select("accuracy"), "f1": measured.select("f1"), "auc": area.select("auc")}
    return sizes.select("*", *[value.scalar().alias(name) for name, value in one.items()])


def publish_probabilities(
    states: DataFrame, model: WordModel, db: str, batch_id: str, model_version: int
) -> DataFrame:
    """Write truth and scored rows, replacing an earlier run of the batch."""
    rows = probabilities(states, score_unlabeled(states, model), batch_id, model_version)
    replace_keys(rows, "word_probabilities", db, ["batch_id"], ["batch_id"], keys_fix_partition=True)
    return states.sparkSession.table(f"{db}.word_probabilities")


def export_probabilities(words: DataFrame, root: str, logical_date: dt.date) -> str:
    """Publish the words grouped by letter set as the latest export."""
    return publish_export(export_rows(letter_set_groups(words)), root, logical_date)
