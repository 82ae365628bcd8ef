"""Incremental ingestion of new puzzle documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from anagrove.operators.matching import split_documents, with_decision_dates, word_decisions
from anagrove.operators.state_log import StateLog
from anagrove.operators.states import decisions_as_updates, enrich_new_words
from anagrove.plans.lifecycle import DECISION_PARTITIONS, update_states
from anagrove.session import materialise
from anagrove.sinks.tables import replace_keys, rows_of_partitions
from anagrove.sinks.versioned import VersionedTable
from anagrove.sources.puzzles import puzzle_reader
from anagrove.streaming.newest import newest_in_stream, state_store


def newest_of_day(documents: DataFrame) -> DataFrame:
    """The newest document of each day: by modification time, then file name."""
    newest = documents.groupBy("printDate").agg(F.max(F.struct("modified", "file_name")).alias("_newest"))
    origin = F.struct("modified", "file_name")
    return documents.join(newest, "printDate").filter(origin == F.col("_newest")).drop("_newest")


def decisions_in(spark: SparkSession, store: str) -> VersionedTable:
    """The decisions that a stream with ``store`` keeps."""
    return VersionedTable(spark, f"{store}/word_decisions", DECISION_PARTITIONS)


def ingest_puzzles(
    spark: SparkSession,
    source: str,
    db: str,
    checkpoint: str,
    batch_prefix: str = "puzzles",
    multi_line: bool = True,
    max_files: int | None = None,
    buckets: int | None = None,
    store: str | None = None,
    stateful: bool = False,
) -> StreamingQuery:
    """Process all puzzle documents not seen before, then stop.

    Each micro-batch replaces its days in ``db.word_decisions`` and merges its
    latest decisions into ``db.word_states``. Both steps give the same tables
    when a micro-batch is replayed, and the merge keeps states that are newer
    than a late puzzle. ``db.words`` supplies the known words, listed and new. Of
    several documents for a day the newest holds (by modification time, then
    name), whether they come in one micro-batch or in several.

    With ``store`` decisions and states are kept below that folder instead, as a
    versioned table and a state log (``decisions_in`` and ``StateLog`` read them):
    a micro-batch's days change at once, and its updates are appended. States have
    to be there before the stream starts.

    ``stateful`` remembers each day's newest document, so one that comes later but
    was written earlier changes nothing. A checkpoint folder belongs to one setting.
    """
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    documents = puzzle_reader(reader, source, multi_line)
    if stateful:
        documents = newest_in_stream(documents)

    def append(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        puzzles, answers = split_documents(newest_of_day(materialise(batch)))
        words, batch_id = session.table(f"{db}.words"), f"{batch_prefix}_{epoch}"
        found = materialise(with_decision_dates(word_decisions(puzzles, answers, words)))
        decisions_in(session, store).replace_keys(found, ["puzzle_date"], keys_fix_partition=True)
        states = StateLog(session, f"{store}/word_states")
        updates = decisions_as_updates(found, batch_id)
        states.merge(enrich_new_words(updates, states.read(fixed=[]), words), batch_id)
        states.compact()

    def process(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        puzzles, answers = split_documents(newest_of_day(batch))
        found = materialise(with_decision_dates(word_decisions(puzzles, answers, session.table(f"{db}.words"))))
        replace_keys(found, "word_decisions", db, ["puzzle_date"], DECISION_PARTITIONS, keys_fix_partition=True)
        # The stream runs in a copy of the session; the caller's file listing must follow.
        spark.catalog.refreshTable(f"{db}.word_decisions")
        dates = puzzles.select("puzzle_date").distinct()
        months = rows_of_partitions(session.table(f"{db}.word_decisions"), found, DECISION_PARTITIONS)
        stored = months.join(dates, "puzzle_date", "left_semi")
        update_states(session, db, stored, f"{batch_prefix}_{epoch}", buckets)

    stream = documents.writeStream.foreachBatch(append if store else process)
    stream = stream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if not stateful:
        return stream.start()
    with state_store(spark):
        return stream.outputMode("update").start()
