"""Word frequencies, embeddings and the checks on them."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from typing import Any

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anagrove.functions import embedding_is_valid, tokens
from anagrove.operators.ranking import assign_batches, batch_log, ordered_chunks
from anagrove.session import materialise


def corpus_frequency(documents: DataFrame) -> DataFrame:
    """Count of every token of a text table."""
    words = documents.select(F.explode(tokens(F.col("text"))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def latest_frequency(words: DataFrame, series: DataFrame, time: list[str], value: str) -> DataFrame:
    """Newest value of each word's series, 0.0 for words without one.

    ``time`` orders the series, with any tie-breakers last.
    """
    newest = series.groupBy("word").agg(
        F.max_by(F.col(value), F.struct(*time)).cast("double").alias("frequency")
    )
    joined = words.join(newest, "word", "left")
    return joined.withColumn("frequency", F.coalesce("frequency", F.lit(0.0)))


def frequency_series(
    series: DataFrame, key: str, time: list[str], value: str, max_rows: int = 1_000
) -> DataFrame:
    """All values per key in time order, in chunks of bounded length."""
    return ordered_chunks(series, key, [F.col(c) for c in time], F.col(value), max_rows)


def mean_pool(vectors: DataFrame, key: str, column: str = "embedding") -> DataFrame:
    """Element-wise mean of all vectors of a key, combined on the map side."""
    pooled = vectors.groupBy(key).agg(Summarizer.mean(array_to_vector(column)).alias("_mean"))
    return pooled.select(key, vector_to_array("_mean").alias(column))


def validate_embeddings(
    df: DataFrame, column: str = "embedding", expected_length: int = 768, expected_type: str = "float"
) -> DataFrame:
    """Total and valid row counts in one pass.

    The element type is a property of the schema, so a wrong type makes every
    row of the right length invalid.
    """
    element = df.schema[column].dataType.elementType.simpleString()
    sound = embedding_is_valid(F.col(column), expected_length)
    right_length = F.coalesce(F.size(column) == expected_length, F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(sound & F.lit(element == expected_type)).alias("valid_embeddings"),
        F.count_if(~right_length).alias("wrong_length"),
        F.count_if(right_length & F.lit(element != expected_type)).alias("wrong_type"),
        F.count_if(right_length & ~sound).alias("broken_elements"),
    )


def require_valid_embeddings(
    df: DataFrame, column: str = "embedding", expected_length: int = 768, expected_type: str = "float"
) -> dict[str, int]:
    """Counts of a valid frame; shows ten bad rows and raises otherwise."""
    found = validate_embeddings(df, column, expected_length, expected_type).first().asDict()
    if found["valid_embeddings"] < found["total_rows"]:
        bad = df.filter(~embedding_is_valid(F.col(column), expected_length)).limit(10)
        bad.withColumn("length", F.size(column)).drop(column).show(truncate=False)
        raise ValueError(f"embeddings are not valid: {found}")
    return found


CollectFn = Callable[[list[str]], dict[str, Any]]


def collect_for_batches(
    assigned: DataFrame, collect_fn: CollectFn, data_col: str, data_type: T.DataType
) -> DataFrame:
    """Call ``collect_fn`` once per batch on the executors.

    ``assigned`` has ``word`` and ``batch_id``. A batch is as large as the batch
    size, whatever the words are, so no group can grow hot.
    """
    schema = T.StructType(
        [
            T.StructField("word", T.StringType(), False),
            T.StructField(data_col, data_type, False),
            T.StructField("batch_id", T.IntegerType(), False),
            T.StructField("collect_seconds", T.DoubleType(), False),
        ]
    )

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        began = time.monotonic()
        found = collect_fn(sorted(batch["word"]))
        return pd.DataFrame(
            {
                "word": list(found.keys()),
                data_col: list(found.values()),
                "batch_id": int(batch["batch_id"].iloc[0]),
                "collect_seconds": time.monotonic() - began,
            }
        )

    return assigned.groupBy("batch_id").applyInPandas(run, schema)


def _stored(spark, path: str) -> DataFrame | None:
    """The table at ``path``; None before the first run, when it is missing or still empty."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def enrich_batches(
    words: DataFrame,
    collect_fn: CollectFn,
    path: str,
    data_col: str,
    data_type: T.DataType,
    batch_size: int = 100,
    batches_per_commit: int = 10_000,
) -> DataFrame:
    """Resumable enrichment of ``words`` into the table at ``path``.

    Words that a finished wave has taken up are left out; the others are sorted
    and cut into batches, numbered on from the highest logged one. So new words,
    wherever they sort, and another batch size are fine. One Spark job handles a
    wave of ``batches_per_commit`` batches and replaces that wave's partition; its
    log partition, with the times taken, is written afterwards and marks it done.
    A wave that was cut short has no log and is done again as a whole.
    """
    spark = words.sparkSession
    data_path, log_path, taken_path = f"{path}/data", f"{path}/log", f"{path}/taken"
    wanted, log = words.select("word").distinct(), _stored(spark, log_path)
    first_wave = first_batch = first_row = 0
    if log is not None:
        last = log.agg(F.max("wave"), F.max("batch_id"), F.max("end_idx")).first()
        first_wave, first_batch, first_row = (int(last[0]) + 1, int(last[1]) + 1, int(last[2]))
        finished = _stored(spark, taken_path).filter(F.col("wave") < first_wave)
        wanted = wanted.join(finished.select("word"), "word", "left_anti")
    assigned = assign_batches(wanted, batch_size).withColumn("batch_id", F.col("batch_id") + first_batch)
    assigned = assigned.withColumn("rank", F.col("rank") + first_row)
    wave = F.floor((F.col("batch_id") - first_batch) / batches_per_commit).cast("int") + first_wave
    planned = materialise(assigned.withColumn("wave", wave))
    # Wave numbers only: one per batches_per_commit * batch_size words.
    waves = [row.wave for row in planned.select("wave").distinct().orderBy("wave").toLocalIterator()]
    for number in waves:
        began = time.monotonic()
        part = planned.filter(F.col("wave") == number)
        found = collect_for_batches(part, collect_fn, data_col, data_type)
        _replace_wave(found.withColumn("wave", F.lit(number)), data_path)
        took = time.monotonic() - began
        done = spark.read.parquet(data_path).filter(F.col("wave") == number)
        seconds = done.groupBy("batch_id").agg(F.max("collect_seconds").alias("collect_seconds"))
        logged = batch_log(part).join(seconds, "batch_id", "left").withColumn("wave_seconds", F.lit(took))
        _replace_wave(part.select("word", "wave"), taken_path)
        _replace_wave(logged.withColumn("wave", F.lit(number)), log_path)
    # What a wave without a log has left behind doesn't count.
    finished = spark.read.parquet(log_path).agg(F.max("wave")).first()[0]
    return spark.read.parquet(data_path).filter(F.col("wave") <= finished).drop("wave", "collect_seconds")


def _replace_wave(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("wave")
        .parquet(path)
    )


def collect_frequencies(words: DataFrame, collect_fn: CollectFn, path: str, batch_size: int = 100):
    return enrich_batches(words, collect_fn, path, "frequency", T.FloatType(), batch_size)


def collect_embeddings(words: DataFrame, collect_fn: CollectFn, path: str, batch_size: int = 1000):
    vector = T.ArrayType(T.FloatType(), False)
    return enrich_batches(words, collect_fn, path, "embedding", vector, batch_size)


def join_word_data(words: DataFrame, embeddings: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Three-way full outer join on ``word``.

    Frequencies join first: the intermediate that has to be shuffled again is
    then narrow, and the wide vectors cross the network only once.
    """
    joined = words.join(frequencies, "word", "full_outer").join(embeddings, "word", "full_outer")
    return joined.select("word", "letter_set", "date_added", "version", "frequency", "embedding")


CHECKED_COLUMNS = ["letter_set", "version", "frequency", "embedding"]


def missing_patterns(joined: DataFrame, columns: Iterable[str] = CHECKED_COLUMNS) -> DataFrame:
    flags = [F.col(c).isNull().alias(f"{c}_missing") for c in columns]
    names = [f"{c}_missing" for c in columns]
    return joined.select(*flags).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))


def _any_missing(columns: Iterable[str]) -> Column:
    gap = F.lit(False)
    for name in columns:
        gap = gap | F.col(name).isNull()
    return gap


def incomplete_words(joined: DataFrame, columns: Iterable[str] = CHECKED_COLUMNS) -> DataFrame:
    return joined.filter(_any_missing(columns))


def require_complete(joined: DataFrame, columns: Iterable[str] = CHECKED_COLUMNS) -> None:
    bad = incomplete_words(joined, columns)
    if not bad.isEmpty():
        bad.limit(10).show(truncate=False)
        raise ValueError("some words lack data; see the rows shown")


def count_reconcile(frames: dict[str, DataFrame]) -> DataFrame:
    """Row count of each frame next to whether all counts agree."""
    counts = None
    for name, frame in frames.items():
        one = frame.agg(F.count(F.lit(1)).alias("n")).withColumn("source", F.lit(name))
        counts = one if counts is None else counts.unionByName(one)
    agree = counts.agg(F.count_distinct("n") == 1).scalar()
    return counts.select("source", "n", agree.alias("all_equal"))


def require_equal_counts(frames: dict[str, DataFrame]) -> None:
    # One row per input frame.
    rows = count_reconcile(frames).collect()
    if not rows[0].all_equal:
        raise ValueError(f"row counts differ: { {r.source: r.n for r in rows} }")
