import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anagrove.operators import enrich


def test_latest_frequency_defaults_to_zero(spark):
    words = spark.createDataFrame([("a",), ("b",)], "word string")
    series = spark.createDataFrame([("a", 1990, 5), ("a", 2000, 3), ("c", 2000, 9)], "word string, year int, n int")
    rows = {r.word: r.frequency for r in enrich.latest_frequency(words, series, ["year"], "n").collect()}
    assert rows == {"a": 3.0, "b": 0.0}


def test_mean_pool(spark):
    df = spark.createDataFrame(
        [("a", [1.0, 2.0]), ("a", [3.0, 6.0]), ("b", [5.0, 5.0])], "word string, embedding array<float>"
    )
    assert {r.word: r.embedding for r in enrich.mean_pool(df, "word").collect()} == {
        "a": [2.0, 4.0],
        "b": [5.0, 5.0],
    }


def test_embedding_checks(spark):
    rows = [([1.0, 2.0],), ([1.0],), ([1.0, None],), ([1.0, float("nan")],), (None,)]
    df = spark.createDataFrame(rows, "embedding array<float>")
    found = enrich.validate_embeddings(df, expected_length=2).first()
    assert tuple(found) == (5, 1, 2, 0, 2)
    with pytest.raises(ValueError, match="not valid"):
        enrich.require_valid_embeddings(df, expected_length=2)
    good = df.limit(1)
    assert enrich.require_valid_embeddings(good, expected_length=2)["valid_embeddings"] == 1
    wrong = enrich.validate_embeddings(good, expected_length=2, expected_type="double").first()
    assert (wrong.valid_embeddings, wrong.wrong_type) == (0, 1)


def frames(spark):
    words = spark.createDataFrame(
        [("a", "A", None, 1), ("b", "B", None, 1)], "word string, letter_set string, date_added date, version int"
    )
    vectors = spark.createDataFrame([("a", [1.0])], "word string, embedding array<float>")
    counts = spark.createDataFrame([("a", 1.0), ("z", 2.0)], "word string, frequency double")
    return words, vectors, counts


def test_join_and_gates(spark):
    words, vectors, counts = frames(spark)
    joined = enrich.join_word_data(words, vectors, counts)
    assert {r.word for r in joined.collect()} == {"a", "b", "z"}
    patterns = {tuple(r)[:4]: r.n for r in enrich.missing_patterns(joined).collect()}
    assert patterns[(False, False, False, False)] == 1 and len(patterns) == 3
    assert {r.word for r in enrich.incomplete_words(joined).collect()} == {"b", "z"}
    with pytest.raises(ValueError, match="lack data"):
        enrich.require_complete(joined)
    with pytest.raises(ValueError, match="differ"):
        enrich.require_equal_counts({"words": words, "vectors": vectors})
    enrich.require_equal_counts({"words": words, "counts": counts})


def test_batches_resume_where_they_stopped(spark):
    folder = tempfile.mkdtemp(prefix="anagrove-enrich-")
    words = spark.createDataFrame([(f"w{i:02d}",) for i in range(25)], "word string")

    def failing(batch):
        if "w15" in batch:
            raise RuntimeError("stopped on purpose")
        return {w: 1.0 for w in batch}

    args = dict(data_col="frequency", data_type=T.FloatType(), batch_size=5, batches_per_commit=2)
    with pytest.raises(Exception, match="stopped on purpose"):
        enrich.enrich_batches(words, failing, folder, **args)
    logged = spark.read.parquet(f"{folder}/log")
    assert sorted(r.batch_id for r in logged.collect()) == [0, 1]

    found = enrich.enrich_batches(words, lambda batch: {w: 2.0 for w in batch}, folder, **args)
    values = {r.word: r.frequency for r in found.collect()}
    assert len(values) == 25
    # The first wave was logged and is not collected again.
    assert {values[f"w{i:02d}"] for i in range(10)} == {1.0}
    assert {values[f"w{i:02d}"] for i in range(10, 25)} == {2.0}
    assert found.groupBy("word").count().filter(F.col("count") > 1).isEmpty()


def test_new_words_are_enriched_wherever_they_sort(spark, tmp_path):
    args = dict(path=str(tmp_path / "e"), data_col="frequency", data_type=T.FloatType())
    first = spark.createDataFrame([("b",), ("c",), ("d",)], "word string")
    enrich.enrich_batches(first, lambda batch: {w: 1.0 for w in batch}, batch_size=2, **args)
    more = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "word string")
    found = enrich.enrich_batches(more, lambda batch: {w: 2.0 for w in batch}, batch_size=3, **args)
    assert {(r.word, r.frequency, r.batch_id) for r in found.collect()} == {
        ("b", 1.0, 0), ("c", 1.0, 0), ("d", 1.0, 1), ("a", 2.0, 2),
    }
    log = spark.read.parquet(args["path"] + "/log").orderBy("batch_id").collect()
    assert [(r.start_idx, r.end_idx) for r in log] == [(0, 2), (2, 3), (3, 4)]
    assert all(r.collect_seconds >= 0 and r.wave_seconds > 0 for r in log)
