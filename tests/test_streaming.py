import datetime as dt
import json
import os

import pytest

from anagrove.operators.matching import eligible_words
from anagrove.operators.states import init_states
from anagrove.plans.lifecycle import backfill_year
from anagrove.session import scratch_name, scratch_path
from anagrove.sinks import export, tables
from anagrove.sources.puzzles import PUZZLE_SCHEMA
from anagrove.streaming.ingest import ingest_puzzles
from pyspark.sql import functions as F


@pytest.fixture
def house(spark):
    db = scratch_name("stream")
    tables.create_db(spark, db, scratch_path(spark, db))
    listed = eligible_words(
        spark.createDataFrame([(w,) for w in ("abba", "cabs", "fade", "zulu")], "word string")
    )
    words = (
        listed.withColumn("version", F.lit(1))
        .withColumn("date_added", F.lit(None).cast("date"))
        .withColumn("frequency", F.lit(1.0))
        .withColumn("embedding", F.array(F.lit(0.5).cast("float")))
    )
    tables.create_table(words, "words", db)
    tables.publish_snapshot(init_states(words, "words"), "word_states", db, buckets=4)
    return db


def write(spark, path, date, answers):
    rows = [(date, "a", list("bcdefg"), answers)]
    export.write_puzzles(spark.createDataFrame(rows, PUZZLE_SCHEMA), path)


def states(spark, db):
    return {r.word: (r.label, r.last_seen_on) for r in spark.table(f"{db}.word_states").collect()}


def test_late_and_repeated_puzzles(spark, house):
    source, checkpoint = scratch_path(spark, "in"), scratch_path(spark, "cp")

    def run():
        ingest_puzzles(spark, source, house, checkpoint, multi_line=False, buckets=4).awaitTermination()

    write(spark, source, "2024-01-05", ["abba", "offlist"])
    run()
    day = dt.date(2024, 1, 5)
    assert states(spark, house) == {
        "abba": (1.0, day),
        "fade": (0.0, day),
        "offlist": (1.0, day),
        "cabs": (None, None),
        "zulu": (None, None),
    }
    # Nothing new: nothing changes.
    run()
    assert states(spark, house)["abba"] == (1.0, day)
    # A late, older puzzle is recorded but does not overwrite newer states.
    write(spark, source, "2024-01-02", ["fade"])
    run()
    assert states(spark, house)["fade"] == (0.0, day)
    assert states(spark, house)["abba"] == (1.0, day)
    assert spark.table(f"{house}.word_decisions").filter("puzzle_date = '2024-01-02'").count() == 2
    # A corrected puzzle replaces its own day only.
    write(spark, source, "2024-01-05", ["fade"])
    run()
    decided = spark.table(f"{house}.word_decisions").filter("puzzle_date = '2024-01-05'").collect()
    assert {r.word: r.accepted for r in decided} == {"abba": 0.0, "fade": 1.0}
    assert states(spark, house)["fade"] == (1.0, day)
    assert spark.table(f"{house}.word_decisions").count() == 4


def test_backfill_replaces_a_year(spark, house):
    listed = spark.table(f"{house}.words")
    rows = [
        ("2023-12-31", "a", list("bcdefg"), ["abba"]),
        ("2024-01-05", "a", list("bcdefg"), ["abba"]),
        ("2024-03-05", "a", list("bcdefg"), ["fade"]),
    ]
    documents = spark.createDataFrame(rows, PUZZLE_SCHEMA)
    backfill_year(documents, listed, house, 2023)
    counts = {r.month: r.n for r in backfill_year(documents, listed, house, 2024).collect()}
    assert len(counts) == 12 and counts[1] == 2 and counts[3] == 2 and counts[2] == 0
    # A rerun without March clears March and leaves the other year alone.
    fewer = documents.filter("printDate <> '2024-03-05'")
    counts = {r.month: r.n for r in backfill_year(fewer, listed, house, 2024).collect()}
    assert counts[1] == 2 and counts[3] == 0
    assert spark.table(f"{house}.word_decisions").filter("year = 2023").count() == 2


def test_a_new_word_is_accepted_then_rejected(spark, house):
    source = scratch_path(spark, "in")
    fresh = spark.createDataFrame([("gagg",)], "word string")
    known = spark.table(f"{house}.words").unionByName(
        eligible_words(fresh).withColumn("version", F.lit(2)), allowMissingColumns=True
    )
    spark.sql(f"CREATE TABLE {house}.more AS SELECT * FROM {house}.words WHERE false")
    known.select(spark.table(f"{house}.words").columns).write.insertInto(f"{house}.more")
    spark.sql(f"ALTER TABLE {house}.words RENAME TO {house}.older")
    spark.sql(f"ALTER TABLE {house}.more RENAME TO {house}.words")
    write(spark, source, "2024-01-05", ["gagg"])
    write(spark, source, "2024-01-06", ["abba"])
    ingest_puzzles(spark, source, house, scratch_path(spark, "cp"), multi_line=False).awaitTermination()
    assert states(spark, house)["gagg"] == (0.0, dt.date(2024, 1, 6))
    decided = {r.puzzle_date.day: r.accepted for r in spark.table(f"{house}.word_decisions").filter("word = 'gagg'").collect()}
    assert decided == {5: 1.0, 6: 0.0}


@pytest.mark.parametrize("max_files", [None, 1])
def test_the_newest_document_of_a_day_holds(spark, house, tmp_path, max_files):
    for i, (name, answers) in enumerate([("a", ["abba"]), ("b", ["fade"]), ("b.latest", ["zulu"])]):
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps(dict(printDate="2024-01-05", centerLetter="a", outerLetters=list("bcdefg"), answers=answers)))
        os.utime(path, (1_700_000_000 + 10 * i,) * 2)
    ingest_puzzles(spark, str(tmp_path), house, scratch_path(spark, "cp"), max_files=max_files).awaitTermination()
    decided = spark.table(f"{house}.word_decisions").collect()
    assert {r.word: r.accepted for r in decided} == {"abba": 0.0, "fade": 1.0}
