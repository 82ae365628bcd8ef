"""Late, repeated and out-of-order documents over several micro-batches."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from anagrove.operators.matching import eligible_words
from anagrove.operators.state_log import StateLog
from anagrove.operators.states import init_states
from anagrove.session import scratch_name
from anagrove.sinks import tables
from anagrove.sources.puzzles import puzzle_reader
from anagrove.streaming.ingest import decisions_in, ingest_puzzles, newest_of_day


@pytest.fixture
def house(spark, tmp_path):
    db = scratch_name("newest")
    tables.create_db(spark, db, str(tmp_path / "db"))
    listed = eligible_words(spark.createDataFrame([(w,) for w in ("abba", "cabs", "fade", "aged")], "word string"))
    words = listed.withColumns(
        {
            "version": F.lit(1),
            "date_added": F.lit(None).cast("date"),
            "frequency": F.lit(1.0),
            "embedding": F.array(F.lit(0.5).cast("float")),
        }
    )
    tables.create_table(words, "words", db)
    StateLog.create(spark, f"{tmp_path}/store/word_states", init_states(words, "words"), buckets=2)
    return db


def put(folder, name, day, answers, modified):
    """One document; ``modified`` in minutes."""
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}.json"
    document = {"printDate": day, "centerLetter": "a", "outerLetters": list("bcdefg"), "answers": answers}
    with open(path, "w") as file:
        file.write(json.dumps(document) + "\n")
    os.utime(path, (1_700_000_000 + 60 * modified,) * 2)


def accepted(rows):
    return sorted((str(r.puzzle_date), r.word) for r in rows.filter("accepted = 1").collect())


def test_the_newest_document_holds_in_any_order(spark, house, tmp_path):
    source, store = str(tmp_path / "in"), str(tmp_path / "store")

    def run():
        ingest_puzzles(
            spark, source, house, str(tmp_path / "cp"), multi_line=False, store=store, stateful=True, max_files=2
        ).awaitTermination()

    put(source, "a", "2024-01-05", ["abba"], 50)
    put(source, "b", "2024-01-06", ["fade"], 10)
    run()
    assert accepted(decisions_in(spark, store).read()) == [("2024-01-05", "abba"), ("2024-01-06", "fade")]
    put(source, "c", "2024-01-05", ["cabs"], 20)  # comes later, written earlier
    put(source, "d", "2024-01-06", ["fade"], 30)  # repeated
    put(source, "e", "2024-01-06", ["aged"], 25)  # between
    run()
    assert accepted(decisions_in(spark, store).read()) == [("2024-01-05", "abba"), ("2024-01-06", "fade")]
    put(source, "f", "2024-01-05", ["cabs", "fade"], 60)
    put(source, "g", "2024-01-07", ["aged"], 1)
    run()
    run()
    found = accepted(decisions_in(spark, store).read())
    assert found == [("2024-01-05", "cabs"), ("2024-01-05", "fade"), ("2024-01-06", "fade"), ("2024-01-07", "aged")]
    whole = newest_of_day(puzzle_reader(spark.read, source, False)).select("printDate", F.explode("answers").alias("word"))
    assert found == sorted((str(r.printDate), r.word) for r in whole.collect())
    states = {r.word: (r.label, r.last_seen_on) for r in StateLog(spark, f"{store}/word_states").read().collect()}
    assert states["aged"] == (1.0, dt.date(2024, 1, 7)) and states["abba"] == (0.0, dt.date(2024, 1, 7))
