import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from anagrove.operators.matching import (
    eligible_words,
    letter_set_index,
    matching_words,
    month_counts,
    raw_words,
    split_documents,
    with_decision_dates,
    word_decisions,
)
from anagrove.operators.skew import salted_join, word_arrays
from anagrove.sources.puzzles import PUZZLE_SCHEMA

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def words(spark):
    rng = random.Random(7)
    drawn = {"".join(rng.choices("abcdefghi", k=rng.randint(4, 9))) for _ in range(600)}
    return eligible_words(spark.createDataFrame([(w,) for w in sorted(drawn)], "word string")).cache()


@pytest.fixture(scope="module")
def puzzles(spark):
    rows = [(DAY, "A", "BCDEFG"), (DAY + dt.timedelta(1), "I", "HGABCC"), (DAY + dt.timedelta(2), "Z", "QXYWVU")]
    return spark.createDataFrame(rows, "puzzle_date date, center_letter string, outer_letters string")


def brute(puzzles, words):
    """Bit-test rule: only puzzle letters, the centre, and one letter more."""
    found = set()
    for p in puzzles.collect():
        allowed = set(p.center_letter + p.outer_letters)
        for w in words.collect():
            letters = set(w.letter_set)
            if letters <= allowed and p.center_letter in letters and letters != {p.center_letter}:
                found.add((p.puzzle_date, w.word))
    return found


def test_match_equals_bit_test(puzzles, words):
    found = matching_words(puzzles, words, distinct=True)
    rows = [(r.puzzle_date, r.word) for r in found.collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == brute(puzzles, words)


def test_repeated_outer_letters_repeat_matches(puzzles, words):
    plain = matching_words(puzzles, words).filter("outer_letters = 'HGABCC'")
    assert plain.count() > plain.distinct().count()


def test_split_hot_keys_give_the_same_rows(puzzles, words):
    plain = matching_words(puzzles, words)
    split = matching_words(puzzles, words, slices=3)
    key = [F.struct(*sorted(plain.columns)).cast("string")]
    assert sorted(r[0] for r in plain.select(*key).collect()) == sorted(
        r[0] for r in split.select(*key).collect()
    )


def test_salted_join_spreads_a_hot_key(spark):
    left = spark.range(200).select(F.lit("k").alias("key"), F.col("id").alias("a"))
    right = spark.range(3).select(F.lit("k").alias("key"), F.col("id").alias("b"))
    joined = salted_join(left, right, "key", ["a"], slices=4)
    assert joined.distinct().count() == joined.count() == 600


def test_word_arrays_are_cut_in_word_order(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 4 == 0, "b").otherwise("a").alias("key"), F.format_string("w%04d", "id").alias("m")
    )
    parts = word_arrays(df, "key", "m", F.col("m"), "ms", words_per_line=120).collect()
    for key, size in (("a", 750), ("b", 250)):
        own = sorted((p for p in parts if p.key == key), key=lambda p: p.part)
        assert [p.part for p in own] == list(range(-(-size // 120)))
        assert [len(p.ms) for p in own[:-1]] == [120] * (len(own) - 1)
        words = [w for p in own for w in p.ms]
        assert words == sorted(words) and len(words) == size


def test_match_plan_has_no_nested_loop(puzzles, words):
    plan = matching_words(puzzles, words)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_index_keeps_payload(spark):
    df = spark.createDataFrame([("abca", 1), ("bcaa", 2), ("abc", 3), ("wxyz", 4)], "word string, n int")
    index = {r.letter_set: [tuple(x) for x in r.rows] for r in letter_set_index(df, ["n"]).collect()}
    assert index == {"ABC": [("abca", 1), ("bcaa", 2)], "WXYZ": [("wxyz", 4)]}


def test_decisions_join_answers_and_matches(spark):
    documents = spark.createDataFrame(
        [("2024-02-03", "a", list("bcdefg"), ["abba", "zulu", "offlist", "abba"])], PUZZLE_SCHEMA
    )
    listed = eligible_words(
        spark.createDataFrame([(w,) for w in ("abba", "cabs", "fade", "aaaa", "zulu")], "word string")
    )
    puzzles, answers = split_documents(documents)
    rows = with_decision_dates(word_decisions(puzzles, answers, listed)).collect()
    assert {r.word: r.accepted for r in rows} == {"abba": 1.0, "zulu": 1.0, "offlist": 1.0, "fade": 0.0}
    first = rows[0]
    assert (first.center_letter, first.outer_letters) == ("A", "BCDEFG")
    assert (first.year, first.month, first.day) == (2024, 2, 3)


def test_month_counts_list_empty_months(spark):
    rows = spark.createDataFrame([(2024, 2), (2024, 2), (2024, 5)], "year int, month int")
    counts = {r.month: r.n for r in month_counts(rows).collect()}
    assert len(counts) == 12 and counts[2] == 2 and counts[5] == 1 and counts[1] == 0


def test_new_answers_become_version_two(spark):
    listed = spark.createDataFrame([("abba",), ("abc",)], "word string")
    answers = spark.createDataFrame([("abba",), ("xy",), ("xy",)], "word string")
    rows = {r.word: (r.version, r.letter_set) for r in raw_words(listed, answers).collect()}
    assert rows == {"abba": (1, "AB"), "xy": (2, "XY")}
