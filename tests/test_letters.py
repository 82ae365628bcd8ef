import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from anagrove.functions import letter_set, subset_keys
from anagrove.operators.matching import eligible_words, with_letter_set
from anagrove.sources.wordlists import latest_version, words_from_lines


@pytest.mark.parametrize(
    ("word", "expected"),
    [
        ("Zebra", "ZABER"),
        ("zebra", "ABERZ"),
        ("AAaa", "AA"),
        ("straße", "AERSTSS"),
        ("élan", "ALNÉ"),
    ],
)
def test_letter_set(spark, word, expected):
    row = spark.createDataFrame([(word,)], "word string").select(letter_set(F.col("word"))).first()
    assert row[0] == expected


def brute_keys(center, outer):
    keys = []
    for size in range(1, 7):
        for chosen in itertools.combinations(outer, size):
            keys.append("".join(sorted([center, *chosen])))
    return sorted(keys)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text("ABCDEFGH", min_size=1, max_size=1), st.text("ABCDEFGHIJ", min_size=1, max_size=8))
def test_subset_keys_equal_combinations(spark, center, outer):
    row = spark.createDataFrame([(center, outer)], "c string, o string")
    keys = row.select(subset_keys(F.col("c"), F.col("o"))).first()[0]
    assert sorted(keys) == brute_keys(center, outer)


def test_key_counts(spark):
    rows = spark.createDataFrame([("A", "BCDEFG"), ("A", "BBCDEF"), ("A", "")], "c string, o string")
    keys = [r[0] for r in rows.select(subset_keys(F.col("c"), F.col("o"))).collect()]
    assert [len(k) for k in keys] == [63, 63, 0]
    assert len(set(keys[0])) == 63 and len(set(keys[1])) < 63
    assert all("A" != k for k in keys[0])


def test_eligibility(spark):
    words = ["abc", "abcd", "aaaa", "abcdefg", "abcdefgh", "straßen", "wordwordword"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    kept = {r.word for r in eligible_words(df).collect()}
    # "straßen" grows past seven letters once upper-cased.
    assert kept == {"abcd", "aaaa", "abcdefg", "wordwordword"}
    assert "letter_set" in with_letter_set(df).columns


def test_word_lines(spark):
    lines = ['"word"', "'word", "  other  ", "", "   ", '"', "it's", '""twice""']
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    assert {r.word for r in words_from_lines(df).collect()} == {"word", "other", "it's", '"twice"'}


def test_latest_version_compares_numbers(spark):
    names = ["list_v9.txt", "list_v10.txt", "other-20210729.txt"]
    df = spark.createDataFrame([(n,) for n in names], "file_name string")
    assert tuple(latest_version(df).first()) == ("list_v10.txt", 10)
