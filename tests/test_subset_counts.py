import random

from pyspark.sql import functions as F

from anagrove.operators.matching import eligible_words, matching_words
from anagrove.operators.subset_counts import center_counts, set_sizes, subset_tables, words_within


def some_words(n=400, alphabet="abcdefghi"):
    rng = random.Random(5)
    return sorted({"".join(rng.choices(alphabet, k=rng.randint(4, 7))) for _ in range(n)} | {"aaaa", "bbbb", "abab"})


def tables(spark, texts, words):
    listed = eligible_words(spark.createDataFrame([(w,) for w in words], "word string"))
    asked = spark.createDataFrame([(t,) for t in texts], "letters string")
    return subset_tables(asked, listed)


def test_every_part_of_the_letters_against_brute_force(spark):
    words = some_words()
    rows = tables(spark, ["ABCDEFG", "CDEFGHI", "ABC", "Z"], words).collect()
    assert {r.letters for r in rows} == {"ABCDEFG", "CDEFGHI", "ABC", "Z"}
    for row in rows:
        for m in range(128):
            part = {x for i, x in enumerate(row.letters) if m >> i & 1}
            assert row.table[m] == sum(set(w.upper()) <= part for w in words)


def test_centers_count_what_matching_lists(spark):
    words = some_words()
    listed = eligible_words(spark.createDataFrame([(w,) for w in words], "word string"))
    counted = center_counts(tables(spark, ["ABCDEFG", "BCDEFGH"], words))
    puzzles = counted.select(
        F.lit("2020-01-01").cast("date").alias("puzzle_date"),
        "center_letter",
        F.expr("replace(letters, center_letter, '')").alias("outer_letters"),
    )
    found = matching_words(puzzles, listed, distinct=True).groupBy("center_letter", "outer_letters").count()
    expected = {(r.center_letter, "".join(sorted(r.center_letter + r.outer_letters))): r["count"] for r in found.collect()}
    got = {(r.center_letter, r.letters): r.n_words for r in counted.collect()}
    assert got == {key: expected.get(key, 0) for key in got}
    assert len(got) == 14


def test_words_with_and_without_letters(spark):
    words = some_words()
    row = (
        tables(spark, ["GFEDCBA"], words)
        .select(words_within(F.col("table"), F.col("letters"), F.lit("XADB")).alias("n"))
        .first()
    )
    assert row.n == sum(set(w) <= set("abd") for w in words)


def test_odd_inputs(spark):
    texts = [None, "", "ABCDEFGH", "AABBA", "BA", "ÄÖÜ"]
    got = {r.letters: r.table[3] for r in tables(spark, texts, ["abab", "baba", "äöäö"]).collect()}
    assert got == {"AB": 2, "ÄÖÜ": 1}
    assert tables(spark, ["AB"], []).first().table == [0] * 128


def test_repeated_words_count_and_null_sets_do_not(spark):
    rows = [("abab", "AB"), ("abab", "AB"), ("x", None)]
    assert [tuple(r) for r in set_sizes(spark.createDataFrame(rows, "word string, letter_set string")).collect()] == [("AB", 2)]


def test_a_hot_set_is_one_row_before_the_join(spark):
    """The plan aggregates words by their set below the join, so a set's size costs nothing there."""
    listed = spark.range(1000).select(F.lit("abab").alias("word"), F.lit("AB").alias("letter_set"))
    asked = spark.createDataFrame([("ABC",)], "letters string")
    frame = subset_tables(asked, listed)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join Inner")
    assert "count(1) AS n_words" in plan[join:]
    assert frame.first().table[3] == 1000
