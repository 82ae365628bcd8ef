"""Which words a puzzle admits, and the decisions that follow from it.

Normalised puzzles have ``puzzle_date`` (date), ``center_letter`` and
``outer_letters`` (upper case). Official answers are kept long, one row per
puzzle and word, so that no puzzle has to be held in one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anagrove.functions import eligible, letter_set, subset_keys
from anagrove.operators.skew import WORDS_PER_LINE, salted_join, word_arrays

PUZZLE_KEY = ["puzzle_date", "center_letter", "outer_letters"]


def with_letter_set(words: DataFrame) -> DataFrame:
    return words.withColumn("letter_set", letter_set(F.col("word")))


def eligible_words(words: DataFrame) -> DataFrame:
    """Words that can be answers; any payload columns are kept."""
    return with_letter_set(words).filter(eligible(F.col("word"), F.col("letter_set")))


def letter_set_index(
    words: DataFrame, payload: list[str] | None = None, words_per_line: int = WORDS_PER_LINE
) -> DataFrame:
    """Inverted index from letter set to its words and their payload."""
    usable = eligible_words(words)
    entry = F.struct("word", *(payload or []))
    return word_arrays(usable, "letter_set", "word", entry, "rows", words_per_line)


def normalise_puzzles(documents: DataFrame) -> DataFrame:
    """Puzzle documents to upper-cased letters and a date; answers untouched."""
    return documents.select(
        F.to_date("printDate", "yyyy-MM-dd").alias("puzzle_date"),
        F.upper("centerLetter").alias("center_letter"),
        F.upper(F.array_join("outerLetters", "")).alias("outer_letters"),
        "answers",
    )


def split_documents(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Puzzle documents to (puzzles, long official answers)."""
    normal = normalise_puzzles(documents)
    puzzles = normal.select(*PUZZLE_KEY).distinct()
    answers = normal.select(*PUZZLE_KEY, F.explode("answers").alias("word"))
    return puzzles, answers


def puzzle_letter_keys(puzzles: DataFrame, distinct: bool = False) -> DataFrame:
    """One row per puzzle and subset key; ``distinct`` folds repeated keys."""
    keys = subset_keys(F.col("center_letter"), F.col("outer_letters"))
    keys = F.array_distinct(keys) if distinct else keys
    return puzzles.select("*", F.explode(keys).alias("letter_set"))


def matching_words(
    puzzles: DataFrame,
    words: DataFrame,
    distinct: bool = False,
    slices: int = 1,
) -> DataFrame:
    """Every (puzzle, word) such that the word's letter set is a puzzle key.

    ``words`` carries ``word``, ``letter_set`` and any payload. The match is an
    equi-join on the letter set: it hashes, shuffles and never compares a puzzle
    with a word it does not admit. Repeated outer letters give repeated rows
    unless ``distinct`` folds the keys, which costs no shuffle. ``slices`` deals
    the puzzles of a letter set out, for callers who know one to be hot.
    """
    keys = puzzle_letter_keys(puzzles, distinct)
    return salted_join(keys, words, "letter_set", PUZZLE_KEY, slices)


def word_decisions(puzzles: DataFrame, answers: DataFrame, words: DataFrame) -> DataFrame:
    """Union of official answers and matches per puzzle; accepted when official.

    ``words`` holds all known words, listed or new, so an answer accepted once can
    be rejected by a later puzzle. Answers outside of it stay, as accepted. The set union is one hash
    aggregation over both inputs rather than a full outer join. Nearly all rows
    are distinct, so they are shuffled first: a map-side table would only copy
    them, and a (puzzle, word) key has too few rows to be hot.
    """
    columns = ["word", "center_letter", "outer_letters", "puzzle_date"]
    known = words.filter(eligible(F.col("word"), F.col("letter_set"))).select("word", "letter_set")
    matched = matching_words(puzzles, known, distinct=True)
    official = answers.select(*columns, F.lit(1.0).cast("float").alias("accepted"))
    implicit = matched.select(*columns, F.lit(0.0).cast("float").alias("accepted"))
    both = official.unionByName(implicit).repartition(*columns)
    return both.groupBy(*columns).agg(F.max("accepted").alias("accepted"))


def with_decision_dates(decisions: DataFrame) -> DataFrame:
    return (
        decisions.withColumn("year", F.year("puzzle_date"))
        .withColumn("month", F.month("puzzle_date"))
        .withColumn("day", F.dayofmonth("puzzle_date"))
    )


def month_counts(decisions: DataFrame) -> DataFrame:
    """Decisions per month of every year present; empty months count 0."""
    counted = decisions.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"))
    years = counted.select("year").distinct()
    calendar = years.select("year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    return calendar.join(counted, ["year", "month"], "left").fillna(0, ["n"])


def decision_partitions(decisions: DataFrame) -> DataFrame:
    return decisions.select("year", "month").distinct().orderBy("year", "month")


def raw_words(word_list: DataFrame, answers: DataFrame) -> DataFrame:
    """Word list as version 1 plus answers missing from it as version 2.

    The word list is filtered for eligibility, the new answers are not.
    """
    listed = eligible_words(word_list.select("word").distinct())
    fresh = with_letter_set(answers.select("word").distinct()).join(listed, "word", "left_anti")
    both = listed.withColumn("version", F.lit(1)).unionByName(
        fresh.withColumn("version", F.lit(2))
    )
    return both.withColumn("date_added", F.lit(None).cast("date"))


def version_counts(words: DataFrame) -> DataFrame:
    return words.groupBy("version").agg(F.count(F.lit(1)).alias("n"))
