"""What readers of the word probabilities ask for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anagrove.operators.matching import PUZZLE_KEY, matching_words
from anagrove.operators.skew import WORDS_PER_LINE, word_arrays


def top_probabilities(
    words: DataFrame, n: int = 5, source: str = "model", descending: bool = True
) -> DataFrame:
    """The ``n`` most (or least) probable words; a per-task top-n, then one merge."""
    order = F.col("probability").desc() if descending else F.col("probability").asc()
    return words.filter(F.col("source") == source).orderBy(order, "word").limit(n)


def letter_set_groups(words: DataFrame, words_per_line: int = WORDS_PER_LINE) -> DataFrame:
    """Words with probability and date, grouped by letter set."""
    element = F.struct("word", "probability", "last_seen_on", "letter_set")
    return word_arrays(words, "letter_set", "word", element, "data", words_per_line)


def export_rows(groups: DataFrame) -> DataFrame:
    """Short, sorted key names; dates as text; probabilities as doubles."""
    entry = F.transform(
        "data",
        lambda row: F.struct(
            F.date_format(row["last_seen_on"], "yyyy-MM-dd").alias("date"),
            row["letter_set"].alias("letters"),
            row["probability"].cast("double").alias("prob"),
            row["word"].alias("word"),
        ),
    )
    return groups.select("letter_set", "part", entry.alias("data"))


def solve_puzzles(puzzles: DataFrame, words: DataFrame, slices: int = 1) -> DataFrame:
    """Words of each puzzle, most probable first.

    A puzzle's words stand together and in order; puzzles are dealt by their hash,
    so no range of dates has to be found before the rows move.
    """
    payload = words.select("word", "letter_set", "probability", "source")
    found = matching_words(puzzles.select(*PUZZLE_KEY), payload, distinct=True, slices=slices)
    dealt = found.repartition(*PUZZLE_KEY)
    return dealt.sortWithinPartitions(*PUZZLE_KEY, F.col("probability").desc(), "word")
