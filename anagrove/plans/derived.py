"""Word, puzzle and state tables derived from the given tables.

The given tables hold texts, vectors, orders and events. These plans turn them
into the inputs of the word-puzzle operators; every row of the source counts.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anagrove.operators.enrich import corpus_frequency, join_word_data
from anagrove.operators.features import probabilities, score_with_column
from anagrove.operators.matching import (
    PUZZLE_KEY,
    eligible_words,
    matching_words,
    raw_words,
    word_decisions,
)
from anagrove.operators.ranking import global_rank
from anagrove.operators.states import (
    decisions_as_updates,
    enrich_new_words,
    init_states,
    merge_states,
)
from anagrove.session import materialise

FIRST_PUZZLE_DATE = "2018-01-01"
FIRST_BATCH = "words_1"
PUZZLE_BATCH = "puzzles_1"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token of the documents with its count."""
    return corpus_frequency(table(spark, sf_dir, "documents"))


def puzzles(listed: DataFrame) -> DataFrame:
    """One puzzle per distinct seven-letter set, one per day in letter order.

    A set that upper case gives a letter twice is left out.
    """
    distinct_letters = F.size(F.array_distinct(F.split("letter_set", "")))
    sets = listed.filter((F.length("letter_set") == 7) & (distinct_letters == 7)).select("letter_set").distinct()
    numbered = global_rank(sets, [F.col("letter_set")])
    number = (F.col("rank") - 1).cast("int")
    center = F.substring("letter_set", F.pmod(number, F.lit(7)) + 1, F.lit(1))
    return numbered.select(
        F.date_add(F.to_date(F.lit(FIRST_PUZZLE_DATE)), number).alias("puzzle_date"),
        center.alias("center_letter"),
        F.replace("letter_set", center, F.lit("")).alias("outer_letters"),
    )


def official_answers(listed: DataFrame, puzzle_rows: DataFrame) -> DataFrame:
    """Matches at least as frequent as the day of the month, plus one made-up word.

    The bar changes from puzzle to puzzle, so a word's latest decision matters. The
    made-up word, the centre and the first four outer letters twice, fits several
    puzzles: those that don't make it up themselves reject it.
    """
    found = matching_words(puzzle_rows, listed.select("word", "letter_set", "n"), distinct=True)
    common = found.filter(F.col("n") >= F.dayofmonth("puzzle_date")).select(*PUZZLE_KEY, "word")
    five = F.concat("center_letter", F.substring("outer_letters", 1, 4))
    letters = F.array_join(F.array_sort(F.split(F.lower(five), "")), "")
    made_up = puzzle_rows.select(*PUZZLE_KEY, F.repeat(letters, F.lit(2)).alias("word"))
    return common.unionByName(made_up)


def puzzle_documents(answers: DataFrame) -> DataFrame:
    """Answers as puzzle documents, one for each puzzle."""
    grouped = answers.groupBy(*PUZZLE_KEY).agg(F.sort_array(F.collect_list("word")).alias("answers"))
    return grouped.select(
        F.date_format("puzzle_date", "yyyy-MM-dd").alias("printDate"),
        F.lower("center_letter").alias("centerLetter"),
        F.split(F.lower("outer_letters"), "").alias("outerLetters"),
        "answers",
    )


def _digest() -> Column:
    return F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("bigint")


def frequencies(words: DataFrame, counted: DataFrame) -> DataFrame:
    """Counts of the listed words; of new words, every second one has its length."""
    listed = counted.select("word", F.col("n").cast("double").alias("frequency"))
    known = words.filter((F.col("version") == 2) & (_digest() % 2 == 0))
    return listed.unionByName(known.select("word", F.length("word").cast("double").alias("frequency")))


def embeddings(vectors: DataFrame, words: DataFrame) -> DataFrame:
    """A vector per word, picked by a digest; about one word in twenty gets none."""
    slots = vectors.agg(F.floor(F.count(F.lit(1)) * 1.05)).scalar()
    placed = words.select("word", F.pmod(_digest(), slots).alias("vec_id"))
    return placed.join(vectors, "vec_id").select("word", "embedding")


def arithmetic_score() -> Column:
    """A stand-in model: rarer words score higher, in exact sixty-fourths."""
    return F.round(64 / (1 + F.coalesce("frequency", F.lit(0.0)))) / 64


class Warehouse:
    """The tables of the word-puzzle warehouse, derived from one data folder.

    Tables that later stages read more than once are written out on first use,
    as the stages of a warehouse are; a query then scans the texts once.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def given(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    @cached_property
    def vocabulary(self) -> DataFrame:
        """Every token and its count.

        Written out before the eligibility filter: Catalyst would otherwise push
        that filter below the count and test every token instead of every word.
        """
        return materialise(vocabulary(self.spark, self.sf_dir))

    @cached_property
    def words(self) -> DataFrame:
        """Eligible vocabulary with count ``n`` and letter set."""
        return materialise(eligible_words(self.vocabulary))

    @cached_property
    def puzzles(self) -> DataFrame:
        return materialise(puzzles(self.words))

    @cached_property
    def answers(self) -> DataFrame:
        return materialise(official_answers(self.words, self.puzzles))

    @cached_property
    def decisions(self) -> DataFrame:
        return materialise(word_decisions(self.puzzles, self.answers, self.raw_words))

    @property
    def frequencies(self) -> DataFrame:
        return frequencies(self.raw_words, self.words)

    @property
    def embeddings(self) -> DataFrame:
        return embeddings(self.given("embeddings").select("vec_id", "embedding"), self.raw_words)

    @cached_property
    def raw_words(self) -> DataFrame:
        return materialise(raw_words(self.words, self.answers))

    @cached_property
    def joined_words(self) -> DataFrame:
        """All raw words, old and new, with frequency and embedding where known."""
        return materialise(join_word_data(self.raw_words, self.embeddings, self.frequencies))

    @property
    def states_before(self) -> DataFrame:
        """States of the word list before any puzzle."""
        listed = self.joined_words.filter(F.col("version") == 1)
        return init_states(listed, FIRST_BATCH)

    @property
    def updates(self) -> DataFrame:
        """Latest decision per word, with the data of words the states lack."""
        latest = decisions_as_updates(self.decisions, PUZZLE_BATCH)
        return enrich_new_words(latest, self.words, self.joined_words)

    @cached_property
    def states(self) -> DataFrame:
        """States after merging the latest decision of every word."""
        return materialise(merge_states(self.states_before, self.updates, PUZZLE_BATCH))

    @cached_property
    def probabilities(self) -> DataFrame:
        """Truth rows and arithmetically scored rows of all states."""
        scored = score_with_column(self.states, arithmetic_score())
        return probabilities(self.states, scored, PUZZLE_BATCH, 1)
