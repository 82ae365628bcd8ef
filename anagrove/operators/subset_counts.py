"""How many words fit every part of a puzzle's letters, without listing them.

Words are first counted per letter set, so a set with a million words is one row from
then on. A puzzle's letters number its subsets by bits: bit i stands for its i-th letter
in order. The counts met by a puzzle fill an array of 2^7 places, and one doubling step
per letter turns it into subset sums: place m holds the words made of the letters of m
alone. Any question of the kind "with these, without those" is then a difference of
places, the answers of all seven centres included.

Repeated letters of a puzzle count once. A puzzle without letters, or with more than
seven different ones, has no table. Null letters: no table. Words as rows: repeated rows
count each time, null letter sets never.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anagrove.functions.letters import MAX_DISTINCT_LETTERS

PLACES = 1 << MAX_DISTINCT_LETTERS


def set_sizes(words: DataFrame) -> DataFrame:
    """Words per letter set; counted before any shuffle, so no set is hot."""
    return words.filter(F.col("letter_set").isNotNull()).groupBy("letter_set").agg(F.count(F.lit(1)).alias("n_words"))


def _letters(text: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.split(text, ""), lambda x: x != "")))


def _subsets(letters: Column) -> Column:
    """Every subset as its key and its number; the array's place is the number."""
    return F.transform(
        F.aggregate(letters, F.array(F.lit("")), lambda keys, x: F.concat(keys, F.transform(keys, lambda k: F.concat(k, x)))),
        lambda key, place: F.struct(key.alias("letter_set"), place.alias("place")),
    )


def _subset_sums(counts: Column) -> Column:
    """Place m of the result: the sum of all places whose bits lie within m."""

    def double(sums: Column, step: Column) -> Column:
        return F.transform(
            sums,
            lambda own, place: F.when(place.bitwiseAND(step) != 0, own + F.get(sums, place - step)).otherwise(own),
        )

    steps = F.array(*[F.lit(1 << bit) for bit in range(MAX_DISTINCT_LETTERS)])
    return F.aggregate(steps, counts, double)


def subset_tables(letter_sets: DataFrame, words: DataFrame, column: str = "letters") -> DataFrame:
    """``letters`` (sorted, distinct) and ``table``, for each distinct set of letters in ``column``.

    Each set is expanded into at most 127 keys, joined with one row per letter set of
    the words. Hits only are grouped, at most 127 for a set of letters.
    """
    asked = letter_sets.select(_letters(F.col(column)).alias("_letters")).filter(
        F.size("_letters").between(1, MAX_DISTINCT_LETTERS)
    )
    asked = asked.select(F.array_join("_letters", "").alias("letters"), "_letters").distinct()
    keys = asked.select("letters", F.inline(F.slice(_subsets(F.col("_letters")), 2, PLACES)))
    hits = keys.join(set_sizes(words), "letter_set")
    met = hits.groupBy("letters").agg(
        F.map_from_entries(F.collect_list(F.struct("place", "n_words"))).alias("_met")
    )
    filled = asked.select("letters").join(met, "letters", "left")
    start = F.transform(
        F.sequence(F.lit(0), F.lit(PLACES - 1)),
        lambda place: F.coalesce(F.try_element_at("_met", place), F.lit(0).cast("bigint")),
    )
    return filled.select("letters", _subset_sums(start).alias("table"))


def _bit(place: Column) -> Column:
    return F.pow(F.lit(2), place).cast("int")


def _place_of(letters: Column, wanted: Column) -> Column:
    """Number of the subset of ``letters`` whose letters occur in ``wanted``."""
    bits = F.transform(
        F.split(letters, ""),
        lambda x, i: F.when(F.contains(wanted, x), _bit(i)).otherwise(F.lit(0)),
    )
    return F.aggregate(bits, F.lit(0), lambda s, b: s + b)


def words_within(table: Column, letters: Column, allowed: Column) -> Column:
    """Words made only of those of ``letters`` that occur in the text ``allowed``."""
    return F.get(table, _place_of(letters, allowed))


def center_counts(tables: DataFrame) -> DataFrame:
    """Answers of each letter as the centre, and words that use all letters.

    Answers hold the centre: all words less those made of the other letters. Words of
    the centre alone aren't answers, as no key of a puzzle is the centre alone.
    """
    every = _bit(F.length("letters")) - 1
    whole = F.get("table", every)
    bit = _bit(F.col("place"))
    alone = F.get("table", bit)
    return tables.select(
        "letters", "table", F.posexplode(F.split("letters", "")).alias("place", "center_letter")
    ).select(
        "letters",
        "center_letter",
        (whole - F.get("table", every - bit) - alone).alias("n_words"),
        whole.alias("n_within"),
    )
