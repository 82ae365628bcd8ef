"""Column expressions on words and letters. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the puzzle rules.
MIN_WORD_LENGTH = 4
MAX_DISTINCT_LETTERS = 7
MAX_OUTER_LETTERS = 6


def letter_set(word: Column) -> Column:
    """Distinct letters in code-point order, upper-cased after sorting."""
    letters = F.array_sort(F.array_distinct(F.split(word, "")))
    return F.upper(F.array_join(letters, ""))


def eligible(word: Column, letters: Column) -> Column:
    """Whether a word can be a puzzle answer at all."""
    long_enough = F.length(word) >= MIN_WORD_LENGTH
    return long_enough & (F.length(letters) <= MAX_DISTINCT_LETTERS)


def subset_keys(center: Column, outer: Column) -> Column:
    """Letter-set keys a puzzle accepts: the centre plus 1 to 6 outer letters.

    The letters are sorted once; each outer letter then doubles the list of
    partial keys and the centre extends all of them. Repeated outer letters
    yield repeated keys, and the centre alone is never a key.
    """
    outer_letters = F.transform(F.split(outer, ""), lambda x: F.struct(x.alias("x"), F.lit(False).alias("c")))
    letters = F.array_sort(
        F.concat(F.array(F.struct(center.alias("x"), F.lit(True).alias("c"))), outer_letters)
    )

    def extend(keys: Column, letter: Column) -> Column:
        short = F.filter(keys, lambda k: F.length(k) < MAX_DISTINCT_LETTERS)
        longer = F.transform(short, lambda k: F.concat(k, letter["x"]))
        return F.when(letter["c"], F.transform(keys, lambda k: F.concat(k, letter["x"]))).otherwise(
            F.concat(keys, longer)
        )

    keys = F.aggregate(letters, F.array(F.lit("")), extend)
    return F.filter(keys, lambda k: F.length(k).between(2, MAX_OUTER_LETTERS + 1))


def tokens(text: Column) -> Column:
    """Lower-case letter runs of a text."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def unquote_line(line: Column) -> Column:
    """Strip white space, then at most one quote at either end."""
    stripped = F.regexp_replace(line, r"^\s+|\s+$", "")
    return F.regexp_replace(F.regexp_replace(stripped, "^['\"]", ""), "['\"]$", "")
