"""Joins and groupings that stay balanced when one key holds much of the data.

Plans don't depend on the size of the data. Skewed shuffle partitions of a join
are split by adaptive execution while it runs; a caller who knows of a hot key may
also ask for a fixed number of slices. Arrays are cut by one rule at any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anagrove.operators.ranking import positions

# Words per array row.
WORDS_PER_LINE = 200_000


def salted_join(left: DataFrame, right: DataFrame, key: str, members: list[str], slices: int = 1) -> DataFrame:
    """Inner equi-join on ``key``; ``slices`` deals the left rows of every key out.

    The slice is a hash of ``members``, which should identify a left row; each
    right row is then repeated once per slice.
    """
    if slices <= 1:
        return left.join(right, key)
    dealt = left.withColumn("_slice", F.pmod(F.xxhash64(*members), F.lit(slices)).cast("int"))
    copied = right.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return dealt.join(copied, [key, "_slice"]).drop("_slice")


def word_arrays(
    df: DataFrame, key: str, member: str, element: Column, alias: str, words_per_line: int = WORDS_PER_LINE
) -> DataFrame:
    """Group rows into arrays in order of ``member``, one row per key and ``part``.

    ``part`` is the position within the key divided by ``words_per_line``, so the
    parts of a key, read in order, are its words in order. Key and member must
    identify a row.
    """
    placed = positions(df, key, [F.col(member)], "_position")
    parted = placed.withColumn("part", F.floor(F.col("_position") / words_per_line).cast("int"))
    pairs = F.sort_array(F.collect_list(F.struct("_position", element.alias("_e"))))
    return parted.groupBy(key, "part").agg(pairs.alias("_pairs")).select(key, "part", F.col("_pairs._e").alias(alias))
