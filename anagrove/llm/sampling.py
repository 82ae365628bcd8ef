"""Bounded samples of labelled texts for fits on the driver.

The bound is on ids and on texts per id, whatever share of the rows one id, label
or text has: only ids whose hash lies in the share of all hashes that holds about
twice the wanted number are compared, and of an id's texts one is kept while the
rows are still on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anagrove.session import materialise

HASHES = 2.0**64


def first_by_hash(known: DataFrame, label: str, rows: int) -> DataFrame:
    """``id``, label and place of at most ``rows`` ids per label, those with the smallest hashes."""
    ids = materialise(known.select("id", label).distinct().withColumn("_h", F.xxhash64(F.col("id"))))
    # Written, so that its size is known and a small one is broadcast before the ids move.
    size = materialise(ids.groupBy(label).agg(F.count(F.lit(1)).alias("_n")))
    low = F.col("_h") / HASHES + 0.5 <= (2 * rows + 64) / F.col("_n")
    overall = Window.partitionBy(label).orderBy("_h", "id")
    ranked = ids.join(size, label).filter(low).withColumn("place", F.row_number().over(overall))
    return ranked.filter(F.col("place") <= rows).select("id", label, "place")


def one_text_each(texts: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    """``chosen`` (a bounded number of rows) with one ``text`` per row of it: that with the smallest hash."""
    named = F.struct(F.xxhash64("text").alias("h"), F.col("text").alias("text"))
    joined = texts.join(F.broadcast(chosen), keys)
    return joined.groupBy(*chosen.columns).agg(F.min(named).alias("_t")).select(*chosen.columns, F.col("_t.text").alias("text"))
