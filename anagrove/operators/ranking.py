"""Global ranks and running totals without a one-partition window.

Rows are range-partitioned on a unique key, so even slices are cut wherever the
data lies, and sorted within the slice. Positions and sums within a slice are
taken while it is written, so the rows cross the network once; totals of the
slices (one row each) turn them into global ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anagrove.session import materialise, shuffle_partitions

# Bits that monotonically_increasing_id keeps for the place within a partition.
PLACE_BITS = 33


def _sliced(df: DataFrame, order: list[Column]) -> DataFrame:
    """Sorted slices; ``_at`` holds the slice's number and the place within it."""
    dealt = df.repartitionByRange(shuffle_partitions(df.sparkSession), *order)
    return dealt.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())


def _offsets(sliced: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Totals of all earlier slices; a row per slice, which bounds window and broadcast."""
    slice_of = F.shiftright("_at", PLACE_BITS).alias("_slice")
    per_slice = sliced.groupBy(slice_of).agg(*[F.sum(value).alias(name) for name, value in totals.items()])
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_off_{name}") for name in totals]
    return F.broadcast(per_slice.select("_slice", *sums))


def running_totals(df: DataFrame, order: list[Column], totals: dict[str, Column]) -> DataFrame:
    """Add, for each entry of ``totals``, the sum over all rows that sort before.

    ``order`` must identify a row; then the slices are balanced for any data.
    Null values count as 0.
    """
    valued = df.withColumns({f"_v_{name}": F.coalesce(value, F.lit(0)) for name, value in totals.items()})
    sliced = _sliced(valued, order)
    names, summed = sliced.columns, list(totals)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = {name: 0 for name in summed}
        for batch in batches:
            if not batch.num_rows:
                continue
            sums = []
            for name in summed:
                own = batch.column(names.index(f"_v_{name}"))
                upto = pc.cumulative_sum(own, start=pa.scalar(before[name], own.type))
                sums.append(pc.subtract(upto, own))
                before[name] = upto[-1].as_py()
            yield pa.RecordBatch.from_arrays([*batch.columns, *sums], names=[*names, *(f"_in_{n}" for n in summed)])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in sliced.schema]
    fields += [f"`_in_{name}` {sliced.schema[f'_v_{name}'].dataType.simpleString()}" for name in totals]
    within = materialise(sliced.mapInArrow(add, ", ".join(fields)))
    offsets = _offsets(within, {name: F.col(f"_v_{name}") for name in totals})
    joined = within.withColumn("_slice", F.shiftright("_at", PLACE_BITS)).join(offsets, "_slice")
    added = [(F.col(f"_in_{name}") + F.col(f"_off_{name}")).alias(name) for name in totals]
    return joined.select(*df.columns, *added)


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """1-based position of each row in the total order given by ``order``."""
    sliced = materialise(_sliced(df, order))
    offsets = _offsets(sliced, {"_rows": F.lit(1).cast("bigint")})
    joined = sliced.withColumn("_slice", F.shiftright("_at", PLACE_BITS)).join(offsets, "_slice")
    place = F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return joined.select(*df.columns, (place + F.col("_off__rows") + 1).alias(name))


def positions(df: DataFrame, key: str, order: list[Column], name: str = "position") -> DataFrame:
    """0-based position of each row among those of its key.

    The global rank less the rank of the key's first row, so a key that holds most
    of the rows is ranked by many tasks. Key and order must identify a row.
    """
    ranked = materialise(global_rank(df, [F.col(key), *order], "_rank"))
    first = ranked.groupBy(key).agg(F.min("_rank").alias("_first"))
    joined = ranked.withColumnRenamed(key, "_key").join(first, F.col("_key").eqNullSafe(F.col(key)))
    return joined.select(*df.columns, (F.col("_rank") - F.col("_first")).alias(name))


def assign_batches(words: DataFrame, batch_size: int) -> DataFrame:
    """Cut the sorted words into runs of ``batch_size``."""
    ranked = global_rank(words, [F.col("word")])
    return ranked.withColumn("batch_id", F.floor((F.col("rank") - 1) / batch_size).cast("int"))


def batch_log(assigned: DataFrame) -> DataFrame:
    """Extent of each batch: start, exclusive end, first and last word."""
    return assigned.groupBy("batch_id").agg(
        (F.min("rank") - 1).alias("start_idx"),
        F.max("rank").alias("end_idx"),
        F.min("word").alias("first_word"),
        F.max("word").alias("last_word"),
        F.count(F.lit(1)).alias("n_words"),
    )


def ordered_chunks(
    df: DataFrame, key: str, order: list[Column], value: Column, max_rows: int
) -> DataFrame:
    """Values of each key in order, as arrays of at most ``max_rows`` elements.

    Chunks are cut on the position within the key, from 0 on, whatever other keys
    there are. Reading a key's chunks by ``chunk`` restores its full series.
    """
    placed = positions(df, key, order, "_position")
    chunked = placed.withColumn("chunk", F.floor(F.col("_position") / max_rows))
    arrays = chunked.groupBy(key, "chunk").agg(
        F.sort_array(F.collect_list(F.struct("_position", value.alias("v")))).alias("_pairs")
    )
    return arrays.select(key, "chunk", F.col("_pairs.v").alias("series"))


def quantiles(counts: DataFrame, column: str, fractions: list[float]) -> DataFrame:
    """Exact quantiles with linear interpolation, as one row with one array.

    ``counts`` has each distinct value of ``column`` once, with its number of
    rows ``n``. The two order statistics each fraction needs are picked from the
    running counts, so no task holds the whole column.
    """
    size = counts.agg(F.sum("n")).first()[0] or 0
    positions = [q * max(size - 1, 0) for q in fractions]
    ranks = sorted({end(p) for p in positions for end in (math.floor, math.ceil)})
    steps = running_totals(
        counts.select(column, F.col("n").alias("_n")), [F.col(column)], {"_before": F.col("_n")}
    )

    def covers(rank: Column) -> Column:
        return (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_n"))

    # At most two rows per fraction survive. A value that occurs once covers just
    # its own rank, which a plain set lookup decides.
    inside = F.exists(F.array(*[F.lit(r) for r in ranks]), covers)
    needed = steps.filter(F.col("_before").isin(ranks) | ((F.col("_n") > 1) & inside))
    picked = needed.agg(
        F.collect_list(F.struct("_before", "_n", F.col(column).alias("_v"))).alias("_steps")
    )

    def value_at(position: Column) -> Column:
        hit = F.filter(
            F.col("_steps"),
            lambda s: (position >= s["_before"]) & (position < s["_before"] + s["_n"]),
        )
        return F.get(hit, F.lit(0))["_v"]

    return picked.select(
        F.transform(
            F.array(*[F.lit(float(p)) for p in positions]),
            lambda s: value_at(F.floor(s))
            + (value_at(F.ceil(s)) - value_at(F.floor(s))) * (s - F.floor(s)),
        ).alias("quantiles")
    )
