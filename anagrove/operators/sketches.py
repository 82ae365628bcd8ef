"""Quantiles from mergeable sketches, without sorting or range-partitioning the rows.

A sketch is a KLL summary: a few thousand doubles whatever the number of rows. Tasks
build their own, and a tree merges them, so no task reads a sketch from every other.

``sketched_quantiles`` reads the column once and is off by at most ``rank_error(k)`` of
the rows, in 99 of 100 cases. ``exact_quantiles`` takes the sketch's values as cuts only:
it counts rows between them, which tells for sure where a wanted rank lies, and goes on
inside that cell. A cell shrinks by about the rank error each time, so 10^12 rows take
some four rounds of two passes; a sketch that misses costs a round, never a wrong value.

Null and NaN take no part. Values are compared as doubles. Without rows every quantile
is None. Ties, infinities and repeated fractions are allowed.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anagrove.session import shuffle_partitions

# Size parameter of the sketches; 8 to 65535.
K = 4096
# Sketches that one step of the tree merges at most, once lanes are formed.
FAN_IN = 16
# Cuts lie this many rank errors to either side of a wanted rank.
MARGIN = 3.0


def rank_error(k: int = K) -> float:
    """Rank error of one quantile as a share of the rows, at 99 % confidence.

    Fixed values: the published fit for this kind of sketch.
    """
    return 2.296 / k**0.9723


def sketches(values: DataFrame, column: str, by: str, k: int = K) -> DataFrame:
    """One sketch per value of ``by``, as ``by`` and ``sketch``, merged in a tree.

    Each task folds its rows into one sketch per ``by``. Lanes, by the number of the
    task, take the first merge; each later one divides the lanes by ``FAN_IN``.
    """
    lanes = shuffle_partitions(values.sparkSession)
    lane = F.pmod(F.spark_partition_id(), F.lit(lanes)).alias("_lane")
    size = F.lit(k)
    merged = (
        values.select(column, by, lane)
        .groupBy(by, "_lane")
        .agg(F.kll_sketch_agg_double(column, size).alias("sketch"))
    )
    while lanes > FAN_IN:
        lanes = math.ceil(lanes / FAN_IN)
        merged = merged.groupBy(by, F.pmod("_lane", F.lit(lanes)).alias("_lane")).agg(
            F.kll_merge_agg_double("sketch", size).alias("sketch")
        )
    return merged.groupBy(by).agg(F.kll_merge_agg_double("sketch", size).alias("sketch"))


def _usable(df: DataFrame, column: str) -> DataFrame:
    value = F.col(column).cast("double")
    return df.select(value.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))


def sketched_quantiles(df: DataFrame, column: str, fractions: list[float], k: int = K) -> list[float | None]:
    """Values whose ranks are near ``fractions`` of the rows; one pass over the column."""
    whole = sketches(_usable(df, column).withColumn("_cell", F.lit(0)), "_v", "_cell", k)
    found = whole.select(F.kll_sketch_get_quantile_double("sketch", _array(fractions)).alias("q")).first()
    return list(found.q) if found else [None] * len(fractions)


def _array(numbers: list[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in numbers])


@dataclass(frozen=True)
class Cell:
    """Rows strictly between two values; None is an open end. ``before`` rows lie at or below ``low``."""

    low: float | None
    high: float | None
    before: int
    rows: int


def _located(value: Column, cuts: list[float], name: Callable[[int, bool], int | None], first: int = 0) -> Column:
    """Name of the cell before cut i, ``name(i, False)``, or of the cut itself, ``name(i, True)``.

    A tree of comparisons: a row meets as many as the logarithm of the cuts.
    """
    if not cuts:
        return F.lit(name(first, False)).cast("int")
    middle = len(cuts) // 2
    at = F.lit(name(first + middle, True)).cast("int")
    below = _located(value, cuts[:middle], name, first)
    above = _located(value, cuts[middle + 1 :], name, first + middle + 1)
    return F.when(value < cuts[middle], below).when(value == cuts[middle], at).otherwise(above)


def values_at(
    df: DataFrame, column: str, ranks: list[int], k: int = K, size: int | None = None
) -> dict[int, float]:
    """The exact values at 0-based ``ranks`` of the sorted column; ranks beyond it are left out.

    The driver holds three cuts per rank and as many counts. ``size`` is the number
    of usable rows, if known.
    """
    values = _usable(df, column)
    whole = Cell(None, None, 0, values.count() if size is None else size)
    waiting = {rank: whole for rank in ranks if 0 <= rank < whole.rows}
    found: dict[int, float] = {}
    while waiting:
        cuts, inside, at = _counted(values, waiting, k)
        left = {}
        for rank, cell in waiting.items():
            place = _place(rank, cell, cuts, inside, at)
            if isinstance(place, Cell):
                left[rank] = place
            else:
                found[rank] = place
        waiting = left
    return found


def _counted(
    values: DataFrame, waiting: dict[int, Cell], k: int
) -> tuple[list[float], dict[int, int], dict[int, int]]:
    """New cuts in the waiting cells; rows between cut i - 1 and i, and rows at cut i."""
    cells = list(dict.fromkeys(waiting.values()))
    value = F.col("_v")
    ends = sorted({end for cell in cells for end in (cell.low, cell.high) if end is not None})
    # Cells lie between two neighbouring ends, so the upper end tells a cell.
    numbers = {len(ends) if cell.high is None else ends.index(cell.high): i for i, cell in enumerate(cells)}
    number = _located(value, ends, lambda i, at: None if at else numbers.get(i))
    open_rows = values.select("_v", number.alias("_cell")).filter(F.col("_cell").isNotNull())
    # The fractions must be constants, so every cell has its own expression.
    wanted = F.coalesce(
        *[
            F.when(F.col("_cell") == i, F.kll_sketch_get_quantile_double("sketch", _array(_shares(cell, waiting, k))))
            for i, cell in enumerate(cells)
        ]
    )
    pivots = sketches(open_rows, "_v", "_cell", k).select(wanted.alias("q")).collect()
    cuts = sorted({v + 0.0 for row in pivots for v in row.q} | set(ends))
    place = _located(value, cuts, lambda i, at: 2 * i + at)
    counts = open_rows.groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("n")).collect()
    inside = {row.place // 2: row.n for row in counts if row.place % 2 == 0}
    at = {row.place // 2: row.n for row in counts if row.place % 2 == 1}
    return cuts, inside, at


def _shares(cell: Cell, waiting: dict[int, Cell], k: int) -> list[float]:
    """Fractions of the cell's rows to cut at, for every rank that it holds."""
    shares = set()
    for rank, held in waiting.items():
        if held == cell:
            middle = (rank - cell.before + 0.5) / cell.rows
            shares.update(min(1.0, max(0.0, middle + side * MARGIN * rank_error(k))) for side in (-1, 0, 1))
    return sorted(shares)


def _place(
    rank: int, cell: Cell, cuts: list[float], inside: dict[int, int], at: dict[int, int]
) -> Cell | float:
    """The rank's value if it is one of the cuts, else the cell between two cuts that holds it."""
    first = 0 if cell.low is None else cuts.index(cell.low) + 1
    last = len(cuts) if cell.high is None else cuts.index(cell.high)
    before, low = cell.before, cell.low
    for i in range(first, last + 1):
        rows = inside.get(i, 0)
        if rank < before + rows:
            return Cell(low, cuts[i] if i < len(cuts) else None, before, rows)
        before += rows
        if i < last:
            if rank < before + at.get(i, 0):
                return cuts[i]
            before += at.get(i, 0)
            low = cuts[i]
    raise RuntimeError("the rows changed between two passes")


def exact_quantiles(df: DataFrame, column: str, fractions: list[float], k: int = K) -> list[float | None]:
    """Quantiles with linear interpolation, equal to those of the sorted column."""
    size = _usable(df, column).count()
    if not size:
        return [None] * len(fractions)
    positions = [q * (size - 1) for q in fractions]
    ends = sorted({end(p) for p in positions for end in (math.floor, math.ceil)})
    value = values_at(df, column, ends, k, size)

    def between(position: float) -> float:
        low, high = value[math.floor(position)], value[math.ceil(position)]
        return low if low == high else low + (high - low) * (position - math.floor(position))

    return [between(p) for p in positions]
