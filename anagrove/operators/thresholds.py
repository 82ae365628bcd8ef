"""Search for the two frequency edges that part the three bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anagrove.operators.ranking import quantiles
from anagrove.operators.sketches import K, exact_quantiles
from anagrove.session import materialise

# Fixed values of the search.
CANDIDATES = 20
FIRST_FRACTION, LAST_FRACTION = 0.05, 0.95
MIN_BAND_SHARE = 0.1
FALLBACK_EDGES = (1.68, 4.72)


def candidate_fractions() -> list[float]:
    step = (LAST_FRACTION - FIRST_FRACTION) / (CANDIDATES - 1)
    return [FIRST_FRACTION + step * i for i in range(CANDIDATES)]


def value_counts(df: DataFrame, column: str, label: str) -> DataFrame:
    """Rows and labels per distinct value, written out for the steps that follow."""
    return materialise(
        df.groupBy(column).agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col(label) == 1).alias("positive"),
            F.count_if(F.col(label) == 0).alias("negative"),
        )
    )


def band_candidates(df: DataFrame, column: str = "log_frequency") -> DataFrame:
    """Twenty quantiles; the lower ten are low edges, the upper ten high edges."""
    counts = materialise(df.groupBy(column).agg(F.count(F.lit(1)).alias("n")))
    return _sides(quantiles(counts, column, candidate_fractions()))


def band_candidates_sketched(df: DataFrame, column: str = "log_frequency", k: int = K) -> DataFrame:
    """The same edges from sketches and counts: no sort, for columns of mostly distinct values."""
    found = exact_quantiles(df, column, candidate_fractions(), k)
    return _sides(df.sparkSession.createDataFrame([(found,)], "quantiles array<double>"))


def _sides(found: DataFrame) -> DataFrame:
    half = CANDIDATES // 2
    return found.select(F.posexplode("quantiles").alias("position", "edge")).select(
        F.when(F.col("position") < half, "low").otherwise("high").alias("side"),
        F.pmod("position", F.lit(half)).alias("i"),
        "edge",
    )


def threshold_grid(
    df: DataFrame, column: str = "log_frequency", label: str = "label"
) -> DataFrame:
    """Score of every admissible (low, high) pair of candidate edges.

    The data is read once, into counts per distinct value. These give the
    candidate edges, then the counts between neighbouring edges, at most 41
    groups. All pairs are scored from those, so the data is neither repeated per
    pair nor joined with the pairs.
    """
    values = value_counts(df, column, label)
    # One row of twenty numbers, each null when there are no rows.
    bounds = quantiles(values, column, candidate_fractions()).first().quantiles
    edges = [F.lit(e).cast("double") for e in bounds]
    value = F.col(column)
    below = sum(((e < value).cast("int") for e in edges), F.lit(0))
    not_above = sum(((e <= value).cast("int") for e in edges), F.lit(0))
    cells = (
        values.select(below.alias("below"), not_above.alias("not_above"), "n", "positive", "negative")
        .groupBy("below", "not_above")
        .agg(*[F.sum(c).alias(c) for c in ("n", "positive", "negative")])
        .agg(F.collect_list(F.struct("below", "not_above", "n", "positive", "negative")).alias("cells"))
        .withColumn("edges", F.array(*edges))
    )
    half = CANDIDATES // 2
    steps = F.sequence(F.lit(0), F.lit(half - 1))
    pairs = (
        cells.withColumn("low_i", F.explode(steps))
        .withColumn("high_i", F.explode(steps))
        .withColumn("low", F.get("edges", F.col("low_i")))
        .withColumn("high", F.get("edges", F.col("high_i") + half))
        .filter(F.col("low") < F.col("high"))
    )

    def total(field: str, inside) -> Column:
        chosen = F.filter(F.col("cells"), inside)
        return F.aggregate(chosen, F.lit(0).cast("bigint"), lambda s, c: s + c[field])

    def is_low(cell: Column) -> Column:
        return cell["not_above"] <= F.col("low_i")

    def is_high(cell: Column) -> Column:
        return cell["below"] > F.col("high_i") + half

    def is_mid(cell: Column) -> Column:
        return ~is_low(cell) & ~is_high(cell)

    counted = pairs.select(
        "low_i",
        "high_i",
        "low",
        "high",
        total("n", lambda c: F.lit(True)).alias("n"),
        total("n", is_low).alias("n_low"),
        total("n", is_high).alias("n_high"),
        total("n", is_mid).alias("n_mid"),
        total("positive", is_low).alias("pos_low"),
        total("negative", is_high).alias("neg_high"),
        total("positive", is_mid).alias("pos_mid"),
    )
    wide_enough = (F.col("n_low") / F.col("n") >= MIN_BAND_SHARE) & (
        F.col("n_high") / F.col("n") >= MIN_BAND_SHARE
    )
    mid_rate = F.try_divide(F.col("pos_mid"), F.col("n_mid"))
    score = (
        F.col("pos_low") / F.col("n_low")
        + F.col("neg_high") / F.col("n_high")
        + F.abs(F.lit(0.5) - mid_rate)
    )
    # An empty middle band has no rate, hence no score, and is never chosen.
    return (
        counted.filter(wide_enough)
        .select("low_i", "high_i", "low", "high", score.alias("score"))
        .filter(F.col("score").isNotNull())
    )


def best_thresholds(grid: DataFrame) -> DataFrame:
    """Lowest score, first pair on ties; the fixed edges when no pair is admissible."""
    best = grid.agg(F.min(F.struct("score", "low_i", "high_i", "low", "high")).alias("b"))
    return best.select(
        F.coalesce("b.low", F.lit(FALLBACK_EDGES[0])).alias("low"),
        F.coalesce("b.high", F.lit(FALLBACK_EDGES[1])).alias("high"),
        F.col("b.score").alias("score"),
    )
