import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from anagrove.operators.sketches import (
    exact_quantiles,
    rank_error,
    sketched_quantiles,
    values_at,
)
from anagrove.operators.thresholds import band_candidates, band_candidates_sketched

FRACTIONS = [0.0, 0.05, 0.25, 0.5, 0.5, 0.731, 0.95, 1.0]


def numbers(spark, values, parts=7):
    return spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)


def samples():
    rng = random.Random(3)
    yield "spread", [rng.lognormvariate(0, 3) for _ in range(3000)]
    yield "ties", [float(rng.choice([1, 1, 1, 1, 2, 7])) for _ in range(3000)]
    yield "one value holds a third", [5.0] * 1000 + [rng.gauss(5, 1e-9) for _ in range(2000)]
    yield "signed zeros", [-0.0, 0.0] * 300 + [-1.0, 1.0]
    yield "single", [3.5]
    yield "two", [1.0, 2.0]


@pytest.mark.parametrize("name,values", list(samples()), ids=lambda x: x if isinstance(x, str) else "")
def test_exact_whatever_the_size_of_the_sketch(spark, name, values):
    # With k = 8 the sketch errs by about a third of the rows, so cells are narrowed again and again.
    for k in (8, 200):
        got = exact_quantiles(numbers(spark, values), "v", FRACTIONS, k)
        assert got == pytest.approx(np.quantile(values, FRACTIONS).tolist(), rel=1e-12, abs=1e-300)


def test_ranks_outside_the_column_are_left_out(spark):
    assert values_at(numbers(spark, [3.0, 1.0, 2.0]), "v", [-1, 0, 2, 3]) == {0: 1.0, 2: 3.0}


def test_null_nan_infinities_and_no_rows(spark):
    rows = [None, float("nan"), float("inf"), float("-inf"), 1.0]
    frame = numbers(spark, rows)
    assert exact_quantiles(frame, "v", [0.0, 0.5, 1.0], 8) == [-math.inf, 1.0, math.inf]
    for empty in (frame.filter("false"), frame.filter("v is null or isnan(v)")):
        assert exact_quantiles(empty, "v", [0.5]) == [None]
        assert sketched_quantiles(empty, "v", [0.5]) == [None]


def test_sketch_stays_within_the_stated_rank_error(spark):
    frame = spark.range(0, 400_000, numPartitions=40).select(
        (F.pmod(F.col("id") * 7919, F.lit(400_000)) / 3).alias("v")
    )
    fractions = [i / 20 for i in range(1, 20)]
    for k in (64, 1024):
        found = sketched_quantiles(frame, "v", fractions, k)
        ranks = [v * 3 / 400_000 for v in found]
        assert max(abs(r - q) for r, q in zip(ranks, fractions)) <= 2 * rank_error(k)


def test_one_scan_and_no_range_shuffle(spark):
    from anagrove.operators.sketches import sketches

    frame = spark.range(1000).select(F.col("id").cast("double").alias("v"), F.lit(0).alias("g"))
    plan = sketches(frame, "v", "g")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    assert "Sort " not in plan
    assert plan.count("Range (") == 1


def test_candidates_equal_the_sorted_ones(spark):
    rng = random.Random(4)
    frame = numbers(spark, [round(rng.gauss(2, 1), 2) for _ in range(2000)]).withColumnRenamed("v", "log_frequency")
    plain = {(r.side, r.i): r.edge for r in band_candidates(frame).collect()}
    sketched = {(r.side, r.i): r.edge for r in band_candidates_sketched(frame, k=64).collect()}
    assert sketched == pytest.approx(plain, rel=1e-12)
