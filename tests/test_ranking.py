import random

import numpy as np
from pyspark.sql import functions as F

from anagrove.operators.ranking import (
    assign_batches,
    batch_log,
    global_rank,
    ordered_chunks,
    quantiles,
    running_totals,
)


def test_global_rank_is_the_sorted_position(spark):
    rng = random.Random(1)
    words = sorted({"".join(rng.choices("ab", k=rng.randint(1, 12))) for _ in range(500)})
    df = spark.createDataFrame([(w,) for w in rng.sample(words, len(words))], "word string")
    ranked = global_rank(df, [F.col("word")]).collect()
    assert {r.word: r.rank for r in ranked} == {w: i + 1 for i, w in enumerate(words)}


def test_running_totals(spark):
    df = spark.createDataFrame([(i, i * i) for i in range(200)], "k int, v bigint")
    rows = running_totals(df, [F.col("k")], {"before": F.col("v")}).collect()
    assert all(r.before == sum(j * j for j in range(r.k)) for r in rows)


def test_batches(spark):
    df = spark.createDataFrame([(f"w{i:03d}",) for i in range(25)], "word string")
    log = {r.batch_id: r for r in batch_log(assign_batches(df, 10)).collect()}
    assert [(log[b].start_idx, log[b].end_idx, log[b].n_words) for b in range(3)] == [
        (0, 10, 10),
        (10, 20, 10),
        (20, 25, 5),
    ]
    assert (log[2].first_word, log[2].last_word) == ("w020", "w024")


def test_chunks_restore_a_hot_series(spark):
    df = spark.range(500).select(
        F.when(F.col("id") % 5 == 0, "b").otherwise("a").alias("key"),
        (1000 - F.col("id")).alias("t"),
        F.col("id").alias("v"),
    )
    chunks = ordered_chunks(df, "key", [F.col("t")], F.col("v"), 40).collect()
    assert max(len(c.series) for c in chunks) <= 40
    for key in "ab":
        series = [v for c in sorted((c for c in chunks if c.key == key), key=lambda c: c.chunk) for v in c.series]
        assert series == sorted(series, reverse=True) and len(series) == (100 if key == "b" else 400)


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(3)
    values = np.round(rng.normal(size=777), 1)
    fractions = [0.0, 0.05, 0.31, 0.5, 0.95, 1.0]
    counts = spark.createDataFrame([(float(v),) for v in values], "x double").groupBy("x").agg(
        F.count(F.lit(1)).alias("n")
    )
    found = quantiles(counts, "x", fractions).first().quantiles
    np.testing.assert_allclose(found, np.quantile(values, fractions), atol=1e-12)


def test_a_series_doesnt_depend_on_other_keys(spark):
    df = spark.range(12).select((F.col("id") % 3).alias("key"), F.col("id").alias("t"))
    chunks = ordered_chunks(df, "key", [F.col("t")], F.col("t"), 5).collect()
    assert {(c.key, c.chunk, tuple(c.series)) for c in chunks} == {(k, 0, (k, k + 3, k + 6, k + 9)) for k in range(3)}


def test_a_rank_shuffles_the_rows_once(spark):
    ranked = global_rank(spark.range(1000).toDF("k"), [F.col("k")])
    ranked.collect()
    assert "Exchange rangepartitioning" not in ranked._jdf.queryExecution().executedPlan().toString()
