"""The randomised SVD against a dense one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from anagrove.operators import lowrank


def frame(spark, rows):
    given = [(i, None if r is None else [float(x) for x in r]) for i, r in enumerate(rows)]
    return spark.createDataFrame(given, "i long, embedding array<double>")


@pytest.mark.parametrize("k", [1, 5, 20])
def test_decaying_spectrum(spark, k):
    rng = np.random.default_rng(k)
    data = rng.normal(size=(600, 40)) * (0.8 ** np.arange(40)) @ np.linalg.qr(rng.normal(size=(40, 40)))[0]
    df = frame(spark, [*data, None]).repartition(20)
    factors, values = lowrank.randomised_svd(df, k)
    dense = np.linalg.svd(data)
    assert np.abs(values / dense[1][:k] - 1).max() < 1e-6
    assert np.abs(factors.T @ factors - np.eye(k)).max() < 1e-12
    cosines = np.abs((factors * dense[2][:k].T).sum(axis=0))
    assert cosines.min() > 1 - 1e-6
    lost = df.filter("embedding is not null").agg(F.sum(lowrank.lost_squares(F.col("embedding"), factors))).first()[0]
    assert lost == pytest.approx((dense[1][k:] ** 2).sum(), rel=1e-6)


def test_real_vectors_lose_nearly_the_least(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("embedding")
    data = np.array([r[0] for r in vectors.collect()], dtype=np.float64)
    dense = np.linalg.svd(data, compute_uv=False)
    for k in (8, 50):
        factors, values = lowrank.randomised_svd(vectors, k)
        best = (dense[k:] ** 2).sum()
        lost = ((data - data @ factors @ factors.T) ** 2).sum()
        assert best * (1 - 1e-9) <= lost <= best * 1.01
        assert lost + (values**2).sum() == pytest.approx((data**2).sum(), rel=1e-9)


def test_low_rank_few_rows_and_none(spark):
    line = [[1.0, 2.0, 2.0], [2.0, 4.0, 4.0]]
    factors, values = lowrank.randomised_svd(frame(spark, line), 2)
    assert values[0] == pytest.approx(np.sqrt(45)) and values[1] == pytest.approx(0, abs=1e-9)
    assert np.allclose(factors[:, 0], np.array([1, 2, 2]) / 3)
    assert lowrank.randomised_svd(frame(spark, []), 2)[1].size == 0
