import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Observation
from pyspark.sql import functions as F

from anagrove.functions import band
from anagrove.operators import features, hybrid, metrics, thresholds
from anagrove.session import scratch_path


def labelled(spark, freqs, labels):
    return spark.createDataFrame([(float(f), float(y)) for f, y in zip(freqs, labels)], "log_frequency double, label double")


def brute_grid(freqs, labels):
    """Scores by masks, straight from the definition."""
    freqs, labels = np.asarray(freqs, float), np.asarray(labels, float)
    edges = np.quantile(freqs, np.linspace(0.05, 0.95, 20))
    found = {}
    for i, low in enumerate(edges[:10]):
        for j, high in enumerate(edges[10:]):
            below, above = freqs < low, freqs > high
            middle = ~below & ~above
            if low < high and below.mean() >= 0.1 and above.mean() >= 0.1 and middle.any():
                rate = labels[middle].mean()
                found[i, j] = labels[below].mean() + (1 - labels[above]).mean() + abs(0.5 - rate)
    return found


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 10_000))
def test_grid_equals_masks(spark, seed):
    rng = np.random.default_rng(seed)
    freqs = np.round(rng.exponential(2.0, 300), 1)
    labels = (rng.random(300) < 0.4).astype(float)
    grid = thresholds.threshold_grid(labelled(spark, freqs, labels)).collect()
    expected = brute_grid(freqs, labels)
    assert {(r.low_i, r.high_i) for r in grid} == set(expected)
    np.testing.assert_allclose([r.score for r in grid], [expected[r.low_i, r.high_i] for r in grid], atol=1e-12)


def test_ties_take_the_first_pair(spark):
    schema = "low_i int, high_i int, low double, high double, score double"
    grid = spark.createDataFrame([(3, 1, 3.0, 9.0, 0.5), (2, 7, 2.0, 8.0, 0.5), (2, 8, 2.0, 8.5, 0.5)], schema)
    assert tuple(thresholds.best_thresholds(grid).first()) == (2.0, 8.0, 0.5)


def test_no_admissible_pair_falls_back(spark):
    grid = thresholds.threshold_grid(labelled(spark, [1.0] * 50, [1.0] * 50))
    assert tuple(thresholds.best_thresholds(grid).first()) == (1.68, 4.72, None)


def test_band_edges(spark):
    df = labelled(spark, [1.0, 1.5, 2.0, 3.0, 3.5], [0] * 5)
    routed = df.select(band(F.col("log_frequency"), F.lit(1.5), F.lit(3.0)).alias("b"))
    assert [r.b for r in routed.collect()] == ["low", "low", "mid", "high", "high"]
    crossed = df.select(band(F.col("log_frequency"), F.lit(3.0), F.lit(1.5)).alias("b"))
    assert [r.b for r in crossed.collect()] == ["low", "high", "high", "high", "high"]
    with pytest.raises(Exception, match="belongs to no band"):
        labelled(spark, [float("nan")], [0]).select(band(F.col("log_frequency"), F.lit(1.0), F.lit(2.0))).collect()


def test_features_stay_in_the_jvm(spark):
    df = spark.createDataFrame([("w", 9.0, [1.0, 2.0], 1.0)], "word string, frequency double, embedding array<float>, label double")
    found = features.features_v1(features.with_log_frequency(df))
    assert found.first().features == [1.0, 1.0, 2.0]
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_split_is_exact_and_reproducible(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 300, 1.0).otherwise(0.0).alias("label"))
    split = features.stratified_split(df, "id")
    sizes = {(r.label, r.is_test): r["count"] for r in split.groupBy("label", "is_test").count().collect()}
    assert sizes[1.0, True] == 99 and sizes[0.0, True] == 231 and sum(sizes.values()) == 1000
    again = features.stratified_split(df.repartition(7), "id")
    assert sorted(split.collect()) == sorted(again.collect())
    other = features.stratified_split(df, "id", seed=1)
    assert sorted(split.collect()) != sorted(other.collect())


def test_balanced_weights(spark):
    df = spark.createDataFrame([(1.0,)] * 3 + [(0.0,)], "label double")
    assert {r.label: r.weight for r in features.class_weights(df).collect()} == {1.0: 4 / 6, 0.0: 4 / 2}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 5), st.booleans()), min_size=2, max_size=60))
def test_auc_equals_pair_counting(spark, rows):
    df = spark.createDataFrame([(float(s), float(y)) for s, y in rows], "score double, label double")
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    auc = metrics.roc_auc(df).first().auc
    if not pos or not neg:
        assert auc is None
    else:
        wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert auc == pytest.approx(wins / (len(pos) * len(neg)))


def test_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 1), (1, 1)], "label int, prediction int")
    row = metrics.binary_metrics(df).first()
    assert row.accuracy == pytest.approx(3 / 5) and row.f1 == pytest.approx(4 / 6)
    none = metrics.binary_metrics(df.filter("label = 0 AND prediction = 0")).first()
    assert (none.accuracy, none.f1) == (1.0, 0.0)


def vectors(spark, n=300, width=12, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)) * np.linspace(3, 1, width) + 0.5
    y = (x[:, 0] + rng.normal(size=n) > 0.5).astype(float)
    freq = np.floor(10 ** rng.uniform(0, 4, n))
    rows = [(f"w{i:03d}", float(freq[i]), [float(v) for v in x[i]], float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "word string, frequency double, embedding array<double>, label float")
    return df, x, y, freq


def test_svd_equals_numpy(spark):
    df, x, _, _ = vectors(spark)
    factors, sizes = hybrid.fit_svd(df, 5)
    _, expected, right = np.linalg.svd(x, full_matrices=False)
    np.testing.assert_allclose(sizes, expected[:5], rtol=1e-9)
    np.testing.assert_allclose(np.abs(factors.T @ right[:5].T), np.eye(5), atol=1e-7)
    assert all(factors[np.abs(factors[:, j]).argmax(), j] > 0 for j in range(5))
    product = hybrid.project(spark, factors)(F.col("embedding"))
    found = np.array([r[0] for r in df.orderBy("word").select(product).collect()])
    np.testing.assert_allclose(found, x @ factors, atol=1e-9)


def test_naive_bayes_statistics(spark):
    df, x, y, _ = vectors(spark)
    rows = df.select("embedding", "label")
    stats = features.class_statistics(rows, features="embedding").collect()
    for r in stats:
        part = x[y == r.label][:, r.feature]
        assert r.mean == pytest.approx(part.mean()) and r.variance == pytest.approx(part.var())
        assert r.n == len(part)
    model = NaiveBayes(modelType="gaussian").fit(rows.withColumn("features", array_to_vector("embedding")))
    np.testing.assert_allclose(model.sigma.toArray()[1], x[y == 1].var(axis=0), rtol=1e-6)


def test_logistic_band_minimises_the_balanced_objective(spark):
    """The gradient of 0.5 |w|^2 + C * sum(weight * loss) vanishes at the fit."""
    df, x, y, _ = vectors(spark)
    rows = df.withColumn("features", array_to_vector("embedding")).withColumn("label", F.col("label").cast("double"))
    spec = hybrid.default_bands(c=0.1)["mid"]
    classes = {0.0: int((y == 0).sum()), 1.0: int((y == 1).sum())}
    spec.estimator = LogisticRegression(maxIter=1000, standardization=False, tol=1e-12)
    model = hybrid._fit_band(spec, rows, classes)
    w, b = model.coefficients.toArray(), model.intercept
    weight = np.where(y == 1, len(y) / (2 * classes[1.0]), len(y) / (2 * classes[0.0]))
    residual = weight * (1 / (1 + np.exp(-(x @ w + b))) - y)
    np.testing.assert_allclose(w + 0.1 * (x.T @ residual), 0, atol=1e-3)
    assert abs(residual.sum()) < 1e-3


def test_hybrid_routes_fits_and_reloads(spark):
    df, _, _, freq = vectors(spark)
    rows = hybrid.training_rows(df)
    model = hybrid.train(rows, (1.0, 3.0), 4, hybrid.default_bands(max_iter=50, trees=5, depth=4))
    scored = model.transform(df).orderBy("word").collect()
    assert len(scored) == 300 and all(0.0 <= r.probability <= 1.0 for r in scored)
    assert all((r.probability > 0.5) == (r.prediction == 1.0) for r in scored if r.probability != 0.5)
    # Each band's rows get exactly what the band's own model says.
    low = model.classifier.models["low"]
    ready = hybrid.reduced_features(features.with_log_frequency(df), model.factors)
    own = {r.word: r.prediction for r in low.transform(ready).collect()}
    assert all(own[r.word] == r.prediction for r in scored if np.log10(r.frequency + 1) <= 1.0)
    path = scratch_path(spark, "model")
    model.save(spark, path)
    again = hybrid.WordModel.load(spark, path).transform(df).orderBy("word").collect()
    assert [r.probability for r in scored] == [r.probability for r in again]
    accuracy = model.classifier.accuracy(hybrid.reduced_features(rows, model.factors))
    assert accuracy == pytest.approx(np.mean([r.prediction == r.label for r in scored]))


def test_scores_in_a_session_that_has_observed(spark):
    """A summary kept in a model refers to the session, which an observation makes impossible to send."""
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    df, *_ = vectors(spark)
    rows = df.select("label", F.log10("frequency").alias("log_frequency"), array_to_vector("embedding").alias("features"))
    bands = hybrid.default_bands(max_iter=20, trees=3, depth=3)
    for name in ("mid", "high"):
        edges = {"mid": (-1.0, 1e9), "high": (-2.0, -1.0)}[name]
        model = hybrid.FrequencyBandClassifier(*edges, {name: bands[name]}).fit(rows)
        assert not model.models[name].hasSummary
        assert model.transform(rows).filter("probability BETWEEN 0 AND 1").count() == 300


class Watcher:
    """Stands in for an estimator and notes how its rows are dealt out."""

    def copy(self, extra=None):
        return self

    def fit(self, rows):
        self.sizes = rows.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
        return self


def test_tasks_that_hold_a_model_follow_the_cores(spark, monkeypatch):
    """Not the pieces that the rows come in, which may be many and uneven."""
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 4000, 1, 50).filter("id < 1000").select((F.col("id") % 2).alias("label"), F.lit(1.0).alias("log_frequency"))
    seen = hybrid._fit_band(hybrid.BandSpec(Watcher()), rows, {0.0: 500, 1.0: 500}).sizes
    assert len(seen) == cores and sum(seen) == 1000 and max(seen) < 2 * 1000 / cores
    scored = hybrid.FrequencyBandModel(0.0, 2.0, {"mid": 1.0}, "log_frequency").transform(rows)
    assert scored.rdd.getNumPartitions() == cores and scored.filter("probability = 1").count() == 1000
    monkeypatch.setattr(hybrid, "ROWS_PER_TASK", 1000 // (3 * cores))
    assert hybrid._tasks(rows, 1000) >= 3 * cores


def test_rows_without_data_stay_unscored(spark):
    df, *_ = vectors(spark)
    model = hybrid.train(hybrid.training_rows(df), (1.0, 3.0), 4, hybrid.default_bands(max_iter=20, trees=3, depth=3))
    gaps = spark.createDataFrame(
        [("a", None, None, None), ("b", 5.0, None, None)],
        "word string, frequency double, embedding array<double>, label float",
    )
    scored = hybrid.score_unlabeled(gaps, model).collect()
    assert len(scored) == 2 and all(r.probability is None for r in scored)


def test_single_class_and_untrained_bands(spark):
    df, *_ = vectors(spark)
    rows = hybrid.training_rows(df).filter("log_frequency <= 3")
    rows = rows.withColumn("label", F.when(F.col("log_frequency") <= 1, 1.0).otherwise(F.col("label")))
    model = hybrid.train(rows, (1.0, 3.0001), 4, hybrid.default_bands(max_iter=20, trees=3, depth=3))
    assert model.classifier.models["low"] == 1.0 and "high" not in model.classifier.models
    low = model.transform(rows.filter("log_frequency <= 1")).collect()
    assert {r.probability for r in low} == {1.0}
    with pytest.raises(Exception, match="was not trained"):
        model.transform(df).collect()


def test_callers_own_scorer(spark):
    df, x, _, freq = vectors(spark)
    scorer = hybrid.python_scorer(spark, 2.0, lambda scale, logs, embs: (logs + embs[:, 0]) * scale)
    found = df.orderBy("word").select(scorer("frequency", "embedding")).collect()
    np.testing.assert_allclose([r[0] for r in found], 2 * (np.log10(freq + 1) + x[:, 0]), rtol=1e-5)
