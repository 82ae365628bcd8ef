"""Uncentred SVD and the classifier with one model per frequency band."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anagrove.functions import band, log_frequency
from anagrove.operators.features import labeled, unlabeled, with_log_frequency
from anagrove.session import materialise

BANDS = ("low", "mid", "high")
# Training rows that a task keeps at hand, at about a kilobyte each.
ROWS_PER_TASK = 1_000_000
TWO_CLASSES = {"ml_attr": {"type": "nominal", "name": "label", "vals": ["0.0", "1.0"]}}


def fit_svd(df: DataFrame, k: int, column: str = "embedding") -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (d x k) and singular values of the embeddings.

    The rows stay distributed; only the d x d Gram matrix and the factors, whose
    size depends on the embedding width alone, reach the driver. Each vector's
    largest component is made positive, which fixes the free signs.
    """
    vectors = df.select(array_to_vector(F.col(column).cast("array<double>")).alias("v"))
    found = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v")).computeSVD(k)
    factors = found.V.toArray()
    largest = factors[np.abs(factors).argmax(axis=0), np.arange(factors.shape[1])]
    return factors * np.where(largest < 0, -1.0, 1.0), found.s.toArray()


def project(spark: SparkSession, factors: np.ndarray) -> Callable[[Column], Column]:
    """Arrow-batched product of an embedding column with the factors.

    One matrix product per batch; a missing embedding projects to zeros.
    """
    shared = spark.sparkContext.broadcast(factors)

    @F.pandas_udf("array<double>")
    def product(embeddings: pd.Series) -> pd.Series:
        width = shared.value.shape[0]
        rows = [np.zeros(width) if e is None else e for e in embeddings]
        return pd.Series(list(np.asarray(rows, dtype=np.float64).reshape(-1, width) @ shared.value))

    return product


def reduced_features(df: DataFrame, factors: np.ndarray, column: str = "embedding") -> DataFrame:
    """Add ``features``: log frequency, then the projected embedding."""
    projected = project(df.sparkSession, factors)(F.col(column))
    front = F.array(F.coalesce("log_frequency", F.lit(0.0)))
    return df.withColumn("features", array_to_vector(F.concat(front, projected)))


@dataclass
class BandSpec:
    """How one band is trained: any estimator with ``featuresCol``, ``labelCol``
    and ``probabilityCol``; ``balanced`` weighs both classes equally."""

    estimator: Estimator
    balanced: bool = False
    inverse_regularization: float | None = None


def default_bands(
    c: float = 0.10, max_iter: int = 1000, trees: int = 100, depth: int = 15, seed: int = 0
) -> dict[str, BandSpec]:
    """Naive Bayes below, balanced logistic regression between, forest above."""
    return {
        "low": BandSpec(NaiveBayes(modelType="gaussian")),
        "mid": BandSpec(
            LogisticRegression(maxIter=max_iter, standardization=False),
            balanced=True,
            inverse_regularization=c,
        ),
        "high": BandSpec(
            RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, maxMemoryInMB=1024), balanced=True
        ),
    }


class FrequencyBandClassifier(Estimator):
    """Trains one model per non-empty frequency band."""

    def __init__(
        self,
        low_mid: float,
        mid_high: float,
        bands: dict[str, BandSpec] | None = None,
        frequency_col: str = "log_frequency",
    ):
        super().__init__()
        self.low_mid, self.mid_high = float(low_mid), float(mid_high)
        self.bands = bands or default_bands()
        self.frequency_col = frequency_col

    def _fit(self, dataset: DataFrame) -> FrequencyBandModel:
        routed = _route(dataset, self.frequency_col, self.low_mid, self.mid_high)
        # At most six rows: the class sizes of three bands.
        sizes = routed.groupBy("_band", "label").agg(F.count(F.lit(1)).alias("n")).collect()
        models: dict[str, Any] = {}
        for name in BANDS:
            classes = {float(r["label"]): r["n"] for r in sizes if r["_band"] == name}
            if len(classes) == 1:
                models[name] = next(iter(classes))
            elif classes:
                rows = routed.filter(F.col("_band") == name)
                models[name] = _fit_band(self.bands[name], rows, classes)
        return FrequencyBandModel(self.low_mid, self.mid_high, models, self.frequency_col)


def _route(df: DataFrame, frequency_col: str, low_mid: float, mid_high: float) -> DataFrame:
    return df.withColumn("_band", band(F.col(frequency_col), F.lit(low_mid), F.lit(mid_high)))


def _tasks(df: DataFrame, rows: int = 0) -> int:
    """As many tasks as there are cores, more if each had above ``ROWS_PER_TASK``.

    Every task of a forest's fit holds, and passes on, counts for all nodes of a level, and
    every task that scores unpacks the whole forest. With the data's own tasks that work
    grows with tasks times nodes, both of which grow with the rows.
    """
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))


def _fit_band(spec: BandSpec, rows: DataFrame, classes: dict[float, int]) -> Model:
    total = sum(classes.values())
    # Dealt evenly: a task waits for the fullest one at every level of the trees.
    rows = rows.repartition(_tasks(rows, total))
    label = F.col("label").cast("double")
    estimator = spec.estimator.copy()
    rows = rows.withColumn("label", label.alias("label", metadata=TWO_CLASSES))
    if spec.balanced:
        weight = F.when(F.col("label") == 1.0, total / (2.0 * classes[1.0])).otherwise(
            total / (2.0 * classes[0.0])
        )
        rows = rows.withColumn("_weight", weight)
        estimator = estimator.copy({estimator.weightCol: "_weight"})
    if spec.inverse_regularization is not None:
        # Balanced weights sum to the row count, so both objectives agree.
        penalty = 1.0 / (spec.inverse_regularization * total)
        estimator = estimator.copy({estimator.regParam: penalty})
    return _without_summary(estimator.fit(rows))


def _without_summary(model: Model) -> Model:
    """The model without what it notes of its training, as if loaded.

    The summary refers to the session, which can't be sent to executors once an
    observation was made in it.
    """
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return model


class FrequencyBandModel(Model):
    """Routes each row to its band's model; one pass over the data.

    A band trained on a single class holds that class; a band without training
    rows stops the job when a row reaches it.
    """

    def __init__(
        self, low_mid: float, mid_high: float, models: dict[str, Any], frequency_col: str
    ):
        super().__init__()
        self.low_mid, self.mid_high = low_mid, mid_high
        self.models = models
        self.frequency_col = frequency_col

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = _route(dataset.coalesce(_tasks(dataset)), self.frequency_col, self.low_mid, self.mid_high)
        chance = F.when(F.lit(False), F.lit(None).cast("double"))
        guess = F.when(F.lit(False), F.lit(None).cast("double"))
        helpers = ["_band"]
        for name in BANDS:
            here = F.col("_band") == name
            model = self.models.get(name)
            if model is None:
                stop = F.raise_error(F.lit(f"band {name} was not trained")).cast("double")
                chance, guess = chance.when(here, stop), guess.when(here, stop)
            elif isinstance(model, float):
                chance, guess = chance.when(here, F.lit(model)), guess.when(here, F.lit(model))
            else:
                proba, pred, raw = f"_p_{name}", f"_y_{name}", f"_r_{name}"
                out = model.transform(
                    out,
                    {
                        model.probabilityCol: proba,
                        model.predictionCol: pred,
                        model.rawPredictionCol: raw,
                    },
                )
                helpers += [proba, pred, raw]
                chance = chance.when(here, F.get(vector_to_array(proba), F.lit(1)))
                guess = guess.when(here, F.col(pred))
        return (
            out.withColumn("probability", chance).withColumn("prediction", guess).drop(*helpers)
        )

    def accuracy(self, dataset: DataFrame) -> float:
        scored = self.transform(dataset)
        right = (F.col("prediction") == F.col("label")).cast("double")
        return scored.agg(F.avg(right)).first()[0]


@dataclass
class WordModel:
    """The SVD factors together with the classifier trained on top of them."""

    factors: np.ndarray
    classifier: FrequencyBandModel

    def transform(self, states: DataFrame) -> DataFrame:
        """States with ``probability`` and ``prediction``.

        Rows that lack a frequency or an embedding stay and show nulls.
        """
        complete = F.col("frequency").isNotNull() & F.col("embedding").isNotNull()
        ready = states.withColumn(
            "log_frequency", F.coalesce(log_frequency(F.col("frequency")), F.lit(0.0))
        )
        scored = self.classifier.transform(reduced_features(ready, self.factors))
        return scored.withColumn("probability", F.when(complete, F.col("probability"))).withColumn(
            "prediction", F.when(complete, F.col("prediction"))
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Band models through the ML writer, numbers as Parquet, below ``path``."""
        clf = self.classifier
        constants = {n: m for n, m in clf.models.items() if isinstance(m, float)}
        edges = [(clf.low_mid, clf.mid_high, clf.frequency_col, constants)]
        schema = "low_mid double, mid_high double, frequency_col string, constants map<string, double>"
        spark.createDataFrame(edges, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/edges")
        rows = [(i, [float(x) for x in row]) for i, row in enumerate(self.factors)]
        spark.createDataFrame(rows, "i int, row array<double>").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{path}/factors")
        names = [(n,) for n, m in clf.models.items() if not isinstance(m, float)]
        spark.createDataFrame(names, "band string").coalesce(1).write.mode("overwrite").parquet(f"{path}/bands")
        for (name,) in names:
            PipelineModel([clf.models[name]]).write().overwrite().save(f"{path}/band_{name}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> WordModel:
        # One row of edges, one row per embedding dimension, three band names.
        edges = spark.read.parquet(f"{path}/edges").first()
        rows = spark.read.parquet(f"{path}/factors").orderBy("i").collect()
        models: dict[str, Any] = {n: float(v) for n, v in edges.constants.items()}
        for row in spark.read.parquet(f"{path}/bands").collect():
            models[row.band] = PipelineModel.load(f"{path}/band_{row.band}").stages[0]
        classifier = FrequencyBandModel(edges.low_mid, edges.mid_high, models, edges.frequency_col)
        return WordModel(np.array([r.row for r in rows]), classifier)


def training_rows(states: DataFrame) -> DataFrame:
    """Decided words with all their features."""
    complete = F.col("frequency").isNotNull() & F.col("embedding").isNotNull()
    return with_log_frequency(labeled(states).filter(complete))


def train(
    rows: DataFrame,
    edges: tuple[float, float],
    components: int,
    bands: dict[str, BandSpec] | None = None,
) -> WordModel:
    """Fit the SVD and the classifier on training rows only."""
    factors, _ = fit_svd(rows, components)
    # Written once: every band and iteration would project the vectors again.
    reduced = materialise(reduced_features(rows, factors).select("log_frequency", "label", "features"))
    classifier = FrequencyBandClassifier(*edges, bands=bands).fit(reduced)
    return WordModel(factors, classifier)


def score_unlabeled(states: DataFrame, model: WordModel) -> DataFrame:
    """Undecided words with their chance of being accepted."""
    return model.transform(unlabeled(states)).withColumn(
        "probability", F.col("probability").cast("float")
    )


def python_scorer(spark: SparkSession, model: Any, predict: Callable) -> Callable[..., Column]:
    """Arrow-batched scorer for a caller's own model object.

    ``predict(model, log_frequencies, embeddings)`` gets two NumPy arrays per
    batch and returns one chance per row. The model is broadcast once; it must
    be of a size an executor can hold.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("float")
    def scorer(frequencies: pd.Series, embeddings: pd.Series) -> pd.Series:
        logs = np.log10(frequencies.to_numpy(dtype=np.float64) + 1.0)
        return pd.Series(predict(shared.value, logs, np.stack(embeddings)), dtype="float32")

    return scorer
