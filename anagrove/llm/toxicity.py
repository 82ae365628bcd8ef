"""Toxicity by cumulative-link ordinal regression on sparse text features.

Features are lower-case words and their first four to six characters. One weight
per feature is shared by all thresholds: P(grade <= k) = sigmoid(threshold_k -
score). A text's expected severity is the sum over k of P(grade > k).

The model is fitted on at most ``TRAINING_ROWS`` labelled ids, those with the
smallest hashes; the executors count features, and the driver gets the features
that stand out among toxic rows by ``MIN_Z`` standard errors and the sample's counts
of them. Labels tell only toxic rows from others, so grades of severity are set from
the texts: toxic rows are ranked by how many of their words hold such features and
cut into ``TOXIC_GRADES`` even grades; other rows are 0.

One row in ``CUT_FOLDS`` of the sample takes no part in the fit. The probability from
which a text is toxic is the least that keeps false alarms among those rows within
``FALSE_ALARMS``.

Defined cases: null and empty texts have no features, and the severity of such;
labels that are null or whose id is null or unknown are ignored, of several for an
id the largest holds; of texts that share an id one is trained on; without toxic and
other labelled rows nothing is toxic; repeated rows are judged alike; other columns
are ignored by ``score``; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anagrove.llm.sampling import one_text_each
from anagrove.session import materialise

TRAINING_ROWS = 6_000
MAX_FEATURES = 4_096
MIN_Z, MIN_ROWS, MIN_SHARE = 3.5, 2, 0.9
PREFIXES = (4, 5, 6)
TOXIC_GRADES = 3
L2, STEPS, RATE = 1e-3, 400, 0.2
CUT_FOLDS, FALSE_ALARMS = 4, 0.001
MAX_CACHED = 300_000
SCORES = "grade int, expected_severity double, toxic_probability double, toxic boolean"

_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features_of(word: str) -> list[str]:
    """The word, and its beginnings, marked as such."""
    return [word, *(word[:k] + "*" for k in PREFIXES if len(word) > k)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class OrdinalModel:
    """Feature weights and ascending thresholds; one grade more than thresholds.

    A text whose P(grade > 0) is at least ``toxic_from`` is toxic.
    """

    weights: dict[str, float]
    thresholds: np.ndarray
    toxic_from: float = 0.5

    def word_weights(self, word: str) -> tuple[tuple[str, float], ...]:
        held = self.weights
        return tuple((f, held[f]) for f in features_of(word) if f in held)

    def exceedances(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) per row and threshold."""
        return _sigmoid(scores[:, None] - self.thresholds[None, :])


def fit_ordinal(
    row: np.ndarray, column: np.ndarray, value: np.ndarray, y: np.ndarray, n_features: int, grades: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that maximise the penalised likelihood.

    Entries of the sparse matrix are given by row, column and value. Gradient steps with momentum and per-parameter scale. Thresholds are kept in
    order as a first one plus positive gaps.
    """
    share = np.cumsum(np.bincount(y, minlength=grades))[:-1] / len(y)
    start = np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3)))
    gaps = np.log(np.maximum(np.diff(start), 0.05))
    p = np.concatenate([np.zeros(n_features), start[:1], gaps])
    m, s = np.zeros_like(p), np.zeros_like(p)
    at = np.arange(len(y))
    for step in range(1, STEPS + 1):
        w, first, gaps = p[:n_features], p[n_features], p[n_features + 1 :]
        theta = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        score = np.bincount(row, value * w[column], len(y))
        below = _sigmoid(theta[None, :] - score[:, None])
        cdf = np.concatenate([np.zeros((len(y), 1)), below, np.ones((len(y), 1))], axis=1)
        slope = np.concatenate([np.zeros((len(y), 1)), below * (1 - below), np.zeros((len(y), 1))], axis=1)
        mass = np.maximum(cdf[at, y + 1] - cdf[at, y], 1e-12) * len(y)
        by_score = (slope[at, y + 1] - slope[at, y]) / mass
        by_theta = np.zeros(len(theta) + 2)
        np.add.at(by_theta, y + 1, -slope[at, y + 1] / mass)
        np.add.at(by_theta, y, slope[at, y] / mass)
        by_theta = by_theta[1:-1]
        tail = np.cumsum(by_theta[::-1])[::-1]
        gradient = np.concatenate(
            [np.bincount(column, value * by_score[row], n_features) + L2 * w, tail[:1], tail[1:] * np.exp(gaps)]
        )
        m, s = 0.9 * m + 0.1 * gradient, 0.99 * s + 0.01 * gradient**2
        p = p - RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    theta = p[n_features] + np.concatenate([[0.0], np.cumsum(np.exp(p[n_features + 1 :]))])
    return p[:n_features], theta


def select_features(sample: DataFrame) -> list[str]:
    """Features that stand out among the toxic rows of ``sample`` (``toxic``, ``text``), most telling first."""
    sizes = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    base = sizes.toxic / sizes.n

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            there, among = Counter(), Counter()
            for toxic, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = {f for w in set(words_of(text)) for f in features_of(w)}
                there.update(own)
                if toxic:
                    among.update(own)
            columns = [pa.array(list(there), pa.string()), pa.array(list(there.values()), pa.int64()), pa.array([among[f] for f in there], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["feature", "n", "toxic"])

    counted = sample.select("toxic", "text").mapInArrow(count, "feature string, n long, toxic long")
    total = counted.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    z = (F.col("toxic") - F.col("n") * base) / F.sqrt(F.col("n") * (base * (1 - base)) + 1)
    telling = total.filter((F.col("n") >= MIN_ROWS) & (F.col("toxic") >= F.col("n") * MIN_SHARE)).withColumn("z", z)
    best = telling.filter(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "feature").limit(MAX_FEATURES)
    return [r.feature for r in best.select("feature").collect()]


def _counts(sample: DataFrame, number: dict[str, int]) -> pa.Table:
    """``toxic``, ``cut``, and per row its numbered features, how often it has each, and its words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, times, words = [], [], []
            for text in batch.column(2):
                own = words_of(text.as_py())
                found = Counter(number[f] for w in own for f in features_of(w) if f in number)
                features.append(list(found))
                times.append(list(found.values()))
                words.append(len(own))
            lists = [pa.array(features, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32())), pa.array(words, pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=["toxic", "cut", "features", "times", "words"])

    schema = "toxic int, cut boolean, features array<int>, times array<int>, words int"
    return sample.select("toxic", "cut", "text").mapInArrow(count, schema).toArrow()


def choose_cut(probability: np.ndarray, toxic: np.ndarray, false_alarms: float = FALSE_ALARMS) -> float:
    """The least cut with at most that share of false alarms, rounded up, halfway to the next probability above."""
    if not len(probability) or toxic.all():
        return 0.5
    clean = np.sort(probability[~toxic])[::-1]
    over = clean[min(math.ceil(false_alarms * len(clean)), len(clean) - 1)]
    above = probability[probability > over]
    return float((over + (above.min() if len(above) else 1.0)) / 2)


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> OrdinalModel:
    """Fit on a bounded sample of the labelled rows of ``docs``."""
    known = labels.select(F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("toxic")).dropna()
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    chosen = known.groupBy("id").agg(F.max("toxic").alias("toxic")).join(texts.select("id").distinct(), "id", "left_semi")
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(rows)
    apart = (F.pmod(F.xxhash64("id", F.lit("cut")), F.lit(CUT_FOLDS)) == 0).alias("cut")
    sample = materialise(one_text_each(texts, chosen, ["id"]).select("toxic", apart, "text"))
    classes = {tuple(r) for r in sample.select("toxic", "cut").distinct().collect()}
    if not {(0, False), (1, False)} <= classes:
        return OrdinalModel({}, np.array([40.0]))
    names = select_features(sample.filter("not cut"))
    taken = _counts(sample, {f: i for i, f in enumerate(names)})
    toxic, cut = (taken.column(c).to_numpy().astype(bool) for c in ("toxic", "cut"))
    features, times = (taken.column(c).combine_chunks() for c in ("features", "times"))
    row = np.repeat(np.arange(len(toxic)), np.diff(features.offsets.to_numpy()))
    column, number = features.flatten().to_numpy(), times.flatten().to_numpy().astype(np.float64)
    dense = np.bincount(row, number, len(toxic)) / np.maximum(1, taken.column("words").to_numpy())
    grade = np.zeros(len(toxic), dtype=np.int64)
    place = np.argsort(np.argsort(dense[toxic], kind="stable"), kind="stable")
    grade[toxic] = 1 + place * TOXIC_GRADES // max(1, int(toxic.sum()))
    own = ~cut[row]
    renumbered = np.cumsum(~cut) - 1
    weights, thresholds = fit_ordinal(renumbered[row[own]], column[own], np.log1p(number[own]), grade[~cut], len(names), TOXIC_GRADES + 1)
    score = np.bincount(row, np.log1p(number) * weights[column], len(toxic))
    beyond = _sigmoid(score - thresholds[0])
    return OrdinalModel(dict(zip(names, weights.tolist(), strict=True)), thresholds, choose_cut(beyond[cut], toxic[cut]))


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``grade`` (the likeliest), ``expected_severity``, ``toxic_probability`` and ``toxic``."""
    narrow = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        for batch in batches:
            scores = []
            for text in batch.column(1):
                words = words_of(text.as_py())
                for word in set(words).difference(known):
                    known[word] = model.word_weights(word)
                found: dict[str, int] = {}
                weight = {}
                for hit in filter(None, map(known.__getitem__, words)):
                    for feature, own in hit:
                        found[feature] = found.get(feature, 0) + 1
                        weight[feature] = own
                scores.append(sum(np.log1p(n) * weight[f] for f, n in found.items()))
                if len(known) > MAX_CACHED:
                    known.clear()
            beyond = model.exceedances(np.array(scores, dtype=np.float64))
            mass = -np.diff(np.concatenate([np.ones((len(beyond), 1)), beyond, np.zeros((len(beyond), 1))], axis=1), axis=1)
            columns = [mass.argmax(axis=1).astype(np.int32), beyond.sum(axis=1), beyond[:, 0], beyond[:, 0] >= model.toxic_from]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns)], names=["id", "grade", "expected_severity", "toxic_probability", "toxic"]
            )

    schema = T.StructType([narrow.schema["id"], *T.StructType.fromDDL(SCORES).fields])
    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_col)
