"""Language identification by hierarchical discrimination.

A linear support vector machine per family (one against the rest) picks the
language family; within it, one machine per pair of languages votes. Features are
frequencies of character n-grams of one to three characters within words, word
ends included, hashed to ``BUCKETS``. As these add up over words, a text's margins
are sums of its words' margins, which are cached.

The model is fitted on at most ``TRAINING_ROWS`` ids per language, those with the
smallest hashes, and ``MAX_TRAINING_ROWS`` in all. A language without a family in
``FAMILIES`` is one of its own.

Defined cases: a text that is null or has no letter is ``und`` with score 0; rows
without a language or an id don't train, of texts that share both one does; a row
without an id isn't held out; with one language learned, all texts with letters
are of it; with none, all are ``und``; repeated rows are judged alike; other
columns are never looked at; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anagrove.llm.sampling import first_by_hash, one_text_each

# Families of languages by code: fixed values.
FAMILIES = {
    "da": "germanic", "de": "germanic", "en": "germanic", "nl": "germanic", "no": "germanic", "sv": "germanic",
    "ca": "romance", "es": "romance", "fr": "romance", "it": "romance", "pt": "romance", "ro": "romance",
    "bg": "slavic", "cs": "slavic", "pl": "slavic", "ru": "slavic", "sk": "slavic", "uk": "slavic",
}
TRAINING_ROWS, MAX_TRAINING_ROWS = 400, 4_000
BUCKETS = 4_096
PENALTY, STEPS = 1e-4, 200
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
MAX_CACHED = 300_000

# Letters and numerals that aren't digits; the latter are rare and sorted out by the slower pattern.
_NEARLY_LETTERS = re.compile(r"[^\W\d_]+")
_LETTERS = regex.compile(r"\p{L}+")


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case."""
    lower = text.lower()
    words = _NEARLY_LETTERS.findall(lower)
    return words if "".join(words).isalpha() else _LETTERS.findall(lower)


def grams_of(word: str) -> list[str]:
    ends = f"<{word}>"
    return [*word, *(ends[i : i + n] for n in (2, 3) for i in range(len(ends) - n + 1))]


def bucket_of(gram: str) -> int:
    return zlib.crc32(gram.encode("utf-8", "surrogatepass")) % BUCKETS


def fit_svm(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Weights, last one the offset, of a linear machine with squared hinge loss.

    Accelerated gradient descent; both classes weigh the same.
    """
    y = np.where(positive, 1.0, -1.0)
    each = np.where(positive, 0.5 / positive.sum(), 0.5 / (~positive).sum())
    # The mean squared length of the rows bounds the curvature.
    rate = 1 / (2 * (each @ (np.einsum("ij,ij->i", x, x, dtype=np.float64) + 1)) + PENALTY)
    w = v = np.zeros(x.shape[1] + 1)
    for step in range(1, STEPS + 1):
        slack = np.maximum(0, 1 - y * (x @ v[:-1].astype(x.dtype) + v[-1]))
        pull = each * y * slack
        gradient = -2 * np.append(pull.astype(x.dtype) @ x, pull.sum()) + PENALTY * v
        last, w = w, v - rate * gradient
        v = w + (step - 1) / (step + 2) * (w - last)
    return w


@dataclass
class LanguageModel:
    """Margins are linear: ``weights`` has a column per machine, ``offsets`` its constant."""

    families: list[list[str]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray
    offsets: np.ndarray

    def decide(self, margins: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score per row of margins: family machines first, then pairs."""
        n = len(self.families)
        scale = 1 / (1 + np.exp(-4 * np.clip(margins, -10, 10)))
        family = margins[:, :n].argmax(axis=1)
        names, scores = [], scale[np.arange(len(margins)), family] if n > 1 else np.ones(len(margins))
        for i, f in enumerate(family):
            languages = self.families[f]
            votes = {x: 0.0 for x in languages}
            least = {x: 1.0 for x in languages}
            for k, (a, b) in enumerate(self.pairs):
                if a in votes:
                    p = scale[i, n + k]
                    votes[a if p >= 0.5 else b] += 1
                    votes[a] += p / len(self.pairs)
                    votes[b] += (1 - p) / len(self.pairs)
                    least[a], least[b] = min(least[a], p), min(least[b], 1 - p)
            best = max(languages, key=lambda x: (votes[x], x))
            names.append(best)
            scores[i] *= least[best]
        return names, scores


def is_held_out(number: Column) -> Column:
    return F.coalesce(F.crc32(number.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, rows: int = TRAINING_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Fit on a bounded sample of the rows outside the held-out fold."""
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    known = known.filter(F.col("lang").isNotNull() & ~is_held_out(F.col("id")))
    known = known.filter(F.col("id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    chosen = first_by_hash(known, "lang", rows).orderBy("place", F.xxhash64("id"), "lang").limit(MAX_TRAINING_ROWS)
    sample = one_text_each(known, chosen.select("id", "lang"), ["id", "lang"]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, shares = [], []
            for text in batch.column(1):
                found = np.bincount([bucket_of(g) for w in words_of(text.as_py()) for g in grams_of(w)], minlength=BUCKETS)
                held = np.flatnonzero(found)
                buckets.append(held.astype(np.int16))
                shares.append((found[held] / max(1, found.sum())).astype(np.float32))
            lists = [pa.array(buckets, pa.list_(pa.int16())), pa.array(shares, pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["lang", "b", "x"])

    taken = sample.mapInArrow(count, "lang string, b array<short>, x array<float>").toArrow()
    if not taken.num_rows:
        return LanguageModel([], [], np.zeros((BUCKETS, 0)), np.zeros(0))
    lang = np.array(taken.column("lang").to_pylist())
    buckets, shares = (taken.column(c).combine_chunks() for c in ("b", "x"))
    # Rows of single precision, BUCKETS wide: at most 66 MB.
    x = np.zeros((len(lang), BUCKETS), dtype=np.float32)
    x[np.repeat(np.arange(len(lang)), np.diff(buckets.offsets.to_numpy())), buckets.flatten().to_numpy()] = shares.flatten().to_numpy()
    del taken, buckets, shares
    # Linear in frequencies, so that margins add up over words; scaled to even out common n-grams.
    scale = 1 / np.sqrt(np.maximum(x.mean(axis=0, dtype=np.float64), 1e-6))
    x *= scale.astype(np.float32)
    size = np.sqrt(np.einsum("ij,ij->", x, x, dtype=np.float64) / len(x))
    x /= np.float32(size)
    scale = scale / size
    languages = sorted(set(lang.tolist()))
    groups: dict[str, list[str]] = {}
    for name in languages:
        groups.setdefault(FAMILIES.get(name, name), []).append(name)
    families = [groups[f] for f in sorted(groups)]
    machines = []
    for own in families:
        positive = np.isin(lang, own)
        machines.append(fit_svm(x, positive) if len(families) > 1 else np.zeros(BUCKETS + 1))
    pairs = [p for own in families for p in combinations(own, 2)]
    for a, b in pairs:
        both = np.isin(lang, [a, b])
        machines.append(fit_svm(x[both], lang[both] == a))
    stacked = np.stack(machines, axis=1)
    return LanguageModel(families, pairs, stacked[:-1] * scale[:, None], stacked[-1])


class _WordMargins:
    """Sums of n-gram weights per word, and how many n-grams it has, cached."""

    def __init__(self, weights: np.ndarray):
        self.weights = np.hstack([weights, np.ones((len(weights), 1))])
        self.buckets: dict[str, int] = {}
        self.number: dict[str, int] = {}
        self.sums = np.zeros((1024, self.weights.shape[1]))

    def _add(self, fresh: list[str]) -> None:
        held, buckets, counts = self.buckets, [], []
        for word in fresh:
            grams = grams_of(word)
            for g in grams:
                if g not in held:
                    held[g] = bucket_of(g)
            buckets.extend([held[g] for g in grams])
            counts.append(len(grams))
        starts = np.cumsum([0, *counts[:-1]])
        first = len(self.number)
        while len(self.sums) < first + len(fresh):
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
        for at in range(0, len(fresh), 4096):
            end = min(at + 4096, len(fresh))
            upto = starts[end] if end < len(fresh) else len(buckets)
            own = self.weights[buckets[starts[at] : upto]]
            self.sums[first + at : first + end] = np.add.reduceat(own, starts[at:end] - starts[at], axis=0)
        self.number.update(zip(fresh, range(first, first + len(fresh)), strict=True))
        if len(held) > MAX_CACHED:
            held.clear()

    def of(self, words: list[str]) -> np.ndarray:
        if len(self.number) > MAX_CACHED:
            self.number.clear()
        fresh = list(set(words).difference(self.number))
        if fresh:
            self._add(fresh)
        total = self.sums[np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))].sum(axis=0)
        return total[:-1] / total[-1]


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``lang_pred`` and ``score``, from the text alone."""
    narrow = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margins_of = _WordMargins(model.weights)
        for batch in batches:
            names, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            at, margins = [], []
            for i, text in enumerate(batch.column(1)):
                words = words_of(text.as_py())
                if words and model.families:
                    at.append(i)
                    margins.append(margins_of.of(words) + model.offsets)
            if at:
                found, certain = model.decide(np.array(margins).reshape(len(at), -1))
                scores[at] = certain
                for i, name in zip(at, found, strict=True):
                    names[i] = name
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names), pa.array(scores)], names=["id", "lang_pred", "score"])

    schema = T.StructType([narrow.schema["id"], *T.StructType.fromDDL("lang_pred string, score double").fields])
    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_col)
