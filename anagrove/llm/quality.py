"""Quality of whole texts by a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into chunks of ``CHUNK`` that overlap by ``OVERLAP``,
so every place of it is in a chunk. Learned filters over ``WIDTH`` bytes run along
each chunk and are max-pooled there; a small hidden layer reads the pooled values and
how full the chunk is, its outputs are averaged over the chunks, and a logistic unit gives one probability.
As a filter sums a learned value per byte and place, it is a table: scoring looks
pairs of bytes up, and places that two chunks share are computed once.

The network is fitted on at most ``TRAINING_ROWS`` labelled ids per class, those
with the smallest hashes, with at most ``TRAINING_CHUNKS`` chunks drawn from all over
each text. Classes weigh the same in the fit; the offset is then set back to the
classes' shares among all labels, so that scores are probabilities.

Defined cases: null and empty texts are one chunk of padding; labels that are null
or whose id is null or unknown are ignored, of several for an id the smallest holds;
with labels of one class every text scores 0 or 1, without any 0.5; of rows that
share an id one is trained on; repeated rows are judged alike; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anagrove.llm.sampling import first_by_hash, one_text_each

CHUNK, OVERLAP = 192, 32
WIDTH, EMBEDDED, FILTERS, HIDDEN = 6, 8, 24, 12
TRAINING_ROWS, TRAINING_CHUNKS = 1_000, 12
STEPS, TEXTS_PER_CLASS, CHUNKS_PER_STEP = 1_000, 16, 4
RATE, DECAY = 4e-3, 1e-4
BYTES_AT_ONCE = 1 << 17
FOLDS, HELD_OUT = 5, 0
GOOD_FROM = 0.3


def is_held_out(number: Column) -> Column:
    return F.coalesce(F.crc32(number.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def chunk_bounds(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and end of all chunks of texts of these lengths; an empty text has an empty one."""
    stride = CHUNK - OVERLAP
    count = np.maximum(1, -(-(lengths - OVERLAP) // stride))
    text = np.repeat(np.arange(len(lengths)), count)
    start = (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)) * stride
    return text, start, np.minimum(start + CHUNK, lengths[text])


@dataclass
class QualityModel:
    """Parameters of the network; ``constant`` is the score where nothing was learned."""

    embedding: np.ndarray  # 256 x EMBEDDED
    kernel: np.ndarray  # WIDTH x EMBEDDED x FILTERS
    bias: np.ndarray
    inner: np.ndarray  # FILTERS + 1 x HIDDEN
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: np.ndarray
    constant: float | None = None

    def byte_tables(self) -> np.ndarray:
        """WIDTH x 256 x FILTERS: what each byte adds at each place of a filter."""
        return np.einsum("be,wef->wbf", self.embedding, self.kernel)

    def pair_tables(self) -> list[np.ndarray]:
        t = self.byte_tables().astype(np.float32)
        return [(t[j][:, None, :] + t[j + 1][None, :, :]).reshape(65536, -1) for j in range(0, WIDTH, 2)]

    def active(self, pooled: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Input of the hidden layer: pooled values above their bias, and the chunk's share of ``CHUNK``."""
        return np.column_stack([np.maximum(pooled + self.bias, 0), sizes / CHUNK])

    def hidden(self, active: np.ndarray) -> np.ndarray:
        return np.tanh(active @ self.inner + self.inner_bias)

    def probability(self, mean_hidden: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(mean_hidden @ self.outer + self.outer_bias[0], -40, 40)))


class Scorer:
    """Scores texts given as one buffer of bytes and their offsets in it."""

    def __init__(self, model: QualityModel):
        self.model, self.tables = model, model.pair_tables()

    def responses(self, data: np.ndarray) -> np.ndarray:
        """Filters at each place of ``data`` that has ``WIDTH`` bytes from there on."""
        places = len(data) - WIDTH + 1
        pairs = data[:-1].astype(np.int64) << 8 | data[1:]
        total = self.tables[0].take(pairs[:places], axis=0)
        for j in range(1, WIDTH // 2):
            total += self.tables[j].take(pairs[2 * j : 2 * j + places], axis=0)
        return total

    def pooled(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Largest response of each filter per chunk; ``end`` is at least ``WIDTH`` after ``start``."""
        out = np.empty((len(start), FILTERS), dtype=np.float32)
        at = 0
        while at < len(start):
            upto = max(at + 1, int(np.searchsorted(end, start[at] + BYTES_AT_ONCE, "right")))
            base = start[at]
            response = self.responses(data[base : end[upto - 1]])
            edges = np.stack([start[at:upto] - base, end[at:upto] - base - WIDTH + 1], axis=1).ravel()
            out[at:upto] = np.maximum.reduceat(response, edges[:-1], axis=0)[::2]
            at = upto
        return out

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability per text."""
        if self.model.constant is not None:
            return np.full(len(offsets) - 1, self.model.constant)
        text, start, end = chunk_bounds(np.diff(offsets))
        start, end = start + offsets[text], end + offsets[text]
        pooled = np.empty((len(text), FILTERS), dtype=np.float32)
        full = end - start >= WIDTH
        if full.any():
            pooled[full] = self.pooled(data, start[full], end[full])
        for i in np.flatnonzero(~full):
            padded = np.zeros(WIDTH, dtype=np.uint8)
            padded[: end[i] - start[i]] = data[start[i] : end[i]]
            pooled[i] = self.responses(padded)[0]
        hidden = self.model.hidden(self.model.active(pooled.astype(np.float64), end - start))
        first = np.flatnonzero(np.diff(text, prepend=-1))
        mean = np.add.reduceat(hidden, first, axis=0) / np.diff(np.append(first, len(text)))[:, None]
        return np.round(self.model.probability(mean), 9)


def _gradients(model: QualityModel, chunks: np.ndarray, sizes: np.ndarray, owner: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean log loss; row k of ``chunks`` is of text ``owner[k]`` and holds ``sizes[k]`` bytes of it."""
    tables = model.byte_tables().astype(np.float32)
    places = chunks.shape[1] - WIDTH + 1
    response = tables[0][chunks[:, :places]]
    for j in range(1, WIDTH):
        response += tables[j][chunks[:, j : j + places]]
    best = response.argmax(axis=1)
    pooled = np.take_along_axis(response, best[:, None, :], axis=1)[:, 0, :].astype(np.float64)
    active = model.active(pooled, sizes)
    hidden = model.hidden(active)
    share = 1 / np.bincount(owner)
    mean = np.zeros((len(y), HIDDEN))
    np.add.at(mean, owner, hidden * share[owner][:, None])
    error = (model.probability(mean) - y) / len(y)
    to_hidden = (error[:, None] * model.outer)[owner] * share[owner][:, None] * (1 - hidden**2)
    to_filter = (to_hidden @ model.inner[:FILTERS].T) * (active[:, :FILTERS] > 0)
    by_byte = np.zeros_like(tables, dtype=np.float64)
    rows = np.arange(len(chunks))[:, None]
    filters = np.broadcast_to(np.arange(FILTERS), best.shape)
    for j in range(WIDTH):
        np.add.at(by_byte[j], (chunks[rows, best + j], filters), to_filter)
    return [
        np.einsum("wbf,wef->be", by_byte, model.kernel),
        np.einsum("be,wbf->wef", model.embedding, by_byte),
        to_filter.sum(axis=0),
        active.T @ to_hidden,
        to_hidden.sum(axis=0),
        mean.T @ error,
        np.array([error.sum()]),
    ]


def initial(seed: int = 0) -> QualityModel:
    draw = np.random.default_rng(seed).normal
    return QualityModel(
        draw(size=(256, EMBEDDED)) * 0.5,
        draw(size=(WIDTH, EMBEDDED, FILTERS)) / math.sqrt(WIDTH * EMBEDDED),
        np.zeros(FILTERS),
        draw(size=(FILTERS + 1, HIDDEN)) / math.sqrt(FILTERS),
        np.zeros(HIDDEN),
        draw(size=HIDDEN) / math.sqrt(HIDDEN),
        np.zeros(1),
    )


def train(texts: list[list[bytes]], y: np.ndarray, seed: int = 0) -> QualityModel:
    """Fit on texts given as chunks; every step draws as many texts of either class, and a few chunks of each."""
    model = initial(seed)
    rng = np.random.default_rng(seed)
    values = [model.embedding, model.kernel, model.bias, model.inner, model.inner_bias, model.outer, model.outer_bias]
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    classes = [np.flatnonzero(y == c) for c in (0, 1)]
    for step in range(1, STEPS + 1):
        own = np.concatenate([rng.choice(c, TEXTS_PER_CLASS, replace=len(c) < TEXTS_PER_CLASS) for c in classes])
        drawn = [(k, c) for k, i in enumerate(own) for c in rng.permutation(len(texts[i]))[:CHUNKS_PER_STEP]]
        chunks = np.stack([_padded(texts[own[k]][c]) for k, c in drawn])
        sizes = np.array([len(texts[own[k]][c]) for k, c in drawn])
        found = _gradients(model, chunks, sizes, np.array([k for k, _ in drawn]), y[own])
        rate = RATE * 0.5 * (1 + math.cos(math.pi * step / STEPS))
        for value, (m, s), g in zip(values, moments, found, strict=True):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            value -= rate * (m / (1 - 0.9**step) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8) + DECAY * value)
    return model


def _padded(chunk: bytes) -> np.ndarray:
    """A chunk of full length: a short one is repeated to it, which adds no more than seams."""
    data = chunk.ljust(WIDTH, b"\0")
    return np.frombuffer((data * (CHUNK // len(data) + 1))[:CHUNK], dtype=np.uint8)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = TRAINING_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> QualityModel:
    """Fit on a bounded sample of the labelled rows outside the held-out fold."""
    known = labels.select(F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("y")).dropna()
    known = known.filter(~is_held_out(F.col("id"))).groupBy("id").agg(F.min("y").alias("y"))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    labelled = known.join(texts.select("id").distinct(), "id", "left_semi")
    size = {r.y: r.n for r in labelled.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(size) < 2:
        model = initial()
        model.constant = float(next(iter(size), 0.5))
        return model
    sample = one_text_each(texts, first_by_hash(labelled, "y", rows).drop("place"), ["id"]).select("id", "y", F.col("text").cast("binary"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for number, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                _, start, end = chunk_bounds(np.array([len(text)]))
                drawn = np.random.default_rng(number % 2**32).permutation(len(start))[:TRAINING_CHUNKS]
                out.append([text[start[i] : end[i]] for i in sorted(drawn)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.binary()))], names=["id", "y", "chunks"])

    schema = T.StructType([sample.schema["id"], *T.StructType.fromDDL("y int, chunks array<binary>").fields])
    taken = sample.mapInArrow(cut, schema).toArrow().sort_by("id")
    y = np.array(taken.column("y").to_pylist(), dtype=np.float64)
    chunks = taken.column("chunks").to_pylist()
    del taken
    model = train(chunks, y)
    model.outer_bias[0] += math.log(size[1] / size[0])
    return model


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``score`` (probability of good quality) and ``predicted``."""
    narrow = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).cast("binary").alias("text"))
    schema = T.StructType([narrow.schema["id"], *T.StructType.fromDDL("score double, predicted int").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            if not batch.num_rows:
                continue
            text = batch.column(1)
            wide = "<i8" if pa.types.is_large_binary(text.type) else "<i4"
            offsets = np.frombuffer(text.buffers()[1], dtype=wide)[text.offset : text.offset + len(text) + 1].astype(np.int64)
            held = text.buffers()[2]
            data = np.frombuffer(held, dtype=np.uint8) if held else np.zeros(0, dtype=np.uint8)
            found = scorer.score(data, offsets)
            columns = [batch.column(0), pa.array(found), pa.array((found >= GOOD_FROM).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_col)
