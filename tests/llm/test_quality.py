"""The network against a place-by-place version, numeric gradients and held-out labels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from anagrove.llm import quality, sampling
from anagrove.llm.queries import op11_quality

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, quality int"
SF = "/root/testdata/sf0.01"


def plain_score(model, data):
    """One text, one chunk and one place after the other."""
    hidden, start = [], 0
    while True:
        chunk = data[start : start + quality.CHUNK]
        held = chunk.ljust(quality.WIDTH, b"\0")
        places = range(len(held) - quality.WIDTH + 1)
        pooled = np.max([sum(model.embedding[held[t + j]] @ model.kernel[j] for j in range(quality.WIDTH)) for t in places], axis=0)
        hidden.append(model.hidden(model.active(pooled[None, :], np.array([len(chunk)])))[0])
        if start + quality.CHUNK >= len(data):
            return float(model.probability(np.mean(hidden, axis=0)))
        start += quality.CHUNK - quality.OVERLAP


def scored(model, texts):
    offsets = np.cumsum([0, *map(len, texts)])
    return quality.Scorer(model).score(np.frombuffer(b"".join(texts), dtype=np.uint8), offsets)


def test_scores_equal_a_plain_network(monkeypatch):
    monkeypatch.setattr(quality, "BYTES_AT_ONCE", 400)
    rng = np.random.default_rng(0)
    sizes = [0, 1, 5, 6, 7, 31, 32, 33, 160, 191, 192, 193, 351, 352, 353, 1500, 0]
    texts = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in sizes]
    model = quality.initial(3)
    assert np.abs(scored(model, texts) - [plain_score(model, t) for t in texts]).max() < 1e-5
    assert np.abs(scored(model, [b""]) - plain_score(model, b"")).max() < 1e-5


def test_every_byte_is_in_a_chunk():
    for n in [1, 191, 192, 193, 352, 353, 5000]:
        _, start, end = quality.chunk_bounds(np.array([n]))
        assert start[0] == 0 and end[-1] == n and (start[1:] + quality.OVERLAP == end[:-1]).all()


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    model = quality.initial(1)
    chunks = rng.integers(0, 256, (5, 30), dtype=np.uint8)
    sizes, owner, y = np.array([30, 30, 9, 30, 30]), np.array([0, 0, 1, 2, 2]), np.array([1.0, 0.0, 1.0])

    def loss():
        places = chunks.shape[1] - quality.WIDTH + 1
        tables = model.byte_tables()
        pooled = sum(tables[j][chunks[:, j : j + places]] for j in range(quality.WIDTH)).max(axis=1)
        hidden = model.hidden(model.active(pooled, sizes))
        p = model.probability(np.stack([hidden[owner == k].mean(axis=0) for k in range(3)]))
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    values = [model.embedding, model.kernel, model.bias, model.inner, model.inner_bias, model.outer, model.outer_bias]
    for value, gradient in zip(values, quality._gradients(model, chunks, sizes, owner, y), strict=True):
        for at in [np.unravel_index(np.abs(gradient).argmax(), gradient.shape), (0,) * value.ndim]:
            kept, step = value[at], 1e-6
            value[at] = kept + step
            up = loss()
            value[at] = kept - step
            down = loss()
            value[at] = kept
            assert abs((up - down) / (2 * step) - gradient[at]) < 1e-4 * max(1e-2, abs(gradient[at]))


def test_held_out_labels_are_found(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = op11_quality(spark, SF).join(labels, "doc_id").filter("held_out").collect()
    good = np.array([r.score for r in rows if r.quality])
    bad = np.array([r.score for r in rows if not r.quality])
    assert len(good) > 30 and len(bad) > 3
    assert (good[:, None] > bad[None, :]).mean() > 0.95
    assert np.mean([r.predicted for r in rows if r.quality]) > 0.95


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, f"plain words number {i} stand here", "en", "s", 1, 0.0, 9) for i in range(40)]
    rows += [(100 + i, "### @@@ %%% " * 9, "en", "s", 1, 0.0, 9) for i in range(40)]
    rows += [(None, "no id", None, None, None, None, None), (1, None, "en", "s", 0, 0.0, 1), (2, "", "en", "s", 0, 0.0, 1)]
    rows += [(3, "plain words " * 20_000, "en", "s", 0, 0.0, 1), (3, "é" * 700, "en", "s", 0, 0.0, 1)]
    return spark.createDataFrame(rows, DOCS)


def test_edges(spark, odd, monkeypatch):
    monkeypatch.setattr(quality, "STEPS", 60)
    given = [(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(40)] + [(None, 1), (5, None), (7, 1), (9999, 0)]
    labels = spark.createDataFrame(given, "doc_id long, quality int")
    model = quality.fit(odd, labels)
    rows = quality.score(odd.repartition(5), model).collect()
    assert len(rows) == 85 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert min(r.score for r in rows if r.doc_id in range(10, 40)) > max(r.score for r in rows if r.doc_id and r.doc_id >= 100)
    assert quality.score(odd.limit(0), model).count() == 0
    for classes, expected in ((labels.filter("quality = 1"), 1.0), (labels.filter("quality = 0"), 0.0), (labels.limit(0), 0.5)):
        assert {r.score for r in quality.score(odd, quality.fit(odd, classes)).collect()} == {expected}


def test_a_hot_id_stays_bounded(spark):
    hot = spark.range(1_000).select(F.lit(7).alias("id"), F.concat(F.lit("text "), "id").alias("text"))
    rest = spark.range(300).select((F.col("id") + 100).cast("int").alias("id"), F.lit("one").alias("text"))
    texts = hot.union(rest)
    known = texts.select("id", F.when(F.col("id") == 7, 1).otherwise(0).alias("y"))
    chosen = sampling.first_by_hash(known, "y", 50).drop("place")
    assert sorted((r.y, r["count"]) for r in chosen.groupBy("y").count().collect()) == [(0, 50), (1, 1)]
    assert sampling.one_text_each(texts, chosen, ["id"]).count() == 51
