"""The log of changes against merges that rewrite everything."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from anagrove.operators import states
from anagrove.operators.state_log import StateLog
from anagrove.sinks.versioned import Conflict

SCHEMA = "word string, letter_set string, last_seen_on date, frequency double, embedding array<float>, label float, batch_id string"


def day(n):
    return None if n is None else dt.date(2024, 1, 1) + dt.timedelta(days=n)


def row(word, n, label, batch):
    return (word, "".join(sorted(set(word))), day(n), float(len(word)), [float(len(word)), 1.0], label, batch)


def content(df):
    return sorted([tuple(r) for r in df.select(*states.STATE_COLUMNS).collect()], key=repr)


def batches(seed):
    """Random updates: new, late, repeated and shrunken batches, words that go and come back."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    start = [row(w, draw.choice([None, 0, 5, 20]), draw.choice([None, 1.0]), draw.choice(["first", "b1", None])) for w in words[:25]]
    made = []
    for k in range(7):
        batch = draw.choice(["b1", "b2", "b3"])
        chosen = draw.sample(words, draw.randint(0, 25))
        made.append((batch, [row(w, draw.choice([None, 1, 4, 9, 21, 30 + k]), draw.choice([0.0, 1.0]), batch) for w in chosen]))
    return start, made


@pytest.mark.parametrize("seed", range(3))
def test_equal_to_rewriting_merges(spark, tmp_path, seed):
    start, made = batches(seed)
    target = spark.createDataFrame(start, SCHEMA)
    log = StateLog.create(spark, str(tmp_path / "log"), target, buckets=3)
    for k, (batch, rows) in enumerate(made):
        source = spark.createDataFrame(rows, SCHEMA)
        target = spark.createDataFrame(states.merge_states(target, source, batch).collect(), SCHEMA)
        log.merge(source, batch)
        assert content(log.read()) == content(target)
        if k == 3:
            assert log.compact(0.0)
            assert content(log.read()) == content(target)
    narrow = log.read(fixed=[])
    assert sorted(narrow.columns) == ["batch_id", "label", "last_seen_on", "word"]
    assert {r.word for r in narrow.collect()} == {r.word for r in target.collect()}


def test_bytes_follow_the_updates(spark, tmp_path):
    wide = spark.range(4_000).select(
        F.concat(F.lit("word"), "id").alias("word"),
        F.lit("dorw").alias("letter_set"),
        F.lit(day(0)).alias("last_seen_on"),
        F.rand(1).alias("frequency"),
        F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.hash("id", i).cast("float")).alias("embedding"),
        F.lit(None).cast("float").alias("label"),
        F.lit("first").alias("batch_id"),
    )
    log = StateLog.create(spark, str(tmp_path / "log"), wide, buckets=4)
    before = sum(map(log.table.manifest().bytes_of, log.table.manifest().entries))
    late = wide.filter("frequency < 0.02").withColumns({"last_seen_on": F.lit(day(3)), "batch_id": F.lit("b"), "embedding": F.lit(None).cast("array<float>")})
    log.merge(late, "b")
    manifest = log.table.manifest()
    added = sum(map(manifest.bytes_of, manifest.entries)) - before
    assert 0 < added < before / 20
    assert log.compact(0.9) == []
    # A bucket with a large log is rewritten alone.
    hot = wide.filter(F.pmod(F.xxhash64("word"), F.lit(4)) == 2).withColumns({"last_seen_on": F.lit(day(4)), "batch_id": F.lit("c")})
    log.merge(hot, "c")
    expected = content(log.read())
    other = {p: f for p, f in log.table.manifest().entries.items() if log.table.values_of(p)["bucket"] != 2}
    assert log.compact(0.9) == [2]
    after = log.table.manifest().entries
    assert all(after[p] == f for p, f in other.items()) and '{"bucket":2,"kind":"log"}' not in after
    assert content(log.read()) == expected


def test_replays_and_conflicts(spark, tmp_path, monkeypatch):
    log = StateLog.create(spark, str(tmp_path / "log"), spark.createDataFrame([row("a", 0, None, "first")], SCHEMA))
    updates = spark.createDataFrame([row("a", 2, 1.0, "x"), row("b", 2, 0.0, "x")], SCHEMA)
    log.merge(updates, "x")
    once = content(log.read())
    log.merge(updates, "x")
    assert content(log.read()) == once
    log.merge(updates.filter("word = 'a'"), "x")
    assert [r[0] for r in content(log.read())] == ["a"]
    with pytest.raises(Exception, match="several source rows"):
        log.merge(updates.union(updates), "y")
    stale = log.table.manifest()
    log.merge(updates, "z")
    monkeypatch.setattr(log.table, "manifest", lambda version=None, real=log.table.manifest: real(version) if version else real(stale.version))
    with pytest.raises(Conflict):
        log.merge(updates, "late")
