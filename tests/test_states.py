import datetime as dt

import pytest
from pyspark.sql import functions as F

from anagrove.operators.states import (
    decisions_as_updates,
    enrich_new_words,
    init_states,
    latest_decisions,
    merge_states,
)
from anagrove.sinks.tables import create_db, publish_snapshot
from anagrove.session import scratch_name, scratch_path

SCHEMA = (
    "word string, letter_set string, last_seen_on date, frequency double, "
    "embedding array<float>, label float, batch_id string"
)
D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))


def state(word, seen, label, batch):
    return (word, word.upper(), seen, 1.0, [0.5], label, batch)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_merge_truth_table(spark):
    target = frame(
        spark,
        [
            state("null_date", None, None, "old"),
            state("older", D1, 0.0, "old"),
            state("equal", D2, 0.0, "old"),
            state("newer", D3, 0.0, "old"),
            state("newer_same_batch", D3, 0.0, "B"),
            state("only_same_batch", D1, 0.0, "B"),
            state("only_other", D1, 0.0, "old"),
            state("only_null_batch", D1, 0.0, None),
        ],
    )
    names = ["null_date", "older", "equal", "newer", "newer_same_batch", "inserted"]
    source = frame(spark, [(n, "X", D2, 9.0, [9.0], 1.0, "B") for n in names])
    merged = {r.word: r for r in merge_states(target, source, "B").collect()}
    for name in ("null_date", "older", "equal"):
        assert (merged[name].label, merged[name].last_seen_on, merged[name].batch_id) == (1.0, D2, "B")
        assert (merged[name].letter_set, merged[name].frequency) == (name.upper(), 1.0)
    assert (merged["newer"].label, merged["newer"].batch_id) == (0.0, "old")
    assert (merged["newer_same_batch"].label, merged["newer_same_batch"].last_seen_on) == (0.0, D3)
    assert tuple(merged["inserted"]) == ("inserted", "X", D2, 9.0, [9.0], 1.0, "B")
    assert set(merged) == {*names, "only_other", "only_null_batch"}


def test_merge_is_idempotent(spark):
    target = frame(spark, [state("a", None, None, "old"), state("b", D3, 0.0, "old")])
    source = frame(spark, [state(w, D2, 1.0, "B") for w in "abc"])
    once = merge_states(target, source, "B")
    twice = merge_states(once, source, "B")
    assert sorted(once.collect()) == sorted(twice.collect())


def test_merge_refuses_repeated_source_rows(spark):
    target = frame(spark, [state("a", None, None, "old")])
    source = frame(spark, [state("a", D1, 1.0, "B"), state("a", D2, 1.0, "B")])
    with pytest.raises(Exception, match="several source rows"):
        merge_states(target, source, "B").collect()


def decisions(spark):
    rows = [
        ("w", "A", "BCDEFG", D1, 1.0),
        ("w", "A", "BCDEFG", D2, 0.0),
        ("w", "B", "ACDEFG", D2, 1.0),
        ("v", "A", "BCDEFG", D1, 0.0),
    ]
    schema = "word string, center_letter string, outer_letters string, puzzle_date date, accepted float"
    return spark.createDataFrame(rows, schema)


def test_latest_decision_per_word(spark):
    latest = latest_decisions(decisions(spark))
    rows = {r.word: (r.puzzle_date, r.accepted, r.center_letter) for r in latest.collect()}
    assert rows == {"w": (D2, 1.0, "B"), "v": (D1, 0.0, "A")}
    assert "WindowGroupLimit" in latest._jdf.queryExecution().toString()


def test_new_words_are_enriched(spark):
    words = spark.createDataFrame(
        [("w", "W", [1.0], 3.0), ("v", "V", [2.0], 4.0)],
        "word string, letter_set string, embedding array<float>, frequency double",
    )
    target = spark.createDataFrame([("v",)], "word string")
    updates = decisions_as_updates(decisions(spark), "B")
    rows = {r.word: r for r in enrich_new_words(updates, target, words).collect()}
    assert (rows["w"].letter_set, rows["w"].frequency, rows["w"].embedding) == ("W", 3.0, [1.0])
    assert rows["v"].letter_set is None and rows["v"].embedding is None


def test_init_states(spark):
    words = spark.createDataFrame(
        [("w", "W", None, 1, 2.0, [1.0])],
        "word string, letter_set string, date_added date, version int, frequency double, embedding array<float>",
    )
    assert tuple(init_states(words, "B").first()) == ("w", "W", None, 2.0, [1.0], None, "B")


def test_bucketed_snapshot_is_merged_without_shuffling_it(spark):
    db = scratch_name("snap")
    create_db(spark, db, scratch_path(spark, db))
    rows = [state(f"w{i}", None, None, "old") for i in range(50)]
    publish_snapshot(frame(spark, rows), "word_states", db, buckets=8)
    source = frame(spark, [state("w1", D1, 1.0, "B")])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        merged = merge_states(spark.table(f"{db}.word_states"), source, "B")
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 1
    assert merged.count() == 50


def test_old_snapshots_expire(spark):
    db = scratch_name("snap")
    create_db(spark, db, scratch_path(spark, db))
    for i in range(4):
        data = spark.range(i + 1) if i == 0 else spark.table(f"{db}.v").unionByName(spark.range(1))
        publish_snapshot(data, "v", db, keep=2)
    assert spark.table(f"{db}.v").count() == 4
    assert sum(t.name.startswith("v__") for t in spark.catalog.listTables(db)) == 2
