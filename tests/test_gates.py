"""Gates counted by the write itself."""

import pytest
from pyspark.sql import functions as F

from anagrove.sinks.gates import GateFailure, Watch, gated_commit, last_counts, require_equal_rows
from anagrove.sinks.versioned import VersionedTable

SCHEMA = "word string, n int, month int"
ROWS = [("a", 1, 1), ("b", -2, 1), ("c", None, 2), ("d", 4, None)]


def broken():
    return {"negative": F.col("n") < 0, "missing": F.col("n").isNull()}


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def table(spark, tmp_path, name="t"):
    return VersionedTable(spark, str(tmp_path / name), ["month"])


def test_a_broken_gate_leaves_the_table_as_it_was(spark, tmp_path):
    held = table(spark, tmp_path)
    assert gated_commit(held, frame(spark, ROWS[:1]), broken()) == 1
    with pytest.raises(GateFailure) as failure:
        gated_commit(held, frame(spark, ROWS), broken(), F.col("word"))
    assert failure.value.counts == {"rows": 4, "negative": 1, "missing": 1}
    assert failure.value.examples == {"negative": "b", "missing": "c"}
    assert held.version() == 1
    assert [tuple(r) for r in held.read().collect()] == ROWS[:1]
    assert last_counts(held) == {"rows": 1, "negative": 0, "missing": 0}


def test_expected_rows_and_counts_across_tables(spark, tmp_path):
    one, two = table(spark, tmp_path, "one"), table(spark, tmp_path, "two")
    sound = [r for r in ROWS if r[0] in "ad"]
    gated_commit(one, frame(spark, sound), broken())
    with pytest.raises(GateFailure, match="2 rows were expected"):
        gated_commit(two, frame(spark, sound[:1]), broken(), rows=last_counts(one)["rows"])
    with pytest.raises(ValueError, match="unknown"):
        require_equal_rows(one, two)
    gated_commit(two, frame(spark, sound), broken(), rows=2)
    assert require_equal_rows(one, two) == 2


def test_an_empty_frame_is_counted(spark, tmp_path):
    held = table(spark, tmp_path)
    gated_commit(held, frame(spark, ROWS[:1]), broken())
    assert gated_commit(held, frame(spark, ROWS).filter("false"), broken()) == 2
    assert gated_commit(held, frame(spark, ROWS).filter("word > 'x'"), broken(), rows=0) == 3
    assert last_counts(held) == {"rows": 0, "negative": 0, "missing": 0}
    assert held.read().count() == 0


def test_only_the_chosen_partitions_are_replaced(spark, tmp_path):
    held = table(spark, tmp_path)
    gated_commit(held, frame(spark, [("a", 1, 1), ("d", 4, 2)]), broken())
    gated_commit(held, frame(spark, [("x", 9, 1)]), broken(), partial=lambda own: own["month"] == 1)
    assert sorted(r.word for r in held.read().collect()) == ["d", "x"]


def test_counts_come_from_the_write_alone(spark, tmp_path):
    """One pass: a row that is read twice would be counted twice by the accumulator."""
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    seen = frame(spark, [("w", i, i % 3) for i in range(100)]).mapInPandas(count, SCHEMA)
    gated_commit(table(spark, tmp_path), seen, broken())
    assert reads.value == 100


def test_the_counting_node_lies_above_every_shuffle(spark):
    dealt = Watch(broken())(frame(spark, ROWS).hint("rebalance", "month"))
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("CollectMetrics")]


def test_a_watch_that_saw_nothing(spark):
    with pytest.raises(RuntimeError):
        Watch(broken()).counts
    with pytest.raises(ValueError):
        Watch({"rows": F.lit(True)})
