"""Atomic commits of several partitions."""

import pytest
from pyspark.sql import functions as F

from anagrove.sinks.versioned import Conflict, VersionedTable

ROWS = [("a", 1, 2020, 1), ("b", 2, 2020, 1), ("c", 3, 2020, 2), ("d", 4, 2021, 1), ("e", 5, None, 1)]
SCHEMA = "word string, n int, year int, month int"


@pytest.fixture
def table(spark, tmp_path):
    made = VersionedTable(spark, str(tmp_path / "t"), ["year", "month"])
    made.replace_keys(spark.createDataFrame(ROWS, SCHEMA), ["word"])
    return made


def content(table, version=None):
    return sorted([tuple(r) for r in table.read(version).collect()], key=repr)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_rows_and_versions(spark, table):
    assert content(table) == sorted(ROWS, key=repr) and table.version() == 1
    assert set(table.manifest().entries) == {'{"year":2020,"month":1}', '{"year":2020,"month":2}', '{"year":2021,"month":1}', '{"month":1}'}
    pruned = table.read(where=lambda own: own["year"] == 2021)
    assert [r.word for r in pruned.collect()] == ["d"] and len(pruned.inputFiles()) == 1


def test_keys_are_replaced_across_partitions(spark, table):
    table.replace_keys(frame(spark, ("a", 9, 2021, 1), ("c", 8, 2022, 5), ("e", 7, None, 1)), ["word"])
    expected = [("a", 9, 2021, 1), ("b", 2, 2020, 1), ("c", 8, 2022, 5), ("d", 4, 2021, 1), ("e", 7, None, 1)]
    assert content(table) == sorted(expected, key=repr)
    assert '{"year":2020,"month":2}' not in table.manifest().entries
    assert content(table, 1) == sorted(ROWS, key=repr)


def test_a_predicate_is_replaced(spark, table):
    table.replace_where(frame(spark, ("x", 1, 2020, 3)), {"year": 2020})
    assert content(table) == sorted([("x", 1, 2020, 3), *ROWS[3:]], key=repr)
    table.replace_where(frame(spark, ("d", 4, 2021, 2)), {"word": "d", "n": 4})
    assert content(table) == sorted([("x", 1, 2020, 3), ("d", 4, 2021, 2), ROWS[4]], key=repr)
    table.replace_where(frame(spark).limit(0), {"year": None})
    assert content(table) == sorted([("x", 1, 2020, 3), ("d", 4, 2021, 2)], key=repr)
    with pytest.raises(Exception, match="outside the replaced range"):
        table.replace_where(frame(spark, ("y", 1, 2030, 1)), {"year": 2020})
    assert len(content(table)) == 2


def test_a_writer_that_dies_leaves_the_old_table(spark, table, monkeypatch):
    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(table, "_publish", die)
        with pytest.raises(KeyboardInterrupt):
            table.replace_keys(frame(spark, ("a", 9, 2021, 1), ("c", 8, 2022, 5)), ["word"])
    assert content(table) == sorted(ROWS, key=repr)
    assert len(table.vacuum()) == 2
    table.replace_keys(frame(spark, ("a", 9, 2021, 1)), ["word"])
    assert ("a", 9, 2021, 1) in content(table)


def test_two_writers(spark, table):
    base = table.manifest()
    other = table.write(frame(spark, ("z", 0, 2021, 1)))
    jan, later = '{"year":2020,"month":1}', '{"year":2021,"month":1}'
    table.replace_where(frame(spark, ("q", 1, 2020, 1)), {"year": 2020, "month": 1})
    # Based on the first version: apart from the newer one's partition it goes on top, on it it conflicts.
    assert table.commit(base, [other], [later]) == 3
    assert {r[0] for r in content(table)} == {"q", "c", "z", "e"}
    before = content(table)
    with pytest.raises(Conflict):
        table.commit(base, [other], [jan])
    with pytest.raises(Conflict):
        table.commit(base, [other], alone=True)
    assert content(table) == before


def test_vacuum_keeps_what_is_named(spark, table):
    for n in range(4):
        table.replace_where(frame(spark, ("a", n, 2020, 1)), {"year": 2020, "month": 1})
    assert table.vacuum(keep=2)
    assert ("a", 3, 2020, 1) in content(table) and ("a", 2, 2020, 1) in content(table, 4)
    assert ("d", 4, 2021, 1) in content(table)
    with pytest.raises(Exception):
        content(table, 1)


def test_odd_values_and_no_rows(spark, tmp_path):
    rows = spark.createDataFrame([("a/b=c %", 1), ('"q" é', 2), (None, 3)], "k string, n int")
    made = VersionedTable(spark, str(tmp_path / "odd"), ["k"])
    made.replace_keys(rows, ["n"])
    assert sorted(r.n for r in made.read().collect()) == [1, 2, 3]
    assert [r.n for r in made.read(where=lambda own: own["k"] == "a/b=c %").collect()] == [1]
    empty = VersionedTable(spark, str(tmp_path / "none"), ["k"])
    with pytest.raises(ValueError):
        empty.read()
    empty.replace_keys(rows.limit(0), ["n"])
    assert empty.read().filter(F.col("n") > 0).count() == 0
