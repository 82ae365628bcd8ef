import pytest
from pyspark.sql import functions as F

from anagrove.session import scratch_name, scratch_path
from anagrove.sinks import export, tables


@pytest.fixture
def db(spark):
    name = scratch_name("db")
    tables.create_db(spark, name, scratch_path(spark, name))
    return name


SCHEMA = "v string, year int, month int, day int"
PARTS = ["year", "month"]


def rows_of(spark, name):
    return sorted(tuple(r) for r in spark.table(name).select("v", "year", "month", "day").collect())


def seeded(spark, db):
    first = spark.createDataFrame(
        [("a", 2024, 1, 1), ("b", 2024, 1, 2), ("c", 2024, 2, 1), ("d", 2023, 1, 1)], SCHEMA
    )
    tables.replace_keys(first, "t", db, ["year"], PARTS)
    return f"{db}.t"


def test_create_refuses_missing_db_and_existing_table(spark, db):
    df = spark.range(5)
    with pytest.raises(ValueError, match="does not exist"):
        tables.create_table(df, "t", "no_such_db")
    tables.create_table(df, "t", db)
    with pytest.raises(ValueError, match="already exists"):
        tables.create_repartitioned_table(df, "t", db)


def test_repartitioned_table_has_that_many_files(spark, db):
    tables.create_repartitioned_table(spark.range(1000), "t", db, 4)
    assert len(spark.table(f"{db}.t").inputFiles()) == 4


def test_replacing_a_day_keeps_the_rest_of_its_month(spark, db):
    name = seeded(spark, db)
    fresh = spark.createDataFrame([("x", 2024, 1, 1), ("y", 2024, 1, 1)], SCHEMA)
    for _ in range(2):
        tables.replace_where(fresh, "t", db, {"year": 2024, "month": 1, "day": 1})
        assert rows_of(spark, name) == [
            ("b", 2024, 1, 2),
            ("c", 2024, 2, 1),
            ("d", 2023, 1, 1),
            ("x", 2024, 1, 1),
            ("y", 2024, 1, 1),
        ]


def test_an_empty_batch_clears_its_month(spark, db):
    name = seeded(spark, db)
    tables.replace_where(spark.createDataFrame([], SCHEMA), "t", db, {"year": 2024, "month": 1})
    assert rows_of(spark, name) == [("c", 2024, 2, 1), ("d", 2023, 1, 1)]


def test_rows_outside_the_range_stop_the_job(spark, db):
    name = seeded(spark, db)
    before = rows_of(spark, name)
    with pytest.raises(Exception, match="outside the replaced range"):
        tables.replace_where(spark.createDataFrame([("x", 2024, 2, 1)], SCHEMA), "t", db, {"month": 1})
    assert rows_of(spark, name) == before


def test_text_values_and_unpartitioned_tables(spark, db):
    schema = "v string, batch string"
    tables.create_table(spark.createDataFrame([("a", "it's"), ("b", "other")], schema), "t", db)
    tables.replace_where(spark.createDataFrame([("c", "it's")], schema), "t", db, {"batch": "it's"})
    assert sorted(r.v for r in spark.table(f"{db}.t").collect()) == ["b", "c"]


def test_a_table_may_feed_its_own_replacement(spark, db):
    name = seeded(spark, db)
    chosen = spark.table(name).filter("year = 2024 AND month = 1 AND v = 'a'")
    tables.replace_where(chosen, "t", db, {"year": 2024, "month": 1})
    assert rows_of(spark, name) == [("a", 2024, 1, 1), ("c", 2024, 2, 1), ("d", 2023, 1, 1)]


def test_replace_keys_handles_many_days(spark, db):
    name = seeded(spark, db)
    fresh = spark.createDataFrame([("x", 2024, 1, 1), ("y", 2024, 2, 1), ("z", 2025, 1, 1)], SCHEMA)
    tables.replace_keys(fresh, "t", db, ["year", "month", "day"])
    assert rows_of(spark, name) == [
        ("b", 2024, 1, 2),
        ("d", 2023, 1, 1),
        ("x", 2024, 1, 1),
        ("y", 2024, 2, 1),
        ("z", 2025, 1, 1),
    ]


def test_export_writes_nulls_and_doubles(spark):
    row = spark.createDataFrame(
        [("ABCD", 0, [(None, "ABCD", 0.5, "abcd")])],
        "letter_set string, part int, data array<struct<date: string, letters: string, prob: double, word: string>>",
    )
    json = export.export_json_lines(row).first().json
    assert json == '{"ABCD":[{"date":null,"letters":"ABCD","prob":0.5,"word":"abcd"}]}'


def test_older_snapshots_are_refused(spark):
    snapshots = spark.createDataFrame([("2024-01-02", 5), ("2024-01-01", 9)], "logical_date string, created_ts bigint")
    assert tuple(export.latest_snapshot(snapshots).first()) == ("2024-01-02", 5)
    export.require_not_older(snapshots, "2024-01-02")
    with pytest.raises(ValueError, match="before the latest"):
        export.require_not_older(snapshots, "2024-01-01")
    export.require_not_older(snapshots.filter(F.lit(False)), "2020-01-01")


def test_the_first_write_is_checked_too(spark, db):
    rows = spark.createDataFrame([("x", 2024, 2, 1)], SCHEMA)
    with pytest.raises(Exception, match="outside the replaced range"):
        tables.replace_where(rows, "t", db, {"month": 1}, PARTS)


def test_replace_keys_reads_only_the_months_of_new_rows(spark, db):
    name = seeded(spark, db)
    fresh = spark.createDataFrame([("y", 2024, 1, 2)], SCHEMA)
    tables.replace_keys(fresh, "t", db, ["year", "month", "day"], PARTS, keys_fix_partition=True)
    assert rows_of(spark, name) == [("a", 2024, 1, 1), ("c", 2024, 2, 1), ("d", 2023, 1, 1), ("y", 2024, 1, 2)]
    pruned = tables.rows_of_partitions(spark.table(name), fresh, PARTS)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024" in plan.split("PartitionFilters: [")[1].split("]")[0]
