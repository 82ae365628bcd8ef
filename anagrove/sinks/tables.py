"""Catalog tables: create once, replace rows by predicate, publish snapshots."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anagrove.session import materialise, scratch_name

FORMAT = "parquet"
OVERWRITE_CONF = "spark.sql.sources.partitionOverwriteMode"


def create_db(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def _require_db(spark: SparkSession, db: str) -> None:
    if not spark.catalog.databaseExists(db):
        raise ValueError(f"database {db} does not exist; create it first")


def create_table(df: DataFrame, table: str, db: str) -> None:
    """Write ``df`` as a new unpartitioned table; refuse to touch an existing one."""
    spark = df.sparkSession
    _require_db(spark, db)
    if spark.catalog.tableExists(f"{db}.{table}"):
        raise ValueError(f"table {db}.{table} already exists")
    df.write.format(FORMAT).mode("errorifexists").saveAsTable(f"{db}.{table}")


def create_repartitioned_table(
    df: DataFrame, table: str, db: str, num_partitions: int = 10
) -> None:
    """As ``create_table``, with rows dealt out evenly to bound writer memory."""
    create_table(df.repartition(num_partitions), table, db)


def _matches(values: dict[str, Any], schema) -> Column:
    """All of ``column <=> value``, with each value as a literal of its column's type."""
    tests = [F.col(c).eqNullSafe(F.lit(v).cast(schema[c].dataType)) for c, v in values.items()]
    return reduce(lambda a, b: a & b, tests)


def _first_write(df: DataFrame, name: str, partitions: list[str] | None) -> None:
    if partitions:
        _gathered(df, partitions).write.format(FORMAT).partitionBy(*partitions).saveAsTable(name)
    else:
        df.write.format(FORMAT).saveAsTable(name)


def _gathered(df: DataFrame, partitions: list[str]) -> DataFrame:
    """Bring a partition's rows together so that it gets few files.

    Rebalancing splits a partition value that holds much of the data.
    """
    return df.hint("rebalance", *partitions)


def replace_where(
    df: DataFrame, table: str, db: str, values: dict[str, Any], partitions: list[str] | None = None
) -> None:
    """Replace the rows where every column of ``values`` has its value.

    The first write creates the table, partitioned by ``partitions``. Later
    writes rebuild only the partitions that lose or gain rows: their other rows
    are carried over, the new rows added, and all are swapped in by one dynamic
    overwrite. A partition that ends up empty is dropped. An unpartitioned table
    is rewritten beside itself and swapped by rename.
    """
    spark = df.sparkSession
    _require_db(spark, db)
    name = f"{db}.{table}"
    if not values:
        raise ValueError("replace_where needs at least one column value")
    exists = spark.catalog.tableExists(name)
    hit = _matches(values, spark.table(name).schema if exists else df.schema)
    fits = F.when(hit, F.lit(True)).otherwise(
        F.raise_error(F.lit("a new row lies outside the replaced range")).cast("boolean")
    )
    if not exists:
        _first_write(df.filter(fits), name, partitions)
        return
    current = spark.table(name)
    # Cut the lineage: the new rows are read several times below and may come
    # from the very table that is about to change.
    fresh = materialise(df.filter(fits).select(*current.columns))
    _rewrite(table, db, fresh, current.filter(hit), lambda rows: rows.filter(~hit))


def replace_keys(
    df: DataFrame,
    table: str,
    db: str,
    keys: list[str],
    partitions: list[str] | None = None,
    keys_fix_partition: bool = False,
) -> None:
    """Replace the rows whose ``keys`` occur in ``df``, such as whole days.

    As ``replace_where`` for many values at once; all other rows stay. With
    ``keys_fix_partition`` equal keys lie in one partition, as days do in months;
    then only the partitions of the new rows are read.
    """
    spark = df.sparkSession
    _require_db(spark, db)
    name = f"{db}.{table}"
    if not spark.catalog.tableExists(name):
        _first_write(df, name, partitions)
        return
    current = spark.table(name)
    fresh = materialise(df.select(*current.columns))
    replaced = fresh.select(*keys).distinct()
    if keys_fix_partition and partitions:
        touched = _partition_values(fresh, partitions)
        current = current.filter(_in_partitions(touched, partitions)) if touched else current.limit(0)
    _rewrite(
        table,
        db,
        fresh,
        current.join(replaced, keys, "left_semi"),
        lambda rows: rows.join(replaced, keys, "left_anti").select(*rows.columns),
    )


def _rewrite(
    table: str,
    db: str,
    fresh: DataFrame,
    lost: DataFrame,
    survivors: Callable[[DataFrame], DataFrame],
) -> None:
    """Swap in ``fresh`` plus the survivors of every partition that changes."""
    spark = fresh.sparkSession
    name = f"{db}.{table}"
    current = spark.table(name)
    keys = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if not keys:
        _swap_table(survivors(current).unionByName(fresh), table, db)
        return
    # Partition values only: as many rows as directories this write touches.
    gained = _partition_values(fresh, keys)
    touched = gained | _partition_values(lost, keys)
    if not touched:
        return
    kept = survivors(current.filter(_in_partitions(touched, keys)))
    emptied = touched - gained - _partition_values(kept, keys)
    with _dynamic_overwrite(spark):
        rows = kept.unionByName(fresh).select(*current.columns)
        _gathered(rows, keys).write.insertInto(name, overwrite=True)
    for values in emptied:
        spec = ", ".join(f"`{k}` = {_sql_literal(v)}" for k, v in zip(keys, values))
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
    spark.catalog.refreshTable(name)


def rows_of_partitions(table: DataFrame, like: DataFrame, partitions: list[str]) -> DataFrame:
    """Rows in those partitions that ``like`` has rows of, pruned at the scan."""
    touched = _partition_values(like, partitions)
    return table.filter(_in_partitions(touched, partitions)) if touched else table.limit(0)


def _sql_literal(value: Any) -> str:
    if value is None:
        return "NULL"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwrite only the partitions that are written; inserts heed the setting alone."""
    before = spark.conf.get(OVERWRITE_CONF)
    spark.conf.set(OVERWRITE_CONF, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_CONF, before)


def _partition_values(df: DataFrame, keys: list[str]) -> set[tuple]:
    return {tuple(row) for row in df.select(*keys).distinct().collect()}


def _in_partitions(partitions: set[tuple], keys: list[str]) -> Column:
    one = [
        reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(v)) for k, v in zip(keys, values)])
        for values in sorted(partitions, key=str)
    ]
    return reduce(lambda a, b: a | b, one)


def _swap_table(df: DataFrame, table: str, db: str) -> None:
    """Write the successor of an unpartitioned table, then exchange the names."""
    spark = df.sparkSession
    successor, retired = scratch_name(table), scratch_name(table)
    df.write.format(FORMAT).mode("errorifexists").saveAsTable(f"{db}.{successor}")
    spark.sql(f"ALTER TABLE {db}.{table} RENAME TO {db}.{retired}")
    spark.sql(f"ALTER TABLE {db}.{successor} RENAME TO {db}.{table}")
    spark.sql(f"DROP TABLE {db}.{retired}")


def publish_snapshot(
    df: DataFrame,
    view: str,
    db: str,
    buckets: int | None = None,
    key: str = "word",
    keep: int = 3,
) -> str:
    """Write a new snapshot table and point the view ``db.view`` at it.

    Readers of the view see the old or the new snapshot, never a mixture, and
    the new one may be computed from the old one. With ``buckets`` the snapshot
    is bucketed and sorted by ``key``, so the next merge shuffles only its small
    side. The newest ``keep`` snapshots stay for running readers; older ones are
    dropped. Returns the snapshot's name.
    """
    spark = df.sparkSession
    _require_db(spark, db)
    prefix = f"{view}__"
    snapshot = scratch_name(f"{prefix}{time.time_ns():020d}")
    writer = df.write.format(FORMAT).mode("errorifexists")
    if buckets:
        # Bucket columns first gathered by key: one file per bucket, not per task.
        writer = df.repartition(buckets, key).write.format(FORMAT).mode("errorifexists")
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(f"{db}.{snapshot}")
    spark.sql(f"CREATE OR REPLACE VIEW {db}.{view} AS SELECT * FROM {db}.{snapshot}")
    known = sorted(t.name for t in spark.catalog.listTables(db) if t.name.startswith(prefix))
    for old in known[:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {db}.{old}")
    return f"{db}.{snapshot}"
