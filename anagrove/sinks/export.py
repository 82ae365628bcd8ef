"""Exports: keyed JSON, puzzle documents, word lists and snapshot guards."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anagrove.operators.ranking import running_totals
from anagrove.session import materialise

# Compact JSON that writes missing dates as null.
JSON_OPTIONS = {"ignoreNullFields": "false"}


def export_json_lines(groups: DataFrame) -> DataFrame:
    """One compact JSON object per letter-set row, rendered on the executors."""
    entry = F.create_map(F.col("letter_set"), F.col("data"))
    return groups.select("letter_set", "part", F.to_json(entry, JSON_OPTIONS).alias("json"))


def write_export(groups: DataFrame, path: str) -> None:
    """Write the export as sorted JSON lines, one line per letter-set row."""
    lines = export_json_lines(groups).orderBy("letter_set", "part")
    lines.select(F.col("json").alias("value")).write.mode("errorifexists").text(path)


def object_fragments(groups: DataFrame) -> DataFrame:
    """The export as fragments of one JSON object: ``letter_set``, ``part``, ``fragment``.

    Joined in this order they are the object, with or without line ends between. A
    fragment brings the brackets and commas that its place calls for: a key's first
    part opens its array, its last one closes it; parts between go on with a comma.
    """
    rows = materialise(groups.select("letter_set", "part", F.to_json("data", JSON_OPTIONS).alias("array")))
    last_part = rows.groupBy("letter_set").agg(F.max("part").alias("_last"))
    # One row; where it is empty so are the groups.
    ends = rows.agg(F.min("letter_set").alias("a"), F.max("letter_set").alias("z"))
    first, last = ends.select("a").scalar(), ends.select("z").scalar()
    name = F.to_json(F.array("letter_set"))
    key = F.concat(F.substring(name, F.lit(2), F.length(name) - 2), F.lit(":["))
    opening = F.when(F.col("part") > 0, ",").otherwise(F.concat(F.when(F.col("letter_set") == first, "{").otherwise(","), key))
    closing = F.when(F.col("part") < F.col("_last"), "").otherwise(F.when(F.col("letter_set") == last, "]}").otherwise("]"))
    elements = F.substring("array", F.lit(2), F.length("array") - 2)
    return rows.join(last_part, "letter_set").select("letter_set", "part", F.concat(opening, elements, closing).alias("fragment"))


def placed_fragments(groups: DataFrame) -> DataFrame:
    """Fragments with the byte at which each starts in the object, for writers that fill one file in parallel."""
    size = F.octet_length("fragment").cast("bigint")
    order = [F.col("letter_set"), F.col("part")]
    return running_totals(object_fragments(groups), order, {"start": size}).withColumn("bytes", size)


def write_export_object(groups: DataFrame, path: str) -> None:
    """Write the export as one JSON object: its files, joined in the order of their names, are valid JSON.

    Keys are range-partitioned, so files are written in parallel and none holds all.
    """
    ordered = object_fragments(groups).orderBy("letter_set", "part").select(F.col("fragment").alias("value"))
    if ordered.isEmpty():
        ordered = groups.sparkSession.createDataFrame([("{}",)], "value string")
    ordered.write.mode("errorifexists").text(path)


def write_puzzles(documents: DataFrame, path: str, by_month: bool = False) -> None:
    """Write puzzle documents below ``year=YYYY/month=MM/date=YYYY-MM-DD``.

    A date that exists is replaced, all other dates stay. The rebalance hint
    gathers each date in few files and still splits a date that grew large. With
    ``by_month`` a month's documents share files, one per line, and a month is
    replaced as a whole: for histories, whose days are small.
    """
    folders = ["year", "month"] if by_month else ["year", "month", "date"]
    date = F.to_date("printDate", "yyyy-MM-dd")
    placed = (
        documents.withColumn("year", F.date_format(date, "yyyy"))
        .withColumn("month", F.date_format(date, "MM"))
        .withColumn("date", F.date_format(date, "yyyy-MM-dd"))
        .select(*documents.columns, *folders)
    )
    (
        placed.hint("rebalance", *folders)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders)
        .json(path)
    )


def write_word_list(words: DataFrame, path: str) -> None:
    """One word per line, sorted across the files."""
    words.select("word").orderBy("word").write.mode("overwrite").text(path)


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """The snapshot with the greatest logical date, then creation time."""
    newest = snapshots.agg(F.max(F.struct("logical_date", "created_ts")).alias("s"))
    return newest.select("s.logical_date", "s.created_ts")


def require_not_older(snapshots: DataFrame, logical_date) -> None:
    """Refuse a snapshot older than the latest one; the same date may repeat."""
    newest = latest_snapshot(snapshots).first()
    if newest is not None and newest.logical_date is not None and logical_date < newest.logical_date:
        raise ValueError(f"{logical_date} is before the latest snapshot {newest.logical_date}")


def _snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Published snapshots below ``root``, one row each."""
    schema = "logical_date date, created_ts bigint"
    try:
        return spark.read.schema(schema).parquet(f"{root}/published")
    except Exception as error:  # noqa: BLE001 - only a missing folder means no snapshot
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], schema)
        raise


def publish_export(groups: DataFrame, root: str, logical_date: dt.date) -> str:
    """Write the export of a logical date and make it the latest.

    A date before the latest one is refused; the same date may be published
    again. A snapshot counts from the moment its row is added to ``published``,
    after all its lines are written, so there is always exactly one latest and
    a failed attempt leaves the previous one in place. Returns the folder.
    """
    spark = groups.sparkSession
    require_not_older(_snapshots(spark, root), logical_date)
    created = time.time_ns()
    folder = f"{root}/data_{logical_date.isoformat()}_{created}"
    write_export(groups, folder)
    row = spark.createDataFrame([(logical_date, created)], "logical_date date, created_ts bigint")
    row.coalesce(1).write.mode("append").parquet(f"{root}/published")
    return folder


def read_latest_export(spark: SparkSession, root: str) -> DataFrame:
    """JSON lines of the latest published export."""
    newest = latest_snapshot(_snapshots(spark, root)).first()
    if newest.logical_date is None:
        raise ValueError(f"nothing has been published below {root}")
    return spark.read.text(f"{root}/data_{newest.logical_date.isoformat()}_{newest.created_ts}")
