"""Plain-text word lists and the choice among their versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anagrove.functions import unquote_line


def words_from_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Distinct words of a table of lines; empty lines are dropped."""
    words = lines.select(unquote_line(F.col(column)).alias("word"))
    return words.filter(F.col("word") != "").distinct()


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    return words_from_lines(spark.read.text(path))


def latest_version(files: DataFrame, column: str = "file_name") -> DataFrame:
    """The file with the greatest ``_vN`` suffix; names without one are ignored."""
    version = F.regexp_extract(F.col(column), r"_v(\d+)\.[^.]*$", 1)
    versions = files.filter(version != "").select(
        F.col(column), version.cast("int").alias("version")
    )
    newest = versions.agg(F.max(F.struct("version", F.col(column))).alias("f"))
    return newest.select(F.col(f"f.{column}").alias(column), "f.version")


def latest_word_list(spark: SparkSession, path: str) -> DataFrame:
    """Latest version among the ``.txt`` files below ``path``, which are only listed."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", True)
    return latest_version(files.load(path).select(F.col("path").alias("file_path")), "file_path")
