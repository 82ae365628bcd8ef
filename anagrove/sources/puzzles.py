"""Puzzle documents and the pages they come from."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PUZZLE_SCHEMA = (
    "printDate string, centerLetter string, outerLetters array<string>, answers array<string>"
)

# Folders that puzzles are written below.
FOLDERS = "year int, month int, date date"

# Fixed value: the page variable that holds the puzzles.
GAME_VARIABLE = "window.gameData"


# Documents with more than one suffix, such as x.latest.json, are copies of others;
# files that Spark wrote have several dots as well but are no documents' names.
COPY_NAME = r"\..*\."
WRITTEN_NAME = r"^part-.*\.c\d+\.json$"


def puzzle_reader(reader, path: str, multi_line: bool = True) -> DataFrame:
    """Puzzles below ``path`` from a batch or stream reader, one rule for both.

    With ``multi_line`` a file is one indented object, or one object per line if
    every line is a whole object. Without it, every line is an object. A file that
    isn't so stops the job. ``file_name`` and ``modified`` tell where a row is from.
    """
    reader = reader.option("pathGlobFilter", "*.json")
    origin_name = F.col("_metadata.file_name")
    origin = [origin_name.alias("file_name"), F.col("_metadata.file_modification_time").alias("modified")]
    if not multi_line:
        rows = reader.schema(PUZZLE_SCHEMA + ", " + FOLDERS).option("mode", "FAILFAST").json(path).select("*", *origin)
    else:
        files = reader.text(path, wholetext=True)
        for folder, kind in (f.split(" ") for f in FOLDERS.split(", ")):
            if folder not in files.columns:
                named = F.try_to_timestamp(F.left(origin_name, F.lit(10)), F.lit("yyyy-MM-dd")) if folder == "date" else F.lit(None)
                files = files.withColumn(folder, named.cast(kind))
        files = files.select("*", *origin)
        lines = F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != "")
        is_lines = F.forall(lines, lambda x: x.rlike(r"^\s*\{.*\}\s*$"))
        each = files.withColumn("value", F.explode(F.when(is_lines, lines).otherwise(F.array("value"))))
        # Within brackets, a second object after the first is an error too.
        text = F.concat(F.lit("["), F.col("value"), F.lit("]"))
        found = F.from_json(text, f"array<struct<{_as_struct(PUZZLE_SCHEMA)}>>", {"mode": "FAILFAST"})
        rows = each.select(F.explode(found).alias("p"), "year", "month", "date", "file_name", "modified")
        rows = rows.select("p.*", "year", "month", "date", "file_name", "modified")
    return rows.filter(~F.col("file_name").rlike(COPY_NAME) | F.col("file_name").rlike(WRITTEN_NAME))


def read_puzzles(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Puzzles below ``path``, with the folders' ``year``, ``month`` and ``date``."""
    return puzzle_reader(spark.read, path, multi_line).drop("file_name", "modified")


def puzzles_of_month(puzzles: DataFrame, year: int, month: int) -> DataFrame:
    """Prunes to the month's folder."""
    return puzzles.filter((F.col("year") == year) & (F.col("month") == month))


def puzzles_of_date(puzzles: DataFrame, date: dt.date) -> DataFrame:
    """Prunes to the date's folder, or to files named for the date."""
    # The first filter concerns folders alone, so it prunes.
    month = puzzles_of_month(puzzles, date.year, date.month)
    found = month.filter((F.col("date") == F.lit(date)) | F.col("date").isNull())
    return found.filter(F.col("printDate") == date.isoformat())


def script_body(html: Column, pattern: str) -> Column:
    """First group of ``pattern`` inside the page's scripts, null when absent."""
    scripts = F.regexp_extract_all(html, F.lit(r"(?s)<script[^>]*>(.*?)</script>"), F.lit(1))
    found = F.transform(scripts, lambda s: F.regexp_extract(s, pattern, 1))
    return F.try_element_at(F.filter(found, lambda s: s != ""), F.lit(1))


def page_script(pages: DataFrame, pattern: str, name: str = "body") -> DataFrame:
    """Script text per page; pages without it show null."""
    return pages.select("page_id", script_body(F.col("html"), pattern).alias(name))


def puzzles_from_pages(pages: DataFrame, variable: str = GAME_VARIABLE) -> DataFrame:
    """Today's puzzle of each page; the job stops at a page without one."""
    quoted = variable.replace(".", r"\.")
    body = script_body(F.col("html"), rf"(?s)^\s*{quoted} = (.*?);?\s*$")
    today = F.from_json(body, f"today struct<{_as_struct(PUZZLE_SCHEMA)}>")["today"]
    missing = F.raise_error(F.lit(f"a page has no script that sets {variable}"))
    return pages.select(F.coalesce(today, missing.cast(f"struct<{_as_struct(PUZZLE_SCHEMA)}>")).alias("p")).select("p.*")


def _as_struct(schema: str) -> str:
    return ", ".join(field.replace(" ", ": ", 1) for field in schema.split(", "))
