"""Times headline queries and prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data folder and the local core count.
Inputs that the warehouse keeps as tables are prepared before the clock starts;
``words`` and ``states`` time their preparation.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from anagrove.catalogue.queries import QUERIES
from anagrove.operators import matching, serving, subset_counts
from anagrove.operators import states as word_states
from anagrove.plans import lifecycle
from anagrove.plans.derived import Warehouse
from anagrove.session import materialise, stages

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

WHOLE_QUERIES = [
    "corpus_frequency",
    "batch_assign",
    "frequency_series",
    "stratified_split",
    "threshold_grid",
    "roc_auc",
    "error_slices",
    "mean_pool",
    "merge_states",
    "merge_states_rewrite",
    "replace_where",
    "replace_where_atomic",
    "incremental_ingest",
]


def match_counts(house: Warehouse) -> DataFrame:
    letters = house.puzzles.select(F.concat("center_letter", "outer_letters").alias("letters"))
    return subset_counts.center_counts(subset_counts.subset_tables(letters, house.words))


def session() -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="anagrove-bench-")
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("anagrove-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> int:
    """Compute all of ``df``; returns its rows, counted on the way."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    return seen.get["n"]


def every_center(puzzles: DataFrame) -> DataFrame:
    """Each letter set once with every one of its letters in the centre."""
    letters = F.array_sort(F.split(F.concat("center_letter", "outer_letters"), ""))
    each = puzzles.select("puzzle_date", F.explode(letters).alias("c"), F.array_join(letters, "").alias("all"))
    return each.select(
        "puzzle_date",
        F.col("c").alias("center_letter"),
        F.replace("all", "c", F.lit("")).alias("outer_letters"),
    )


def main() -> None:
    spark = session()
    times: dict[str, float] = {}
    rows: dict[str, int] = {}

    def timed(name, work):
        start = time.time()
        result = work()
        times[name] = round(time.time() - start, 3)
        if isinstance(result, int):
            rows[name] = result
        return result

    run(spark.read.parquet(f"{SF_DIR}/region.parquet"))  # start the executors
    for name in WHOLE_QUERIES:
        with stages(spark):
            timed(name, lambda: run(QUERIES[name](spark, SF_DIR)))
    house = Warehouse(spark, SF_DIR)
    timed("words", lambda: house.words)
    house.answers
    all_centers = materialise(every_center(house.puzzles))
    timed("matching_words", lambda: run(matching.matching_words(house.puzzles, house.words)))
    timed(
        "matching_words_every_center",
        lambda: run(matching.matching_words(all_centers, house.words, distinct=True)),
    )
    timed("match_counts_every_center", lambda: run(match_counts(house)))
    timed("word_decisions", lambda: run(house.decisions))
    timed("latest_decision", lambda: run(word_states.latest_decisions(house.decisions)))
    house.joined_words
    timed("states", lambda: house.states)
    timed("word_probabilities", lambda: run(house.probabilities))
    timed("train", lambda: lifecycle.train_on_states(house.states, 50))
    timed("letter_set_groups", lambda: run(serving.letter_set_groups(house.probabilities)))
    timed("solve_puzzle", lambda: run(serving.solve_puzzles(house.puzzles, house.probabilities)))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows": rows,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
