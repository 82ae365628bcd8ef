"""One registered query per operator, over the whole given tables.

Dates and nested values are rendered as text, floats widened to double, so that
results compare by value with any SQL engine.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml.classification import NaiveBayes, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anagrove.operators import enrich, features, forest_proof, hybrid, lowrank, matching, metrics, ranking, serving
from anagrove.operators import states as word_states
from anagrove.operators import subset_counts, thresholds
from anagrove.operators.state_log import StateLog
from anagrove.plans import derived, lifecycle
from anagrove.plans.derived import Warehouse
from anagrove.session import materialise, scratch_name, scratch_path
from anagrove.functions import embedding_is_valid
from anagrove.sinks import export, gates, tables
from anagrove.sinks.versioned import VersionedTable
from anagrove.sources import puzzles as puzzle_source
from anagrove.sources import wordlists
from anagrove.streaming.ingest import ingest_puzzles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PUZZLE_TEXT = ["puzzle_date", "center_letter", "outer_letters"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def _double(column: str) -> Column:
    return F.col(column).cast("double").alias(column)


def _long(column: str) -> Column:
    return F.col(column).cast("bigint").alias(column)


def _vector(column: str = "embedding") -> Column:
    """All elements of an embedding, as text in millionths."""
    whole = F.transform(column, lambda x: F.round(x.cast("double") * 1_000_000).cast("bigint").cast("string"))
    return F.array_join(whole, ",").alias(column)


def _new_db(spark: SparkSession) -> str:
    db = scratch_name("anagrove")
    tables.create_db(spark, db, scratch_path(spark, db))
    return db


# --- sources ---------------------------------------------------------------


@query
def wordlist_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = derived.table(spark, sf_dir, "documents")
    lines = texts.select(F.explode(F.split("text", "\n")).alias("value"))
    return wordlists.words_from_lines(lines)


@query
def puzzle_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _puzzle_text(_stored_puzzles(spark, sf_dir))


@query
def puzzle_month_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _puzzle_text(puzzle_source.puzzles_of_month(_stored_puzzles(spark, sf_dir), 2018, 3))


def _stored_puzzles(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "puzzles")
    answers = Warehouse(spark, sf_dir).answers
    export.write_puzzles(derived.puzzle_documents(answers), path)
    return puzzle_source.read_puzzles(spark, path, multi_line=False)


def _puzzle_text(documents: DataFrame) -> DataFrame:
    return documents.select(
        "printDate",
        "centerLetter",
        F.array_join("outerLetters", "").alias("outerLetters"),
        F.array_join(F.array_sort("answers"), ",").alias("answers"),
    )


@query
def puzzle_date_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = dt.date(2018, 1, 20)
    return _puzzle_text(puzzle_source.puzzles_of_date(_stored_puzzles(spark, sf_dir), day))


@query
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = derived.table(spark, sf_dir, "documents")
    names = texts.select(
        F.concat("source", F.lit("_"), "lang", F.lit("_v"), "doc_id", F.lit(".txt")).alias("file_name")
    )
    return wordlists.latest_version(names).select("file_name", _long("version"))


@query
def labeled_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = derived.table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = derived.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    joined = texts.join(labels, "doc_id", "left")
    return features.labeled(joined).select("doc_id", "lang", _long("label"))


@query
def page_script_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = derived.table(spark, sf_dir, "pages")
    return puzzle_source.page_script(pages, r"track\((\d+)\)", "body")


# --- sinks -----------------------------------------------------------------


@query
def table_create_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _new_db(spark)
    tables.create_table(matching.eligible_words(Warehouse(spark, sf_dir).vocabulary), "words", db)
    return spark.table(f"{db}.words")


@query
def table_create_repartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _new_db(spark)
    vectors = derived.table(spark, sf_dir, "embeddings")
    tables.create_repartitioned_table(vectors, "word_embeddings", db)
    return spark.table(f"{db}.word_embeddings").select("vec_id", _long("label"), _vector())


@query
def replace_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions partitioned by month; one day is then replaced by its acceptances."""
    db = _new_db(spark)
    rows = matching.with_decision_dates(Warehouse(spark, sf_dir).decisions)
    parts = lifecycle.DECISION_PARTITIONS
    tables.replace_keys(rows, "word_decisions", db, ["puzzle_date"], parts)
    stored = spark.table(f"{db}.word_decisions")
    day = {"year": 2018, "month": 2, "day": 14}
    chosen = stored.filter("year = 2018 AND month = 2 AND day = 14 AND accepted = 1")
    tables.replace_where(chosen, "word_decisions", db, day, parts)
    return _decision_text(spark.table(f"{db}.word_decisions"))


@query
def replace_where_atomic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same day replaced in a versioned table, the old version still readable; its decisions."""
    rows = matching.with_decision_dates(Warehouse(spark, sf_dir).decisions)
    table = VersionedTable(spark, scratch_path(spark, "decisions"), lifecycle.DECISION_PARTITIONS)
    table.replace_keys(rows, ["puzzle_date"], keys_fix_partition=True)
    of_month = table.read(where=lambda own: (own["year"], own["month"]) == (2018, 2))
    table.replace_where(of_month.filter("day = 14 AND accepted = 1"), {"year": 2018, "month": 2, "day": 14})
    return _decision_text(table.read())


def _decision_text(rows: DataFrame) -> DataFrame:
    return rows.select("word", "center_letter", "outer_letters", _day("puzzle_date"), _double("accepted"))


@query
def puzzle_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the written puzzles: how many documents each month holds."""
    stored = _stored_puzzles(spark, sf_dir)
    return stored.groupBy(_long("year"), _long("month")).agg(F.count(F.lit(1)).alias("n"))


@query
def wordlist_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "wordlist")
    export.write_word_list(derived.vocabulary(spark, sf_dir), path)
    return wordlists.read_word_list(spark, path)


@query
def export_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = serving.letter_set_groups(Warehouse(spark, sf_dir).probabilities)
    lines = export.export_json_lines(serving.export_rows(groups))
    return lines.select("letter_set", _long("part"), "json")


@query
def export_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments of the export as one keyed object, with the byte where each starts."""
    groups = serving.export_rows(serving.letter_set_groups(Warehouse(spark, sf_dir).probabilities))
    return export.placed_fragments(groups).select("letter_set", _long("part"), "start", "bytes", "fragment")


@query
def publish_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two exports are published, an older one is refused; the latest is read back."""
    root = scratch_path(spark, "exports")
    words = materialise(Warehouse(spark, sf_dir).probabilities)
    lifecycle.export_probabilities(words.filter(F.col("source") == "truth"), root, dt.date(2025, 1, 1))
    lifecycle.export_probabilities(words, root, dt.date(2025, 1, 2))
    try:
        lifecycle.export_probabilities(words.limit(0), root, dt.date(2025, 1, 1))
    except ValueError:
        refused = True
    else:
        refused = False
    return export.read_latest_export(spark, root).select(F.col("value").alias("json"), F.lit(refused).alias("refused"))


@query
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = derived.table(spark, sf_dir, "orders")
    month = F.date_format("o_orderdate", "yyyy-MM")
    snapshots = orders.groupBy(month.alias("logical_date")).agg(
        F.max("o_orderkey").alias("created_ts")
    )
    return export.latest_snapshot(snapshots)


# --- words and puzzles -----------------------------------------------------


@query
def letter_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = derived.table(spark, sf_dir, "documents")
    words = texts.select(F.explode(F.split("text", r"\s+")).alias("word")).distinct()
    return matching.with_letter_set(words)


@query
def eligible_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.eligible_words(Warehouse(spark, sf_dir).vocabulary)


@query
def letter_set_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = matching.letter_set_index(Warehouse(spark, sf_dir).vocabulary, ["n"])
    entry = F.transform("rows", lambda r: F.concat_ws(":", r["word"], r["n"]))
    return index.select("letter_set", _long("part"), F.array_join(entry, ",").alias("rows"))


@query
def puzzle_letter_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = matching.eligible_words(Warehouse(spark, sf_dir).vocabulary)
    keys = matching.puzzle_letter_keys(derived.puzzles(listed))
    return keys.select(_day("puzzle_date"), "center_letter", "outer_letters", "letter_set")


@query
def matching_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    house = Warehouse(spark, sf_dir)
    found = matching.matching_words(house.puzzles, house.words)
    return found.select(_day("puzzle_date"), "center_letter", "outer_letters", "letter_set", "word", "n")


@query
def match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of every letter of every puzzle as its centre, by subset sums; no match is listed."""
    house = Warehouse(spark, sf_dir)
    letters = house.puzzles.select(F.concat("center_letter", "outer_letters").alias("letters"))
    return subset_counts.center_counts(subset_counts.subset_tables(letters, house.words))


@query
def word_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decision_text(Warehouse(spark, sf_dir).decisions)


@query
def decision_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = matching.with_decision_dates(Warehouse(spark, sf_dir).decisions)
    return rows.select("word", _day("puzzle_date"), _long("year"), _long("month"), _long("day"))


@query
def backfill_month_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = matching.with_decision_dates(Warehouse(spark, sf_dir).decisions)
    return matching.month_counts(rows).select(_long("year"), _long("month"), "n")


@query
def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year is backfilled, then again without February, which is cleared."""
    db = _new_db(spark)
    house = Warehouse(spark, sf_dir)
    documents = materialise(derived.puzzle_documents(house.answers))
    lifecycle.backfill_year(documents, house.raw_words, db, 2018)
    fewer = documents.filter(~F.col("printDate").startswith("2018-02"))
    lifecycle.backfill_year(fewer, house.raw_words, db, 2018)
    return _decision_text(spark.table(f"{db}.word_decisions"))


@query
def raw_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Warehouse(spark, sf_dir).raw_words
    return rows.select("word", "letter_set", _long("version"), _day("date_added"))


@query
def version_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.version_counts(Warehouse(spark, sf_dir).raw_words).select(_long("version"), "n")


@query
def decision_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = matching.with_decision_dates(Warehouse(spark, sf_dir).decisions)
    return matching.decision_partitions(rows).select(_long("year"), _long("month"))


# --- enrichment and states -------------------------------------------------


@query
def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = ranking.assign_batches(derived.vocabulary(spark, sf_dir).select("word"), 100)
    return assigned.select("word", "rank", _long("batch_id"))


@query
def batched_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of the words of even length, then of all; the caller's function counts vowels."""

    def share_of_vowels(words: list[str]) -> dict[str, float]:
        return {w: sum(w.count(v) for v in "aeiou") / len(w) for w in words}

    words = materialise(derived.vocabulary(spark, sf_dir).select("word"))
    path = scratch_path(spark, "enriched")
    enrich.collect_frequencies(words.filter(F.length("word") % 2 == 0), share_of_vowels, path, 1000)
    found = enrich.collect_frequencies(words, share_of_vowels, path, 1000)
    return found.select("word", _double("frequency"), _long("batch_id"))


@query
def batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = derived.vocabulary(spark, sf_dir).select("word")
    log = ranking.batch_log(ranking.assign_batches(words, 1000))
    return log.select(_long("batch_id"), "start_idx", "end_idx", "first_word", "last_word", "n_words")


@query
def latest_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's newest event value; customers without events get 0."""
    keys = derived.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("word"))
    return enrich.latest_frequency(keys, _event_series(spark, sf_dir), ["ts", "event_id"], "value")


def _event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = derived.table(spark, sf_dir, "events")
    return events.select(F.col("user_id").alias("word"), "ts", "event_id", "value")


@query
def frequency_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = enrich.frequency_series(
        _event_series(spark, sf_dir), "word", ["ts", "event_id"], "value", 1000
    )
    text = F.array_join(F.transform("series", lambda v: F.format_string("%.2f", v)), ",")
    return series.select("word", "chunk", text.alias("series"))


@query
def corpus_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.vocabulary(spark, sf_dir)


@query
def mean_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = derived.table(spark, sf_dir, "embeddings")
    pooled = enrich.mean_pool(vectors, "label")
    return pooled.select(_long("label"), F.posexplode("embedding").alias("position", "v")).select(
        "label", _long("position"), F.round("v", 6).alias("mean")
    )


@query
def validate_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.validate_embeddings(derived.table(spark, sf_dir, "embeddings"), expected_length=64)


@query
def words_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Warehouse(spark, sf_dir).joined_words.select(
        "word", "letter_set", _day("date_added"), _long("version"), _double("frequency"), _vector()
    )


@query
def missing_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.missing_patterns(Warehouse(spark, sf_dir).joined_words)


@query
def incomplete_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.incomplete_words(Warehouse(spark, sf_dir).joined_words).select(
        "word", "letter_set", _double("frequency"), _vector()
    )


@query
def count_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    house = Warehouse(spark, sf_dir)
    frames = {
        "words": house.words,
        "frequencies": house.frequencies,
        "embeddings": house.embeddings,
        "joined": house.joined_words,
    }
    return enrich.count_reconcile(frames)


@query
def gated_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All joined words are offered to a table with gates, which refuses them; then the complete ones.

    Rows at fault per gate as the writes counted them, with the table's version afterwards.
    """
    joined = Warehouse(spark, sf_dir).joined_words
    broken = {f"{c}_missing": F.col(c).isNull() for c in enrich.CHECKED_COLUMNS}
    broken["embedding_broken"] = F.col("embedding").isNotNull() & ~embedding_is_valid(F.col("embedding"), 64)
    found, complete = [], joined
    for condition in broken.values():
        complete = complete.filter(~condition)
    table = VersionedTable(spark, scratch_path(spark, "gated"), ["version"])
    for offer, rows in (("all", joined), ("complete", complete)):
        try:
            gates.gated_commit(table, rows, broken, F.col("word"))
            counts = gates.last_counts(table)
        except gates.GateFailure as failure:
            counts = failure.counts
        found += [(offer, table.version(), gate, n) for gate, n in counts.items()]
    return spark.createDataFrame(found, "offer string, table_version bigint, gate string, n bigint")


def _state_text(rows: DataFrame) -> DataFrame:
    return rows.select(
        "word",
        "letter_set",
        _day("last_seen_on"),
        _double("frequency"),
        _vector(),
        _double("label"),
        "batch_id",
    )


@query
def init_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state_text(Warehouse(spark, sf_dir).states_before)


@query
def latest_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Warehouse(spark, sf_dir).decisions
    return _decision_text(word_states.latest_decisions(rows))


@query
def distinct_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_states.distinct_words(Warehouse(spark, sf_dir).decisions)


@query
def new_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    house = Warehouse(spark, sf_dir)
    return word_states.new_words(house.decisions, house.words)


@query
def enrich_new_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state_text(Warehouse(spark, sf_dir).updates)


@query
def merge_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First half of the puzzles, then all, then the first half again as late data, in a log of changes."""
    states, merges, data = _three_merges(spark, sf_dir)
    log = StateLog.create(spark, scratch_path(spark, "states"), states)
    for part, batch in merges:
        update = word_states.decisions_as_updates(part, batch)
        log.merge(word_states.enrich_new_words(update, log.read(fixed=[]), data), batch)
        log.compact()
    return _state_text(log.read())


@query
def merge_states_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merges, each as a new snapshot of all states."""
    states, merges, data = _three_merges(spark, sf_dir)
    for part, batch in merges:
        update = word_states.decisions_as_updates(part, batch)
        update = word_states.enrich_new_words(update, states, data)
        states = materialise(word_states.merge_states(states, update, batch))
    return _state_text(states)


def _three_merges(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[tuple[DataFrame, str]], DataFrame]:
    """States before any puzzle, the merges' decisions with their batch ids, and data of all words."""
    house = Warehouse(spark, sf_dir)
    rows = materialise(house.decisions)
    dates = rows.agg(F.min("puzzle_date").alias("a"), F.max("puzzle_date").alias("b"))
    middle = dates.select(F.expr("date_add(a, cast(floor(datediff(b, a) / 2) as int))")).scalar()
    early = rows.filter(F.col("puzzle_date") <= middle)
    data = house.joined_words
    states = word_states.init_states(data.filter(F.col("version") == 1), derived.FIRST_BATCH)
    return states, [(early, "early"), (rows, "all"), (early, "late")], data


# --- features, training, scoring -------------------------------------------


@query
def log_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.with_log_frequency(derived.vocabulary(spark, sf_dir).withColumnRenamed("n", "frequency"))
    return rows.select("word", F.round("log_frequency", 6).alias("log_frequency"))


def _training_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings with a frequency and a label per vector."""
    vectors = derived.table(spark, sf_dir, "embeddings")
    return vectors.select(
        "vec_id",
        F.col("vec_id").cast("double").alias("frequency"),
        "embedding",
        F.when(F.col("label") >= 5, 1.0).otherwise(0.0).alias("label"),
    )


@query
def features_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.with_log_frequency(_training_frame(spark, sf_dir))
    found = features.features_v1(rows, ["vec_id"])
    long = found.select("vec_id", "label", F.posexplode("features").alias("position", "v"))
    return long.select("vec_id", "label", _long("position"), F.round("v", 6).alias("value"))


@query
def label_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.label_split_counts(Warehouse(spark, sf_dir).states)


@query
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = derived.table(spark, sf_dir, "orders")
    rows = orders.select("o_orderkey", F.col("o_orderstatus").alias("label"))
    return features.stratified_split(rows, "o_orderkey")


@query
def svd_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of every vector after projection to the full width, which keeps it."""
    rows = features.with_log_frequency(_training_frame(spark, sf_dir))
    width = rows.select(F.max(F.size("embedding"))).first()[0]
    factors, _ = hybrid.fit_svd(rows, width)
    reduced = hybrid.project(spark, factors)(F.col("embedding"))
    squares = F.aggregate(reduced, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return rows.select("vec_id", F.round(F.sqrt(squares), 4).alias("length"))


@query
def svd_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares that a projection to 8, 50 and all components keeps, with those it loses row by row.

    Kept squares come from the singular values, lost ones from the vectors: only
    for orthonormal directions with their own values both add up to all squares.
    """
    vectors = materialise(derived.table(spark, sf_dir, "embeddings").select(F.col("embedding").cast("array<double>").alias("v")))
    width = vectors.select(F.max(F.size("v"))).first()[0]
    out = None
    for k in (8, 50, width):
        factors, values = lowrank.randomised_svd(vectors, k, "v")
        lost = F.sum(lowrank.lost_squares(F.col("v"), factors))
        kept = float((values**2).sum())
        one = vectors.agg(F.count(F.lit(1)).alias("n"), F.round(lost + kept, 2).alias("squares"), (lost < 1e-6).alias("lossless"))
        one = one.select(F.lit(k).cast("bigint").alias("k"), "n", "squares", "lossless")
        out = one if out is None else out.union(one)
    return out


def _priced_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items: log quantity-times-price against whether they were returned."""
    lines = derived.table(spark, sf_dir, "lineitem")
    returned = F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)
    return lines.select(F.col("l_extendedprice").alias("log_frequency"), returned.alias("label"))


@query
def band_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = thresholds.band_candidates(_priced_rows(spark, sf_dir))
    return found.select("side", _long("i"), F.round("edge", 6).alias("edge"))


@query
def band_candidates_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same edges, narrowed by sketches and counted instead of sorted."""
    found = thresholds.band_candidates_sketched(_priced_rows(spark, sf_dir))
    return found.select("side", _long("i"), F.round("edge", 6).alias("edge"))


@query
def threshold_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = thresholds.threshold_grid(_priced_rows(spark, sf_dir))
    return grid.select(
        _long("low_i"),
        _long("high_i"),
        F.round("low", 6).alias("low"),
        F.round("high", 6).alias("high"),
        F.round("score", 9).alias("score"),
    )


@query
def best_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = thresholds.best_thresholds(thresholds.threshold_grid(_priced_rows(spark, sf_dir)))
    return best.select(*[F.round(c, 6).alias(c) for c in ("low", "high", "score")])


@query
def band_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    from anagrove.functions import band

    lines = derived.table(spark, sf_dir, "lineitem")
    routed = band(F.col("l_quantity"), F.lit(10.0), F.lit(40.0))
    return lines.select("l_orderkey", _long("l_linenumber"), "l_quantity", routed.alias("band"))


COMPONENTS = 50
# What any useful model exceeds on its own rows, and on rows it hasn't seen.
ACCURACY_FLOOR = 0.5


def _trained(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, hybrid.WordModel]:
    current = Warehouse(spark, sf_dir).states
    return current, lifecycle.train_on_states(current, COMPONENTS)


@query
def hybrid_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges that the search chose, rows per band and their classes, and whether the model beats the floor."""
    current, model = _trained(spark, sf_dir)
    rows = hybrid.training_rows(current)
    clf = model.classifier
    from anagrove.functions import band

    routed = band(F.col("log_frequency"), F.lit(clf.low_mid), F.lit(clf.mid_high))
    scored = model.transform(rows).withColumn("band", routed)
    return scored.agg(
        F.count_if(F.col("band").isin("low", "mid", "high")).alias("n"),
        *[F.count_if(F.col("band") == name).alias(f"n_{name}") for name in ("low", "mid", "high")],
        *[F.sum(F.when(F.col("band") == name, F.col("label").cast("double"))).alias(f"positive_{name}") for name in ("low", "mid", "high")],
        F.sum("label").cast("double").alias("positive"),
        (F.avg((F.col("prediction") == F.col("label")).cast("double")) > ACCURACY_FLOOR).alias("above_floor"),
        F.round(F.lit(clf.low_mid), 6).alias("low_mid"),
        F.round(F.lit(clf.mid_high), 6).alias("mid_high"),
    )


def _is_chance(column: str) -> Column:
    return F.coalesce(F.col(column).between(0, 1), F.lit(False))


LOW_EDGE, HIGH_EDGE = 0.85, 1.59


def _frequency_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows with the log frequency as their only feature."""
    rows = hybrid.training_rows(Warehouse(spark, sf_dir).states)
    return materialise(rows.select("label", "log_frequency", array_to_vector(F.array("log_frequency")).alias("features")))


@query
def banded_naive_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routing, fit and prediction by value: naive Bayes in every band, one chance per frequency and label."""
    rows = _frequency_rows(spark, sf_dir)
    bands = {name: hybrid.BandSpec(NaiveBayes(modelType="gaussian")) for name in hybrid.BANDS}
    scored = hybrid.FrequencyBandClassifier(LOW_EDGE, HIGH_EDGE, bands).fit(rows).transform(rows)
    each = scored.groupBy(F.round("log_frequency", 6).alias("log_frequency"), _double("label"))
    return each.agg(
        F.count(F.lit(1)).alias("n"), F.max("prediction").alias("prediction"), F.round(F.max("probability"), 6).alias("probability")
    )


@query
def banded_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balanced logistic regression at its optimum: weighted chances add up as labels do, the slope of the objective is 0."""
    rows = _frequency_rows(spark, sf_dir)
    spec = hybrid.default_bands()["mid"]
    model = hybrid.FrequencyBandClassifier(-1.0, 1e9, {"mid": spec}).fit(rows)
    beta, total = float(model.models["mid"].coefficients[0]), rows.count()
    classes = features.class_weights(rows)
    scored = model.transform(rows).join(classes.select(F.col("label").alias("_class"), "weight"), F.col("label") == F.col("_class"))
    error = F.col("weight") * (F.col("probability") - F.col("label"))
    penalty = beta / (spec.inverse_regularization * total)
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.col("weight") * F.col("probability")) / F.count(F.lit(1)), 5).alias("weighted_chance"),
        F.round(F.abs(F.sum(error * F.col("log_frequency")) / total + penalty), 4).alias("slope"),
    )


@query
def forest_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First splits of a forest on the log frequency in tenths, by value: no other cut lowers the impurity more.

    Fitted without resampling, so each tree has to find the best cut of all rows.
    """
    rows = hybrid.training_rows(Warehouse(spark, sf_dir).states)
    tenths = F.round("log_frequency", 1)
    rows = materialise(rows.select(_double("label"), array_to_vector(F.array(tenths)).alias("features")))
    forest = RandomForestClassifier(numTrees=2, maxDepth=1, maxBins=256, bootstrap=False, seed=0)
    nodes = forest_proof.forest_nodes(spark, forest.fit(rows))
    return forest_proof.split_gains(rows, nodes, 1).select(
        _long("tree"),
        "n",
        F.round("impurity", 9).alias("impurity"),
        F.round("gain", 9).alias("gain"),
        F.round("fitted_gain", 9).alias("fitted_gain"),
    )


@query
def hybrid_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every training row with its label and band, and whether its prediction follows from its chance."""
    from anagrove.functions import band

    current, model = _trained(spark, sf_dir)
    scored = model.transform(hybrid.training_rows(current))
    routed = band(F.col("log_frequency"), F.lit(model.classifier.low_mid), F.lit(model.classifier.mid_high))
    follows = F.abs(F.col("prediction") - F.col("probability")) <= 0.5
    return scored.select("word", _double("label"), routed.alias("band"), (_is_chance("probability") & follows).alias("sound"))


@query
def score_unlabeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every undecided word that can be scored, and whether it got a chance."""
    current, model = _trained(spark, sf_dir)
    scored = hybrid.score_unlabeled(current, model)
    return scored.select("word", "letter_set", _is_chance("probability").alias("scored"))


@query
def score_with_model_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A caller's own model, here an arithmetic one, over all vectors."""

    def predict(scale, logs, vectors):
        return scale * (vectors[:, 0] > 0) + 0.25 * (logs >= 2)

    scorer = hybrid.python_scorer(spark, 0.5, predict)
    rows = _training_frame(spark, sf_dir)
    return rows.select("vec_id", scorer("frequency", "embedding").cast("double").alias("probability"))


@query
def holdout_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split, fit on the training part alone, and measure on the test part."""
    found = lifecycle.evaluate_on_holdout(Warehouse(spark, sf_dir).states, COMPONENTS)
    return found.select(
        _double("label"), "n", (F.col("auc").between(0, 1) & F.col("f1").between(0, 1) & F.col("accuracy").between(0, 1)).alias("measured")
    )


@query
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest difference between a model's scores before and after a reload."""
    current, model = _trained(spark, sf_dir)
    path = scratch_path(spark, "model")
    model.save(spark, path)
    again = hybrid.WordModel.load(spark, path)
    rows = hybrid.training_rows(current).select("word", "frequency", "embedding")
    first = model.transform(rows).select("word", F.col("probability").alias("a"))
    second = again.transform(rows).select("word", F.col("probability").alias("b"))
    both = first.join(second, "word", "full_outer")
    return both.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("a") - F.col("b"))).alias("difference")
    )


@query
def gnb_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.with_log_frequency(_training_frame(spark, sf_dir))
    stats = features.class_statistics(features.features_v1(rows, ["vec_id"]))
    return stats.select(
        "label",
        _long("feature"),
        "n",
        F.round("mean", 6).alias("mean"),
        F.round("variance", 6).alias("variance"),
    )


@query
def gnb_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive Bayes on the training frame: confusion of its own rows."""
    rows = features.with_log_frequency(_training_frame(spark, sf_dir))
    found = features.features_v1(rows, ["vec_id"])
    found = found.withColumn("features", array_to_vector("features"))
    model = NaiveBayes(modelType="gaussian").fit(found)
    return metrics.confusion(model.transform(found))


@query
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = derived.table(spark, sf_dir, "lineitem")
    weights = features.class_weights(lines, "l_returnflag")
    return weights.select("l_returnflag", "n", F.round("weight", 9).alias("weight"))


@query
def word_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Warehouse(spark, sf_dir).probabilities
    return rows.select(
        "word",
        "letter_set",
        _day("last_seen_on"),
        _double("probability"),
        "source",
        F.col("model_version").cast("string").alias("model_version"),
        "batch_id",
    )


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items: price as the score of being returned."""
    lines = derived.table(spark, sf_dir, "lineitem")
    guess = F.when(F.col("l_extendedprice") >= 50000, 1.0).otherwise(0.0)
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_key"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"),
        guess.alias("prediction"),
        F.col("l_extendedprice").alias("score"),
    )


@query
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(_predictions(spark, sf_dir))


@query
def binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.binary_metrics(_predictions(spark, sf_dir))
    return found.select("n", F.round("accuracy", 9).alias("accuracy"), F.round("f1", 9).alias("f1"))


@query
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.roc_auc(_predictions(spark, sf_dir)).select(F.round("auc", 9).alias("auc"))


@query
def error_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    slices = metrics.error_slices(_predictions(spark, sf_dir), "row_key")
    return slices.select("slice", "row_key", "label", "prediction", "score", _long("position"))


# --- serving ---------------------------------------------------------------


def _ranked(rows: DataFrame) -> DataFrame:
    return rows.select("word", "letter_set", _double("probability"), "source")


@query
def top_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(serving.top_probabilities(Warehouse(spark, sf_dir).probabilities))


@query
def bottom_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Warehouse(spark, sf_dir).probabilities
    return _ranked(serving.top_probabilities(rows, descending=False))


@query
def letter_set_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = serving.letter_set_groups(Warehouse(spark, sf_dir).probabilities)
    words = F.array_join(F.transform("data", lambda r: r["word"]), ",")
    chance = F.aggregate("data", F.lit(0.0), lambda s, r: s + r["probability"].cast("double"))
    return groups.select("letter_set", _long("part"), words.alias("words"), chance.alias("total"))


@query
def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = serving.letter_set_groups(Warehouse(spark, sf_dir).probabilities)
    rows = serving.export_rows(groups)
    return rows.select("letter_set", F.explode("data").alias("d")).select("letter_set", "d.*")


@query
def solve_puzzle(spark: SparkSession, sf_dir: str) -> DataFrame:
    house = Warehouse(spark, sf_dir)
    solved = serving.solve_puzzles(house.puzzles, house.probabilities)
    return solved.select(
        _day("puzzle_date"),
        "center_letter",
        "outer_letters",
        "letter_set",
        "word",
        _double("probability"),
        "source",
    )


@query
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream all puzzle documents into versioned decisions and a state log; returns the states."""
    db, store = _new_db(spark), scratch_path(spark, "store")
    house = Warehouse(spark, sf_dir)
    source = scratch_path(spark, "puzzles")
    export.write_puzzles(derived.puzzle_documents(house.answers), source, by_month=True)
    tables.create_table(house.joined_words, "words", db)
    log = StateLog.create(spark, f"{store}/word_states", house.states_before)
    stream = ingest_puzzles(spark, source, db, scratch_path(spark, "stream"), multi_line=False, store=store)
    stream.awaitTermination()
    return _state_text(log.read())
