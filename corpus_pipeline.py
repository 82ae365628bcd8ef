"""The corpus pipeline: toxicity, language, near copies, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.
Filtering stages keep the columns of ``documents``. Each row is judged with its own
text, so rows that lack or share an id are judged too: near copies are told apart and
joined back by id and digest of the text. Rows that repeat the id and text of the
document that stays, stay with it. Stages of classifiers have no SQL twin, so the
pipeline has none.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anagrove.llm import jaccard, language, packing, toxicity
from anagrove.session import materialise

ORACLE_SQL = None
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _rows(docs: DataFrame) -> DataFrame:
    """Each row as the id of its text, so that a decision carries its row along."""
    return docs.select(F.struct(*docs.columns).alias("row"), "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose severity grade is likelier 0 than above."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(_rows(docs), model, id_col="row").filter("not toxic").select("row.*")


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in one of the learned languages."""
    model = language.fit(docs)
    known = F.col("lang_pred") != language.UNKNOWN
    return language.predict(_rows(docs), model, id_col="row").filter(known).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id, then digest of the text."""
    digest = F.xxhash64("text").alias("_digest")
    own = docs.select(F.struct("doc_id", digest).alias("own"), "text")
    copies = jaccard.similarity_join(own, id_col="own").filter("not kept").select(F.col("own.doc_id").alias("_id"), "own._digest").distinct()
    same = docs["doc_id"].eqNullSafe(copies["_id"]) & (F.xxhash64(docs["text"]) == copies["_digest"])
    return docs.join(copies, same, "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    return packing.pack_documents(docs, WORD_TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("ngram_jaccard", drop_near_copies),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
