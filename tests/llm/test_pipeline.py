"""The pipeline against its own operators."""

import corpus_pipeline
from anagrove.llm import jaccard, language, shingles, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_take_their_decisions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(None, None, None, None, None), (10**6, "", "en", "s", 0), (None, "trash idiot", "en", "s", 11)]
    extra = docs.union(docs.limit(1)).unionByName(spark.createDataFrame(odd, docs.schema))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rejected = (
        toxicity.score(extra, toxicity.fit(extra, labels)).filter("toxic"),
        language.predict(extra, language.fit(extra)).filter("lang_pred = 'und'"),
        jaccard.similarity_join(extra).filter("not kept"),
    )
    every = {r.doc_id for r in extra.collect()}
    for (_, stage), out in zip(corpus_pipeline.STAGES[:-1], rejected, strict=True):
        kept = stage(spark, extra, SF)
        assert kept.columns == docs.columns
        gone = {r.doc_id for r in out.collect()}
        assert {r.doc_id for r in kept.collect()} - {None} == every - gone - {None}


def test_stages_run_on_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_pipeline_packs_what_is_left(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    ids = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert rows and {r.doc_id for r in rows} <= ids


def test_a_row_that_shares_its_id_with_a_copy_stays(spark):
    copy = " ".join(f"word{i}" for i in range(40))
    other = " ".join(f"thing{i}" for i in range(40))
    rows = [(1, copy), (5, copy), (5, other), (7, copy + " end"), (None, "alone with some words of its own here"), (None, copy), (8, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert kept.columns == docs.columns
    found = sorted([(r.doc_id, r.text) for r in kept.collect()], key=repr)
    # The row without an id sorts first in its group.
    assert found == sorted([(None, copy), (5, other), rows[4], (8, None), (9, "")], key=repr)


def test_near_copies_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, SF).select("doc_id").collect()}
    sets = {r.doc_id: set(shingles.shingles(r.text or "").tolist()) for r in docs.collect()}
    ids = sorted(sets)
    root = {i: i for i in ids}
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 0.8 * len(x) <= len(y) <= len(x) / 0.8 and len(x & y) >= 0.8 * len(x | y):
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    assert kept == {i for i in ids if root[i] == i}
