"""The manifest against a plain tree of lists."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from anagrove.llm import merkle
from anagrove.llm.queries import op13_merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree long, path string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, text):
    return digest(*map(framed, (row.doc_id, row.source, row.lang, row.n_chars, text)))


def plain_tree(level):
    """Root, and per leaf its siblings to the left and right, level by level."""
    sides, own = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for found, at in zip(sides, own, strict=True):
            first = at // 3 * 3
            found.append(("".join(level[first:at]), "".join(level[at + 1 : first + 3])))
        level = [digest(*level[i : i + 3]) for i in range(0, len(level), 3)]
        own = [at // 3 for at in own]
    return level[0], sides


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row.source, []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    roots, inner = [], []
    for name in names:
        groups[name].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
        subroot, sides = plain_tree([leaf_of(r, r.text) for r in groups[name]])
        roots.append(subroot)
        inner.append(sides)
    root, crown = plain_tree(roots)
    out = []
    for name, subroot, sides, above in zip(names, roots, inner, crown, strict=True):
        for row, own in zip(groups[name], sides, strict=True):
            text = row.text
            if row.doc_id is not None and text is not None and zlib.crc32(str(row.doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf_of(row, text)
            for left, right in own + above:
                node = digest(left, node, right)
            proof = digest(*[a + b for a, b in own + above])
            out.append((row.doc_id, leaf_of(row, row.text), subroot, root, proof, node, node == root))
    return sorted(out, key=repr)


def rows_of(n, sources):
    return [(i, f"line {i}\nmore é\n", "en", sources[i % len(sources)], i, "own", 7, "p") for i in range(n)]


EDGES = [
    (None, "no id", "en", "a", 1, "x", 1, "y"),
    (None, None, None, None, None, None, None, None),
    (3, "", "de", "", 0, "x", 1, "y"),
    (4, "twice\n", "de", "é", 6, "x", 1, "y"),
    (4, "twice\n", "de", "é", 6, "x", 1, "y"),
    (4, "other", "de", "é", 5, "x", 1, "y"),
    (-12, "\n\n", None, "😀", 2, "x", 1, "y"),
    (5, "long\n" * 50_000, "fr", "Z", 250_000, "x", 1, "y"),
]


@pytest.mark.parametrize("given", [EDGES, EDGES[:1], rows_of(60, ["hot"] * 8 + ["b", None, "c"]), rows_of(31, [f"s{i}" for i in range(31)])])
def test_proofs_equal_plain_lists(spark, tmp_path, monkeypatch, given):
    monkeypatch.setattr(merkle, "HEIGHT", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    spark.createDataFrame(given, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet").collect()
    found = sorted([tuple(r) for r in op13_merkle(spark, str(tmp_path)).collect()], key=repr)
    assert found == brute(rows)


def test_blocks_of_full_size(spark, tmp_path):
    spark.createDataFrame(rows_of(2_400, ["hot"] * 6 + ["b"]), DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet").collect()
    assert sorted([tuple(r) for r in op13_merkle(spark, str(tmp_path)).collect()], key=repr) == brute(rows)


def test_nothing_has_no_root(spark):
    leaves = spark.createDataFrame([], "doc_id long, source string, leaf string")
    assert merkle.prove(leaves).collect() == []


def test_a_fold_with_a_wrong_sibling_fails(spark):
    leaves = spark.range(10).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), merkle.leaf_digest(F.col("id")).alias("leaf"))
    swapped = F.transform(F.col("path"), lambda p: F.struct(p["right"].alias("left"), p["left"].alias("right")))
    proofs = merkle.prove(leaves)
    good = proofs.filter(merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).count()
    bad = proofs.filter(merkle.fold(F.col("leaf"), swapped) == F.col("root")).count()
    assert (good, bad) == (10, 0)
