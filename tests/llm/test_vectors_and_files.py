"""Vector, archive and sharding operators against brute force and edge cases."""

import hashlib
from itertools import combinations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from anagrove.llm import ann, embedding_dedup, multi_index, sharding, warc
from anagrove.llm.components import components
from anagrove.session import materialise, scratch_path

VECTORS = "vec_id long, embedding array<float>, label int, score double"


def _cloud():
    rng = np.random.default_rng(5)
    points = np.repeat(rng.normal(size=(40, 16)), 20, axis=0) + rng.normal(size=(800, 16)) * 0.15
    points[300:330] = points[300]
    rows = [(i, [float(np.float32(x)) for x in p], i % 3, 0.0) for i, p in enumerate(points)]
    odd = [[0.0] * 16, None, [float("nan")] * 16, [1.0] * 3, [None] + [1.0] * 15, [float("inf")] * 16]
    rows += [(1000 + i, v, 0, 0.0) for i, v in enumerate(odd)]
    return rows + [(None, rows[0][1], 0, 0.0), (2000, rows[0][1], None, 0.0)]


def test_cells_come_by_rising_distance():
    rng = np.random.default_rng(1)
    one, two = rng.random(7), rng.random(5)
    order = list(multi_index.visit(one, two))
    sums = np.add.outer(one, two)
    assert len({c for _, c in order}) == len(order) == 35
    assert [t for t, _ in order] == sorted(t for t, _ in order)
    assert all(np.isclose(t, sums[c // 5, c % 5]) for t, c in order)


def test_large_cells_are_spread():
    count = np.array([3, 2, 50, 1, 9, 0, 10, 4])
    first, parts = ann.blocks_of(count, 10)
    assert parts.tolist() == [1, 1, 5, 1, 1, 1, 1, 1]
    assert not set(range(first[2], first[2] + 5)) & set(np.delete(first, 2).tolist())


def test_nearest_against_brute_force(spark):
    rows = _cloud()
    table = spark.createDataFrame(rows, VECTORS)
    usable = {i: np.array(v, dtype=np.float64) for i, v, *_ in rows if i is not None and (i < 1000 or i == 2000)}
    found = ann.nearest(table, table.filter("vec_id % 20 = 0"), k=5, block_rows=64).collect()
    asked = [i for i in usable if i % 20 == 0]
    assert {r.query_id for r in found} == set(asked)
    hits = 0
    for q in asked:
        exact = sorted((float(np.sqrt(((v - usable[q]) ** 2).sum())), i) for i, v in usable.items() if i != q)
        distance = {i: d for d, i in exact}
        own = sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == [1, 2, 3, 4, 5]
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        assert all(np.isclose(r.score, distance[r.vec_id], rtol=1e-12) for r in own)
        hits += len({r.vec_id for r in own} & {i for _, i in exact[:5]})
    assert hits >= 0.9 * 5 * len(asked)


def test_nearest_of_few(spark):
    table = spark.createDataFrame(_cloud()[:3], VECTORS)
    assert ann.nearest(table.limit(0), table.limit(0)).count() == 0
    assert ann.nearest(table, table, k=5).count() == 6


def test_links_against_brute_force(spark):
    rows = _cloud()
    usable = {i: (label, np.array(v, dtype=np.float64)) for i, v, label, _ in rows if i is not None and i < 1000}
    near = {i: set() for i, *_ in rows if i is not None}
    for (i, (a, x)), (j, (b, y)) in combinations(usable.items(), 2):
        if a == b and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
            near[i].add(j)
            near[j].add(i)
    found = embedding_dedup.link(spark.createDataFrame(rows, VECTORS), block_rows=16).collect()
    assert len(found) == len(rows)
    assert all(r.n_links <= len(near.get(r.vec_id, ())) for r in found)
    assert sum(r.n_links for r in found) >= 0.99 * sum(map(len, near.values())) > 0
    edges = spark.createDataFrame([(i, j) for i in near for j in near[i]], "a long, b long")
    root = {r.vertex: r.root for r in components(edges).collect()}
    for r in found:
        assert r.component_id == root.get(r.vec_id, r.vec_id)
        assert r.kept == (r.vec_id is None or r.component_id == r.vec_id)


def test_links_of_nothing(spark):
    assert embedding_dedup.link(spark.createDataFrame([], VECTORS)).count() == 0


def test_components_of_a_path(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(5, 5), (None, 3), (100, 99)], "a long, b long")
    found = {r.vertex: r.root for r in components(path).collect()}
    assert found == {**{i: 0 for i in range(61)}, 99: 99, 100: 99}


def test_archives_round_trip(spark):
    big = "é\r\n\r\nWARC/1.1\r\n" * 100
    rows = [
        (1, "http://www.B.com/x?q", big),
        (5, "https://a.com:8080/\r\ny", big),
        (3, None, "tiny"),
        (4, "x", "tiny"),
        (None, "u", big),
        (7, "u", None),
        (9, "u", ""),
        (9, "u", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.withColumn("captured", F.timestamp_seconds(F.lit(0))).withColumn("digest", F.lit("clash"))
    path = scratch_path(spark, "archives")
    index = warc.archive(pages.repartition(4), path).collect()
    assert len(index) == len(rows)
    found = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in index}
    digest, size = hashlib.sha1(big.encode()).hexdigest(), len(big.encode())
    assert found[1] == found[None] == (size, digest, "revisit", 5)
    assert found[5] == (size, digest, "response", None)
    assert all(found[i][2] == "response" for i in (3, 4, 7, 9)) and found[3][0] == 4 and found[7][0] == 0
    merged = warc.merge(materialise(warc.read(spark, path)), range_rows=3).collect()
    order = [(r.url_key, r.captured) for r in sorted(merged, key=lambda r: (r.range, r.position))]
    assert order == sorted(order) and len(order) == len(rows)
    assert warc.archive(pages.limit(0)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 20)), max_size=9))
def test_loser_tree_merges(runs):
    tree = warc.LoserTree([[(x,) for x in sorted(r)] for r in runs], lambda e: e)
    assert [x for (x,) in tree] == sorted(x for r in runs for x in r)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=6), st.integers(1, 6))
def test_flow_moves_the_fewest(supply, n):
    capacity = sharding.even_capacity(sum(supply), n)
    cost = [[int(i != j) for j in range(n)] for i in range(len(supply))]
    flow = sharding.min_cost_flow(supply, capacity, cost)
    assert [sum(f) for f in flow] == supply and [sum(f[j] for f in flow) for j in range(n)] == capacity
    moved = sum(cost[i][j] * flow[i][j] for i in range(len(supply)) for j in range(n))
    assert moved == sum(supply) - sum(min(s, capacity[i]) for i, s in enumerate(supply) if i < n)


def test_reshard(spark):
    length = (F.col("id") % 30).cast("int")
    rows = spark.range(400).select(
        F.when(F.col("id") % 9 > 0, F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 7 > 0, F.repeat(F.lit("é"), length)).alias("text"),
        F.lit(1).alias("slot"),
    )
    old = F.when(F.col("doc_id") < 150, 0).otherwise(F.col("doc_id") % 3)
    placed = sharding.reshard(rows, old, 5).collect()
    assert sorted((r.doc_id, r.text) for r in placed if r.doc_id and r.text) == sorted(
        (r.doc_id, r.text) for r in rows.collect() if r.doc_id and r.text
    )
    assert len(placed) == 400 and all(r.size == 16 + len((r.text or "").encode()) for r in placed)
    sizes = [sum(r.size for r in placed if r.shard == s) for s in range(5)]
    assert max(sizes) - min(sizes) <= 200
    for s in range(5):
        slots = sorted(r.slot for r in placed if r.shard == s)
        assert slots == list(range(len(slots)))
    assert sharding.reshard(rows.limit(0), F.lit(0), 3).count() == 0


def test_only_affected_shards_are_rewritten(spark):
    rows = spark.range(90).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    path = scratch_path(spark, "shards")
    old = F.when(F.col("doc_id") < 50, 0).when(F.col("doc_id") < 60, 1).otherwise(2)
    placed = sharding.reshard(rows, old, 3, capacity=[30 * 17] * 3, path=path).collect()
    assert {r.shard for r in spark.read.parquet(path).select("shard").distinct().collect()} == {0, 1}
    assert all(r.shard == 2 for r in placed if r.doc_id >= 60) and len(placed) == 90
