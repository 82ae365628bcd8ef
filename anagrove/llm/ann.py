"""Approximate nearest neighbours by an inverted multi-index.

Distinct vectors are indexed once, with the smallest ids that carry them. A query
visits cells by summed centroid distance until they hold a share of the index
that gave ``TARGET_RECALL`` on the bounded sample; what it has visited is
reranked by exact distance. Cells are stored in blocks of bounded size; a cell
larger than a block is spread over several, all of which its visitors reach.

Defined cases: rows with a null id, and vectors that are null, zero, of another
length than most, or hold null or non-finite components, take no part; rows with
equal vectors are neighbours at distance 0; ties go to the smaller id; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anagrove.llm.multi_index import Grid, centroids_for, is_valid, sample_of, vectors, visit
from anagrove.session import materialise

TARGET_RECALL = 0.95
SAMPLE_QUERIES = 64
BLOCK_ROWS = 4096


def take_part(rows: DataFrame, id_col: str, vector_col: str, label_col: str | None = None) -> DataFrame:
    """``id``, ``v`` and, if asked for, ``label`` of the rows that take part."""
    named = {"id": id_col, "v": vector_col} | ({"label": label_col} if label_col else {})
    valid = rows.select(*[F.col(c).alias(name) for name, c in named.items()]).filter(is_valid(F.col("v")))
    for name in named:
        valid = valid.filter(F.col(name).isNotNull())
    sizes = valid.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    usual = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return valid.filter(F.size("v") == (usual.d if usual else 0))


def share_to_visit(grid: Grid, sample: np.ndarray, k: int, target: float = TARGET_RECALL) -> float:
    """Share of the sample that queries of it must visit to find enough of their nearest."""
    cells = grid.cells(sample)
    count = np.bincount(cells, minlength=len(grid.first) * len(grid.second))
    shares = []
    for i in range(0, len(sample), max(1, len(sample) // SAMPLE_QUERIES)):
        one, two = grid.distances(sample[i : i + 1])
        order = np.argsort((one[0][:, None] + two[0][None, :]).ravel(), kind="stable")
        held = np.empty(len(count))
        held[order] = np.cumsum(count[order])
        distance = ((sample - sample[i]) ** 2).sum(axis=1)
        nearest = np.argsort(distance, kind="stable")[1 : k + 1]
        shares.extend(held[cells[nearest]] / len(sample))
    return float(np.quantile(shares, target)) if shares else 1.0


def blocks_of(count: np.ndarray, block_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First block of each cell, and over how many blocks its rows are spread."""
    parts = np.maximum(1, -(-count // block_rows))
    shared = np.where(parts == 1, count, 0)
    new_run = np.cumsum(shared) // block_rows
    starts = np.flatnonzero(np.diff(new_run, prepend=-1) | (parts > 1) | (np.roll(parts, 1) > 1))
    opens = np.zeros(len(count), dtype=np.int64)
    opens[starts] = parts[starts]
    upto = np.cumsum(opens)
    return upto - parts, parts


def nearest(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    target: float = TARGET_RECALL,
) -> DataFrame:
    """``query_id``, ``rank``, the id and ``score`` of the ``k`` nearest rows found per query.

    ``queries`` are rows of the same table; a query isn't its own neighbour.
    """
    spark = rows.sparkSession
    id_type = dict(rows.dtypes)[id_col]
    indexed = take_part(rows, id_col, vector_col)
    # Equal vectors: the k + 1 smallest ids suffice, and are found before the shuffle.
    by_vector = Window.partitionBy("v").orderBy("id")
    smallest = indexed.withColumn("r", F.dense_rank().over(by_vector)).filter(F.col("r") <= k + 1)
    distinct = materialise(smallest.groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids")))
    total = distinct.count()
    asked = take_part(queries, id_col, vector_col).select(F.col("id").alias("query_id"), "v")
    if not total:
        return spark.createDataFrame([], f"query_id {id_type}, rank int, `{id_col}` {id_type}, score double")
    sample = sample_of(distinct, "v")
    grid = Grid.fit(sample, centroids_for(total))
    share = share_to_visit(grid, sample, k, target)
    wanted = max(math.ceil(share * total), k + 1)

    def to_cells(batches):
        for batch in batches:
            cells = pa.array(grid.cells(vectors(batch.column(0))))
            yield pa.RecordBatch.from_arrays([*batch.columns, cells], names=["v", "ids", "cell"])

    vector_type, ids_type = dict(distinct.dtypes)["v"], dict(distinct.dtypes)["ids"]
    placed = materialise(distinct.mapInArrow(to_cells, f"v {vector_type}, ids {ids_type}, cell long"))
    n_cells = len(grid.first) * len(grid.second)
    # At most MAX_CENTROIDS ** 2 counts, however many rows there are.
    count = np.zeros(n_cells, dtype=np.int64)
    for cell, n in placed.groupBy("cell").count().toPandas().to_numpy():
        count[cell] = n
    first, parts = blocks_of(count, block_rows)

    def to_blocks(batches):
        for batch in batches:
            cells = batch.column(2).to_numpy()
            salt = np.array([hash(x) for x in vectors(batch.column(0)).sum(axis=1).tolist()])
            block = pa.array(first[cells] + salt % parts[cells])
            yield pa.RecordBatch.from_arrays([block, *batch.columns], names=["block", "v", "ids", "cell"])

    def to_visits(batches):
        for batch in batches:
            points = vectors(batch.column(0))
            row, block, cells = [], [], []
            for i, (one, two) in enumerate(zip(*grid.distances(points), strict=True)):
                held, seen = 0, []
                for _, cell in visit(one, two):
                    if count[cell]:
                        seen.append(cell)
                        held += count[cell]
                        if held >= wanted:
                            break
                seen = np.array(seen)
                own = np.repeat(seen, parts[seen])
                at = np.repeat(first[seen], parts[seen])
                within = np.arange(len(own)) - np.repeat(np.cumsum(parts[seen]) - parts[seen], parts[seen])
                at = at + within
                order = np.argsort(at, kind="stable")
                cuts = np.flatnonzero(np.diff(at[order], prepend=-1))
                row.extend([i] * len(cuts))
                block.extend(at[order][cuts])
                cells.extend(np.split(own[order], cuts[1:]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int64()), batch.column(0).take(pa.array(row, pa.int64())), pa.array(cells, pa.list_(pa.int64()))],
                names=["block", "q", "cells"],
            )

    entries = placed.mapInArrow(to_blocks, f"block long, v {vector_type}, ids {ids_type}, cell long")
    visits = asked.select("v").distinct().mapInArrow(to_visits, f"block long, q {vector_type}, cells array<long>")

    def rerank(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"q": [], "ids": [], "score": []}
        if left.num_rows and right.num_rows:
            own = vectors(left.column("v").combine_chunks())
            cell = left.column("cell").to_numpy()
            least = np.array([ids[0] for ids in left.column("ids").to_pylist()])
            points = vectors(right.column("q").combine_chunks())
            picked, query = [], []
            for i, visited in enumerate(right.column("cells").to_pylist()):
                near = np.flatnonzero(np.isin(cell, visited))
                score = np.sqrt(((own[near] - points[i]) ** 2).sum(axis=1))
                best = np.lexsort((least[near], score))[: k + 1]
                picked.append(near[best])
                query.extend([i] * len(best))
                out["score"].append(score[best])
            picked = pa.array(np.concatenate(picked))
            return pa.table(
                [right.column("q").take(pa.array(query, pa.int64())), left.column("ids").take(picked), pa.array(np.concatenate(out["score"]))],
                names=["q", "ids", "score"],
            )
        return pa.table([pa.array([], right.schema.field("q").type), pa.array([], left.schema.field("ids").type), pa.array([], pa.float64())], names=["q", "ids", "score"])

    found = entries.groupBy("block").cogroup(visits.groupBy("block")).applyInArrow(rerank, f"q {vector_type}, ids {ids_type}, score double")
    each = found.select("q", "score", F.explode("ids").alias("id"))
    by_query = Window.partitionBy("q").orderBy("score", "id")
    close = each.withColumn("r", F.row_number().over(by_query)).filter(F.col("r") <= k + 1).drop("r")
    lists = close.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("score", "id"))).alias("near"))
    answers = asked.join(lists.withColumnRenamed("q", "v"), "v")
    others = F.slice(F.filter("near", lambda n: n["id"] != F.col("query_id")), 1, k)
    return answers.select("query_id", F.posexplode(others).alias("rank", "n")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("n.id").alias(id_col), F.col("n.score").alias("score")
    )
