"""Resharding by minimum-cost flow.

Each old shard's rows are hashed into blocks. From the old shards' sizes and the
new shards' capacities a minimum-cost flow finds the transfers that move the
fewest bytes: bytes that stay cost nothing, others one unit each. Transfers are
rounded to whole blocks, largest blocks first. Then the files of those shards
that gain or lose a block are rewritten; the others' rows stay where they are.

The driver holds one number per shard and block: at most ``old shards *
MAX_BLOCKS``, however many rows there are. It never sees a row.

Defined cases: a null text has no bytes; a null old shard is shard 0; rows that
repeat both id and text share a block; slots follow id, then text, so ties are
among equal rows; a null id stays null; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anagrove.session import scratch_path

ROW_BYTES = 16
MIN_BLOCKS, MAX_BLOCKS = 1024, 1 << 16
BLOCK_BYTES = 64 << 20
FILE_BYTES = 128 << 20
LAW = "bytes"


def min_cost_flow(supply: list[int], demand: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Flow from each supply to each demand of the least total cost.

    Successive shortest paths with potentials; costs mustn't be negative, and
    supplies must sum to the demands.
    """
    m, n = len(supply), len(demand)
    flow = [[0] * n for _ in range(m)]
    left, need = list(supply), list(demand)
    potential = [0] * (m + n)
    while any(left):
        distance = [math.inf] * (m + n)
        came = [-1] * (m + n)
        heap = [(0, i) for i in range(m) if left[i]]
        for _, i in heap:
            distance[i] = 0
        heapq.heapify(heap)
        while heap:
            d, u = heapq.heappop(heap)
            if d > distance[u]:
                continue
            if u < m:
                steps = ((m + j, cost[u][j]) for j in range(n))
            else:
                steps = ((i, -cost[i][u - m]) for i in range(m) if flow[i][u - m])
            for v, c in steps:
                there = d + c + potential[u] - potential[v]
                if there < distance[v]:
                    distance[v], came[v] = there, u
                    heapq.heappush(heap, (there, v))
        end = min((j for j in range(n) if need[j]), key=lambda j: distance[m + j] + potential[m + j])
        path, u = [], m + end
        while came[u] >= 0:
            path.append((came[u], u))
            u = came[u]
        amount = min([left[u], need[end], *(flow[b][a - m] for a, b in path if a >= m)])
        for a, b in path:
            if a < m:
                flow[a][b - m] += amount
            else:
                flow[b][a - m] -= amount
        left[u] -= amount
        need[end] -= amount
        far = max(d for d in distance if d < math.inf)
        potential = [p + min(d, far) for p, d in zip(potential, distance, strict=True)]
    return flow


def plan_blocks(blocks: pd.DataFrame, capacity: list[int]) -> np.ndarray:
    """New shard of each block (columns ``old``, ``bytes``), following the flow.

    A block goes to the transfer with the most bytes still to fill. What rounding
    leaves uneven is evened out by single blocks, as long as that helps.
    """
    n = len(capacity)
    old, size = blocks["old"].to_numpy(), blocks["bytes"].to_numpy()
    shards = max(n, int(old.max()) + 1)
    supply = np.bincount(old, size, shards).astype(np.int64).tolist()
    cost = [[int(i != j) for j in range(n)] for i in range(shards)]
    flow = np.array(min_cost_flow(supply, list(capacity), cost), dtype=np.int64)
    target = np.zeros(len(blocks), dtype=np.int64)
    for k in np.argsort(-size, kind="stable").tolist():
        quota = flow[old[k]]
        target[k] = j = int(quota.argmax())
        quota[j] -= size[k]
    over = np.bincount(target, size, n).astype(np.int64) - np.array(capacity)
    for _ in range(len(blocks)):
        high, low = int(over.argmax()), int(over.argmin())
        own = np.flatnonzero(target == high)
        gap = over[high] - over[low]
        best = own[np.abs(2 * size[own] - gap).argmin()] if len(own) else None
        if best is None or size[best] >= gap or size[best] == 0:
            break
        target[best] = low
        over[high] -= size[best]
        over[low] += size[best]
    return target


def even_capacity(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def reshard(
    docs: DataFrame,
    old_shard: Column,
    shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: list[int] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Id, text, ``size``, ``shard`` and ``slot`` of every row in its new place.

    ``old_shard`` gives numbers from 0. New shards get ``capacity`` bytes each, by
    default equal ones. Rows of affected shards are written below ``path``, by
    shard, and read back from there; rows of the others keep their old files.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.coalesce(old_shard.cast("int"), F.lit(0)).alias("old"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
    )
    measured = rows.agg(F.sum("size")).first()[0] or 0
    per_shard = int(min(MAX_BLOCKS, max(MIN_BLOCKS, measured // BLOCK_BYTES)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", F.crc32(text.cast("binary"))), F.lit(per_shard)).cast("int"))
    blocks = rows.groupBy("old", "block").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).toPandas()
    if blocks.empty:
        return rows.select(F.col("id").alias(id_col), F.col("text").alias(text_col), "size", F.col("old").alias("shard"), F.col("size").alias("slot"))
    blocks = blocks.sort_values(["old", "block"], ignore_index=True)
    if capacity is None:
        capacity = even_capacity(int(blocks["bytes"].sum()), shards)
    blocks["shard"] = plan_blocks(blocks, capacity)
    moved = blocks[blocks["shard"] != blocks["old"]]
    affected = sorted({*moved["shard"], *moved["old"]} & set(range(shards)))
    in_shard = blocks.groupby("shard")
    blocks["start"] = in_shard["n"].cumsum() - blocks["n"]
    blocks["file"] = (in_shard["bytes"].cumsum() - blocks["bytes"]) // FILE_BYTES
    # One row per block; see the module's bound.
    plan = spark.createDataFrame(blocks[["old", "block", "shard", "start", "file"]].astype("int64"))
    placed = rows.join(F.broadcast(plan), ["old", "block"]).repartition("shard", "file")
    within = Window.partitionBy("shard", "file", "old", "block").orderBy("id", "text")
    slotted = placed.withColumn("slot", F.col("start") + F.row_number().over(within) - 1)
    final = slotted.select("id", "text", "size", F.col("shard").cast("int").alias("shard"), "slot")
    is_affected = F.col("shard").isin(affected)
    path = path or scratch_path(spark, "shards")
    final.filter(is_affected).write.partitionBy("shard").parquet(path)
    store = final.filter(~is_affected)
    if affected:
        written = spark.read.schema(final.schema).parquet(path)
        store = written if len(affected) == shards else written.unionByName(store)
    return store.select(F.col("id").alias(id_col), F.col("text").alias(text_col), "size", "shard", "slot")
