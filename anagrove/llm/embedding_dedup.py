"""Near-duplicate embeddings by an inverted multi-index.

Vectors are scaled to length one; equal vectors of one label are one entry. An
entry visits cells by summed centroid distance until the distance exceeds the
nearest cell's by a margin. The margin is the one within which ``TARGET_RECALL``
of simulated partners lay: vectors of the bounded sample, turned in random
directions by the widest angle that still counts as a link. Visited entries of
the same label are verified by exact cosine.

Cells are grouped into blocks. Where a label has more than ``BLOCK_ROWS`` entries
in one block, entries and visitors are dealt out over a grid of tasks. A task
returns link counts and a spanning forest of its links, never the links.

Defined cases: rows with a null id or label, and vectors that are null, zero, of
another length than most, or hold null or non-finite components, link with
nothing and stand alone; equal vectors of a label are linked; rows that share an
id share its links; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anagrove.llm.ann import take_part
from anagrove.llm.components import components, forest
from anagrove.llm.multi_index import MAX_CENTROIDS, Grid, sample_of, vectors, visit
from anagrove.session import materialise

THRESHOLD = 0.93
TARGET_RECALL = 0.999
BLOCK_ROWS = 4096
CELL_ROWS = 64
SIMULATED = 2048


def unit(points: np.ndarray) -> np.ndarray:
    points = points / np.abs(points).max(axis=1, keepdims=True)
    return points / np.sqrt((points**2).sum(axis=1, keepdims=True))


def margin_for(grid: Grid, sample: np.ndarray, threshold: float, target: float) -> float:
    """How much farther than the nearest cell the cell of a partner lies, at the target."""
    rng = np.random.default_rng(3)
    base = sample[rng.integers(0, len(sample), SIMULATED)]
    turn = rng.normal(size=base.shape)
    turn -= (turn * base).sum(axis=1, keepdims=True) * base
    length = np.sqrt((turn**2).sum(axis=1, keepdims=True))
    turn = np.divide(turn, length, out=np.zeros_like(turn), where=length > 0)
    partner = threshold * base + math.sqrt(max(0.0, 1 - threshold**2)) * turn
    one, two = grid.distances(base)
    cell, row = grid.cells(partner), np.arange(len(base))
    there = one[row, cell // len(grid.second)] + two[row, cell % len(grid.second)]
    return float(np.quantile(there - one.min(axis=1) - two.min(axis=1), target))


def _block_links(threshold: float):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["rep", "linked", "near"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, names=names)
        own = unit(vectors(left.column("v").combine_chunks()))
        rep, copies = left.column("rep").to_numpy(), left.column("copies").to_numpy()
        visitor = right.column("rep").to_numpy()
        points = unit(vectors(right.column("v").combine_chunks()))
        ids, number = np.unique(np.concatenate([rep, visitor]), return_inverse=True)
        entry_at, visitor_at = number[: len(rep)], number[len(rep) :]
        linked = np.zeros(len(ids), dtype=np.int64)
        root = np.arange(len(ids))
        for at in range(0, len(visitor), 512):
            near = points[at : at + 512] @ own.T >= threshold
            near &= visitor[at : at + 512, None] != rep[None, :]
            i, j = np.nonzero(near)
            i = visitor_at[at + i]
            np.add.at(linked, i, copies[j])
            here = np.flatnonzero(root != np.arange(len(ids)))
            root = forest(len(ids), np.concatenate([i, here]), np.concatenate([entry_at[j], root[here]]))
        hit = (linked > 0) | (root != np.arange(len(ids)))
        return pa.table([ids[hit], linked[hit], ids[root[hit]]], names=names)

    return run


def _fitted(groups: DataFrame, total: int, threshold: float, target: float) -> tuple[Grid, float]:
    sample = unit(sample_of(groups, "v"))
    k = int(min(MAX_CENTROIDS, max(4, math.ceil(math.sqrt(total / CELL_ROWS)))))
    grid = Grid.fit(sample, k)
    return grid, margin_for(grid, sample, threshold, target)


def link(
    rows: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block_rows: int = BLOCK_ROWS,
    target: float = TARGET_RECALL,
) -> DataFrame:
    """One row per row: id, ``n_links``, ``component_id`` and ``kept``.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest id that links lead to. Ids must be integers.
    """
    keyed = take_part(rows, id_col, vector_col, label_col)
    groups = materialise(
        keyed.groupBy("label", "v").agg(F.min("id").cast("long").alias("rep"), F.count(F.lit(1)).alias("copies"))
    )
    total = groups.count()
    own = F.col(id_col)
    alone = [F.lit(0).cast("long").alias("n_links"), own.cast("long").alias("component_id"), F.lit(True).alias("kept")]
    if not total:
        return rows.select(own, *alone)
    grid, margin = _fitted(groups, total, threshold, target)
    width = len(grid.second)
    # Cells of a row of the grid are grouped so that a block stays small at any size.
    per_group = math.ceil(width / min(width, max(1, math.ceil(total / len(grid.first) / block_rows))))

    def block_of(cells: np.ndarray) -> np.ndarray:
        return cells // width * width + cells % width // per_group

    def to_blocks(batches):
        for batch in batches:
            blocks = block_of(grid.cells(unit(vectors(batch.column(0)))))
            yield pa.RecordBatch.from_arrays([pa.array(blocks), *batch.columns[1:], batch.column(0)], names=["block", "label", "rep", "copies", "v"])

    def to_visits(batches):
        for batch in batches:
            row, block = [], []
            for i, (one, two) in enumerate(zip(*grid.distances(unit(vectors(batch.column(0)))), strict=True)):
                cells, least = [], None
                for total, cell in visit(one, two):
                    least = total if least is None else least
                    if total > least + margin:
                        break
                    cells.append(cell)
                own = np.unique(block_of(np.array(cells)))
                row.extend([i] * len(own))
                block.extend(own)
            kept = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), *[c.take(kept) for c in (*batch.columns[1:], batch.column(0))]], names=["block", "label", "rep", "copies", "v"])

    types = dict(groups.dtypes)
    schema = f"block long, label {types['label']}, rep long, copies long, v {types['v']}"
    shown = groups.select("v", "label", "rep", "copies")
    entries, visits = materialise(shown.mapInArrow(to_blocks, schema)), shown.mapInArrow(to_visits, schema)
    hot = entries.groupBy("block", "label").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("parts")).filter("parts > 1")
    everywhere = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
    share = F.pmod(F.xxhash64("rep"), F.coalesce("parts", F.lit(1))).cast("int")
    on = ["block", "label"]
    entries = entries.join(hot, on, "left").withColumn("part", share).withColumn("slice", F.explode(everywhere)).drop("parts")
    visits = visits.join(hot, on, "left").withColumn("slice", share).withColumn("part", F.explode(everywhere)).drop("parts")
    task = ["block", "label", "part", "slice"]
    links = materialise(
        entries.groupBy(*task).cogroup(visits.groupBy(*task)).applyInArrow(_block_links(threshold), "rep long, linked long, near long")
    )
    linked = links.groupBy("rep").agg(F.sum("linked").alias("linked"))
    roots = components(links.select("rep", "near")).select(F.col("vertex").alias("rep"), "root")
    reps = groups.groupBy("rep", "label", "v").agg(F.max("copies").alias("copies"))
    described = reps.join(linked, "rep", "left").join(roots, "rep", "left").select(
        "label", "v", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n"), F.coalesce("root", "rep").alias("c")
    )
    per_row = keyed.join(described, ["label", "v"])
    found = per_row.groupBy("id").agg(F.max("n").alias("n_links"), F.min("c").alias("component_id"))
    joined = rows.select(own).join(found, own == found["id"], "left")
    return joined.select(
        own,
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", own.cast("long")).alias("component_id"),
        F.coalesce(F.coalesce("component_id", own.cast("long")) == own, F.lit(True)).alias("kept"),
    )
