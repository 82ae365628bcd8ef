"""Merkle manifest of a dataset, with levels kept as concatenated hex strings.

Rows are leaves of one tree per group, in the order of their ids; the groups'
roots are leaves of one more tree. ``ARITY`` consecutive nodes have the digest of
their concatenated hex digests as parent, the last run may be shorter.

Nodes are dealt into aligned blocks of ``BLOCK`` positions. A block keeps each
level as one hex string: fixed-width substrings of a level are hashed to the next,
and a node's siblings are the substrings that flank it. Tops of blocks are the
nodes of the next round, until a block holds the whole level. Proofs come down the
same way: a block gets the path above its top once, for all its nodes.

Defined cases: null fields hash as ``-``; rows without an id come first within
their group, ties are ordered by digest, repeated rows have a place each; null is
a group of its own and the first; a lone leaf is its group's root, a lone group's
root the root; other columns are ignored unless carried; an empty table gives no
rows and has no root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anagrove.operators.ranking import global_rank
from anagrove.session import materialise

ARITY = 3
HEIGHT = 6
BLOCK = ARITY**HEIGHT
WIDTH = 64
EMPTY = "cast(array() as array<struct<left: string, right: string>>)"


def sha256(value: Column) -> Column:
    return F.sha2(value, 256)


def leaf_digest(*fields: Column) -> Column:
    """Digest of the fields, each with its length in bytes, so that no two rows read alike."""

    def framed(value: Column) -> Column:
        shown = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))

    return sha256(F.concat(*map(framed, fields)))


def _steps(n: Column) -> Column:
    """Levels to climb within a block, in a tree whose level has ``n`` nodes."""
    steps = F.lit(HEIGHT)
    for k in reversed(range(HEIGHT)):
        steps = F.when(n <= ARITY**k, k).otherwise(steps)
    return steps


def _next_level(level: Column) -> Column:
    """Digests of each run of ``ARITY`` digests of a level, as one hex string."""
    runs = F.sequence(F.lit(0), F.floor((F.octet_length(level) - 1) / (ARITY * WIDTH)).cast("int"))
    run = lambda i: sha256(F.substring(level, i * (ARITY * WIDTH) + 1, F.lit(ARITY * WIDTH)))
    return F.encode(F.array_join(F.transform(runs, run), ""), "utf-8")


def _blocks(nodes: DataFrame) -> DataFrame:
    """One row per tree and block: its nodes in order, and its ``levels`` from their digests up.

    ``nodes``: ``tree``, ``position``, ``n`` (nodes of the tree at this level),
    ``digest``, and whatever ``nodes`` carries.
    """
    keys = ("tree", "position", "n")
    item = F.struct("position", *[c for c in nodes.columns if c not in keys])
    dealt = nodes.groupBy("tree", "n", F.floor(F.col("position") / BLOCK).alias("block"))
    held = dealt.agg(F.sort_array(F.collect_list(item)).alias("items"))
    first = F.encode(F.array_join(F.col("items.digest"), ""), "utf-8")
    # One step per level; the last entry of the accumulator is the level to climb from.
    climb = F.reduce(
        F.filter(F.sequence(F.lit(0), F.lit(HEIGHT - 1)), lambda k: k < _steps(F.col("n"))),
        F.array(first),
        lambda levels, _: F.concat(levels, F.array(_next_level(F.element_at(levels, F.lit(-1))))),
    )
    return held.withColumn("levels", climb)


def _flanks(i: Column, levels: Column) -> Column:
    """Per level of a block, what stands left and right of node ``i``'s ancestor in its run."""

    def at(k: Column) -> Column:
        place = F.floor(i / F.pow(F.lit(ARITY), k)).cast("int")
        within = place % ARITY * WIDTH
        start = (place - place % ARITY) * WIDTH + 1
        level = F.element_at(levels, k + 1)
        left = F.substring(level, start, within)
        right = F.substring(level, start + within + WIDTH, F.lit((ARITY - 1) * WIDTH) - within)
        return F.struct(F.decode(left, "utf-8").alias("left"), F.decode(right, "utf-8").alias("right"))

    heights = F.filter(F.sequence(F.lit(0), F.lit(HEIGHT)), lambda k: k < F.size(levels) - 1)
    return F.transform(heights, at)


def _top() -> Column:
    return F.decode(F.element_at("levels", -1), "utf-8")


class _Forest:
    """Trees over ``nodes``, as the written blocks of each round."""

    def __init__(self, nodes: DataFrame):
        self.rounds = [materialise(_blocks(nodes))]
        while self.rounds[-1].filter(F.col("n") > BLOCK).limit(1).count():
            below = self.rounds[-1].filter(F.col("n") > BLOCK)
            tops = below.select(
                "tree", F.col("block").alias("position"), F.ceil(F.col("n") / BLOCK).alias("n"), _top().alias("digest")
            )
            self.rounds.append(materialise(_blocks(tops)))

    def roots(self) -> DataFrame:
        """``tree`` and ``subroot``."""
        done = [r.filter(F.col("n") <= BLOCK).select("tree", _top().alias("subroot")) for r in self.rounds]
        union = done[0]
        for more in done[1:]:
            union = union.union(more)
        return union

    def paths(self, above: DataFrame) -> DataFrame:
        """Columns of the nodes with ``path``, and what ``above`` has per ``tree``.

        ``above`` has the path from each tree's root on; paths run from leaf to root.
        """
        extra = [c for c in above.columns if c not in ("tree", "path")]
        at_root = known = above.withColumn("block", F.lit(0).cast("long"))
        for k, blocks in reversed(list(enumerate(self.rounds))):
            # Trees that end in this round have block 0 alone; the others' tops are nodes of the next.
            joined = blocks.join(known, ["tree", "block"])
            each = joined.select(
                "tree", *extra, F.col("path").alias("_above"), "levels", F.posexplode("items").alias("_i", "_item")
            )
            here = each.select(
                "tree", *extra, "_item.*", F.concat(_flanks(F.col("_i"), F.col("levels")), F.col("_above")).alias("path")
            )
            if k:
                ends = self.rounds[k - 1].filter(F.col("n") <= BLOCK).select("tree").distinct()
                nodes = here.select("tree", *extra, "path", F.col("position").alias("block"))
                known = materialise(nodes.unionByName(at_root.join(ends, "tree", "left_semi")))
        return here


def prove(
    leaves: DataFrame, group_col: str = "source", id_col: str = "doc_id", leaf_col: str = "leaf", carry: tuple[str, ...] = ()
) -> DataFrame:
    """Id, ``leaf``, ``subroot``, ``root``, ``path`` and carried columns per row of ``leaves``.

    ``path`` has, per level from the leaf to the root, the concatenated digests to
    the left and right of the own one. ``fold`` and ``proof_digest`` read it.
    """
    named = [F.col(group_col).alias("_group"), F.col(id_col).alias("_id"), F.col(leaf_col).alias("digest")]
    kept = [F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)]
    # The number of the row in the written table parts repeated rows.
    written = materialise(leaves.select(*named, *kept).withColumn("_row", F.monotonically_increasing_id()))
    order = ["_group", "_id", "digest", "_row"]
    ranked = materialise(global_rank(written, [F.col(c).asc_nulls_first() for c in order], "_rank"))
    groups = ranked.groupBy("_group").agg(F.min("_rank").alias("_first"), F.count(F.lit(1)).alias("n"))
    trees = materialise(global_rank(groups, [F.col("_group").asc_nulls_first()], "tree"))
    own = ranked.withColumnRenamed("_group", "_g").join(trees, F.col("_g").eqNullSafe(F.col("_group")))
    nodes = own.select("tree", (F.col("_rank") - F.col("_first")).alias("position"), "n", "digest", "_id", *[f"_c{i}" for i in range(len(carry))])
    forest = _Forest(nodes)
    subroots = forest.roots()
    size = trees.count()
    crown = _Forest(
        subroots.select(
            F.lit(0).cast("long").alias("tree"), (F.col("tree") - 1).alias("position"), F.lit(size).cast("long").alias("n"), F.col("subroot").alias("digest")
        )
    )
    root = crown.roots().first()
    start = leaves.sparkSession.range(1).select(F.col("id").alias("tree"), F.expr(EMPTY).alias("path"))
    above = materialise(crown.paths(start).select((F.col("position") + 1).alias("tree"), F.col("digest").alias("subroot"), "path"))
    return forest.paths(above).select(
        F.col("_id").alias(id_col),
        F.col("digest").alias(leaf_col),
        "subroot",
        F.lit(root.subroot if root else None).cast("string").alias("root"),
        "path",
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)],
    )


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, from the leaf to the root, left to right."""
    return sha256(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""))


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and its siblings lead to."""
    return F.reduce(path, leaf, lambda own, p: sha256(F.concat(p["left"], own, p["right"])))
