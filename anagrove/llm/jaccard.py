"""N-gram Jaccard join with Bayesian candidate pruning.

1. Each text becomes the set of its five-word shingles, a digest of that set and
   ``HASHES`` MinHash values. Rows with equal sets are one class.
2. Classes that agree on a band of MinHash values are candidates. Only the star
   around each bucket's smallest class is written, never a bucket's pairs; its
   connected components are clusters outside of which there is no candidate.
3. Clusters are cut into chunks of bounded size, and every two chunks of a
   cluster meet in one task. There MinHash values are compared step by step. A
   pair is dropped once the probability that its similarity reaches the
   threshold, given the agreements so far and a uniform prior, falls below the
   tolerance. The shingle sets of all other pairs are intersected exactly.
4. A task returns link counts per class and a spanning forest of its links, not
   the links. Components of the forests are the groups of near copies.

A pair at the threshold shares no band with probability (1 - 0.8^4)^32 < 1e-7 and
is pruned with about the tolerance.

Defined cases: null and wordless texts and rows with a null id link with nothing;
repeated rows are members of one class and linked with each other; other columns
are ignored; an empty table gives no rows. An id that stands for several texts
has a row for each of its rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anagrove.llm.components import components, forest
from anagrove.llm.shingles import WORDS, mix, shingles
from anagrove.session import materialise

THRESHOLD = 0.8
TOLERANCE = 1e-6
HASHES = 128
BAND_ROWS = 4
STEP = 32
CHUNK_ROWS = 512
_FACTORS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


def signature(hashes: np.ndarray) -> np.ndarray:
    """MinHash values of a non-empty shingle set."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 512):
        np.minimum(least, (hashes[at : at + 512, None] * _FACTORS).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def band_hashes(signatures: np.ndarray) -> np.ndarray:
    """One value per row and band; the band's number is part of it."""
    words = signatures.reshape(len(signatures), -1, BAND_ROWS).astype(np.uint64)
    out = np.arange(words.shape[1], dtype=np.uint64)[None, :].repeat(len(words), axis=0)
    for k in range(BAND_ROWS):
        out = mix(out * np.uint64(0x100000001B3) + words[:, :, k] + np.uint64(1))
    return out


def agreements_needed(threshold: float, tolerance: float, compared: int) -> int:
    """Fewest agreements that leave a similarity at the threshold likely enough.

    With a uniform prior the posterior after m of n agreements is Beta(m + 1,
    n - m + 1); its mass from t on equals P[Binomial(n + 1, t) <= m].
    """
    n, mass = compared + 1, 0.0
    for m in range(n):
        mass += comb(n, m) * threshold**m * (1 - threshold) ** (n - m)
        if mass >= tolerance:
            return m
    return compared


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``id``, ``key`` (digest of the shingle set, null if there is none) and ``sig`` per row."""
    narrow = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sigs = [], []
            for text in batch.column(1):
                own = shingles(text.as_py(), words)
                keys.append(_digest(own) if len(own) else None)
                sigs.append(signature(own).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())], names=["id", "key", "sig"]
            )

    return narrow.mapInArrow(run, f"id {kind}, key binary, sig binary")


def _with_bands(classes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            joined = b"".join(batch.column(1).to_pylist())
            bands = band_hashes(np.frombuffer(joined, dtype=np.uint32).reshape(-1, HASHES)).view(np.int64)
            lists = pa.ListArray.from_arrays(
                np.arange(0, bands.size + 1, HASHES // BAND_ROWS, dtype=np.int32), bands.ravel()
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["key", "bands"])

    each = classes.select("key", "sig").mapInArrow(run, "key binary, bands array<long>")
    return each.select("key", F.explode("bands").alias("bucket"))


def candidate_stars(classes: DataFrame) -> DataFrame:
    """Pairs (leader, key) of classes that share a bucket with its smallest class."""
    banded = materialise(_with_bands(classes))
    leaders = banded.groupBy("bucket").agg(F.min("key").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return banded.join(leaders.drop("n"), "bucket").filter("key <> leader").select("leader", "key").distinct()


def _chunked(members: DataFrame, chunk_rows: int) -> DataFrame:
    """Add the two chunks each member meets in: one row per block of its cluster.

    A cluster of up to ``chunk_rows`` members is one block and shares it with
    other small clusters; a larger one has a block for every two of its chunks.
    """
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    total = members.count()
    small = max(1, -(-total * 2 // chunk_rows))
    parts = F.ceil(F.col("size") / chunk_rows).cast("int")
    own = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    sized = members.join(sizes, "root").withColumn("parts", parts).withColumn("own", own)
    others = sized.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    placed = others.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    shared = F.concat(F.lit("s"), F.pmod(F.xxhash64("root"), F.lit(small)))
    paired = F.concat_ws("-", F.hex("root"), "low", "high")
    return placed.withColumn("block", F.when(F.col("parts") == 1, shared).otherwise(paired)).drop("parts", "size", "other")


def _verified(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Whether each pair's exact similarity reaches the threshold. Pairs are sorted by ``left``."""
    out = np.zeros(len(left), dtype=bool)
    cuts = np.flatnonzero(np.diff(left, prepend=-1, append=-1))
    for at, end in zip(cuts, cuts[1:], strict=False):
        own = sets[left[at]]
        others = [sets[j] for j in right[at:end]]
        lengths = np.array([len(o) for o in others])
        joined = np.concatenate(others)
        hit = own[np.minimum(np.searchsorted(own, joined), len(own) - 1)] == joined
        shared = np.add.reduceat(hit.astype(np.int64), np.concatenate([[0], np.cumsum(lengths)[:-1]]))
        out[at:end] = shared >= threshold * (len(own) + lengths - shared) - 1e-9
    return out


def pruned_pairs(
    signatures: np.ndarray, own: np.ndarray, between: tuple[int, int], threshold: float, tolerance: float
) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs left < right of a block that survive the step-wise comparison."""
    bands = band_hashes(signatures)
    low, high = np.flatnonzero(own == between[0]), np.flatnonzero(own == between[1])
    needed = {n: agreements_needed(threshold, tolerance, n) for n in range(STEP, HASHES + 1, STEP)}
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for at in range(0, len(low), 64):
        rows = low[at : at + 64]
        meet = np.zeros((len(rows), len(high)), dtype=bool)
        for k in range(bands.shape[1]):
            meet |= bands[rows, k][:, None] == bands[high, k][None, :]
        i, j = np.nonzero(meet)
        i, j = rows[i], high[j]
        if between[0] == between[1]:
            i, j = i[i < j], j[i < j]
        agreed = np.zeros(len(i), dtype=np.int64)
        for n, least in needed.items():
            part = slice(n - STEP, n)
            agreed += (signatures[i, part] == signatures[j, part]).sum(axis=1)
            keep = agreed >= least
            i, j, agreed = i[keep], j[keep], agreed[keep]
        found.append((i, j))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _block_links(threshold: float, tolerance: float):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.drop_duplicates("key").sort_values("key", ignore_index=True)
        signatures = np.frombuffer(b"".join(block["sig"]), dtype=np.uint32).reshape(-1, HASHES)
        sets = [np.frombuffer(s, dtype=np.uint64) for s in block["set"]]
        between = (block["low"].iloc[0], block["high"].iloc[0])
        left, right = pruned_pairs(signatures, block["own"].to_numpy(), between, threshold, tolerance)
        linked = _verified(sets, left, right, threshold)
        left, right = left[linked], right[linked]
        copies = block["copies"].to_numpy(dtype=np.float64)
        links = np.bincount(left, copies[right], len(block)) + np.bincount(right, copies[left], len(block))
        root = forest(len(block), left, right)
        hit = links > 0
        keys = block["key"].to_numpy()
        return pd.DataFrame({"key": keys[hit], "linked": links[hit].astype(np.int64), "near": keys[root[hit]]})

    return run


def _sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """Shingle sets of the wanted classes, from the text of each one's smallest id."""
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("rep"), F.col(text_col).alias("text")).join(wanted.select("rep", "key"), "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sets = [], []
            for text, key in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                own = shingles(text.as_py() or "", words)
                if len(own) and _digest(own) == key:
                    keys.append(key)
                    sets.append(own.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], names=["key", "set"])

    return texts.select(F.col("rep").cast(kind), "text", "key").mapInArrow(run, "key binary, set binary")


def similarity_join(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
    words: int = WORDS,
    chunk_rows: int = CHUNK_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, ``class_id``, ``n_links``, ``component_id``, ``kept``.

    ``class_id`` is the smallest id with an equal shingle set, ``n_links`` the
    number of other rows at or above the threshold, ``component_id`` the smallest
    id that links lead to. Rows outside of all classes stand alone.
    """
    sketches = materialise(sketch(docs, id_col, text_col, words))
    classes = materialise(
        sketches.filter("key is not null and id is not null")
        .groupBy("key")
        .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("sig").alias("sig"))
    )
    clusters = components(candidate_stars(classes)).withColumnRenamed("vertex", "key")
    members = materialise(clusters.join(classes, "key"))
    sets = _sets_of(docs, members, id_col, text_col, words)
    blocks = _chunked(members.drop("rep"), chunk_rows).join(sets.dropDuplicates(["key"]), "key")
    links = materialise(
        blocks.groupBy("block").applyInPandas(_block_links(threshold, tolerance), "key binary, linked long, near binary")
    )
    groups = components(links.select("near", "key")).select(F.col("vertex").alias("key"), "root")
    counts = links.groupBy("key").agg(F.sum("linked").alias("linked"))
    reps = classes.select("key", "rep", "copies").join(counts, "key", "left").join(groups, "key", "left")
    least = reps.filter("root is not null").groupBy("root").agg(F.min("rep").alias("component"))
    described = reps.join(least, "root", "left").select(
        "key",
        F.col("rep").alias("_class"),
        (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("_links"),
        F.coalesce("component", "rep").alias("_component"),
    )
    apart = F.col("key").isNull() | F.col("id").isNull()
    alone = sketches.filter(apart).select(
        F.col("id").alias(id_col),
        F.col("id").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"),
        F.col("id").alias("component_id"),
        F.lit(True).alias("kept"),
    )
    joined = sketches.filter(~apart).select("id", "key").join(described, "key")
    return joined.select(
        F.col("id").alias(id_col),
        F.col("_class").alias("class_id"),
        F.col("_links").alias("n_links"),
        F.col("_component").alias("component_id"),
        (F.col("_component") == F.col("id")).alias("kept"),
    ).unionByName(alone)
