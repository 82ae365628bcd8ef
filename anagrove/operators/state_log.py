"""Word states as a base and a log of changes, merged when they are read.

A merge appends the updates, one row per updated word with a sequence number, so it
writes as many bytes as it gets. Readers apply a word's changes to its base row in
order, by the rules of the conditional merge: an update counts unless the state is
newer, unknown words are inserted, and a state that a batch wrote goes when a later
run of that batch lacks its word. A compaction rewrites only buckets of words whose
log has become large, in one atomic commit with the removal of that log.

A word has at most one change per merge, so its changes are few between compactions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from anagrove.operators.states import STATE_COLUMNS, once_per_word
from anagrove.sinks.versioned import Manifest, VersionedTable

BUCKETS = 16
CHANGING = ["label", "last_seen_on", "batch_id"]
FIXED = [c for c in STATE_COLUMNS if c not in ("word", *CHANGING)]
NEVER = 2**62


class StateLog:
    """States below ``path``; ``buckets`` is set by ``create`` and kept in the table's notes."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = VersionedTable(spark, path, ["bucket", "kind"])

    @classmethod
    def create(cls, spark: SparkSession, path: str, states: DataFrame, buckets: int = BUCKETS) -> StateLog:
        """Start with ``states`` as the base of sequence number 0."""
        made = cls(spark, path)
        rows = made._placed(states, "base", 0, buckets)
        base = made.table.manifest()
        if base.version:
            raise ValueError(f"{path} has states already")
        notes = {"buckets": buckets, "seq": 0, "commits": []}
        made.table.commit(base, [made.table.write(rows)], schema=rows.schema, notes=notes, alone=True)
        return made

    @staticmethod
    def _placed(rows: DataFrame, kind: str, seq: int, buckets: int) -> DataFrame:
        bucket = F.pmod(F.xxhash64("word"), F.lit(buckets)).cast("int").alias("bucket")
        return rows.select(*STATE_COLUMNS, F.lit(seq).cast("long").alias("seq"), bucket, F.lit(kind).alias("kind"))

    def merge(self, source: DataFrame, batch_id: str) -> int:
        """Append the updates of ``source`` (columns of states, a row per word); returns the sequence number.

        Words that are new need their full row in ``source``. Raises ``Conflict``
        when another merge or compaction has come between; then it can be repeated.
        """
        base = self.table.manifest()
        seq = base.notes["seq"] + 1
        rows = self._placed(once_per_word(source), "log", seq, base.notes["buckets"])
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in StructType.fromJson(base.schema)])
        notes = {"seq": seq, "commits": [*base.notes["commits"], [seq, batch_id]]}
        self.table.commit(base, [self.table.write(rows)], notes=notes, alone=True)
        return seq

    def read(self, fixed: list[str] | None = None, version: int | None = None) -> DataFrame:
        """Current states; ``fixed`` limits the columns that no update changes, so wide ones needn't be read."""
        manifest = self.table.manifest(version)
        return self._resolved(manifest, FIXED if fixed is None else fixed).drop("_bucket")

    def _resolved(self, manifest: Manifest, fixed: list[str], where=lambda own: True) -> DataFrame:
        def rows(kind: str) -> DataFrame:
            return self.table._rows(manifest, lambda own: own["kind"] == kind and where(own))

        payload = [*fixed, *CHANGING, "seq"]
        base = rows("base").select("word", "bucket", F.struct(F.lit(True).alias("alive"), *payload).alias("state"))
        entry = F.struct("seq", *[c for c in payload if c != "seq"])
        log = rows("log").groupBy("word", "bucket").agg(F.sort_array(F.collect_list(entry)).alias("changes"))
        # Left joins on either side of the union can broadcast a log that is small, by its measured size.
        known = base.join(log.drop("bucket"), "word", "left")
        unknown = log.join(base.select("word"), "word", "left_anti")
        kind = base.schema["state"].dataType
        nothing = F.struct(*[F.lit(False if f.name == "alive" else None).cast(f.dataType).alias(f.name) for f in kind.fields])
        both = known.unionByName(unknown.withColumn("state", nothing), allowMissingColumns=True)
        runs: dict[str, list[int]] = {}
        for seq, batch in manifest.notes["commits"]:
            runs.setdefault(batch, []).append(seq)

        def gone(state: Column, before: Column) -> Column:
            """A later run of the batch that wrote the state, up to ``before``, lacked the word."""
            if not runs:
                return F.lit(False)
            again = F.element_at(F.create_map(*[F.lit(x) for b, s in runs.items() for x in (b, s)]), state["batch_id"])
            return F.coalesce(F.exists(again, lambda s: (s > state["seq"]) & (s < before)), F.lit(False))

        def apply(state: Column, change: Column) -> Column:
            inserted = ~state["alive"] | gone(state, change["seq"])
            newer = state["last_seen_on"].isNull() | (change["last_seen_on"] >= state["last_seen_on"])
            updated = inserted | F.coalesce(newer, F.lit(False))

            def value(name: str) -> Column:
                if name in ("alive", "seq"):
                    return (F.lit(True) if name == "alive" else change["seq"]).alias(name)
                return F.when(updated if name in CHANGING else inserted, change[name]).otherwise(state[name]).alias(name)

            return F.struct(*[value(f.name).cast(f.dataType).alias(f.name) for f in kind.fields])

        changes = F.coalesce("changes", F.array().cast(log.schema["changes"].dataType))
        ended = both.select("word", F.col("bucket").alias("_bucket"), F.reduce(changes, F.col("state"), apply).alias("_state"))
        kept = ended.filter(F.col("_state.alive") & ~gone(F.col("_state"), F.lit(NEVER)))
        columns = [c for c in STATE_COLUMNS if c in ("word", *fixed, *CHANGING)]
        return kept.select(*[F.col(c) if c == "word" else F.col(f"_state.{c}").alias(c) for c in columns], "_bucket")

    def compact(self, ratio: float = 0.25) -> list[int]:
        """Rewrite the buckets whose log holds more than ``ratio`` of their base's bytes; returns them."""
        base = self.table.manifest()
        size: dict[tuple[int, str], int] = {}
        parts: dict[int, list[str]] = {}
        for part in base.entries:
            own = self.table.values_of(part)
            size[own["bucket"], own["kind"]] = base.bytes_of(part)
            parts.setdefault(own["bucket"], []).append(part)
        large = sorted(b for b in parts if size.get((b, "log"), 0) > ratio * size.get((b, "base"), 0))
        if not large:
            return []
        chosen = set(large)
        rows = self._resolved(base, FIXED, lambda own: own["bucket"] in chosen)
        placed = self._placed(rows, "base", base.notes["seq"], base.notes["buckets"])
        notes = {}
        if chosen == set(parts):
            notes = {"commits": []}  # every base is as new as the newest commit
        self.table.commit(base, [self.table.write(placed)], [p for b in large for p in parts[b]], notes=notes, alone=True)
        return large
