"""Partitioned tables whose commits are atomic: immutable files and a manifest per version.

A commit writes new folders and then one manifest, which names the folders of every
partition. Readers take the newest manifest, so they see all partitions of a commit
or none, and a writer that dies before its manifest leaves nothing but unused files.
Manifests are numbered. A writer whose number was taken meanwhile goes on top of the
newer version if nobody touched its partitions, else it raises ``Conflict``.

A manifest has one entry per partition and is the only thing the driver reads.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce
from typing import Any
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PART = "_part"


def _nullable(schema: StructType) -> StructType:
    """The schema with nulls allowed everywhere, as later writers may bring them."""
    return StructType.fromDDL(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema))


class Conflict(RuntimeError):
    """Another writer has changed what this commit is based on."""


@dataclass
class Manifest:
    """``entries``: folders with their bytes, per partition (its values as JSON)."""

    version: int = 0
    schema: dict | None = None
    entries: dict[str, list[tuple[str, int]]] = field(default_factory=dict)
    notes: dict[str, Any] = field(default_factory=dict)

    def bytes_of(self, part: str) -> int:
        return sum(size for _, size in self.entries.get(part, []))


class VersionedTable:
    """A table below ``path``, partitioned by the columns ``partitions``."""

    def __init__(self, spark: SparkSession, path: str, partitions: list[str]):
        self.spark, self.path, self.partitions = spark, path.rstrip("/"), partitions
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.path).getFileSystem(self._conf)

    # --- versions ---------------------------------------------------------

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/manifests/{version:020d}.json"

    def version(self) -> int:
        """The newest version, 0 before the first commit."""
        folder = self._path(f"{self.path}/manifests")
        if not self._fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)

    def manifest(self, version: int | None = None) -> Manifest:
        version = self.version() if version is None else version
        if not version:
            return Manifest()
        stream = self._fs.open(self._path(self._manifest_path(version)))
        try:
            held = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        entries = {part: [tuple(x) for x in folders] for part, folders in held["entries"].items()}
        return Manifest(version, held["schema"], entries, held["notes"])

    def _publish(self, manifest: Manifest) -> bool:
        """Write a manifest under its number; False if that number is taken."""
        jvm = self.spark._jvm
        text = json.dumps({"schema": manifest.schema, "entries": manifest.entries, "notes": manifest.notes})
        draft = self._path(f"{self.path}/drafts/{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        final = self._path(self._manifest_path(manifest.version))
        self._fs.mkdirs(final.getParent())
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri() if draft.toUri().getScheme() else self._fs.getUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            context.rename(draft, final, options)
        except Py4JJavaError as error:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    # --- reading ----------------------------------------------------------

    def read(self, version: int | None = None, where: Callable[[dict], bool] | None = None) -> DataFrame:
        """Rows of a version; ``where`` picks partitions by their values, before any file is listed."""
        return self._rows(self.manifest(version), where)

    def _rows(self, manifest: Manifest, where: Callable[[dict], bool] | None = None) -> DataFrame:
        if manifest.schema is None:
            raise ValueError(f"{self.path} has no version yet")
        schema = StructType.fromJson(manifest.schema)
        chosen = [p for p in sorted(manifest.entries) if where is None or where(self.values_of(p))]
        folders = [f"{self.path}/{folder}" for p in chosen for folder, _ in manifest.entries[p]]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def values_of(self, part: str) -> dict[str, Any]:
        """Partition values as JSON has them; null where a value is absent."""
        held = json.loads(part)
        return {c: held.get(c) for c in self.partitions}

    def part(self) -> Column:
        return F.to_json(F.struct(*self.partitions)).alias(PART)

    # --- writing ----------------------------------------------------------

    def write(
        self, df: DataFrame, watch: Callable[[DataFrame], DataFrame] | None = None
    ) -> dict[str, list[tuple[str, int]]]:
        """Write rows without a commit: their folders per partition, as the file system lists them.

        ``watch`` may add an observation to what goes into the writer.
        """
        folder = f"data/{uuid.uuid4().hex}"
        dealt = df.withColumn(PART, self.part()).hint("rebalance", PART)
        dealt = watch(dealt) if watch else dealt
        dealt.write.partitionBy(PART).parquet(f"{self.path}/{folder}")
        out = {}
        for status in self._fs.listStatus(self._path(f"{self.path}/{folder}")):
            name = status.getPath().getName()
            if name.startswith(f"{PART}="):
                size = self._fs.getContentSummary(status.getPath()).getLength()
                out[unquote(name.removeprefix(f"{PART}="))] = [(f"{folder}/{name}", size)]
        return out

    def commit(
        self,
        base: Manifest,
        add: Iterable[dict[str, list[tuple[str, int]]]] = (),
        remove: Iterable[str] = (),
        schema: StructType | None = None,
        notes: dict[str, Any] | None = None,
        alone: bool = False,
    ) -> int:
        """Publish the next version: ``remove``'s partitions start anew, ``add``'s folders join theirs.

        Versions that came after ``base`` are kept if they left the removed
        partitions as ``base`` has them; ``alone`` allows none.
        """
        removed, wanted = set(remove), _nullable(schema).jsonValue() if schema else base.schema
        current = base
        while True:
            entries = {p: list(f) for p, f in current.entries.items() if p not in removed}
            for written in add:
                for part, folders in written.items():
                    entries.setdefault(part, []).extend(folders)
            following = Manifest(current.version + 1, wanted, entries, {**current.notes, **(notes or {})})
            if self._publish(following):
                return following.version
            newer = self.manifest()
            touched = [p for p in removed if newer.entries.get(p) != base.entries.get(p)]
            if alone or touched or newer.schema != wanted:
                raise Conflict(f"{self.path}: version {newer.version} came after {base.version} and changed {touched or 'its base'}")
            current = newer

    def replace_where(self, df: DataFrame, values: dict[str, Any]) -> int:
        """Replace the rows where every column of ``values`` has its value, in all partitions at once."""
        base = self.manifest()
        schema = StructType.fromJson(base.schema) if base.schema else df.schema
        tests = [F.col(c).eqNullSafe(F.lit(v).cast(schema[c].dataType)) for c, v in values.items()]
        hit = reduce(lambda a, b: a & b, tests)
        outside = F.raise_error(F.lit("a new row lies outside the replaced range")).cast("boolean")
        fresh = self.write(df.filter(F.when(hit, True).otherwise(outside)).select(*schema.names))
        within = {c: v for c, v in values.items() if c in self.partitions}
        near = [p for p in base.entries if all(self.values_of(p)[c] == v for c, v in within.items())]
        if not near:
            return self.commit(base, [fresh], schema=schema)
        rows = self._rows(base, lambda own: all(own[c] == v for c, v in within.items()))
        if len(within) < len(values):
            held = rows.filter(hit).select(self.part()).distinct()
            lost = {r[PART] for r in held.collect()}
            survivors = self.write(self._of_parts(base, lost).filter(~hit)) if lost else {}
            return self.commit(base, [fresh, survivors], lost)
        return self.commit(base, [fresh], near)

    def replace_keys(self, df: DataFrame, keys: list[str], keys_fix_partition: bool = False) -> int:
        """Replace the rows whose ``keys`` occur in ``df``.

        With ``keys_fix_partition`` equal keys lie in one partition, so no other is read.
        """
        base = self.manifest()
        names = StructType.fromJson(base.schema).names if base.schema else df.columns
        fresh = self.write(df.select(*names))
        if not base.entries or not fresh:
            return self.commit(base, [fresh], schema=df.select(*names).schema if not base.schema else None)
        new = [f"{self.path}/{folder}" for folders in fresh.values() for folder, _ in folders]
        replaced = self.spark.read.schema(StructType.fromJson(base.schema)).parquet(*new).select(*keys).distinct()
        same = lambda rows: reduce(lambda a, b: a & b, [rows[k].eqNullSafe(replaced[k]) for k in keys])
        if keys_fix_partition:
            touched = set(fresh) & set(base.entries)
        else:
            rows = self._rows(base)
            touched = {r[PART] for r in rows.join(replaced, same(rows), "left_semi").select(self.part()).distinct().collect()}
        if not touched:
            return self.commit(base, [fresh])
        rows = self._of_parts(base, touched)
        kept = self.write(rows.join(replaced, same(rows), "left_anti"))
        return self.commit(base, [fresh, kept], touched)

    def _of_parts(self, manifest: Manifest, parts: set[str]) -> DataFrame:
        return self._rows(Manifest(manifest.version, manifest.schema, {p: manifest.entries[p] for p in parts}))

    # --- upkeep -----------------------------------------------------------

    def vacuum(self, keep: int = 3) -> list[str]:
        """Remove versions before the newest ``keep`` and the folders none of those names.

        Not to be run beside a writer, whose folders no manifest names yet.
        """
        newest = self.version()
        oldest = max(1, newest - keep + 1)
        used = {f.rsplit("/", 1)[0] for v in range(oldest, newest + 1) for e in self.manifest(v).entries.values() for f, _ in e}
        gone = []
        for status in self._fs.listStatus(self._path(f"{self.path}/data")):
            folder = f"data/{status.getPath().getName()}"
            if folder not in used:
                self._fs.delete(status.getPath(), True)
                gone.append(folder)
        for version in range(1, oldest):
            self._fs.delete(self._path(self._manifest_path(version)), False)
        return gone
