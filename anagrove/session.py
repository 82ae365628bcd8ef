"""Session-level helpers: shared storage, lineage cuts and run names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


_LOCAL_FALLBACKS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a ``local`` master may fall back to a temporary folder: there the
    driver and the executors are one process on one machine.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_CONF} must name a folder shared by the cluster")
    if context.applicationId not in _LOCAL_FALLBACKS:
        _LOCAL_FALLBACKS[context.applicationId] = tempfile.mkdtemp(prefix="anagrove-")
    return _LOCAL_FALLBACKS[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    for made in _OPEN:
        made.append(path)
    return path


_OPEN: list[list[str]] = []


@contextmanager
def stages(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, all stages that were made within.

    For callers who have used or written a result by then: a frame that still
    reads such a stage can't be computed afterwards.
    """
    made: list[str] = []
    _OPEN.append(made)
    try:
        yield
    finally:
        _OPEN[:] = [m for m in _OPEN if m is not made]
        context = spark.sparkContext
        for path in made:
            target = context._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def scratch_name(label: str) -> str:
    """A catalog identifier that no earlier run has used."""
    return f"{label}_{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder and read them back.

    The copy survives the loss of any executor. As a Parquet table, unlike a
    checkpoint, it is read by column and filter, and its size is known to the
    planner.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
