"""The newest document per day, remembered over micro-batches.

State is keyed by day and holds one stamp: when the newest document so far was
written, and its name. A document that comes later but is older is not passed on. A
stamp expires after ``REMEMBERED``, so the state store holds as many days as that,
however long the history is; no earlier file or table is looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

REMEMBERED = timedelta(days=90)
STAMP = "modified timestamp, file_name string"
# Micro-batches without data would follow each other for ever: state that can expire asks for them.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


class NewestOfDay(StatefulProcessor):
    """Passes a day's newest document on, if it is no older than the newest before it."""

    def __init__(self, remembered: timedelta = REMEMBERED):
        self.lifetime = int(remembered.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stamp = handle.getValueState("newest", STAMP, self.lifetime)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        held = self.stamp.get() if self.stamp.exists() else None
        best = (pd.Timestamp(held[0]), held[1]) if held else None
        found = None
        for frame in rows:
            for i, row_stamp in enumerate(zip(frame["modified"], frame["file_name"], strict=True)):
                row_stamp = (pd.Timestamp(row_stamp[0]).tz_localize(None), row_stamp[1])
                if best is None or row_stamp >= best:
                    # Several rows of one file are one document's.
                    found = [frame.iloc[[i]]] if found is None or row_stamp > best else [*found, frame.iloc[[i]]]
                    best = row_stamp
        if found:
            self.stamp.update((best[0].to_pydatetime(), best[1]))
            yield pd.concat(found)

    def close(self) -> None:
        pass


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Streams that start within keep their state as this operator needs it."""
    before = {name: spark.conf.get(name) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def newest_in_stream(documents: DataFrame, remembered: timedelta = REMEMBERED) -> DataFrame:
    """Those rows of a stream of documents that are the newest of their day so far."""
    return documents.groupBy("printDate").transformWithStateInPandas(
        statefulProcessor=NewestOfDay(remembered), outputStructType=documents.schema, outputMode="Update", timeMode="ProcessingTime"
    )
