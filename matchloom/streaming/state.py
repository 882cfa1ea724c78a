"""Arbitrary state on streams: one row a key, first come, kept in the state store until it expires."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The state store that keeps values and timers of keys: on disk, with its changes in the checkpoint.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstWins(StatefulProcessor):
    """Hands on a key's first row, by order within a batch, and nothing more until the state expires."""

    def __init__(self, order: list[str], columns: list[str], expire_ms: int | None):
        self.order, self.columns, self.expire_ms = order, columns, expire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        best = None
        for part in rows:  # a key's rows come in parts; one row is carried from part to part
            first = part.sort_values(self.order, kind="stable").head(1)
            best = first if best is None else pd.concat([best, first]).sort_values(self.order, kind="stable").head(1)
        if best is None or self.seen.exists():
            return
        now = timerValues.getCurrentProcessingTimeInMs() if self.expire_ms is not None else 0
        self.seen.update((now,))
        if self.expire_ms is not None:
            self.handle.registerTimer(now + self.expire_ms)
        yield best[self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_wins(stream: DataFrame, keys: list[str], order: list[str], schema: str, expire_ms: int | None = None) -> DataFrame:
    """The first row of each key of a stream; later ones are dropped, across batches and restarts.

    A key takes one value in the state store. With expire_ms it is forgotten that many milliseconds (processing time) after
    its first row, by a timer of its own, and a row after that is a first one again. Sets the session's state store provider.
    schema: the stream's columns.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    mode = "None" if expire_ms is None else "ProcessingTime"
    return stream.groupBy(*keys).transformWithStateInPandas(FirstWins(order, stream.columns, expire_ms), outputStructType=schema, outputMode="append", timeMode=mode)
