"""Resumable processing of a stream of keyed items: each key is done once, across restarts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.keyed_store import KeyedStore


def dedup_within_watermark(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """First event of each key within the watermark; state is dropped as the watermark passes."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def process_once(stream: DataFrame, keys: list[str], order: list[str], path: str, checkpoint: str, work: Callable[[DataFrame], DataFrame] = lambda d: d) -> StreamingQuery:
    """Add work(item) for the first item of each key to the keyed store at `path`; keys already there are skipped.

    Offsets are in the checkpoint and results under their key, so a restart, or a batch that is run again, does nothing twice.
    A batch reads the store's buckets that its keys are in (see KeyedStore); `KeyedStore(spark, path, keys).read()` has the rows.
    """

    def batch(rows: DataFrame, _: int) -> None:
        if not rows.isEmpty():
            KeyedStore(rows.sparkSession, path, keys).insert_missing(rows, *[F.col(c) for c in order], work=work)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, key: str, width: str, delay: str) -> DataFrame:
    """Events of each key in tumbling windows, late ones up to the delay included."""
    window: Column = F.window(time, width)
    return stream.withWatermark(time, delay).groupBy(window, key).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), key, "n")
