"""A corpus-wide lexicon in two parts: frequent entries go to every worker, the rest are joined.

The frequent part holds entries that make up at least a fixed share of all occurrences, so it has at most 1 / share rows
whatever the corpus is, and no entry that remains to be joined can be hot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries with at least this share of all occurrences are sent to every worker: two million of them at most.
HOT_SHARE = 1 / 2_000_000
#: Distinct entries that a worker gathers before it hands their counts on.
GATHERED = 300_000


class Gatherer:
    """Adds up counts of strings over slices, in bounded memory."""

    def __init__(self, schema: pa.Schema):
        self.parts: list[pa.Table] = []
        self.rows, self.schema = 0, schema

    def add(self, values: pa.Array, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(pa.table({"entry": values.cast(pa.large_string()), "n": counts}))
        self.rows += len(values)
        if self.rows > 2 * GATHERED:
            self._merge()
            if self.rows > GATHERED:
                yield from self.flush()

    def _merge(self) -> None:
        if self.parts:
            merged = pa.concat_tables(self.parts).group_by("entry", use_threads=False).aggregate([("n", "sum")])
            self.parts = [pa.table({"entry": merged["entry"], "n": merged["n_sum"]})]
            self.rows = merged.num_rows

    def flush(self) -> Iterator[pa.RecordBatch]:
        self._merge()
        for t in self.parts:
            yield from pa.Table.from_arrays([t["entry"].cast(self.schema.field(0).type), t["n"].cast(pa.int64())], schema=self.schema).to_batches(max_chunksize=20_000)
        self.parts, self.rows = [], 0


COUNTS = pa.schema([("entry", pa.string()), ("n", pa.int64())])


def count_entries(docs: DataFrame, text_col: str, entries: Callable[[pa.RecordBatch], Iterator[pa.Array]]) -> DataFrame:
    """(entry, n): occurrences of every entry over all rows; counted per worker first, then added up by entry."""

    def count(batches):
        gathered = Gatherer(COUNTS)
        for batch in batches:
            for values in entries(batch):
                found = values.value_counts()
                yield from gathered.add(found.field("values"), found.field("counts").to_numpy())
        yield from gathered.flush()

    return docs.select(F.col(text_col).alias("text")).mapInArrow(count, "entry string, n long").groupBy("entry").agg(F.sum("n").alias("n"))


def hot_from(total: int, share: float = HOT_SHARE) -> float:
    """Least number of occurrences of a frequent entry; an entry found once is never one."""
    return max(2.0, total * share)
