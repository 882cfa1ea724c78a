"""Shared helpers: tables in the folder all machines see, and word splitting on Arrow buffers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

#: Text bytes that a Python worker handles at a time; bounds its memory whatever the batch size is.
SLICE_BYTES = 4_000_000
#: A word is a maximal run of characters other than these (space and \x09-\x0D).
WORD_BREAK = r"[\x20\x09-\x0D]+"

_own_dirs: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset, a local one if all runs in one process, and an error else."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="matchloom-")
    return _own_dirs[app]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: later steps neither recompute it nor depend on executors that held it."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def release(spark: SparkSession, *written: DataFrame) -> None:
    """Delete materialized tables that nothing reads any more, and let the shuffle files of steps that are over go."""
    context = spark.sparkContext
    for df in written:
        path = context._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    context._jvm.System.gc()


def as_rows(docs: DataFrame, **columns: Column) -> DataFrame:
    """All columns of docs as one struct `row`, and columns to work with beside it: no name of docs can clash with them."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[v.alias(k) for k, v in columns.items()])


def from_rows(d: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs out of `row`."""
    return d.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def hashable(docs: DataFrame, name: str) -> Column:
    """A column as hash functions take it."""
    column = F.col(f"`{name}`")
    return F.map_entries(column) if isinstance(docs.schema[name].dataType, MapType) else column


def filtered(docs: DataFrame, text_col: str, keep: Callable[[], Callable[[pa.RecordBatch], np.ndarray]], limit: int | None = None) -> DataFrame:
    """The rows of docs that a function of their texts keeps, with all columns.

    keep() is called once in each task; what it gives gets batches with a column `text` and answers with a mask.
    """
    d = as_rows(docs, text=F.col(f"`{text_col}`"))

    def run(batches):
        mask = keep()
        for batch in slices(batches, "text", limit):
            yield batch.select(["row"]).filter(pa.array(mask(batch)))

    return from_rows(d.mapInArrow(run, d.select("row").schema), docs)


def split_of(id_col: str, modulus: int) -> "F.Column":
    """crc32 of the id written as text, modulo: the fixed train / held-out split."""
    return F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % F.lit(modulus)


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int | None = None) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about `limit` bytes of text (always at least one row)."""
    limit = limit or SLICE_BYTES
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = text_offsets(batch.column(text))[0]
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(sizes, sizes[start] + limit, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def text_offsets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (from 0) and the bytes of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_string(column.type):
        dtype = np.int32
    else:
        column, dtype = column.cast(pa.large_string()), np.int64
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype)[column.offset : column.offset + len(column) + 1].astype(np.int64) if offsets else np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return at - at[0], raw


_BREAK = np.zeros(256, bool)
_BREAK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def words_of(column: pa.Array, lower: bool = False, breaks: np.ndarray = _BREAK) -> tuple[pa.Array, np.ndarray]:
    """All words of a string column as one Arrow array, and for each row the number of words before it (rows + 1 entries).

    Only ASCII bytes separate words (those that breaks, a table of 256, names; else white space), so the work is done on
    UTF-8 bytes; lower maps A-Z alone.
    """
    at, raw = text_offsets(column)
    inside = ~breaks[raw]
    first = np.empty(len(raw), bool)
    if len(raw):
        first[0] = inside[0]
        first[1:] = inside[1:] & ~inside[:-1]
        cut = at[(at > 0) & (at < len(raw))]
        first[cut] = inside[cut]
    starts = np.flatnonzero(first)
    kept = raw[inside]
    if lower:
        upper = (kept >= 65) & (kept <= 90)
        kept = kept + (upper.astype(np.uint8) << 5)
    seen = np.cumsum(inside, dtype=np.int64)
    offsets = np.empty(len(starts) + 1, np.int64)
    offsets[:-1] = seen[starts] - 1
    offsets[-1] = len(kept)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(kept)))
    return words, np.searchsorted(starts, at)


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A fixed 64-bit mixer on uint64 arrays (finaliser of the public-domain splitmix generator)."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x += np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x ^= x >> np.uint64(30)
        x *= _M1
        x ^= x >> np.uint64(27)
        x *= _M2
        x ^= x >> np.uint64(31)
    return x


def hash_strings(values: pa.Array) -> np.ndarray:
    """64-bit hashes of distinct strings."""
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(v) for v in values.cast(pa.large_binary()).to_pylist()), np.uint64, len(values))


class HashMap64:
    """A read-only map from 64-bit hashes to positions, by binary search in sorted arrays: 8 bytes an entry, cheap to broadcast."""

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key in the array given at the start, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.order[at], -1)
