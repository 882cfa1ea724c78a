"""A table of rows by key that grows by batches: files bucketed by key, and a manifest of those that count."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .manifest import Manifest
from .scratch import materialize

#: Buckets of a new store. A batch reads and writes those that its keys are in.
BUCKETS = 64
#: Files of a bucket, by folders, from which it is put together anew.
MOST_FOLDERS = 16


class KeyedStore:
    """One row a key. The number of buckets and the schema are those of the first batch.

    Every change writes new folders and then a manifest (see Manifest), so a reader sees all of a batch or nothing, and a batch
    that fails, or is run again, leaves nothing behind that counts. Null is a key like others.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = BUCKETS):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys
        self.manifest = Manifest(spark, path)
        self.buckets = self._state()[1].get("buckets", buckets)

    def _state(self) -> tuple[int, dict]:
        number, state = self.manifest.latest()
        if state and state["keys"] != self.keys:
            raise ValueError(f"{self.path} is kept by {state['keys']}, not by {self.keys}")
        return number, state

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _rows(self, state: dict, buckets: list[int] | None = None) -> DataFrame | None:
        folders = state.get("folders", {})
        paths = [f"{self.path}/data/{f}/_bucket={b}" for b in (folders if buckets is None else map(str, buckets)) for f in folders.get(b, [])]
        return self.spark.read.schema(StructType.fromJson(state["schema"])).parquet(*paths) if paths else None

    def read(self) -> DataFrame:
        """All rows as of the last commit."""
        _, state = self._state()
        if not state:
            raise ValueError(f"nothing is kept in {self.path}")
        found = self._rows(state)
        return self.spark.createDataFrame([], StructType.fromJson(state["schema"])) if found is None else found

    def _first(self, rows: DataFrame, *order: Column) -> DataFrame:
        w = Window.partitionBy(*self.keys).orderBy(*order)
        return rows.withColumn("_nth", F.row_number().over(w)).filter("_nth = 1").drop("_nth")

    def _put(self, number: int, state: dict, rows: DataFrame, instead: list[int] | None) -> None:
        """Write rows and commit them: in the place of the buckets `instead`, or beside what there is."""
        name = f"{number + 1:012}-{uuid.uuid4().hex}"
        schema = state.get("schema") or rows.schema.jsonValue()
        rows.withColumn("_bucket", self._bucket()).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/data/{name}")
        written = [f.removeprefix("_bucket=") for f in self.manifest.folders(f"data/{name}") if f.startswith("_bucket=")]
        folders = {b: f for b, f in state.get("folders", {}).items() if instead is None or int(b) not in instead}
        for b in written:
            folders[b] = [*folders.get(b, []), name]
        self.manifest.commit(number + 1, {"keys": self.keys, "buckets": self.buckets, "schema": schema, "folders": folders})

    def _touched(self, rows: DataFrame) -> list[int]:
        return [r[0] for r in rows.select(self._bucket().alias("b")).distinct().collect()]  # as many as buckets

    def upsert(self, rows: DataFrame, *order: Column) -> None:
        """Put rows in, in the place of those of their keys; of several rows of one key the last by `order` counts.

        The buckets that the batch's keys are in are read and written anew, no others.
        """
        number, state = self._state()
        new = materialize(self._first(rows, *[c.desc() for c in order] or [F.lit(0)]), "upsert")
        touched = self._touched(new)
        old = self._rows(state, touched)
        if old is not None:
            both = old.withColumn("_age", F.lit(1)).unionByName(new.withColumn("_age", F.lit(0)))
            new = self._first(both, F.col("_age")).drop("_age")
        self._put(number, state, new, touched)

    def insert_missing(self, rows: DataFrame, *order: Column, work: Callable[[DataFrame], DataFrame] = lambda d: d) -> None:
        """Add work(row) for the first row by `order` of each key that the store lacks; keys that it has stay as they are.

        Only the keys of the buckets that the batch is in are read; new rows go into files of their own beside them. work keeps
        the keys, and is given nothing that is there already.
        """
        number, state = self._state()
        new = materialize(self._first(rows, *order or [F.lit(0)]), "insert")
        old = self._rows(state, self._touched(new))
        if old is not None:
            known = old.select(*[F.col(k).alias(f"_{k}") for k in self.keys])
            same = F.lit(True)
            for k in self.keys:
                same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
            new = materialize(new.join(known, same, "left_anti"), "missing")
            if new.isEmpty():
                return
        self._put(number, state, work(new), None)
        if any(len(f) > MOST_FOLDERS for f in self._state()[1]["folders"].values()):
            self.compact()

    def compact(self) -> None:
        """Put each bucket that lies in several folders into one."""
        number, state = self._state()
        many = [int(b) for b, f in state.get("folders", {}).items() if len(f) > 1]
        if many:
            self._put(number, state, self._rows(state, many), many)

    def vacuum(self) -> list[str]:
        """Delete the folders that the last manifest does not name: replaced ones, and what failed batches left. Not while others read older states or write."""
        used = {f for names in self._state()[1].get("folders", {}).values() for f in names}
        gone = [f for f in self.manifest.folders("data") if f not in used]
        for f in gone:
            self.manifest.delete(f"data/{f}")
        return gone
