"""Stream queries over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.keyed_store import KeyedStore
from ..sources.readers import table
from ..sources.scratch import new_folder
from ..streaming.resume import process_once, windowed_counts
from ..streaming.state import first_wins
from .registry import query


def _events(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{sf}/events.parquet"
    # A stream reads folders: the pattern matches the table, be it a folder of parts or one file.
    return spark.readStream.schema(spark.read.parquet(path).schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(path if not _is_file(spark, path) else f"{sf}/events.parque[t]")


def _is_file(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isFile()


@query("""WITH f AS (SELECT user_id, event_type, event_id, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nth FROM events)
SELECT user_id, event_type, event_id, value FROM f WHERE nth = 1""")
def stream_resume_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Each key once, by a stream that is run twice over the same input: the second run finds nothing to do."""
    out, checkpoint = new_folder(spark, "stream-out"), new_folder(spark, "stream-checkpoint")
    for _ in range(2):
        process_once(_events(spark, sf), ["user_id", "event_type"], ["ts", "event_id"], out, checkpoint).awaitTermination()
    return KeyedStore(spark, out, ["user_id", "event_type"]).read().select("user_id", "event_type", "event_id", "value")


_LATEST = """WITH f AS (SELECT user_id, event_type, event_id, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS nth FROM events)
SELECT user_id, event_type, event_id, value FROM f WHERE nth = 1"""


@query(_LATEST)
def keyed_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The last event of each key: a keyed store that three batches, by time, are put into."""
    keys = ["user_id", "event_type"]
    store = KeyedStore(spark, new_folder(spark, "latest"), keys, 16)
    events = table(spark, sf, "events").select(*keys, "event_id", "ts", "value")
    cuts = events.select(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), F.array(F.lit(0.4), F.lit(0.8))).alias("c")).first()["c"]
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    for batch in (events.filter(at <= cuts[0]), events.filter((at > cuts[0]) & (at <= cuts[1])), events.filter(at > cuts[1])):
        store.upsert(batch, F.col("ts"), F.col("event_id"))
    return store.read().select(*keys, "event_id", "value")


@query("""WITH f AS (SELECT user_id, event_type, event_id, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nth FROM events)
SELECT user_id, event_type, event_id, value FROM f WHERE nth = 1""")
def stream_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    """The first event of each key by a state store: a value for each key, kept across batches and restarts."""
    out, checkpoint = new_folder(spark, "firsts-out"), new_folder(spark, "firsts-checkpoint")
    events = _events(spark, sf).select("user_id", "event_type", "event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    schema = "user_id long, event_type string, event_id long, ts timestamp, value double"

    def save(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    for _ in range(2):  # the second run goes on from the first one's state and finds nothing new
        firsts = first_wins(events, ["user_id", "event_type"], ["ts", "event_id"], schema)
        firsts.writeStream.outputMode("append").foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema).parquet(out).select("user_id", "event_type", "event_id", "value")


@query("""SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_hourly_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tumbling hourly counts of a stream, with a day for late events; its state is dropped after that."""
    out, checkpoint = new_folder(spark, "hours-out"), new_folder(spark, "hours-checkpoint")
    events = _events(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = windowed_counts(events, "ts", "event_type", "1 hour", "1 day")

    def save(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    counts.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(out)
    return rows.withColumn("start", F.col("start").cast("timestamp_ntz")).groupBy("start", "event_type").agg(F.max_by("n", "batch").alias("n"))


@query("""SELECT event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY 1""")
def event_totals(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
