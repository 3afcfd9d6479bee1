"""Incremental runs: micro-batches over files with keyed state that expires, rolling marks and stages."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..operators.dedup import blocked, stacked
from ..operators.feed import unexpired
from ..session import materialise
from ..sources.readers import exists, read_or_empty
from ..sources.writers import delete, listed

SEEN_DAYS, CACHE_DAYS = 30, 14
DAY_MS = 86_400_000


class FirstSeen(StatefulProcessor):
    """Of each key the first row, and none again until ``days`` days of processing time after it.

    State is the time of a key's first row, and a timer that drops it. Timers run after a batch's rows, so an entry that
    has expired still blocks in the batch that drops it; a hit doesn't renew an entry.
    """

    def __init__(self, days: float, columns: list[str]):
        self.ms, self.columns = max(1, int(days * DAY_MS)), columns

    def init(self, handle) -> None:
        self.handle, self.seen = handle, handle.getValueState("seen", "first_seen long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        first = None
        for part in rows:  # one row is held, however many a key has
            head = part.sort_values(["file_", "row_"]).head(1)
            first = head if first is None else pd.concat([first, head]).sort_values(["file_", "row_"]).head(1)
        if first is None or self.seen.exists():
            return
        now = timerValues.getCurrentProcessingTimeInMs()
        self.seen.update((now,))
        self.handle.registerTimer(now + self.ms)
        yield first[self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.seen.clear()
        return iter([])

    def close(self) -> None:
        pass


#: Keyed state lives in RocksDB beside the tasks, with its changes in the checkpoint. Timers of processing time would ask for batches without rows for ever.
_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def _state_conf(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in _STATE_CONF}
    try:
        for k, v in _STATE_CONF.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def ingest(spark: SparkSession, source: str, schema: T.StructType, sink: str, checkpoint: str, days: float = SEEN_DAYS, against_sink: bool = True) -> None:
    """Take up all new files of ``source`` once: urls that weren't seen in the last ``days`` days and (with ``against_sink``) aren't in the sink are appended to it.

    What was seen is keyed state (``FirstSeen``), so a batch reads and writes its own urls only, and expired ones go. A batch that is run again, as
    after a lost commit, starts from the state before it, and the sink's log of batches keeps it from being appended twice. Of a url's rows the
    first by file and place stays; empty and blocked urls are left out.
    """
    columns = schema.names
    stream = spark.readStream.schema(schema).parquet(source)
    rows = stream.select(*columns, F.col("_metadata.file_path").alias("file_"), F.col("_metadata.row_index").alias("row_"))
    rows = rows.where((F.trim(F.coalesce("raw_url", F.lit(""))) != "") & ~blocked(F.col("raw_url")))
    if against_sink and exists(spark, sink):
        rows = rows.join(spark.read.schema(schema).parquet(sink).select("raw_url"), "raw_url", "left_anti").select(*columns, "file_", "row_")
    with _state_conf(spark):
        first = rows.groupBy("raw_url").transformWithStateInPandas(FirstSeen(days, columns), schema, "Append", "ProcessingTime")
        first.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def forget_commit(spark: SparkSession, checkpoint: str) -> None:
    """Take away a query's last commit, as a crash before it would have: its last batch is run again by the next start."""
    newest = spark.read.format("binaryFile").load(f"{checkpoint}/commits").select(F.max(F.element_at(F.split("path", "/"), -1).try_cast("long"))).first()[0]
    for name in (f"{newest}", f".{newest}.crc"):
        delete(spark, f"{checkpoint}/commits/{name}")


def seen(spark: SparkSession, checkpoint: str) -> DataFrame:
    """raw_url and first_seen (milliseconds) of the entries in the state of ``ingest``."""
    with _state_conf(spark):
        state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "seen").load()
    return state.select("key.raw_url", "value.first_seen")


CACHE = T.StructType([T.StructField("arrival", T.LongType()), T.StructField("title", T.StringType()), T.StructField("v", T.ArrayType(T.DoubleType())), T.StructField("published", T.TimestampType())])


def mark_batch(rows: DataFrame, cache: DataFrame, now: Column, days: int = CACHE_DAYS, **thresholds: float) -> tuple[DataFrame, DataFrame]:
    """Duplicates of one batch (arrival, title, v, published) against the cache of the last ``days`` days, and the next cache.

    Arrivals go on from those of the cache. Duplicates never enter it.
    """
    old = unexpired(cache, "published", now, days)
    both = old.withColumn("cached", F.lit(True)).unionByName(rows.select(*CACHE.names).withColumn("cached", F.lit(False)))
    marks = stacked(both, **thresholds)
    marked = rows.join(marks.hint("merge"), "arrival")  # both have the batch's rows, which take far fewer bytes in files than in a broadcast
    return marked, old.unionByName(marked.where(~F.col("is_duplicate")).select(*CACHE.names))


def roll(rows: DataFrame, path: str, number: int, now: Column, days: int = CACHE_DAYS, **thresholds: float) -> DataFrame:
    """``rows`` (arrival, title, v, published) of batch ``number`` with their marks against what batches before it have left in the cache at ``path``.

    A batch compares its own rows with each other and with the cache, never the cache with itself, and adds only its own kept rows, in a folder of its batch and
    days. Run again it reads the same batches before it and writes the same folder. Folders of days that are out of the window are deleted; the cache is not
    rewritten. Arrivals rise from batch to batch.
    """
    spark = rows.sparkSession
    schema = T.StructType([*CACHE.fields, T.StructField("batch", T.LongType()), T.StructField("day", T.DateType())])
    cache = read_or_empty(spark, path, schema, "parquet").where(F.col("batch") < number)
    today = F.to_date(now)
    old = unexpired(cache.where(F.col("day") >= F.date_sub(today, days + 1)).select(*CACHE.names), "published", now, days)
    both = old.withColumn("cached", F.lit(True)).unionByName(rows.select(*CACHE.names).withColumn("cached", F.lit(False)))
    # both sides have the batch's rows, which take far fewer bytes in files than in a broadcast
    marked = materialise(rows.join(stacked(both, **thresholds).hint("merge"), "arrival"), "rolled")
    fresh = marked.where(~F.col("is_duplicate")).select(*CACHE.names).withColumn("day", F.coalesce(F.to_date("published"), today))
    fresh.write.mode("overwrite").partitionBy("day").parquet(f"{path}/batch={number}")
    limit = spark.range(1).select(F.date_sub(today, days + 1).cast("string")).first()[0]
    for batch in listed(spark, path):
        there = listed(spark, f"{path}/{batch}")
        gone = [d for d in there if d.startswith("day=") and d.removeprefix("day=") < limit]
        if batch.startswith("batch=") and gone and len(gone) == len([d for d in there if d.startswith("day=")]):
            delete(spark, f"{path}/{batch}")
        else:
            for d in gone:
                delete(spark, f"{path}/{batch}/{d}")
    return marked


def first_in_window(stream: DataFrame, key: str, at: str, days: int = SEEN_DAYS) -> DataFrame:
    """Event-time form of the same for streams of any source: the first of each key within ``days`` days."""
    return stream.withWatermark(at, f"{days} days").dropDuplicatesWithinWatermark([key])


def slices(stages: dict[str, Callable[[], object]], chosen: list[str] | None = None, stop_at_failure: bool = True) -> dict[str, str]:
    """Run the chosen stages in order; what each came to. After a failure the rest is skipped, or run all the same."""
    out: dict[str, str] = {}
    for name, stage in stages.items():
        if chosen is not None and name not in chosen:
            out[name] = "skipped"
        elif stop_at_failure and any(v.startswith("failed") for v in out.values()):
            out[name] = "not run"
        else:
            try:
                stage()
                out[name] = "done"
            except Exception as e:  # a stage's failure is reported, not raised
                out[name] = f"failed: {e}"
    return out
