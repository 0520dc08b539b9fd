"""Task states and vector logs kept current by Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from medloom.operators.tasks import STATES
from medloom.sinks.keyed import KeyedTable

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows that leave the state: a task, its new state, since when, which version, and whether a timer changed it.
CHANGES = "name string, state smallint, timestamp timestamp, version bigint, timed_out boolean"
#: The same with times in microseconds, as the state store has them.
_CHANGES = "name string, state smallint, at bigint, version bigint, timed_out boolean"


def event_stream(spark: SparkSession, path: str, schema, per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).parquet(path)


@contextmanager
def _state_in_rocks(spark: SparkSession):
    """A query that starts inside keeps its state in RocksDB; the session is left as it was."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


class TaskMachine(StatefulProcessor):
    """Of each task the row of greatest time and version, kept in the state store.

    A row that is older than what is kept changes nothing.  A task that comes to be in progress gets a timer ``stuck_ms``
    after its time; if the watermark passes it and the task is still as it was, the task is queued again as of the
    timer's time.  A newer row replaces the timer.  Only changes are handed on."""

    def __init__(self, stuck_ms: int):
        self.stuck_ms = stuck_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.current = handle.getValueState("current", "state int, at bigint, version bigint")

    def _due(self, at: int) -> int:
        """When a task that is in progress since ``at`` (microseconds) is stuck, in whole milliseconds."""
        return -(-at // 1000) + self.stuck_ms

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best = max((r["at"], r["version"], r["state"]) for r in rows)
        # each question to the state store is a message to the executor: one tells whether there is a state, and only one that is
        # in progress has a timer
        before = self.current.get()
        if before is not None:
            state, at, version = before
            if best <= (at, version, state):
                return
            if state == STATES["InProgress"]:
                self.handle.deleteTimer(self._due(at))
        self.current.update((best[2], best[0], best[1]))
        if best[2] == STATES["InProgress"]:
            self.handle.registerTimer(self._due(best[0]))
        yield Row(name=key[0], state=best[2], at=best[0], version=best[1], timed_out=False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state, at, version = self.current.get()
        if state == STATES["InProgress"] and self._due(at) == expiredTimerInfo.getExpiryTimeInMs():
            at += self.stuck_ms * 1000
            self.current.update((STATES["Queued"], at, version))
            yield Row(name=key[0], state=STATES["Queued"], at=at, version=version, timed_out=True)

    def close(self) -> None:
        pass


#: Rows of which a task keeps the newest of each name, before they are shuffled.
HELD = 500_000


def _newest(rows: pa.Table) -> pa.Table:
    """Of each name the row of greatest time, version and state."""
    rows = rows.take(pc.sort_indices(rows, [("name", "ascending"), ("timestamp", "descending"), ("version", "descending"), ("state", "descending")]))
    name = rows.column("name").combine_chunks().dictionary_encode()
    code = (name.combine_chunks() if isinstance(name, pa.ChunkedArray) else name).indices.to_numpy()
    return rows.filter(pa.array(np.append(True, code[1:] != code[:-1])[: len(code)]))


def _newest_of_each(batches):
    """Older rows of a name change nothing, late or not: of up to ``HELD`` rows the newest ones go on."""
    held, n = [], 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        n += len(batch)
        if n >= HELD:
            held = [_newest(pa.concat_tables(held))]
            n = len(held[0])
            if n > HELD // 2:
                yield from held[0].to_batches()
                held, n = [], 0
    if n:
        yield from _newest(pa.concat_tables(held)).to_batches()


def state_changes(events: DataFrame, stuck: str, late: str) -> DataFrame:
    """Changes (``CHANGES``) of the tasks in a stream of name, state, timestamp and version.

    Rows that are ``late`` behind the newest one seen in earlier batches do not count (Spark leaves them out); null names, states, times
    and versions do not count.  A task that is in progress for ``stuck`` without news is queued again."""
    spark = events.sparkSession
    stuck_ms = int(spark.sql(f"SELECT cast(unix_millis(timestamp'1970-01-01 00:00:00+00:00' + interval {stuck}) AS bigint)").first()[0])
    rows = events.select(F.col("name").cast("string").alias("name"), F.col("state").cast("int").alias("state"), F.col("timestamp").cast("timestamp").alias("timestamp"), F.col("version").cast("bigint").alias("version")).dropna()
    rows = rows.mapInArrow(_newest_of_each, rows.schema)
    rows = rows.withWatermark("timestamp", late).withColumn("at", F.unix_micros("timestamp"))
    changed = rows.groupBy("name").transformWithState(statefulProcessor=TaskMachine(stuck_ms), outputStructType=_CHANGES, outputMode="Update", timeMode="EventTime")
    return changed.select("name", "state", F.timestamp_micros("at").alias("timestamp"), "version", "timed_out")


def keep_states(events: DataFrame, path: str, checkpoint: str, stuck: str = "1 day", late: str = "0 seconds", buckets: int = 64) -> StreamingQuery:
    """Current state of each task in a keyed table at ``path``: name, state, timestamp, version and timed_out.

    The states are in the stream's state store, of which the checkpoint has the versions; a restart goes on from there.
    A micro-batch writes the buckets of the tasks that it changes, and a batch that is run again gives the same table."""

    def fold(batch: DataFrame, _: int) -> None:
        KeyedTable(batch.sparkSession, path, ["name"], buckets).keep_greatest(batch, ["timestamp", "version", "timed_out", "state"])

    with _state_in_rocks(events.sparkSession):
        return state_changes(events, stuck, late).writeStream.foreachBatch(fold).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def batch_states(events: DataFrame, stuck: str, late: str) -> DataFrame:
    """What ``keep_states`` comes to if all events come in one batch."""
    rows = events.select(F.col("name").cast("string").alias("name"), F.col("state").cast("smallint").alias("state"), F.col("timestamp").cast("timestamp").alias("timestamp"), F.col("version").cast("bigint").alias("version")).dropna()
    newest = rows.groupBy("name").agg(F.max(F.struct("timestamp", "version", "state")).alias("r")).select("name", "r.*")
    mark = rows.agg((F.max("timestamp") - F.expr(f"interval {late}")).alias("mark"))
    due = F.col("timestamp") + F.expr(f"interval {stuck}")
    out = (F.col("state") == STATES["InProgress"]) & (due <= F.col("mark"))
    both = newest.join(F.broadcast(mark))
    return both.select("name", F.when(out, F.lit(STATES["Queued"])).otherwise(F.col("state")).cast("smallint").alias("state"), F.when(out, due).otherwise(F.col("timestamp")).alias("timestamp"), "version", out.alias("timed_out"))


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts per window and type with a watermark (an extension): start, event_type, n of windows that are over."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")
