"""Keyed upserts, task states and incremental selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: States of a task, as persisted (fixed values).
STATES = {"Queued": 0, "InProgress": 1, "Completed": 2, "Failed": 3, "Unavailable": 4}


def last_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order``.  ``max_by`` aggregates before the shuffle, so a key with a third of
    all rows costs one row a task."""
    rest = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"r.{c}").alias(c) for c in rows.columns])


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Insert or update: new rows replace old ones of equal keys; of several new ones the last by ``order`` counts."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    return last_wins(both, keys, ["__new", *(order or [c for c in new.columns if c not in keys])]).drop("__new")


def stamped_upsert(old: DataFrame, new: DataFrame, key: str, stamp: str, now: Column) -> DataFrame:
    """An upsert that keeps the time stamp of rows whose other columns are equal, null-safe."""
    values = [c for c in new.columns if c not in (key, stamp)]
    o = old.select(key, F.struct(*values).alias("o"), F.col(stamp).alias("o_stamp"))
    n = new.select(key, F.struct(*values).alias("n"))
    j = o.join(n, key, "full")
    changed = F.col("n").isNotNull() & ~F.col("o").eqNullSafe(F.col("n"))
    out = F.coalesce("n", "o")
    return j.select(key, *[out[c].alias(c) for c in values], F.when(changed, now).otherwise(F.col("o_stamp")).alias(stamp))


def two_way_sync(local: DataFrame, remote: DataFrame, key: str, state: str, done: int) -> DataFrame:
    """Remote rows first; local rows in the done state that the remote lacks are added."""
    mine = local.where(F.col(state) == done)
    return remote.unionByName(mine.join(remote.select(key), key, "left_anti"))


def reconcile(listing: DataFrame, tasks: DataFrame) -> DataFrame:
    """Listing (name, remote) against tasks (name, state, timestamp): unseen and newer ones are queued, others stay."""
    j = listing.join(tasks, "name", "full")
    again = F.col("timestamp").isNull() | (F.col("remote") > F.col("timestamp"))
    queued = F.lit(STATES["Queued"]).cast("smallint")
    return j.select("name", F.when(F.col("remote").isNotNull() & again, queued).otherwise(F.col("state")).alias("state"), F.greatest("remote", "timestamp").alias("timestamp"))


def current_state(events: DataFrame, key: str, state: str, order: list[str]) -> DataFrame:
    return events.groupBy(key).agg(F.max_by(state, F.struct(*order)).alias(state), F.max(order[0]).alias(order[0]))


def needs_work(tasks: DataFrame, states: list[str], most: int, order: list[str]) -> DataFrame:
    """The first ``most`` tasks in one of the states; the limit takes from every task only what it needs."""
    return tasks.where(F.col("state").isin([STATES[s] for s in states])).orderBy(*order).limit(most)


def gate(tasks: DataFrame) -> DataFrame:
    """Whether a job has no task left to complete; a job without tasks passes."""
    left = F.count_if(F.col("state") != STATES["Completed"])
    return tasks.agg(left.alias("left"), (left == 0).alias("passes"))


def counts_by(tasks: DataFrame, key: str) -> DataFrame:
    return tasks.groupBy(key).agg(F.count("*").alias("n"))


def seed(source: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return source.join(known.select(key), key, "left_anti")


def latest_rows(rows: DataFrame, key: str, stamp: str) -> DataFrame:
    """All rows that carry their key's latest stamp, ties included: the maximum is aggregated, then joined back."""
    newest = rows.groupBy(key).agg(F.max(stamp).alias("__newest"))
    return rows.join(newest, key).where(F.col(stamp) == F.col("__newest")).drop("__newest")


def update_from(target: DataFrame, source: DataFrame, key: str, column: str) -> DataFrame:
    """UPDATE target SET column = source.column where the key matches."""
    s = source.select(key, F.col(column).alias("__value"))
    return target.join(s, key, "left").withColumn(column, F.coalesce("__value", column)).drop("__value")


def page(rows: DataFrame, keys: list[str], size: int, number: int) -> DataFrame:
    """Page ``number`` (from 0) in the order of the full key: a top-k of the first pages, then their tail."""
    return rows.orderBy(*keys).offset(size * number).limit(size)


def pending(rows: DataFrame, log: DataFrame, key: str, stamp: str, now: Column) -> DataFrame:
    """Rows that changed within a day of ``now``, as PENDING (0) entries over the log's."""
    recent = rows.where(F.col(stamp) >= now - F.expr("interval 1 day")).select(key, F.lit(0).cast("smallint").alias("status"))
    return upsert(log, recent, [key], ["status"])


def full_text_jobs(tasks: DataFrame, results: DataFrame, location: Column) -> DataFrame:
    """Full-text tasks (identifier, location, year, state, timestamp) after a run over ``results`` (identifier, status).

    Queued and failed tasks alone are worked on: Ok completes one and sets its location, Unavailable makes it
    unavailable, any other status fails it; without a result a task stays as it is."""
    work = F.col("state").isin(STATES["Queued"], STATES["Failed"]) & F.col("status").isNotNull()
    state = F.when(F.col("status") == "Ok", STATES["Completed"]).when(F.col("status") == "Unavailable", STATES["Unavailable"]).otherwise(STATES["Failed"])
    j = tasks.join(results.select("identifier", "status"), "identifier", "left")
    done = work & (F.col("status") == "Ok")
    return j.select("identifier", F.when(done, location).otherwise(F.col("location")).alias("location"), "year", F.when(work, state).otherwise(F.col("state")).cast("smallint").alias("state"), "timestamp")


#: States of a row in a vector log (fixed values).
LOG = {"PENDING": 0, "IN_PROGRESS": 1, "COMPLETED": 2, "FAILED": 3}


def taken(log: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The log with the rows in progress that a page takes up."""
    return upsert(log, rows.select(key, F.lit(LOG["IN_PROGRESS"]).cast("smallint").alias("status")), [key], ["status"])


def finished(log: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """The log with the outcome (key, ok) of rows in progress: completed or failed; other rows stay."""
    j = log.join(results.groupBy(key).agg(F.bool_and("ok").alias("ok")), key, "left")
    state = F.when(F.col("ok"), LOG["COMPLETED"]).otherwise(LOG["FAILED"])
    return j.select(key, F.when((F.col("status") == LOG["IN_PROGRESS"]) & F.col("ok").isNotNull(), state).otherwise(F.col("status")).cast("smallint").alias("status"))


def unfinished(log: DataFrame, done: int, key: str) -> DataFrame:
    return log.where(F.col("status") != done).orderBy(key)


def of_ids(rows: DataFrame, key: str, ids: DataFrame | list) -> DataFrame:
    """Rows of the ids: a short list as a literal one, a table by a semi join."""
    return rows.where(F.col(key).isin(ids)) if isinstance(ids, list) else rows.join(ids.select(key).distinct(), key, "left_semi")


def sample_of(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows by a hash of seed and key: the same ones whatever the partitions."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)


def map_by_key(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """A row for each key, the last by ``order``."""
    return last_wins(rows, [key], order)


def ranked_latest(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    return rows.withColumn("rank", F.rank().over(Window.partitionBy(key).orderBy(*order))).where("rank = 1").drop("rank")
