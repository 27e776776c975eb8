"""The per-URL crawl state: inserts, transitions, queues and counts.

The state has one row per URL.  Parquet knows no MERGE, so every transition is
``new state = f(old state, changes)``.  Changes are first reduced to one row
per URL by aggregates with a partial form; after that both join sides are
unique on ``url`` and no key can be hot.  Which side is broadcast, if any, is
left to Spark's own size check.  ``now`` is always passed in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from folioloom.functions.text import truncate
from folioloom.schemas import (
    DONE, ERROR, MAX_FAILURES, MAX_RETRIES, PENDING, STATE_MESSAGE_CHARS, STATE_SCHEMA)
from folioloom.sources.tables import store

STATE_COLUMNS = tuple(STATE_SCHEMA.names)


# --- filters -----------------------------------------------------------------

def pending(state: DataFrame) -> DataFrame:
    return state.where(F.col("status") == PENDING)


def crawled(state: DataFrame) -> DataFrame:
    return state.where(F.col("crawled_at").isNotNull())


# --- inserts -----------------------------------------------------------------

def new_urls(entries: DataFrame, state: DataFrame, now: Column) -> DataFrame:
    """State rows for the URLs the state does not know yet, as pending.

    Repeated URLs give one row, with the largest ``lastmod``.
    """
    unknown = (
        entries.groupBy("url").agg(F.max("lastmod").alias("lastmod"))
        .join(state.select("url"), "url", "left_anti"))
    given = {"url": F.col("url"), "lastmod": F.col("lastmod"),
             "first_seen": now, "status": F.lit(PENDING)}
    return unknown.select(*[
        given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in STATE_SCHEMA])


def insert_if_absent(entries: DataFrame, state: DataFrame, now: Column) -> DataFrame:
    """The state with unknown URLs added; known rows stay as they are."""
    return state.unionByName(new_urls(entries, state, now))


def new_vs_done(merged: DataFrame, state: DataFrame) -> DataFrame:
    """How many merged URLs were never crawled, and how many were."""
    known = crawled(state).select("url", F.lit(True).alias("known"))
    return (
        merged.select("url").join(known, "url", "left")
        .agg(F.count_if(F.col("known").isNull()).alias("new_count"),
             F.count_if(F.col("known")).alias("done_count")))


# --- transitions -------------------------------------------------------------

def fold_changes(changes: DataFrame) -> DataFrame:
    """One row per URL from a log of results.

    ``changes``: ``url, ok, batch_id, content_hash, error_message, changed_at,
    seq``; ``(changed_at, seq)`` orders the results of one URL.
    """
    when = F.struct("changed_at", "seq")
    last = F.struct("ok", "error_message")
    stored = F.struct("batch_id", "content_hash")
    return changes.groupBy("url").agg(
        F.count_if(~F.col("ok")).alias("bad"),
        F.max("changed_at").alias("last_at"),
        F.max_by(last, when).alias("last"),
        F.max_by(stored, F.when(F.col("ok"), when)).alias("stored"))


def apply_folded(
    state: DataFrame, folded: DataFrame, max_retries: int = MAX_RETRIES
) -> DataFrame:
    """The state after the folded results; URLs it does not know are ignored."""
    old = state.alias("s")
    joined = old.join(folded.alias("c"), F.col("s.url") == F.col("c.url"), "left")
    hit = F.col("c.url").isNotNull()
    ok = F.col("c.last.ok")
    count = F.coalesce(F.col("s.scrape_count"), F.lit(0)) + F.col("c.bad")

    def changed(value: Column, name: str, where: Column = hit) -> Column:
        kept = F.col(f"s.{name}")
        kind = STATE_SCHEMA[name].dataType
        return F.when(where, value.cast(kind)).otherwise(kept).alias(name)

    has_stored = F.col("c.stored").isNotNull()
    new = {
        "status": changed(
            F.when(ok, DONE).when(count >= max_retries, ERROR).otherwise(PENDING), "status"),
        "crawled_at": changed(F.col("c.last_at"), "crawled_at"),
        "batch_id": changed(F.col("c.stored.batch_id"), "batch_id", has_stored),
        "content_hash": changed(F.col("c.stored.content_hash"), "content_hash", has_stored),
        "error_message": changed(
            F.when(~ok, truncate(F.col("c.last.error_message"), STATE_MESSAGE_CHARS)),
            "error_message"),
        "scrape_count": changed(count, "scrape_count", F.col("c.bad") > 0),
    }
    return joined.select(*[new.get(c, F.col(f"s.{c}")) for c in STATE_COLUMNS])


def apply_changes(
    state: DataFrame, changes: DataFrame, max_retries: int = MAX_RETRIES
) -> DataFrame:
    return apply_folded(state, fold_changes(changes), max_retries)


def mark_done(state: DataFrame, stored: DataFrame, now: Column) -> DataFrame:
    """``stored``: ``url, batch_id, content_hash``.  The retry count is kept."""
    return apply_changes(state, stored.select(
        "url", F.lit(True).alias("ok"), "batch_id", "content_hash",
        F.lit(None).cast("string").alias("error_message"),
        now.cast("timestamp").alias("changed_at"),
        F.struct("batch_id", "content_hash").alias("seq")))


def mark_error(
    state: DataFrame, failures: DataFrame, now: Column, max_retries: int = MAX_RETRIES
) -> DataFrame:
    """``failures``: ``url, error_message``, one row per failed crawl.

    Below ``max_retries`` bad crawls a URL goes back to the queue, from there
    on it is an error.
    """
    # The message orders the failures of one time and is stored too: rows carry it once, and no longer than it is kept.
    worst = F.struct(now.cast("timestamp").alias("changed_at"),
                     truncate(F.col("error_message"), STATE_MESSAGE_CHARS).alias("error_message"))
    folded = failures.groupBy("url").agg(F.count("*").alias("bad"), F.max(worst).alias("worst"))
    return apply_folded(state, folded.select(
        "url", "bad", F.col("worst.changed_at").alias("last_at"),
        F.struct(F.lit(False).alias("ok"), F.col("worst.error_message")).alias("last"),
        F.lit(None).cast("struct<batch_id:string,content_hash:string>").alias("stored")), max_retries)


def reset_done(state: DataFrame) -> DataFrame:
    """Every done URL back to the queue; hash and retry count stay."""
    done = F.col("status").eqNullSafe(DONE)
    return state.withColumns({
        "status": F.when(done, PENDING).otherwise(F.col("status")),
        "crawled_at": F.when(~done, F.col("crawled_at")),
        "batch_id": F.when(~done, F.col("batch_id")),
    })


def reset_errors(state: DataFrame, max_failures: int = MAX_FAILURES) -> DataFrame:
    """Errors with fewer than ``max_failures`` bad crawls back to the queue."""
    revive = F.col("status").eqNullSafe(ERROR) & (
        F.coalesce(F.col("scrape_count"), F.lit(0)) < max_failures)
    return state.withColumns({
        "status": F.when(revive, PENDING).otherwise(F.col("status")),
        "error_message": F.when(~revive, F.col("error_message")),
    })


# --- counts and queues -------------------------------------------------------

def state_stats(state: DataFrame) -> DataFrame:
    """Counts by status in one pass; the total includes unknown statuses."""
    status = F.col("status")
    return state.agg(
        F.count("*").alias("total"),
        F.count_if(status == PENDING).alias("pending"),
        F.count_if(status == DONE).alias("done"),
        F.count_if(status == ERROR).alias("error"))


def pending_count(state: DataFrame) -> DataFrame:
    return pending(state).agg(F.count("*").alias("pending"))


def pending_queue(state: DataFrame, limit: int = 1000) -> DataFrame:
    """The longest-waiting URLs, a top-k over the pending rows."""
    return pending(state).orderBy("first_seen", "url").limit(limit)


def recent_crawled(state: DataFrame, limit: int = 50) -> DataFrame:
    return (
        crawled(state).select("url", "status", "crawled_at", "content_hash")
        .orderBy(F.desc("crawled_at"), "url").limit(limit))


def run_queue(state: DataFrame, max_urls: int | None = None) -> DataFrame:
    """URLs a run works on: all pending ones, or the ``max_urls`` oldest."""
    if max_urls is None:
        return pending(state)
    return oldest_by_range(pending(state), max_urls)


def oldest_by_range(rows: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows by ``first_seen, url``, for ``n`` of any size.

    A top-k passes its rows through one task.  Here the rows are sorted into
    ranges and stored once, so that the ranges stay what they were counted as;
    the counts (one per range) say which ranges to keep whole and where to cut.
    """
    ranged = store(
        rows.repartitionByRange("first_seen", "url").withColumn("part", F.spark_partition_id()), "queue")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("part").agg(F.count("*").alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    in_part = Window.partitionBy("part").orderBy("first_seen", "url")
    return (
        ranged.join(F.broadcast(starts.where(F.col("start") < n)), "part")
        .withColumn("rank", F.col("start") + F.row_number().over(in_part))
        .where(F.col("rank") <= n).select(*rows.columns))
