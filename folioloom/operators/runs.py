"""Run checkpoints and the monitoring aggregates over them.

Aggregates of the latest runs start from a top-k of at most ``limit`` rows;
single values of other tables come in as scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from folioloom.functions.numbers import day, eta, percent, rate, seconds_between
from folioloom.operators.state import state_stats
from folioloom.schemas import CANCELLED, COMPLETED, FAILED, RUN_SCHEMA, RUNNING

RECENT = 20


def start_run(runs: DataFrame, crawl_id: Column, mode: Column, now: Column) -> DataFrame:
    """The runs with a new running one; ``runs`` needs no rows."""
    given = {"crawl_id": crawl_id, "mode": mode, "status": F.lit(RUNNING),
             "start_time": now, "total_urls": F.lit(0)}
    spark = runs.sparkSession
    row = spark.range(1).select(*[
        given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RUN_SCHEMA])
    return runs.unionByName(row)


def update_runs(runs: DataFrame, updates: DataFrame, now: Column) -> DataFrame:
    """Set the non-null fields of ``updates``; a final status sets ``end_time``.

    ``updates``: ``crawl_id, processed_urls, successful_urls, failed_urls,
    status``.  Of several rows for a run the largest counts hold, and a final
    status before one that is not.
    """
    ends = F.col("status").isin(COMPLETED, FAILED, CANCELLED)
    updates = updates.groupBy("crawl_id").agg(
        *(F.max(c).alias(c) for c in ("processed_urls", "successful_urls", "failed_urls")),
        F.max(F.when(F.col("status").isNotNull(), F.struct(ends.alias("ends"), "status")))["status"].alias("status"))
    final = F.col("u.status").isin(COMPLETED, FAILED, CANCELLED)
    joined = runs.alias("r").join(
        updates.alias("u"), F.col("r.crawl_id") == F.col("u.crawl_id"), "left")

    def field(name: str) -> Column:
        old, kind = F.col(f"r.{name}"), RUN_SCHEMA[name].dataType
        if name == "end_time":
            return F.when(final, now.cast(kind)).otherwise(old).alias(name)
        if name in ("processed_urls", "successful_urls", "failed_urls", "status"):
            return F.coalesce(F.col(f"u.{name}"), old).cast(kind).alias(name)
        return old

    return joined.select(*[field(f.name) for f in RUN_SCHEMA])


def drop_stale(runs: DataFrame) -> DataFrame:
    """Without running entries that never processed anything."""
    stale = F.col("status").eqNullSafe(RUNNING) & (
        F.coalesce(F.col("processed_urls"), F.lit(0)) == 0)
    return runs.where(~stale)


def recent_runs(runs: DataFrame, limit: int = 10) -> DataFrame:
    return runs.orderBy(F.desc("start_time"), F.desc("crawl_id")).limit(limit)


def runs_table(runs: DataFrame, limit: int = 10, recent: int = RECENT) -> DataFrame:
    """The rows of the runs list: recent, not stale, short ids."""
    return (
        drop_stale(recent_runs(runs, recent))
        .orderBy(F.desc("start_time"), F.desc("crawl_id")).limit(limit)
        .select(F.substring("crawl_id", 1, 30).alias("crawl_id"), "status",
                "processed_urls", "successful_urls", "failed_urls", "start_time"))


def progress(state: DataFrame) -> DataFrame:
    return state_stats(state).select(
        "done", "total", percent(F.col("done"), F.col("total")).alias("percent_done"))


def success_rate(runs: DataFrame, recent: int = RECENT) -> DataFrame:
    """Percent successful over the completed ones of the recent runs."""
    completed = recent_runs(runs, recent).where(F.col("status") == COMPLETED)
    return completed.agg(
        F.coalesce(F.sum("processed_urls"), F.lit(0)).alias("processed"),
        F.coalesce(F.sum("successful_urls"), F.lit(0)).alias("successful"),
    ).withColumn("success_rate", percent(F.col("successful"), F.col("processed")))


def latest_rate(runs: DataFrame, recent: int = RECENT) -> DataFrame:
    """URLs per second of the latest completed one of the recent runs, else 0."""
    completed = recent_runs(runs, recent).where(F.col("status") == COMPLETED)
    latest = F.max_by(
        F.struct("start_time", "end_time", "processed_urls"),
        F.struct("start_time", "crawl_id"))
    return completed.agg(latest.alias("r")).select(F.coalesce(
        rate(F.col("r.processed_urls"),
             seconds_between(F.col("r.start_time"), F.col("r.end_time"))),
        F.lit(0.0)).alias("rate"))


def time_left(state: DataFrame, runs: DataFrame, recent: int = RECENT) -> DataFrame:
    """Pending URLs at the latest rate, as text."""
    return (
        state_stats(state).select("pending")
        .withColumn("rate", latest_rate(runs, recent).scalar())
        .withColumn("eta", eta(F.col("pending"), F.col("rate"))))


def started_from(runs: DataFrame, first: Column, end: Column) -> DataFrame:
    """Runs that began on a day from ``first`` and before ``end``.

    Bounds on the time itself, unlike a condition on its day, reach the file scan.
    """
    kind = runs.schema["start_time"].dataType
    return runs.where((F.col("start_time") >= first.cast(kind)) & (F.col("start_time") < end.cast(kind)))


def daily_series(
    runs: DataFrame, today: Column, days: int = 14, max_runs: int | None = RECENT
) -> DataFrame:
    """Processed URLs per day over the last ``days`` days, zero-filled.

    ``max_runs`` limits the series to the latest runs; ``None`` takes all.
    """
    first = F.date_sub(day(today), days - 1)
    source = runs if max_runs is None else recent_runs(runs, max_runs)
    per_day = (
        started_from(source, first, F.date_add(day(today), 1))
        .groupBy(day(F.col("start_time")).alias("day")).agg(F.sum("processed_urls").alias("processed")))
    spine = runs.sparkSession.range(days).select(
        F.date_add(first, F.col("id").cast("int")).alias("day"))
    return spine.join(per_day, "day", "left").select(
        "day", F.coalesce("processed", F.lit(0)).alias("processed"))


def today_total(
    runs: DataFrame, today: Column, max_runs: int | None = RECENT
) -> DataFrame:
    source = runs if max_runs is None else recent_runs(runs, max_runs)
    return started_from(source, day(today), F.date_add(day(today), 1)).agg(
        F.coalesce(F.sum("processed_urls"), F.lit(0)).alias("processed"))
