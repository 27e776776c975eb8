"""Change detection against the state."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def content_changed(crawl: DataFrame, state: DataFrame, order: str) -> DataFrame:
    """``url, change``: is the content new, changed or unchanged?

    ``crawl``: ``url, content_hash`` and an ``order`` column; of several
    crawls of a URL the last one counts.
    """
    latest = crawl.groupBy("url").agg(F.max_by(
        "content_hash", F.struct(order, "content_hash")).alias("new_hash"))
    stored = state.select("url", F.col("content_hash").alias("old_hash"))
    return latest.join(stored, "url", "left").select(
        "url",
        F.when(F.col("old_hash").isNull(), "new")
        .when(F.col("old_hash").eqNullSafe(F.col("new_hash")), "unchanged")
        .otherwise("changed").alias("change"))


def lastmod_changed(merged: DataFrame, state: DataFrame) -> DataFrame:
    """Known URLs whose merged ``lastmod`` is later than the stored one."""
    stored = state.select("url", F.col("lastmod").alias("old_lastmod"))
    later = F.col("old_lastmod").isNull() | (F.col("lastmod") > F.col("old_lastmod"))
    return (
        merged.select("url", "lastmod").where(F.col("lastmod").isNotNull())
        .join(stored, "url").where(later)
        .select("url", "old_lastmod", "lastmod"))
