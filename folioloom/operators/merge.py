"""Merging main and news sitemap entries by URL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

ENTRY_ORDER = ("index_url", "sitemap_no", "pos")


def _by_url(main: DataFrame, news: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per URL from one shuffle of both inputs.

    Every aggregate has a partial form, so a URL that fills a third of the
    input reaches the shuffle as one row per task.
    """
    seen = F.struct(*[F.col(c) for c in order])
    tagged = main.select("url", "lastmod", seen.alias("seen")).unionByName(
        news.select("url", "lastmod"), allowMissingColumns=True)
    in_main = F.col("seen").isNotNull()
    return tagged.groupBy("url").agg(
        F.max_by("lastmod", "seen").alias("main_lastmod"),
        F.max(F.when(~in_main, F.col("lastmod"))).alias("news_lastmod"))


def merge_entries(
    main: DataFrame, news: DataFrame, order: Sequence[str] = ENTRY_ORDER
) -> DataFrame:
    """``(url, lastmod)`` over both sources, one row per URL.

    Within the main sitemaps the last occurrence wins, even with a null
    ``lastmod``; the news sitemap can only raise the value.  ``lastmod`` is
    text and compared as text.
    """
    return _by_url(main, news, order).select(
        "url", F.greatest("main_lastmod", "news_lastmod").alias("lastmod"))


def unique_urls(main: DataFrame, news: DataFrame) -> DataFrame:
    """Number of distinct URLs over both sources."""
    return (
        main.select("url").unionByName(news.select("url")).distinct()
        .agg(F.count("*").alias("unique_urls")))


def found_urls(main: DataFrame, news: DataFrame) -> DataFrame:
    """``(url, m, n)``: how often a URL occurs in each source."""
    return (
        main.select("url", F.lit(1).alias("m"), F.lit(0).alias("n"))
        .unionByName(news.select("url", F.lit(0).alias("m"), F.lit(1).alias("n")))
        .groupBy("url").agg(F.sum("m").alias("m"), F.sum("n").alias("n")))


def source_counts(main: DataFrame, news: DataFrame, state: DataFrame) -> DataFrame:
    """Entries per source, distinct URLs found and URLs already tracked."""
    tracked = state.agg(F.count("*")).scalar()
    return found_urls(main, news).agg(
        F.coalesce(F.sum("m"), F.lit(0)).alias("main_count"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("news_count"),
        F.count("*").alias("total_found"),
    ).withColumn("tracked", tracked)


def preview(merged: DataFrame, n: int = 10) -> DataFrame:
    """The first URLs in URL order."""
    return merged.select("url").orderBy("url").limit(n)
