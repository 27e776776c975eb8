"""Packing articles into sink rows of a fixed number of pages.

All batches but the last must be full, so every article needs its rank in one
global order, without a global sort in one task.  The order is the MD5 of the
article's keys.  Its first digits cut the rows into ``BUCKETS`` even ranges
that need no sampling and come out the same whenever a task is run again.
Counting the ranges (a pass over the keys only) gives the rank at which each
starts; rows are then shuffled once, together with their neighbours in rank,
and ranked and packed where they land.

Keys may repeat: rows get numbers when they are stored, and a range with more
rows than a group is cut into parts by these numbers.  So no part reaches
into more than two groups, whatever the keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from folioloom.functions.text import content_hash, truncate
from folioloom.operators.state import apply_changes
from folioloom.sources.tables import store
from folioloom.schemas import (
    ARTICLE_SCHEMA, BATCH_MESSAGE_CHARS, BATCH_SIZE, MAX_RETRIES)

BUCKET_DIGITS = 5                    # hexadecimal digits of the MD5
BUCKETS = 16 ** BUCKET_DIGITS        # about a million: bounds the broadcast below
BUCKETS_PER_GROUP = 8                # at least; keeps rows copied to two groups few
BATCHES_PER_GROUP = 50               # at least
ROW = "row_no"                       # column that tells rows apart

# Values for columns the articles do not have (fixed values); others get null.
ARTICLE_DEFAULTS = {"url": "", "title": "", "content": "", "language": "ar", "word_count": 0}


def batch_projection(articles: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The article columns of the sink.  A null that is present stays null.

    ``keys`` outside the article columns and row numbers come along.
    """
    extra = [k for k in (*keys, ROW) if k not in ARTICLE_SCHEMA.names and (k != ROW or k in articles.columns)]
    return articles.select(*extra, *[
        (F.col(f.name) if f.name in articles.columns
         else F.lit(ARTICLE_DEFAULTS.get(f.name))).cast(f.dataType).alias(f.name)
        for f in ARTICLE_SCHEMA])


def _order(keys: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def _bucket(order: Column) -> Column:
    return F.conv(F.substring(order, 1, BUCKET_DIGITS), 16, 10).cast("int")


def numbered(articles: DataFrame) -> DataFrame:
    """The articles as a stored table with a number for each row."""
    if ROW in articles.columns:
        return articles
    return store(articles.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def _part(parts: Column) -> Column:
    return F.pmod(F.xxhash64(ROW), parts).cast("int")


def _bucket_parts(keyed: DataFrame, batch_size: int) -> DataFrame:
    """``(bucket, n, group_batches, parts)`` from the rows' ``bucket``.

    A group is a run of ``group_batches`` batches; a part holds about half a group.
    """
    everything = Window.orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    batches = F.ceil(BUCKETS_PER_GROUP * F.sum("n").over(everything) / (BUCKETS * batch_size))
    counts = keyed.groupBy("bucket").agg(F.count("*").alias("n"))
    return counts.withColumn("group_batches", F.greatest(F.lit(BATCHES_PER_GROUP), batches)).withColumn(
        "parts", F.when(F.col("n") <= F.col("group_batches") * batch_size, 1).otherwise(
            F.ceil(2 * F.col("n") / (F.col("group_batches") * batch_size))).cast("int"))


def _part_starts(keyed: DataFrame, buckets: DataFrame, batch_size: int) -> DataFrame:
    """``(bucket, part, part_start, group_no, group_batches)``, one row per part
    and group it reaches into.

    There are at most ``BUCKETS`` ranges whatever the data, and two parts for
    each group, so the running sum over their counts is small.
    """
    large = keyed.join(F.broadcast(buckets.where("parts > 1").select("bucket", "group_batches", "parts")), "bucket")
    cut = large.groupBy("bucket", _part(F.col("parts")).alias("part"), "group_batches").agg(F.count("*").alias("n"))
    whole = buckets.where("parts = 1").select("bucket", F.lit(0).alias("part"), "group_batches", "n")
    before = Window.orderBy("bucket", "part").rowsBetween(Window.unboundedPreceding, -1)
    per_group = F.col("group_batches") * batch_size
    return (
        whole.unionByName(cut)
        .withColumn("part_start", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .select(
            "bucket", "part", "part_start", "group_batches",
            F.explode(F.sequence(
                F.floor(F.col("part_start") / per_group),
                F.floor((F.col("part_start") + F.col("n") - 1) / per_group),
            )).alias("group_no")))


def assign_batches(
    articles: DataFrame, batch_size: int = BATCH_SIZE, keys: Sequence[str] = ("url",)
) -> DataFrame:
    """Articles with ``group_no, batch_no, page_no`` (numbers from 0).

    The result is partitioned by ``group_no``; grouping by ``group_no,
    batch_no`` shuffles nothing more.  Articles without the column ``row_no``
    are stored once with one, which must tell rows apart and stay the same
    however often it is read.
    """
    rows = numbered(articles)
    keyed = rows.select(ROW, _bucket(_order(keys)).alias("bucket"))
    buckets = _bucket_parts(keyed, batch_size)
    starts = _part_starts(keyed, buckets, batch_size)
    in_part = Window.partitionBy("group_no", "bucket", "part").orderBy("order_key", *keys, ROW)
    rank = F.col("part_start") + F.row_number().over(in_part) - 1
    return (
        rows
        .withColumn("order_key", _order(keys))
        .withColumn("bucket", _bucket(F.col("order_key")))
        .join(F.broadcast(buckets.select("bucket", "parts")), "bucket")
        .withColumn("part", _part(F.col("parts")))
        .join(F.broadcast(starts), ["bucket", "part"])
        # A part across a group boundary is sent to both groups; each keeps
        # the ranks that are its own.
        .repartition("group_no")
        .withColumn("rank", rank)
        .withColumn("batch_no", F.floor(F.col("rank") / batch_size))
        .withColumn("page_no", F.col("rank") % batch_size)
        .where(F.floor(F.col("batch_no") / F.col("group_batches")) == F.col("group_no"))
        .drop("order_key", "bucket", "part", "parts", "part_start", "group_batches", "rank", ROW))


def pack_batches(
    articles: DataFrame,
    run_id: str,
    now: Column,
    batch_size: int = BATCH_SIZE,
    keys: Sequence[str] = ("url",),
) -> DataFrame:
    """Sink rows ``batch_id, page_count, pages, created_at``.

    ``batch_id`` is the run id and the batch number.
    """
    page = F.struct(*ARTICLE_SCHEMA.names)
    return (
        assign_batches(batch_projection(articles, keys), batch_size, keys)
        .groupBy("group_no", "batch_no")
        .agg(F.count("*").cast("int").alias("page_count"),
             F.sort_array(F.collect_list(F.struct("page_no", page.alias("page"))))
             .alias("numbered"))
        .select(
            F.concat(F.lit(f"{run_id}-"), F.col("batch_no").cast("string")).alias("batch_id"),
            "page_count",
            F.transform("numbered", lambda p: p["page"]).alias("pages"),
            now.cast("timestamp").alias("created_at")))


def dry_run_summary(batches: DataFrame) -> DataFrame:
    return batches.select("batch_id", "page_count")


def batch_members(batches: DataFrame) -> DataFrame:
    """``url, batch_id, content_hash`` of every stored page."""
    return (
        batches.select("batch_id", F.explode("pages").alias("page"))
        .select(F.col("page.url").alias("url"), "batch_id",
                content_hash(F.col("page.content"), cleaned=True).alias("content_hash")))


def batch_changes(members: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """State changes from storing batches, each of them whole or not at all.

    ``results``: ``batch_id, ok, error``; of several for a batch a success
    counts, else the largest error.  URLs of a stored batch are done, those of
    a failed one count one bad crawl.
    """
    results = results.groupBy("batch_id").agg(F.max("ok").alias("ok"), F.max("error").alias("error"))
    message = F.concat(
        F.lit("Batch insert failed: "), truncate(F.col("error"), BATCH_MESSAGE_CHARS))
    return members.join(results, "batch_id").select(
        "url", "ok", "batch_id", "content_hash",
        F.when(~F.col("ok"), message).alias("error_message"),
        now.cast("timestamp").alias("changed_at"), F.col("batch_id").alias("seq"))


def apply_batch_outcome(
    state: DataFrame,
    members: DataFrame,
    results: DataFrame,
    now: Column,
    max_retries: int = MAX_RETRIES,
) -> DataFrame:
    """The state after storing batches; see ``batch_changes``."""
    return apply_changes(state, batch_changes(members, results, now), max_retries)
