"""Table schemas shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

STATE_SCHEMA = T.StructType([
    T.StructField("url", T.StringType(), False),
    T.StructField("lastmod", T.StringType()),
    T.StructField("first_seen", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("crawled_at", T.TimestampType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("content_hash", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("scrape_count", T.IntegerType()),
])

RUN_SCHEMA = T.StructType([
    T.StructField("crawl_id", T.StringType(), False),
    T.StructField("mode", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
    T.StructField("total_urls", T.LongType()),
    T.StructField("processed_urls", T.LongType()),
    T.StructField("successful_urls", T.LongType()),
    T.StructField("failed_urls", T.LongType()),
])

ARTICLE_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("published_date", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("tags", T.StringType()),
    T.StructField("images", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("word_count", T.IntegerType()),
])

BATCH_SCHEMA = T.StructType([
    T.StructField("batch_id", T.StringType(), False),
    T.StructField("page_count", T.IntegerType(), False),
    T.StructField("pages", T.ArrayType(ARTICLE_SCHEMA, False), False),
    T.StructField("created_at", T.TimestampType(), False),
])

# Status values (fixed values).
PENDING, DONE, ERROR = "pending", "done", "error"
RUNNING, COMPLETED, FAILED, CANCELLED = "running", "completed", "failed", "cancelled"

# Limits (fixed values).
MAX_RETRIES = 3          # bad attempts before a URL becomes an error
MAX_FAILURES = 5         # bad attempts after which an error is never revived
MAX_FETCH_ATTEMPTS = 3   # fetch attempts of one URL in one run
BATCH_SIZE = 200         # articles in one sink row
STATE_MESSAGE_CHARS = 500
FETCH_MESSAGE_CHARS = 300
BATCH_MESSAGE_CHARS = 200

# One row per (run, URL): the deciding attempt so far, and the first and last times.
PARTIAL_SCHEMA = T.StructType([
    T.StructField("crawl_id", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("settled", T.StructType([
        T.StructField("attempt", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in ("error", "batch_id", "content_hash")]])),
    T.StructField("first", T.TimestampType()),
    T.StructField("last", T.TimestampType()),
])
