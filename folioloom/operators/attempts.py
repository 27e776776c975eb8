"""Fetch attempts: one outcome per URL and run, run totals, the state fold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from folioloom.functions.numbers import rate, seconds_between
from folioloom.functions.text import truncate
from folioloom.operators.state import fold_changes
from folioloom.schemas import (
    DONE, ERROR, FETCH_MESSAGE_CHARS, MAX_FETCH_ATTEMPTS, MAX_RETRIES, PENDING,
    STATE_MESSAGE_CHARS)

# HTTP codes that ask for another try (fixed values).
RETRY_STATUS = (429, 503)

# Error texts (fixed values).
NO_RESPONSE = "HTTP No response"
NOT_FOUND = "HTTP 404 Not Found"
NO_ARTICLE = "No content extracted or validation failed"
EXHAUSTED = "All {} fetch attempts failed"


def partial_outcomes(
    attempts: DataFrame, keys: Sequence[str], max_attempts: int = MAX_FETCH_ATTEMPTS
) -> DataFrame:
    """``keys, settled, first, last``: what a part of the log says of each key.

    Parts of a log that are aggregated apart are put together by
    ``finished_outcomes``: all three values are least or largest ones.
    """
    status = F.col("http_status")
    failed = F.col("exception").isNotNull()
    last = F.col("attempt") >= max_attempts
    settles = F.when(failed, last).otherwise(
        status.isNull() | ~status.isin(*RETRY_STATUS))
    error = (
        F.when(failed, truncate(F.col("exception"), FETCH_MESSAGE_CHARS))
        .when(status.isNull(), F.lit(NO_RESPONSE))
        .when((status == 200) & F.coalesce(F.col("valid"), F.lit(False)), F.lit(None))
        .when(status == 200, F.lit(NO_ARTICLE))
        .when(status == 404, F.lit(NOT_FOUND))
        .otherwise(F.concat(F.lit("HTTP "), status.cast("string"))))
    nothing = F.lit(None).cast("string")
    given = [(F.col(c) if c in attempts.columns else nothing).alias(c) for c in ("batch_id", "content_hash")]
    # The least (attempt, error): of repeated entries for one attempt a success
    # comes first, so the result does not depend on the order of the log.
    return (
        attempts.where(F.col("attempt") <= max_attempts)
        .withColumn("ts", F.col("ts").cast("timestamp") if "ts" in attempts.columns else F.lit(None).cast("timestamp"))
        .groupBy(*keys).agg(
            F.min(F.when(settles, F.struct("attempt", error.alias("error"), *given))).alias("settled"),
            F.min("ts").alias("first"), F.max("ts").alias("last")))


def finished_outcomes(
    partials: DataFrame, keys: Sequence[str], max_attempts: int = MAX_FETCH_ATTEMPTS
) -> DataFrame:
    """``keys, settled, first, last, error, outcome`` from one or more parts."""
    return merged_partials(partials, keys).transform(_judged, max_attempts)


def merged_partials(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key from several parts, which is again a part."""
    return partials.groupBy(*keys).agg(
        F.min("settled").alias("settled"), F.min("first").alias("first"), F.max("last").alias("last"))


def _judged(settled: DataFrame, max_attempts: int) -> DataFrame:
    return settled.withColumn("error", F.when(
        F.col("settled").isNull(), F.lit(EXHAUSTED.format(max_attempts)))
        .otherwise(F.col("settled.error"))
    ).withColumn("outcome", F.when(F.col("error").isNull(), "success").otherwise("error"))


def _outcomes(attempts: DataFrame, keys: Sequence[str], max_attempts: int) -> DataFrame:
    """One aggregation: the deciding attempt of each key."""
    return partial_outcomes(attempts, keys, max_attempts).transform(_judged, max_attempts)


def attempt_outcome(
    attempts: DataFrame,
    keys: Sequence[str] = ("url",),
    max_attempts: int = MAX_FETCH_ATTEMPTS,
) -> DataFrame:
    """``keys, outcome, error`` from ``attempt, http_status, valid, exception``.

    The first attempt that settles the fetch decides; later ones and those
    beyond ``max_attempts`` do not count.  If none settles it, the fetch failed.
    """
    return _outcomes(attempts, keys, max_attempts).select(*keys, "outcome", "error")


def run_summary(
    attempts: DataFrame, run: str = "crawl_id", max_attempts: int = MAX_FETCH_ATTEMPTS
) -> DataFrame:
    """Processed, successful and failed URLs and URLs per second of each run.

    One pass over the log: URLs first, so that a run holding most of the
    attempts is summed from many tasks.
    """
    per_url = _outcomes(attempts, (run, "url"), max_attempts)
    outcome = F.col("outcome")
    return per_url.groupBy(run).agg(
        F.count("*").alias("processed"),
        F.count_if(outcome == "success").alias("successful"),
        F.count_if(outcome == "error").alias("failed"),
        seconds_between(F.min("first"), F.max("last")).alias("seconds"),
    ).select(run, "processed", "successful", "failed",
             rate(F.col("processed"), F.col("seconds")).alias("rate"))


def outcome_changes(outcomes: DataFrame, run: str = "crawl_id") -> DataFrame:
    """Outcomes of (run, URL) in the shape of state changes: each is one crawl.

    ``(last attempt, run)`` orders the crawls of a URL.
    """
    ok = F.col("outcome") == "success"
    return outcomes.select(
        "url", ok.alias("ok"),
        *[F.when(ok, F.col(f"settled.{c}")).alias(c) for c in ("batch_id", "content_hash")],
        F.col("error").alias("error_message"), F.col("last").alias("changed_at"), F.col(run).alias("seq"))


def attempt_changes(
    attempts: DataFrame, run: str = "crawl_id", max_attempts: int = MAX_FETCH_ATTEMPTS
) -> DataFrame:
    """State changes of an attempt log: one for each URL of a run, however often it was tried."""
    return outcome_changes(_outcomes(attempts, (run, "url"), max_attempts), run)


def folded_state(folded: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Folded changes read as the state of URLs that had none before."""
    ok = F.col("last.ok")
    return folded.select(
        "url",
        F.when(ok, DONE).when(F.col("bad") >= max_retries, ERROR)
        .otherwise(PENDING).alias("status"),
        F.col("last_at").alias("crawled_at"),
        F.col("stored.content_hash").alias("content_hash"),
        F.when(~ok, truncate(F.col("last.error_message"), STATE_MESSAGE_CHARS))
        .alias("error_message"),
        F.col("bad").cast("int").alias("scrape_count"))


def state_fold(
    attempts: DataFrame, max_retries: int = MAX_RETRIES, run: str = "crawl_id",
    max_attempts: int = MAX_FETCH_ATTEMPTS,
) -> DataFrame:
    """The state a whole attempt log leads to: its outcomes, folded in one more aggregation."""
    return folded_state(fold_changes(attempt_changes(attempts, run, max_attempts)), max_retries)
