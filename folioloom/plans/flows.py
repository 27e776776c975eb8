"""The two whole jobs: refreshing the state from sitemaps, and one crawl run."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from folioloom.operators import batches as B, extract as X, merge as M, state as S
from folioloom.operators.attempts import NO_ARTICLE, attempt_outcome
from folioloom.operators.runs import start_run, update_runs
from folioloom.schemas import BATCH_SIZE, COMPLETED, DONE, MAX_FAILURES, MAX_RETRIES
from folioloom.sources import sitemaps, tables


def refresh_state(
    docs: DataFrame, index_docs: DataFrame, news: DataFrame, state: DataFrame, now: Column
) -> DataFrame:
    """Sitemaps parsed, merged with the news entries, unknown URLs inserted."""
    main = sitemaps.expand_sitemaps(docs, index_docs, keep_repeats=False)
    return S.insert_if_absent(M.merge_entries(main, news), state, now)


def crawl_cycle(
    spark: SparkSession,
    state: DataFrame,
    pages: DataFrame,
    out_dir: str,
    run_id: str,
    now: Column,
    mode: str = "incremental",
    max_urls: int | None = None,
    batch_size: int = BATCH_SIZE,
    max_retries: int = MAX_RETRIES,
    max_failures: int = MAX_FAILURES,
    keys: Sequence[str] = ("url",),
    attempts: DataFrame | None = None,
    insert: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One run over fetched ``pages``: ``url, html`` and the ``keys``.

    ``keys`` order the pages; pages of one URL are packed like any others.
    ``attempts`` is the fetch log of the run: URLs of the queue whose fetch
    failed and that have no page count one bad crawl.  ``insert`` puts the
    stored batches into a sink and returns ``batch_id, ok, error``; without it
    every batch succeeds.

    Writes ``articles`` and ``batches`` of the run below ``out_dir`` and returns
    the new state.  Both are partitions of the run: a run repeated after a
    break replaces them, so it stores each page once.  The articles are a
    stored table because packing reads them twice and the parse is the dear
    part; a lost executor then costs no re-parse.

    The queue prunes the pages before the parse.  Pages stored in buckets by URL
    (``save_state_table`` takes any table with that column) lie as the join
    needs them: their markup is then never shuffled, however long the queue.
    """
    if mode == "full":
        state = S.reset_done(state)
    state = S.reset_errors(state, max_failures)
    queue = S.run_queue(state, max_urls).select("url")

    articles_path, batches_path = f"{out_dir}/articles/run_id={run_id}", f"{out_dir}/batches"
    pages = pages.join(queue, "url", "left_semi")
    articles = X.extract_articles(pages, keep=[k for k in keys if k != "url"])
    (articles.withColumn("valid", X.is_valid_article())
     .withColumn(B.ROW, F.monotonically_increasing_id())
     .write.mode("overwrite").parquet(articles_path))
    articles = spark.read.parquet(articles_path)
    packed = B.pack_batches(articles.where("valid"), run_id, now, batch_size, keys)
    tables.store_run_batches(packed, batches_path, run_id)
    batches = tables.read_batches(spark, f"{batches_path}/run_id={run_id}")

    nothing, at = F.lit(None).cast("string"), now.cast("timestamp").alias("changed_at")
    if insert:
        results = insert(batches)
    else:
        results = batches.select("batch_id", F.lit(True).alias("ok"), nothing.alias("error"))
    changes = B.batch_changes(B.batch_members(batches), results, now)

    def bad(urls: DataFrame, message: Column) -> DataFrame:
        return urls.select(
            "url", F.lit(False).alias("ok"), nothing.alias("batch_id"),
            nothing.alias("content_hash"), message.alias("error_message"), at, F.lit("").alias("seq"))

    changes = changes.unionByName(bad(articles.where("NOT valid"), F.lit(NO_ARTICLE)))
    if attempts is not None:
        failed = (
            attempt_outcome(attempts).where(F.col("outcome") == "error")
            .join(queue, "url", "left_semi").join(articles.select("url"), "url", "left_anti"))
        changes = changes.unionByName(bad(failed, F.col("error")))
    return S.apply_changes(state, changes, max_retries)


def record_run(
    runs: DataFrame, before: DataFrame, after: DataFrame, run_id: str, mode: str,
    started: Column, ended: Column,
) -> DataFrame:
    """The run table with this run opened and closed, from the state before and after it.

    A URL was processed if the run crawled it, and successful if it is done now.
    """
    old = before.select("url", F.col("crawled_at").alias("old_crawled_at"))
    changed = after.join(old, "url", "left").where(
        F.col("crawled_at").isNotNull() & ~F.col("crawled_at").eqNullSafe(F.col("old_crawled_at")))
    update = changed.agg(
        F.count("*").alias("processed_urls"),
        F.count_if(F.col("status") == DONE).alias("successful_urls"),
        F.count_if(F.col("status") != DONE).alias("failed_urls")).select(
        F.lit(run_id).alias("crawl_id"), "processed_urls", "successful_urls", "failed_urls",
        F.lit(COMPLETED).alias("status"))
    opened = start_run(runs, F.lit(run_id), F.lit(mode), started)
    return update_runs(opened, update, ended)


def check_new(main: DataFrame, news: DataFrame, state: DataFrame) -> DataFrame:
    """What a refresh would find, without writing anything.  Each table is read once."""
    found, known = F.col("m").isNotNull(), F.col("crawled_at").isNotNull()
    joined = M.found_urls(main, news).join(
        state.select("url", "crawled_at", F.lit(True).alias("in_state")), "url", "full")
    return joined.agg(
        F.coalesce(F.sum("m"), F.lit(0)).alias("main_count"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("news_count"),
        F.count_if(found).alias("total_found"), F.count("in_state").alias("tracked"),
        F.count_if(found & ~known).alias("new_count"), F.count_if(found & known).alias("done_count"))
