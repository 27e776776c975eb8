"""The registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from folioloom.functions import numbers as N, text as T, urls as U
from folioloom.operators import (
    attempts as A, batches as B, changes as C, extract as X, merge as M, runs as R, state as S)
from folioloom.plans import flows, render
from folioloom.plans.fixtures import FIXTURES, fixture, read_table
from folioloom.schemas import ARTICLE_SCHEMA
from folioloom.sources import sitemaps, state_table, tables
from folioloom.streaming import folds

Query = Callable[[SparkSession, str], DataFrame]

RUN_ID = "run"
PACK_SIZE = 20
STATE_BUCKETS = 8
POS = ("pos",)

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


# --- shared inputs --------------------------------------------------------------

def _now():
    return F.lit("2024-03-01 00:00:00").cast("timestamp")


def _main(spark, sf):
    main = fixture(spark, sf, "sitemap_main")
    return main.where(U.is_article_url(F.col("url")))


def _news(spark, sf):
    news = fixture(spark, sf, "sitemap_news")
    return news.where(U.is_article_url(F.col("url"))).select("url", "lastmod")


def _merged(spark, sf):
    return M.merge_entries(_main(spark, sf), _news(spark, sf), POS)


def _state(spark, sf):
    return fixture(spark, sf, "crawl_state")


def _runs(spark, sf):
    return fixture(spark, sf, "checkpoints")


def _docs(spark, sf):
    return render.sitemap_docs(fixture(spark, sf, "sitemap_entry")).select("doc_url", "body")


def _index_docs(spark, sf):
    return render.index_docs(fixture(spark, sf, "sitemap_entry"))


def _runs_of(attempts):
    """Attempts with the day as their run."""
    return attempts.withColumn("crawl_id", F.to_date("ts").cast("string"))


def _scanned(spark, sf, table, wanted):
    return X.scan_pages(fixture(spark, sf, table), wanted)


def _articles(spark, sf, table="article_pages"):
    return X.extract_articles(fixture(spark, sf, table), keep=("page_id",))


def _stored_articles(spark, sf, table="pages"):
    """Valid articles of the given pages, as the table packing starts from."""
    return tables.store(X.valid_article(_articles(spark, sf, table)).withColumn(
        B.ROW, F.monotonically_increasing_id()), "articles")


def _packed(spark, sf, table="pages"):
    return B.pack_batches(_stored_articles(spark, sf, table), RUN_ID, _now(), PACK_SIZE)


def _digest(batches):
    line = F.transform("pages", lambda p: F.concat_ws("|", *(
        F.coalesce(p[f.name].cast("string"), F.lit("-")) for f in ARTICLE_SCHEMA)))
    return batches.select(
        "batch_id", "page_count", F.md5(F.array_join(line, "\n")).alias("digest"))


def _page_state(spark, sf):
    """The state with the URLs of the given pages waiting in it."""
    seen = F.lit("2024-01-15 00:00:00").cast("timestamp")
    urls = read_table(spark, sf, "pages").select("url", F.lit(None).cast("string").alias("lastmod"))
    return S.insert_if_absent(urls, _state(spark, sf), seen)


# --- sources and sinks ------------------------------------------------------------

@query
def sitemap_urlset(spark, sf):
    return sitemaps.urlset_entries(_docs(spark, sf))


@query
def sitemap_video(spark, sf):
    return sitemaps.video_entries(_docs(spark, sf))


@query
def sitemap_index(spark, sf):
    return sitemaps.index_children(_index_docs(spark, sf))


@query
def sitemap_expand(spark, sf):
    return sitemaps.expand_sitemaps(_docs(spark, sf), _index_docs(spark, sf))


@query
def news_sitemap(spark, sf):
    docs = _docs(spark, sf).unionByName(render.news_docs(fixture(spark, sf, "sitemap_news")))
    return sitemaps.news_entries(docs, render.NEWS_URL).select("url", "lastmod")


@query
def state_scan(spark, sf):
    path = tables.shared_dir(spark) + "/state"
    tables.write_snapshot(_state(spark, sf), path)
    return tables.scan_state(spark, path, ["url", "status", "crawled_at", "content_hash"])


@query
def batch_sink(spark, sf):
    path = tables.shared_dir(spark) + "/batches"
    tables.append_batches(_packed(spark, sf), path)
    return _digest(tables.read_batches(spark, path))


@query
def dry_run_summary(spark, sf):
    return B.dry_run_summary(_packed(spark, sf))


# --- filters and projections ------------------------------------------------------

@query
def article_url_filter(spark, sf):
    return _main(spark, sf)


@query
def valid_article(spark, sf):
    return X.valid_article(_articles(spark, sf)).select("page_id", "url")


@query
def pending_filter(spark, sf):
    return S.pending(_state(spark, sf))


@query
def stale_run_filter(spark, sf):
    return R.drop_stale(_runs(spark, sf))


@query
def crawled_filter(spark, sf):
    return S.crawled(_state(spark, sf))


@query
def batch_projection(spark, sf):
    fields = _scanned(spark, sf, "pages", X.TITLE + X.CONTENT).select(
        "url", X.title().alias("title"), X.content().alias("content"))
    return B.batch_projection(fields)


# --- extraction -------------------------------------------------------------------

def _field(name, table, column, key, wanted):
    def run(spark, sf):
        return _scanned(spark, sf, table, wanted).select("page_id", column().alias(key))
    run.__name__ = name
    return query(run)


_field("extract_title", "pages", X.title, "title", X.TITLE)
_field("extract_author", "article_pages", X.author, "author", X.AUTHOR)
_field("extract_published", "article_pages", X.published_date, "published_date", X.PUBLISHED)
_field("extract_content", "pages", X.content, "content", X.CONTENT)
_field("extract_category", "article_pages", X.category, "category", X.CATEGORY)
_field("extract_tags", "article_pages", X.tags, "tags", X.TAGS)
_field("extract_images", "article_pages", X.images, "images", X.IMAGES)
_field("extract_description", "article_pages", X.description, "description", X.DESCRIPTION)


@query
def word_count(spark, sf):
    return _articles(spark, sf, "pages").select("page_id", "word_count", "language")


@query
def extract_articles(spark, sf):
    return _articles(spark, sf)


@query
def selector_fallback(spark, sf):
    """Text, then the ``content`` attribute, then ``src``, by element."""
    return _scanned(spark, sf, "article_pages", X.TITLE + X.DESCRIPTION + X.IMAGES).select(
        "page_id", X.first_value(X.TITLE).alias("from_text"),
        X.first_value(X.DESCRIPTION).alias("from_content"),
        X.first_value(X.IMAGES).alias("from_src"))


# --- scalar functions -------------------------------------------------------------

@query
def strip_html(spark, sf):
    return read_table(spark, sf, "pages").select(
        "page_id", T.strip_html(F.col("html")).alias("text"))


@query
def clean_text(spark, sf):
    return read_table(spark, sf, "documents").select(
        "doc_id", T.clean_text(F.col("text")).alias("text"))


@query
def content_hash(spark, sf):
    return read_table(spark, sf, "documents").select(
        "doc_id", T.content_hash(F.col("text")).alias("content_hash"))


@query
def error_truncate(spark, sf):
    text = F.col("text")
    return read_table(spark, sf, "documents").select(
        "doc_id", T.truncate(text, 500).alias("state_message"),
        T.truncate(text, 300).alias("fetch_message"),
        T.truncate(text, 200).alias("batch_message"))


@query
def url_lower_match(spark, sf):
    return read_table(spark, sf, "pages").select(
        "page_id", U.url_matches(F.col("url"), U.NON_ARTICLE_PATTERNS).alias("rejected"),
        U.url_matches(F.col("url"), U.ARTICLE_PATTERNS).alias("accepted"))


@query
def day_of_run(spark, sf):
    return _runs(spark, sf).select("crawl_id", N.day(F.col("start_time")).alias("day"))


@query
def pct_1dp(spark, sf):
    return _runs(spark, sf).select(
        "crawl_id", N.percent(F.col("successful_urls"), F.col("processed_urls")).alias("percent"))


# --- joins and keyed updates --------------------------------------------------------

@query
def sitemap_merge(spark, sf):
    return _merged(spark, sf)


@query
def insert_if_absent(spark, sf):
    return S.insert_if_absent(_merged(spark, sf), _state(spark, sf), _now())


@query
def new_vs_done(spark, sf):
    return S.new_vs_done(_merged(spark, sf), _state(spark, sf))


def _results(spark, sf):
    """Results for all of the state, dealt by URL while narrow: a small file, read by one task, gives long messages."""
    return _state(spark, sf).select(
        "url", (F.coalesce("scrape_count", F.lit(0)) % 2 == 0).alias("ok")).repartition("url")


@query
def mark_done(spark, sf):
    stored = _results(spark, sf).where("ok").select(
        "url", F.lit("run-7").alias("batch_id"),
        F.md5(F.concat("url", F.lit("x"))).alias("content_hash"))
    return S.mark_done(_state(spark, sf), stored, _now())


@query
def mark_error(spark, sf):
    failures = _results(spark, sf).where("NOT ok").select(
        "url", F.repeat("url", F.lit(20)).alias("error_message"))
    return S.mark_error(_state(spark, sf), failures, _now())


def _in_place(spark, sf, changes, apply):
    """A state table, after an update that rewrites the buckets it hits."""
    path = tables.shared_dir(spark, "state")
    state_table.create_state(_state(spark, sf), path, STATE_BUCKETS)
    state_table.update_state(spark, path, changes, apply)
    return state_table.read_state(spark, path)


@query
def insert_in_place(spark, sf):
    return _in_place(spark, sf, _merged(spark, sf), lambda old, new: S.insert_if_absent(new, old, _now()))


@query
def mark_done_in_place(spark, sf):
    stored = _results(spark, sf).where("ok").select(
        "url", F.lit("run-7").alias("batch_id"), F.md5(F.concat("url", F.lit("x"))).alias("content_hash"))
    return _in_place(spark, sf, stored, lambda old, new: S.mark_done(old, new, _now()))


@query
def mark_error_in_place(spark, sf):
    failures = _results(spark, sf).where("NOT ok").select("url", F.repeat("url", F.lit(20)).alias("error_message"))
    return _in_place(spark, sf, failures, lambda old, new: S.mark_error(old, new, _now()))


@query
def reset_done(spark, sf):
    return S.reset_done(_state(spark, sf))


@query
def reset_errors(spark, sf):
    return S.reset_errors(_state(spark, sf))


@query
def apply_batch_outcome(spark, sf):
    path = tables.shared_dir(spark) + "/batches"
    tables.append_batches(_packed(spark, sf), path)
    batches = tables.read_batches(spark, path)
    number = F.substring_index("batch_id", "-", -1).cast("bigint")
    results = batches.select(
        "batch_id", (number % 4 != 3).alias("ok"),
        F.concat(F.lit("quota exceeded for "), "batch_id").alias("error"))
    return B.apply_batch_outcome(
        _page_state(spark, sf), B.batch_members(batches), results, _now())


@query
def checkpoint_upsert(spark, sf):
    end = F.lit("2002-01-01 00:00:00").cast("timestamp")
    runs = _runs(spark, sf)
    updates = runs.where("status = 'running'").select(
        "crawl_id", (F.col("processed_urls") + 1).alias("processed_urls"),
        F.lit(None).cast("bigint").alias("successful_urls"),
        (F.col("failed_urls") + 1).alias("failed_urls"), F.lit("completed").alias("status"))
    return R.start_run(
        R.update_runs(runs, updates, end), F.lit("crawl_new"), F.lit("full"), end)


# --- aggregations -------------------------------------------------------------------

@query
def state_stats(spark, sf):
    return S.state_stats(_state(spark, sf))


@query
def pending_count(spark, sf):
    return S.pending_count(_state(spark, sf))


@query
def run_summary(spark, sf):
    attempts = fixture(spark, sf, "attempts").withColumn(
        "crawl_id", F.to_date("ts").cast("string"))
    return A.run_summary(attempts)


@query
def batch_pack(spark, sf):
    return _digest(_packed(spark, sf, "article_pages"))


@query
def attempt_outcome(spark, sf):
    return A.attempt_outcome(fixture(spark, sf, "attempts"))


@query
def state_fold(spark, sf):
    return A.state_fold(_runs_of(fixture(spark, sf, "attempts")))


@query
def progress(spark, sf):
    return R.progress(_state(spark, sf))


@query
def success_rate(spark, sf):
    return R.success_rate(_runs(spark, sf))


@query
def latest_rate(spark, sf):
    return R.latest_rate(_runs(spark, sf))


@query
def eta(spark, sf):
    return R.time_left(_state(spark, sf), _runs(spark, sf))


def _today(spark, sf):
    return read_table(spark, sf, "orders").agg(F.max("o_orderdate")).scalar()


@query
def daily_series(spark, sf):
    return R.daily_series(_runs(spark, sf), _today(spark, sf), max_runs=None)


@query
def today_total(spark, sf):
    return R.today_total(_runs(spark, sf), _today(spark, sf))


@query
def url_dedup(spark, sf):
    return M.unique_urls(_main(spark, sf), _news(spark, sf))


@query
def source_counts(spark, sf):
    return M.source_counts(_main(spark, sf), _news(spark, sf), _state(spark, sf))


# --- top-k ---------------------------------------------------------------------------

@query
def pending_queue(spark, sf):
    return S.pending_queue(_state(spark, sf), 100)


@query
def recent_crawled(spark, sf):
    return S.recent_crawled(_state(spark, sf))


@query
def recent_checkpoints(spark, sf):
    return R.recent_runs(_runs(spark, sf))


@query
def runs_table(spark, sf):
    return R.runs_table(_runs(spark, sf))


@query
def max_urls(spark, sf):
    return S.run_queue(_state(spark, sf), 250)


@query
def preview(spark, sf):
    return M.preview(_merged(spark, sf))


# --- streaming -----------------------------------------------------------------------

def _event_stream(spark, sf):
    """The events table read as a stream, be it one file or a folder of files."""
    path = f"{sf.rstrip('/')}/{{events.parquet}}"   # a stream takes one file only as a glob
    return folds.attempt_stream(spark, path, read_table(spark, sf, "events").schema)


def _stored_outcomes(spark, sf):
    out = tables.shared_dir(spark)
    attempts = _runs_of(spark.sql(FIXTURES["attempts"], events=_event_stream(spark, sf)))
    folds.stream_outcomes(attempts, out + "/parts", out + "/check").awaitTermination()
    return folds.stored_partials(spark, out + "/parts")


@query
def stream_state_fold(spark, sf):
    return folds.combined_state(_stored_outcomes(spark, sf))


@query
def stream_daily(spark, sf):
    return folds.combined_daily(_stored_outcomes(spark, sf))


# --- change detection ------------------------------------------------------------------

@query
def content_changed(spark, sf):
    url = F.col("url")
    crawl = fixture(spark, sf, "sitemap_main").select(
        "url", "pos", F.when(F.col("pos") % 2 == 0, F.md5(F.concat(url, F.lit("x"))))
        .otherwise(F.md5(url)).alias("content_hash"))
    return C.content_changed(crawl, _state(spark, sf), "pos")


@query
def lastmod_changed(spark, sf):
    return C.lastmod_changed(_merged(spark, sf), _state(spark, sf))


# --- whole jobs --------------------------------------------------------------------------

@query
def sitemap_refresh(spark, sf):
    state = flows.refresh_state(
        _docs(spark, sf), _index_docs(spark, sf), _news(spark, sf), _state(spark, sf), _now())
    return S.state_stats(state)


@query
def check_new(spark, sf):
    return flows.check_new(_main(spark, sf), _news(spark, sf), _state(spark, sf))


def _run(spark, sf, state, mode):
    """The state before and after a run over the given pages, with failed fetches and batches."""
    attempts = fixture(spark, sf, "attempts")
    urls = read_table(spark, sf, "pages").select("url").unionByName(attempts.select("url"))
    waiting = S.insert_if_absent(
        urls.withColumn("lastmod", F.lit(None).cast("string")), state, F.lit("2024-01-15 00:00:00").cast("timestamp"))

    def insert(batches):
        number = F.substring_index("batch_id", "-", -1).cast("int")
        ok = number % 4 != 3
        return batches.select("batch_id", ok.alias("ok"), F.when(~ok, "no space").alias("error"))

    after = flows.crawl_cycle(
        spark, waiting, read_table(spark, sf, "pages").select("url", "html"), tables.shared_dir(spark), RUN_ID,
        _now(), mode, batch_size=PACK_SIZE, attempts=attempts, insert=insert)
    return waiting, after


def _run_state(state):
    return state.select("url", "status", "batch_id", "content_hash", "error_message", "scrape_count")


@query
def crawl_cycle(spark, sf):
    empty = spark.createDataFrame([], S.STATE_SCHEMA)
    return _run_state(_run(spark, sf, empty, "incremental")[1])


@query
def crawl_cycle_full(spark, sf):
    return _run_state(_run(spark, sf, _state(spark, sf), "full")[1])


@query
def record_run(spark, sf):
    before, after = _run(spark, sf, _state(spark, sf), "full")
    return flows.record_run(
        fixture(spark, sf, "checkpoints"), before, after, RUN_ID, "full",
        F.lit("2024-03-01 00:00:00").cast("timestamp"), F.lit("2024-03-01 01:00:00").cast("timestamp"))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Which URLs are new, and how many wait: merge, insert, count by status."""
    empty = spark.createDataFrame([], S.STATE_SCHEMA)
    return S.state_stats(S.insert_if_absent(_merged(spark, sf), empty, _now()))
