from __future__ import annotations

from pyspark.sql import functions as F

from folioloom.operators import attempts as A, runs as R, state as S
from folioloom.plans import flows
from folioloom.schemas import RUN_SCHEMA, STATE_SCHEMA
from helpers import rows, ts


def runs(spark, *rs):
    """Rows as (crawl_id, status, start, end, processed, successful)."""
    df = spark.createDataFrame(list(rs), "crawl_id string, status string, s string, e string, "
                               "processed_urls bigint, successful_urls bigint")
    given = {"start_time": F.col("s"), "end_time": F.col("e"), "mode": F.lit("incremental"),
             "total_urls": F.lit(0), "failed_urls": F.lit(None)}
    return df.select(*[
        given.get(f.name, F.col(f.name) if f.name in df.columns else F.lit(None))
        .cast(f.dataType).alias(f.name) for f in RUN_SCHEMA])


def test_run_life(spark):
    table = R.start_run(runs(spark, ("a", "running", "2024-01-01", None, 3, None)),
                        F.lit("b"), F.lit("full"), ts("2024-01-02"))
    updates = spark.createDataFrame(
        [("a", 9, None, None, "completed"), ("b", None, 4, None, None), ("zz", 1, 1, 1, "failed")],
        "crawl_id string, processed_urls bigint, successful_urls bigint, failed_urls bigint, status string")
    got = R.update_runs(table, updates, ts("2024-01-03"))
    assert got.schema.names == RUN_SCHEMA.names
    assert rows(got.select("crawl_id", "mode", "status", "processed_urls", "successful_urls",
                           F.col("end_time").cast("date").cast("string")), "crawl_id") == [
        ("a", "incremental", "completed", 9, None, "2024-01-03"),
        ("b", "full", "running", None, 4, None)]


def test_stale_runs(spark):
    table = runs(spark, ("a", "running", "2024-01-01", None, 0, 0), ("b", "running", "2024-01-01", None, None, 0),
                 ("c", "running", "2024-01-01", None, 1, 0), ("d", None, "2024-01-01", None, 0, 0),
                 ("e" * 40, "failed", "2024-01-02", None, 0, 0))
    assert [r[0] for r in rows(R.runs_table(table))] == ["e" * 30, "d", "c"]


def test_rates(spark):
    table = runs(spark, ("a", "completed", "2024-01-01 00:00:00", "2024-01-01 00:00:10", 50, 10),
                 ("b", "completed", "2024-01-02 00:00:00", "2024-01-02 00:00:04.500", 9, 9),
                 ("c", "running", "2024-01-03 00:00:00", None, 100, 0))
    assert rows(R.latest_rate(table)) == [(2.0,)]
    assert rows(R.latest_rate(table.where("status = 'running'"))) == [(0.0,)]
    assert rows(R.latest_rate(table, recent=1)) == [(0.0,)]
    assert rows(R.success_rate(table)) == [(59, 19, 32.2)]
    assert rows(R.success_rate(table.where("false"))) == [(0, 0, 0.0)]
    state = spark.createDataFrame([("u", "pending")] * 10 + [("v", "done")] * 5, "url string, status string")
    assert rows(R.time_left(state, table)) == [(10, 2.0, "~1 hours")]
    assert rows(R.progress(state)) == [(5, 15, 33.3)]


def test_daily_series(spark):
    table = runs(spark, ("a", "completed", "2024-01-14 23:59:59", None, 5, 0),
                 ("b", "completed", "2024-01-14 00:00:00", None, 6, 0),
                 ("c", "completed", "2024-01-01 10:00:00", None, 7, 0),
                 ("d", "completed", "2023-12-31 10:00:00", None, 8, 0))
    got = rows(R.daily_series(table, ts("2024-01-14 12:00:00")), "day")
    assert [n for _, n in got] == [7] + [0] * 12 + [11]
    assert [n for _, n in rows(R.daily_series(table, ts("2024-01-14"), max_runs=1), "day")][-1] == 5
    assert rows(R.today_total(table, ts("2024-01-14 12:00:00"))) == [(11,)]


def test_run_summary(spark):
    log = [("r", "a", 1, "2024-01-01 00:00:00", 429, None, None),
           ("r", "a", 2, "2024-01-01 00:00:02", 200, True, None),
           ("r", "b", 1, "2024-01-01 00:00:04", 404, None, None),
           ("q", "a", 1, "2024-01-01 00:00:04", 200, True, None)]
    df = spark.createDataFrame(log, "crawl_id string, url string, attempt int, t string, "
                               "http_status int, valid boolean, exception string")
    df = df.withColumn("ts", F.col("t").cast("timestamp"))
    assert rows(A.run_summary(df), "crawl_id") == [("q", 1, 1, 0, 0.0), ("r", 2, 1, 1, 0.5)]


def page(title, body):
    return f"<h1>{title}</h1><article>{body}</article>"


def cycle(spark, out, **options):
    state = spark.createDataFrame([], STATE_SCHEMA)
    urls = [("good1",), ("good2",), ("bad",), ("worn",), ("done",)]
    state = state.unionByName(spark.createDataFrame(urls, "url string").select(*[
        {"url": F.col("url"),
         "status": F.when(F.col("url") == "done", "done").when(F.col("url") == "worn", "error")
         .otherwise("pending"), "scrape_count": F.when(F.col("url") == "worn", 4),
         "first_seen": ts("2024-01-01")}
        .get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in STATE_SCHEMA]))
    body = "x" * 150
    pages = spark.createDataFrame(
        [(u, page("A long title", body if u != "bad" else "short")) for u, in urls]
        + [("unknown", page("A long title", body))], "url string, html string")
    got = flows.crawl_cycle(spark, state, pages, out, "run", ts("2024-03-01"), batch_size=2, **options)
    return {r.url: (r.status, r.scrape_count, r.error_message) for r in got.collect()}


def test_crawl_cycle(spark, tmp_path):
    want = {"good1": ("done", None, None), "good2": ("done", None, None),
            "bad": ("pending", 1, "No content extracted or validation failed"),
            "worn": ("done", 4, None), "done": ("done", None, None)}
    assert cycle(spark, str(tmp_path / "a")) == want
    stored = spark.read.parquet(str(tmp_path / "a/batches"))
    assert sorted(r.page_count for r in stored.collect()) == [1, 2]
    assert cycle(spark, str(tmp_path / "b"), max_urls=100) == want
    assert cycle(spark, str(tmp_path / "c"), mode="full") == want
    one = cycle(spark, str(tmp_path / "d"), max_urls=1)
    assert one["bad"][1] == 1 and one["good1"][0] == "pending"
    assert spark.read.parquet(str(tmp_path / "c/articles")).count() == 5
    assert cycle(spark, str(tmp_path / "a")) == want          # again after a break
    assert spark.read.parquet(str(tmp_path / "a/batches")).count() == 2
    assert spark.read.parquet(str(tmp_path / "a/articles")).count() == 4


def test_crawl_cycle_leaves_its_outputs_only(spark, tmp_path):
    import os

    from folioloom.sources import tables

    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    with tables.scope():
        cycle(spark, str(tmp_path / "a"), max_urls=3)
    assert set(os.listdir(shared)) == before
    assert sorted(n for n in os.listdir(tmp_path / "a")) == ["articles", "batches"]


def test_failed_fetches_and_batches_count_once(spark, tmp_path):
    urls = spark.createDataFrame([("good",), ("lost",), ("gone",), ("slow",), ("idle",)], "url string")
    before = S.new_urls(urls.withColumn("lastmod", F.lit(None).cast("string")),
                        spark.createDataFrame([], STATE_SCHEMA), ts("2024-01-01"))
    pages = spark.createDataFrame(
        [(u, page("A long title", "x" * 150)) for u in ("good", "lost")], "url string, html string")
    tries = [("gone", 1, 404, None)] + [("slow", i, 429, None) for i in (1, 2, 3)] + [
        ("good", 1, 500, None), ("unknown", 1, 404, None), ("idle", 1, 200, None)]
    attempts = spark.createDataFrame([(u, i, s, s == 200, e) for u, i, s, e in tries],
                                     "url string, attempt int, http_status int, valid boolean, exception string")

    def insert(batches):
        ok = F.col("pages")[0]["url"] == "good"
        return batches.select("batch_id", ok.alias("ok"), F.when(~ok, "full disk").alias("error"))

    after = flows.crawl_cycle(spark, before, pages, str(tmp_path), "run", ts("2024-03-01"), batch_size=1,
                              attempts=attempts, insert=insert)
    assert {r.url: (r.status, r.scrape_count, r.error_message) for r in after.collect()} == {
        "good": ("done", None, None), "lost": ("pending", 1, "Batch insert failed: full disk"),
        "gone": ("pending", 1, "HTTP 404 Not Found"), "slow": ("pending", 1, "All 3 fetch attempts failed"),
        "idle": ("pending", None, None)}
    table = flows.record_run(runs(spark, ("old", "completed", "2024-01-01", "2024-01-02", 1, 1)), before, after,
                             "run", "incremental", ts("2024-03-01"), ts("2024-03-02"))
    assert rows(table.where("crawl_id = 'run'").select(
        "status", "processed_urls", "successful_urls", "failed_urls")) == [("completed", 4, 1, 3)]


def test_crawl_cycle_with_a_url_fetched_many_times(spark, tmp_path):
    """A third of the pages are one URL; with a page id they are spread and all kept."""
    pages = spark.range(90).select(
        F.col("id").alias("page_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), "id")).alias("url"),
        F.lit(page("A long title", "x" * 150)).alias("html"))
    urls = pages.select("url", F.lit(None).cast("string").alias("lastmod"))
    state = S.new_urls(urls, spark.createDataFrame([], STATE_SCHEMA), ts("2024-01-01"))
    got = flows.crawl_cycle(spark, state, pages, str(tmp_path), "run", ts("2024-03-01"),
                            batch_size=7, keys=("url", "page_id"))
    assert rows(got.groupBy("status").count()) == [("done", 61)]
    sizes = sorted(r.page_count for r in spark.read.parquet(str(tmp_path / "batches")).collect())
    assert sizes == [6] + [7] * 12


def test_check_new(spark):
    entry = "url string, lastmod string, pos int"
    main = spark.createDataFrame([("a", None, 0), ("b", None, 1)], entry)
    news = spark.createDataFrame([("c", None)], "url string, lastmod string")
    state = spark.createDataFrame([("a", True), ("z", False)], "url string, c boolean").withColumn(
        "crawled_at", F.when(F.col("c"), ts("2024-01-01")))
    assert rows(flows.check_new(main, news, state)) == [(2, 1, 3, 2, 2, 1)]
