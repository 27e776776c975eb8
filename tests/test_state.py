from __future__ import annotations

import random

from pyspark.sql import functions as F

from folioloom.operators import attempts as A, batches as B, changes as C, state as S
from folioloom.schemas import STATE_SCHEMA
from folioloom.sources import tables
from helpers import plan, rows, ts

NOW = "2024-03-01 00:00:00"


def state(spark, *rs):
    """Rows as (url, status, scrape_count)."""
    df = spark.createDataFrame(list(rs), "url string, status string, scrape_count int")
    extra = {"lastmod": "2020", "first_seen": "2024-01-01", "crawled_at": "2024-02-01",
             "batch_id": "b0", "content_hash": "h0", "error_message": "e0"}
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(extra[f.name]))
        .cast(f.dataType).alias(f.name) for f in STATE_SCHEMA])


def brief(df):
    return rows(df.select("url", "status", "scrape_count", "batch_id", "content_hash",
                          "error_message"), "url")


def test_insert_twice_inserts_nothing(spark):
    old = state(spark, ("a", "done", 1))
    entries = spark.createDataFrame([("a", "2024"), ("b", None), ("b", "2023"), ("c", None)],
                                    "url string, lastmod string")
    assert rows(S.new_urls(entries, old, ts(NOW)).select("url", "lastmod", "status"), "url") == [
        ("b", "2023", "pending"), ("c", None, "pending")]
    once = S.insert_if_absent(entries, old, ts(NOW))
    assert once.schema.names == STATE_SCHEMA.names
    assert S.new_urls(entries, once, ts(NOW)).count() == 0
    assert rows(once.where("url = 'a'")) == rows(old)


def test_mark_done_keeps_the_retry_count(spark):
    old = state(spark, ("a", "pending", 2), ("b", "pending", None))
    stored = spark.createDataFrame([("a", "b7", "h7"), ("zz", "b7", "h")],
                                   "url string, batch_id string, content_hash string")
    assert brief(S.mark_done(old, stored, ts(NOW))) == [
        ("a", "done", 2, "b7", "h7", None), ("b", "pending", None, "b0", "h0", "e0")]


def test_mark_error_bounds(spark):
    old = state(spark, ("a", "pending", 2), ("b", "pending", 1), ("c", "pending", None),
                ("d", "done", 0))
    bad = spark.createDataFrame([(u, "x" * 900) for u in "abc"] + [("zz", "m")],
                                "url string, error_message string")
    got = S.mark_error(old, bad, ts(NOW), max_retries=3)
    assert [(r[0], r[1], r[2], len(r[5])) for r in brief(got)] == [
        ("a", "error", 3, 500), ("b", "pending", 2, 500), ("c", "pending", 1, 500),
        ("d", "done", 0, 2)]
    assert {str(r[0])[:10] for r in rows(got.where("url < 'd'").select("crawled_at"))} == {"2024-03-01"}


def test_resets(spark):
    s = state(spark, ("a", "done", 2), ("b", "error", 4), ("c", "error", 5), ("d", "error", None),
              ("e", "pending", 1), ("f", None, 1))
    done = S.reset_done(s)
    assert rows(done.where("url = 'a'").select("status", "crawled_at", "batch_id", "content_hash",
                                               "scrape_count")) == [("pending", None, None, "h0", 2)]
    assert done.where("status = 'done'").count() == 0
    errors = S.reset_errors(s, 5)
    assert [(r[0], r[1], r[5]) for r in brief(errors)] == [
        ("a", "done", "e0"), ("b", "pending", None), ("c", "error", "e0"),
        ("d", "pending", None), ("e", "pending", "e0"), ("f", None, "e0")]
    assert rows(S.state_stats(s)) == [(6, 1, 1, 3)]


def attempts_log(spark, n, seed=1, hot=True):
    """A log in which one URL has a third of all attempts; a run is 200 attempts long."""
    rnd, tries = random.Random(seed), {}
    log = []
    for i in range(n):
        url, run = "hot" if hot and i % 3 == 0 else f"u{rnd.randrange(60)}", f"r{i // 200:03d}"
        tries[run, url] = tries.get((run, url), 0) + 1
        status = rnd.choice([200, 200, 200, 404, 429, 503, 500, None])
        log.append((run, url, tries[run, url], f"2024-01-01 {i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d}", status,
                    rnd.random() < 0.6, "boom" if rnd.random() < 0.3 else None, i, f"h{i}"))
    df = spark.createDataFrame(log, "crawl_id string, url string, attempt int, t string, http_status int, "
                               "valid boolean, exception string, event_id bigint, content_hash string")
    return log, df.withColumn("ts", F.col("t").cast("timestamp")).drop("t")


def settle(tries):
    """The outcome of one URL in one run: (error, hash, time of the last try)."""
    tries = [x for x in tries if x[2] <= 3]
    for _, _, attempt, _, status, valid, exc, _, digest in tries:
        if exc and attempt < 3 or not exc and status in (429, 503):
            continue
        if exc or status is None:
            error = exc or "HTTP No response"
        elif status == 200:
            error = None if valid else "No content extracted or validation failed"
        else:
            error = "HTTP 404 Not Found" if status == 404 else f"HTTP {status}"
        return error, digest, tries[-1][3]
    return "All 3 fetch attempts failed", None, tries[-1][3]


def replay(log, start, max_retries=3):
    """Step by step, one update per URL and run."""
    now, by = dict(start), {}
    for entry in log:
        by.setdefault(entry[:2], []).append(entry)
    for (run, url), tries in sorted(by.items()):
        if url not in now:
            continue
        row = dict(now[url])
        error, digest, row["crawled_at"] = settle(tries)
        if error is None:
            row.update(status="done", hash=digest, error=None)
        else:
            row["count"] = (row["count"] or 0) + 1
            row["status"] = "error" if row["count"] >= max_retries else "pending"
            row["error"] = error
        now[url] = row
    return now


def test_fold_equals_step_by_step(spark):
    log, df = attempts_log(spark, 1500)
    urls = sorted({r[1] for r in log})
    start = {u: {"status": "pending", "count": None, "hash": None, "error": None} for u in urls}
    want = replay(log, start)
    got = rows(A.state_fold(df).select("url", "status", "scrape_count", "content_hash",
                                       "error_message", F.col("crawled_at").cast("string")), "url")
    assert got == [(u, want[u]["status"], want[u]["count"] or 0, want[u]["hash"],
                    want[u]["error"], want[u]["crawled_at"]) for u in urls]


def test_changes_on_a_state_equal_step_by_step(spark):
    log, df = attempts_log(spark, 900, seed=5)
    old = state(spark, ("hot", "pending", 1), ("u1", "done", None), ("u2", "error", 4),
                ("idle", "pending", 0))
    start = {u: {"status": s, "count": n, "hash": "h0", "error": "e0"} for u, s, n in
             [("hot", "pending", 1), ("u1", "done", None), ("u2", "error", 4), ("idle", "pending", 0)]}
    want = replay(log, start)
    got = S.apply_changes(old, A.attempt_changes(df))
    assert [(r[0], r[1], r[2], r[4], r[5]) for r in brief(got)] == [
        (u, w["status"], w["count"], w["hash"], w["error"]) for u, w in sorted(want.items())]


def outcome(spark, *log):
    df = spark.createDataFrame(
        [("u", i + 1, *r) for i, r in enumerate(log)],
        "url string, attempt int, http_status int, valid boolean, exception string")
    return rows(A.attempt_outcome(df))[0][1:]


def test_attempt_outcomes(spark):
    again, down = (429, None, None), (503, None, None)
    assert outcome(spark, again, again, down) == ("error", "All 3 fetch attempts failed")
    assert outcome(spark, again, (200, True, None)) == ("success", None)
    assert outcome(spark, (200, False, None), (200, True, None)) == (
        "error", "No content extracted or validation failed")
    assert outcome(spark, (404, None, None)) == ("error", "HTTP 404 Not Found")
    assert outcome(spark, (500, None, None)) == ("error", "HTTP 500")
    assert outcome(spark, (None, None, None)) == ("error", "HTTP No response")
    assert outcome(spark, (None, None, "a"), (None, None, "b"), (None, None, "c" * 400)) == (
        "error", "c" * 300)
    assert outcome(spark, (None, None, "a"), again, again, (200, True, None)) == (
        "error", "All 3 fetch attempts failed")


def test_large_queue_equals_top_k(spark):
    s = state(spark, *[(f"u{i:04d}", "pending" if i % 4 else "done", 0) for i in range(2000)])
    s = s.withColumn("first_seen", F.when(F.col("url") > "u0700", ts(NOW))
                     .otherwise(F.col("first_seen")))
    for n in (1, 525, 526, 900, 5000):
        want = rows(S.pending_queue(s, n).select("url"), "url")
        assert rows(S.oldest_by_range(S.pending(s), n).select("url"), "url") == want
    assert S.run_queue(s, None).count() == 1500
    assert S.run_queue(s, 0).count() == 0


def test_bucketed_state_is_not_shuffled(spark):
    s = state(spark, *[(f"u{i}", "pending", 0) for i in range(200)])
    tables.save_state_table(s, "state_b", 4)
    stored = spark.table("state_b")
    bad = spark.createDataFrame([(f"u{i}", "m") for i in range(50)], "url string, error_message string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        updated = S.mark_error(stored, bad, ts(NOW))
        text = plan(updated)
        assert text.count("Exchange hashpartitioning") == 1     # the changes only
        assert updated.where("scrape_count = 1").count() == 50
        entries = spark.createDataFrame([("u1", "1"), ("new", "1")], "url string, lastmod string")
        text = plan(S.new_urls(entries, stored, ts(NOW)))
        assert text.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def test_failures_carry_a_message_once_and_no_longer_than_it_is_kept(spark):
    """Before they are grouped, too: a task sorts the rows it groups."""
    old = state(spark, ("a", "pending", 0), ("b", "pending", 1), ("c", "pending", None), ("d", "done", 0))
    long = "m" * 500
    bad = spark.createDataFrame(
        [("a", long + "x"), ("a", long + "y"), ("a", "l" * 900), ("b", None), ("c", None), ("c", "only"), ("gone", "z")],
        "url string, error_message string")
    updated = S.mark_error(old, bad, ts(NOW))
    assert [(r[0], r[1], r[2], r[5]) for r in brief(updated)] == [
        ("a", "error", 3, long), ("b", "pending", 2, None), ("c", "pending", 2, "only"), ("d", "done", 0, "e0")]
    grouped = [line for line in plan(updated).splitlines() if "partial_max" in line]
    assert len(grouped) == 1 and "substring(error_message" in grouped[0] and "seq" not in grouped[0]


def test_results_of_one_file_are_dealt_before_messages_are_made(spark):
    from folioloom.plans import queries as Q
    folder = tables.shared_dir(spark)
    spark.range(300).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(folder + "/customer.parquet")
    for name in ("mark_error", "mark_done"):
        updated = Q.QUERIES[name](spark, folder)
        lines = plan(updated).splitlines()
        dealt = next(i for i, line in enumerate(lines) if "REPARTITION_BY_COL" in line)
        grouped = [i for i, line in enumerate(lines) if "partial_" in line]
        assert grouped and max(grouped) < dealt and "repeat(" not in "".join(lines[dealt:])
        assert updated.count() == 300
    assert Q._results(spark, folder).count() == 300


def test_pending_filter_prunes_a_snapshot(spark):
    path = tables.shared_dir(spark)
    tables.write_snapshot(state(spark, ("a", "done", 0), ("b", "pending", 0)), path)
    read = S.pending(tables.scan_state(spark, path)).select("url")
    assert "PartitionFilters: [isnotnull(status" in plan(read)
    assert rows(read) == [("b",)]


def test_content_and_lastmod_changes(spark):
    s = state(spark, ("a", "done", 0), ("b", "done", 0), ("c", "pending", 0)).withColumn(
        "content_hash", F.when(F.col("url") != "c", F.col("content_hash"))).withColumn(
        "lastmod", F.when(F.col("url") != "c", F.col("lastmod")))
    crawl = spark.createDataFrame(
        [("a", "x", 1), ("a", "h0", 2), ("b", "x", 1), ("c", "x", 1), ("d", "x", 1)],
        "url string, content_hash string, n int")
    assert rows(C.content_changed(crawl, s, "n"), "url") == [
        ("a", "unchanged"), ("b", "changed"), ("c", "new"), ("d", "new")]
    merged = spark.createDataFrame([("a", "2021"), ("b", "2019"), ("c", "2001"), ("d", "2024")],
                                   "url string, lastmod string")
    assert rows(C.lastmod_changed(merged, s), "url") == [
        ("a", "2020", "2021"), ("c", None, "2001")]


def test_batch_outcome_is_all_or_nothing(spark):
    s = state(spark, ("a", "pending", 2), ("b", "pending", 0), ("c", "pending", 0))
    members = spark.createDataFrame([("a", "r-0", "ha"), ("b", "r-1", "hb"), ("c", "r-0", "hc")],
                                    "url string, batch_id string, content_hash string")
    results = spark.createDataFrame([("r-0", False, "q" * 400), ("r-1", True, None)],
                                    "batch_id string, ok boolean, error string")
    got = brief(B.apply_batch_outcome(s, members, results, ts(NOW)))
    text = "Batch insert failed: " + "q" * 200
    assert got == [("a", "error", 3, "b0", "h0", text), ("b", "done", 0, "r-1", "hb", None),
                   ("c", "pending", 1, "b0", "h0", text)]
