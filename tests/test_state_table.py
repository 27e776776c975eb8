"""The state as a table whose buckets are rewritten one by one."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from folioloom.operators import state as S
from folioloom.schemas import STATE_SCHEMA
from folioloom.sources import manifest, state_table, tables
from helpers import plan, rows, ts

BUCKETS = 16


def now():
    return ts("2024-03-01 00:00:00")


def state_of(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("https://s/news/"), "id").alias("url"), F.lit("2024").alias("lastmod"), ts("2024-01-01").alias("first_seen"),
        F.lit("pending").alias("status"), *[F.lit(None).cast(STATE_SCHEMA[c].dataType).alias(c) for c in STATE_SCHEMA.names[4:]])


def files(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture()
def table(spark, tmp_path):
    path = str(tmp_path / "state")
    state_table.create_state(state_of(spark, 4000), path, BUCKETS)
    return path


def test_updates_equal_the_plain_transitions(spark, table):
    state = state_of(spark, 4000)
    done = spark.range(0, 4400, 7).select(F.concat(F.lit("https://s/news/"), "id").alias("url"),
                                          F.lit("b").alias("batch_id"), F.lit("h").alias("content_hash"))
    bad = spark.range(0, 4000, 11).select(F.concat(F.lit("https://s/news/"), "id").alias("url"), F.lit("no").alias("error_message"))
    new = spark.range(3990, 4100).select(F.concat(F.lit("https://s/news/"), "id").alias("url"), F.lit(None).cast("string").alias("lastmod"))
    steps = [(done, lambda old, c: S.mark_done(old, c, now())), (bad, lambda old, c: S.mark_error(old, c, now())),
             (new, lambda old, c: S.insert_if_absent(c, old, now()))]
    for changes, apply in steps:
        state_table.update_state(spark, table, changes, apply)
        state = apply(state, changes)
        assert rows(state_table.read_state(spark, table), "url") == rows(state.select(*STATE_SCHEMA.names), "url")


def test_an_update_writes_the_buckets_it_hits(spark, table):
    """A change of a hundredth of one bucket writes that bucket."""
    bucket = state_table.bucket_of(F.col("url"), BUCKETS)
    changes = state_of(spark, 4000).where(bucket == 5).limit(3).select(
        "url", F.lit("b").alias("batch_id"), F.lit("h").alias("content_hash"))
    before = files(table)
    hit = state_table.update_state(spark, table, changes, lambda old, c: S.mark_done(old, c, now()))
    after = files(table)
    assert hit == [5] and {f: t for f, t in after.items() if f in before} == before
    written = set(after) - set(before)
    assert written and all("state_bucket=5" in f for f in written)
    assert sum(os.path.getsize(f"{table}/{f}") for f in written) < 2 * sum(os.path.getsize(f"{table}/{f}") for f in before) / BUCKETS
    read = state_table.read_state(spark, table, [5])
    assert all("state_bucket=5" in f for f in read.inputFiles())
    assert S.state_stats(state_table.read_state(spark, table)).first().done == 3

    # The old folder stays for one update more.
    state_table.update_state(spark, table, changes, lambda old, c: S.mark_done(old, c, now()))
    assert not set(before) & {f for f in files(table) if "state_bucket=5" in f}
    assert state_table.read_state(spark, table).count() == 4000


def test_an_update_that_breaks_off_changes_nothing(spark, table, monkeypatch):
    changes = state_of(spark, 50).select("url", F.lit("no").alias("error_message"))
    want = rows(state_table.read_state(spark, table), "url")

    def apply(old, c):
        return S.mark_error(old, c, now())

    def breaks(*_):
        raise OSError("gone")

    shared = spark.conf.get("spark.checkpoint.dir")
    stored = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    with monkeypatch.context() as broken:
        broken.setattr(state_table, "write_manifest", breaks)
        with pytest.raises(OSError):
            state_table.update_state(spark, table, changes, apply)
    assert rows(state_table.read_state(spark, table), "url") == want
    state_table.update_state(spark, table, changes, apply)
    assert state_table.read_state(spark, table).where("scrape_count = 1").count() == 50
    assert set(os.listdir(shared)) == stored


def test_two_writers_cannot_both_succeed(spark, table):
    number, content = manifest.read_manifest(spark, table)
    manifest.write_manifest(spark, table, number + 1, content)
    with pytest.raises(RuntimeError):
        manifest.write_manifest(spark, table, number + 1, content)


def test_changes_of_unknown_urls_and_no_changes(spark, tmp_path):
    path = str(tmp_path / "empty")
    state_table.create_state(state_of(spark, 0), path, 4)
    assert state_table.read_state(spark, path).count() == 0
    changes = spark.createDataFrame([("u", "m")], "url string, error_message string")
    assert len(state_table.update_state(spark, path, changes, lambda old, c: S.mark_error(old, c, now()))) == 1
    assert state_table.update_state(spark, path, changes.limit(0), lambda old, c: S.mark_error(old, c, now())) == []
    assert state_table.read_state(spark, path).count() == 0


def test_scopes_delete_what_was_stored(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    with tables.scope():
        with tables.scope() as inner:
            kept, lost = inner.keep(tables.store(spark.range(3))), tables.store(spark.range(4))
        assert kept.count() == 3 and os.path.basename(lost._folioloom_path) not in os.listdir(shared)
    assert os.path.basename(kept._folioloom_path) not in os.listdir(shared)
    with pytest.raises(ZeroDivisionError):
        with tables.scope():
            broken = tables.store(spark.range(3))
            raise ZeroDivisionError
    assert os.path.basename(broken._folioloom_path) not in os.listdir(shared)


def test_run_bounds_reach_the_scan(spark, tmp_path):
    from folioloom.operators import runs as R

    path = str(tmp_path / "runs")
    spark.range(40).select(
        F.concat(F.lit("r"), "id").alias("crawl_id"), F.timestamp_seconds(F.lit(1_700_000_000) + 40_000 * F.col("id")).alias("start_time"),
        F.col("id").alias("processed_urls")).write.parquet(path)
    today = F.lit("2023-11-20").cast("date")
    for df in (R.today_total(spark.read.parquet(path), today, None), R.daily_series(spark.read.parquet(path), today, 3, None)):
        text = plan(df)
        assert "GreaterThanOrEqual(start_time" in text and "LessThan(start_time" in text
