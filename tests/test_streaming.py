from __future__ import annotations

from pyspark.sql import functions as F

from folioloom.operators import attempts as A
from folioloom.streaming import folds
from helpers import rows
from test_state import attempts_log


def add_files(spark, path, df, parts):
    """Files with the attempts whose number leaves one of these remainders by 3: runs and URLs are
    cut across files, and later files hold earlier attempts."""
    (df.where((F.col("event_id") % 3).isin(parts)).repartition(2).write.mode("append").parquet(path))


def test_fold_resumes_counts_late_attempts_and_equals_the_batch_fold(spark, tmp_path):
    src, table, check = (str(tmp_path / n) for n in ("src", "parts", "check"))
    _, df = attempts_log(spark, 1200)
    schema = df.schema

    def run():
        stream = folds.attempt_stream(spark, src, schema, files_per_trigger=1)
        folds.stream_outcomes(stream, table, check).awaitTermination()
        return spark.read.parquet(table)

    add_files(spark, src, df, [2])
    assert rows(folds.combined_state(run()), "url") == rows(A.state_fold(df.where("event_id % 3 = 2")), "url")
    add_files(spark, src, df, [0, 1])
    parts = run()
    assert rows(folds.combined_state(parts), "url") == rows(A.state_fold(df), "url")
    assert rows(folds.combined_state(run()), "url") == rows(A.state_fold(df), "url")      # nothing new
    assert parts.select("part").distinct().count() > 2

    want = A.run_summary(df).agg(F.sum("processed").alias("n")).first().n
    assert [(str(d), n) for d, n in rows(folds.combined_daily(parts), "day")] == [("2024-01-01", want)]


def test_many_micro_batches_leave_few_folders(spark, tmp_path):
    from folioloom.sources.manifest import names, read_manifest

    table = str(tmp_path / "parts")
    assert folds.combined_state(folds.stored_partials(spark, table)).count() == 0
    assert folds.combined_daily(folds.stored_partials(spark, table)).count() == 0
    _, df = attempts_log(spark, 600)
    df = df.cache()
    for number in range(30):
        folds.store_part(df.where((F.col("event_id") % 30) == number), number, table, every=3)
        if number in (1, 13, 29):
            want = rows(A.state_fold(df.where((F.col("event_id") % 30) <= number)), "url")
            assert rows(folds.combined_state(folds.stored_partials(spark, table)), "url") == want
    folders = [n for n in names(spark, table) if not n.startswith("_")]
    # 30 = 1 * 27 + 0 * 9 + 1 * 3 parts in folds of size 4, 2 and none left over.
    assert len(folders) == 2 and read_manifest(spark, table)[1]["upto"] == 29

    # The last micro-batch again, as after a break before its commit.
    folds.store_part(df.where((F.col("event_id") % 30) == 29), 29, table, every=3)
    assert rows(folds.combined_state(folds.stored_partials(spark, table)), "url") == rows(A.state_fold(df), "url")


def test_a_compaction_that_breaks_off_is_repeated(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "parts")
    _, df = attempts_log(spark, 300)
    parts = [df.where((F.col("event_id") % 4) == n) for n in range(4)]
    for n in range(3):
        folds.store_part(parts[n], n, table, every=100)

    def breaks(*_):
        raise OSError("gone")

    def seen():
        return rows(folds.combined_state(folds.stored_partials(spark, table)), "url")

    want = rows(A.state_fold(df.where("event_id % 4 < 3")), "url")
    with monkeypatch.context() as broken:          # the fold is written, the manifest is not
        broken.setattr(folds, "write_manifest", breaks)
        try:
            folds.compact(spark, table, ("crawl_id", "url"), 2)
            raise AssertionError
        except OSError:
            pass
    assert seen() == want
    with monkeypatch.context() as broken:          # the manifest is written, nothing is deleted
        broken.setattr(folds, "sweep", breaks)
        try:
            folds.compact(spark, table, ("crawl_id", "url"), 2)
            raise AssertionError
        except OSError:
            pass
    assert seen() == want
    folds.store_part(parts[3], 3, table, every=2)
    assert seen() == rows(A.state_fold(df), "url")
