"""Streaming forms of the state fold and the daily series.

A micro-batch is folded to one row for each URL of a run and stored in a folder
of its own, which a repeated micro-batch overwrites: every attempt counts
exactly once, a restart goes on from the checkpoint, and there is no state to
keep between micro-batches.  Least and largest values of parts are those of
the whole, so the folds over the stored parts are complete at any moment, and
attempts count however late they come.

Parts are put together as they come: ``every`` of them make one fold, as many
folds a larger one, and so on.  After n micro-batches there are at most
``every`` folders of each size, of which there are log n, and a row has been
rewritten log n times.  A manifest names the folds that count and the last
micro-batch they hold; parts up to that one are ignored, and parts and folds
that another fold has replaced are deleted after it is named.  Broken off at
any point, the next micro-batch goes on from the manifest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from folioloom.operators.attempts import (
    finished_outcomes, folded_state, merged_partials, outcome_changes, partial_outcomes)
from folioloom.operators.state import fold_changes
from folioloom.schemas import MAX_FETCH_ATTEMPTS, MAX_RETRIES, PARTIAL_SCHEMA
from folioloom.sources.manifest import delete, names, read_manifest, write_manifest

FILES_PER_TRIGGER = 1000
EVERY = 20  # folders of one size


def attempt_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = FILES_PER_TRIGGER
) -> DataFrame:
    """A file stream; a backlog is read in micro-batches of so many files."""
    return (spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", files_per_trigger).parquet(path))


def store_part(
    rows: DataFrame, number: int, table: str, run: str = "crawl_id", max_attempts: int = MAX_FETCH_ATTEMPTS,
    every: int = EVERY,
) -> None:
    """Store a micro-batch as its part, and put parts together when there are enough."""
    spark = rows.sparkSession
    partial_outcomes(rows, (run, "url"), max_attempts).write.mode("overwrite").parquet(f"{table}/part={number}")
    if number % every == every - 1:
        compact(spark, table, (run, "url"), number, every)


def _parts_after(spark: SparkSession, table: str, upto: int) -> list[str]:
    numbers = sorted(int(n[5:]) for n in names(spark, table) if n.startswith("part="))
    return [f"part={n}" for n in numbers if n > upto]


def compact(spark: SparkSession, table: str, keys: Sequence[str], upto: int, every: int = EVERY) -> None:
    """Fold the parts up to a micro-batch, and folds of one size where there are ``every``."""
    version, manifest = read_manifest(spark, table)
    folds, done = manifest.get("folds", []), manifest.get("upto", -1)
    parts = [p for p in _parts_after(spark, table, done) if int(p[5:]) <= upto]
    if not parts:
        return
    merging, size = parts, 1
    # Larger folds come first: those at the end have the sizes below.
    while sum(f["size"] == size for f in folds) >= every - 1:
        merging = [f["folder"] for f in folds if f["size"] == size] + merging
        folds = [f for f in folds if f["size"] != size]
        size += 1
    folder = f"fold={version + 1}"
    merged_partials(spark.read.parquet(*(f"{table}/{f}" for f in merging)), keys).write.mode("overwrite").parquet(
        f"{table}/{folder}")
    write_manifest(spark, table, version + 1, {"folds": [*folds, {"size": size, "folder": folder}], "upto": upto})
    sweep(spark, table)


def sweep(spark: SparkSession, table: str) -> None:
    """Delete what the manifest does not name, parts still to be folded aside."""
    _, manifest = read_manifest(spark, table)
    kept = {f["folder"] for f in manifest.get("folds", [])} | set(_parts_after(spark, table, manifest.get("upto", -1)))
    for name in names(spark, table):
        if name.startswith(("part=", "fold=")) and name not in kept:
            delete(spark, f"{table}/{name}")


def stored_partials(spark: SparkSession, table: str) -> DataFrame:
    """All partial outcomes stored so far, each attempt in exactly one; none before the first micro-batch."""
    _, manifest = read_manifest(spark, table)
    folders = [f["folder"] for f in manifest.get("folds", [])] + _parts_after(spark, table, manifest.get("upto", -1))
    if not folders:
        return spark.createDataFrame([], PARTIAL_SCHEMA)
    return spark.read.parquet(*(f"{table}/{f}" for f in folders))


def stream_outcomes(
    attempts: DataFrame, table: str, checkpoint: str, run: str = "crawl_id",
    max_attempts: int = MAX_FETCH_ATTEMPTS, every: int = EVERY,
) -> StreamingQuery:
    """Store the partial outcomes of what has arrived, then stop."""

    def store(rows: DataFrame, number: int) -> None:
        store_part(rows, number, table, run, max_attempts, every)

    return (attempts.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def combined_state(
    partials: DataFrame, max_retries: int = MAX_RETRIES, run: str = "crawl_id",
    max_attempts: int = MAX_FETCH_ATTEMPTS,
) -> DataFrame:
    """The state from the stored parts; equals the fold of all attempts read so far."""
    outcomes = finished_outcomes(partials, (run, "url"), max_attempts)
    return folded_state(fold_changes(outcome_changes(outcomes, run)), max_retries)


def combined_daily(partials: DataFrame, run: str = "crawl_id") -> DataFrame:
    """``day, processed``: URLs processed, by the day on which a run last tried them."""
    per_url = partials.groupBy(run, "url").agg(F.max("last").alias("last"))
    return per_url.groupBy(F.to_date("last").alias("day")).agg(F.count("*").alias("processed"))
