"""State snapshots, the batch sink, and intermediate tables in the shared folder."""

from __future__ import annotations

import atexit
import functools
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager, suppress

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from folioloom.schemas import BATCH_SCHEMA


def shared_dir(spark: SparkSession, name: str = "") -> str:
    """A fresh folder name below the folder every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``; a session without
    that setting can name it by ``SparkContext.setCheckpointDir``.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/folioloom-{name + '-' if name else ''}{uuid.uuid4().hex}"


#: Folders of intermediate tables by the scope that will delete them, innermost last.
_scopes: list[list[str]] = [[]]


def store(df: DataFrame, name: str = "", compression: str | None = None) -> DataFrame:
    """The rows of df, written once and read back.

    Later steps neither repeat nor depend on the work before, and a lost executor
    costs no more than the tasks it ran.  The table goes with its scope.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    _scopes[-1].append(path)
    writer = df.write.option("compression", compression) if compression else df.write
    writer.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._folioloom_path = path
    return back


def drop(*stored: DataFrame) -> None:
    """Delete tables made by ``store`` that nothing reads any more."""
    for df in stored:
        _delete(df._folioloom_path)
        for paths in _scopes:
            if df._folioloom_path in paths:
                paths.remove(df._folioloom_path)


def _delete(path: str) -> None:
    context = SparkContext._active_spark_context
    if context is not None:
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


class Scope:
    """The tables stored in a ``scope``."""

    def __init__(self, paths: list[str]):
        self._paths = paths

    def keep(self, stored: DataFrame) -> DataFrame:
        """Leave a stored table to the scope around this one."""
        self._paths.remove(stored._folioloom_path)
        _scopes[_place_of(self._paths) - 1].append(stored._folioloom_path)
        return stored


def _place_of(paths: list[str]) -> int:
    return next(i for i, known in enumerate(_scopes) if known is paths)


@contextmanager
def scope() -> Iterator[Scope]:
    """Deletes the tables stored inside when it ends, also by an error.

    What is read from them must be written before.  Tables stored outside any
    scope go when Python ends.
    """
    _scopes.append([])
    paths = _scopes[-1]
    try:
        yield Scope(paths)
    finally:
        del _scopes[_place_of(paths)]
        for path in paths:
            _delete(path)


def tidy(operator):
    """An operator whose stored tables go at once if it fails.  Else its lazy
    result still reads them: they go with the scope around it."""
    @functools.wraps(operator)
    def run(*args, **kwargs):
        paths: list[str] = []
        _scopes.append(paths)
        try:
            result = operator(*args, **kwargs)
        except BaseException:
            _scopes.pop()
            for path in paths:
                _delete(path)
            raise
        _scopes.pop()
        _scopes[-1].extend(paths)
        return result
    return run


@atexit.register
def _drop_all() -> None:
    for paths in _scopes:
        for path in paths:
            with suppress(Exception):
                _delete(path)


def write_snapshot(state: DataFrame, path: str) -> None:
    """Write a state snapshot, one folder per status.

    Readers of the pending queue then list only ``status=pending``.  Each
    status is spread over all tasks, so a status holding most rows stays
    parallel.
    """
    state.write.mode("errorifexists").partitionBy("status").parquet(path)


def scan_state(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Read chosen columns of a state or run table."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def save_state_table(state: DataFrame, table: str, buckets: int) -> None:
    """Write the state as a table bucketed by URL.

    Joins on ``url`` read such a table without shuffling it: only the changes
    move.  Take as many buckets as shuffle partitions, so that folded changes
    already lie the same way, and enough for files of a few hundred MB.  URLs are
    unique, so hashing them first gives even buckets of one sorted file each.
    """
    (state.repartition(buckets, "url").write.mode("errorifexists").format("parquet")
     .bucketBy(buckets, "url").sortBy("url").saveAsTable(table))


def append_batches(batches: DataFrame, path: str) -> None:
    """Append packed batches to the sink, creating it when absent."""
    (batches.select(*[F.col(f.name).cast(f.dataType) for f in BATCH_SCHEMA])
     .write.mode("append").parquet(path))


def store_run_batches(batches: DataFrame, path: str, run_id: str) -> None:
    """Write the batches of one run into its own partition of the sink.

    A run that is repeated after a break replaces what it had stored.
    """
    (batches.select(*[F.col(f.name).cast(f.dataType) for f in BATCH_SCHEMA])
     .write.mode("overwrite").parquet(f"{path}/run_id={run_id}"))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BATCH_SCHEMA).parquet(path)


def pages_json(batches: DataFrame) -> DataFrame:
    """Batches with ``pages`` as JSON text, nulls kept, for text-only sinks."""
    return batches.withColumn(
        "pages", F.to_json("pages", {"ignoreNullFields": "false"}))
