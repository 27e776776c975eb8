"""The state as a table whose buckets are rewritten one by one.

URLs are dealt over buckets by hash.  A transition reads and writes only the
buckets its changes hit; a manifest names the folder each bucket is in, so
the others stay where they are.  All buckets of an update become visible at
once, and an update that broke off is simply repeated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from folioloom.schemas import STATE_SCHEMA
from folioloom.sources.manifest import delete, names, read_manifest, write_manifest
from folioloom.sources.tables import scope, store

BUCKET = "state_bucket"


def bucket_of(url: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, version: int, buckets: int, tasks: int) -> dict[str, str]:
    """Write rows as buckets of a version; the folder of each bucket that has rows."""
    spark = rows.sparkSession
    (rows.select(*STATE_SCHEMA.names, bucket_of(F.col("url"), buckets).alias(BUCKET))
     .repartition(tasks, BUCKET).sortWithinPartitions(BUCKET, "url")
     .write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/v={version}"))
    return {n.split("=")[1]: f"v={version}/{n}" for n in names(spark, f"{path}/v={version}") if n.startswith(BUCKET)}


def create_state(state: DataFrame, path: str, buckets: int) -> None:
    """Write a state as a new table; take buckets of a few hundred MB."""
    where = _write(state, path, 1, buckets, buckets)
    write_manifest(state.sparkSession, path, 1, {"buckets": buckets, "where": where, "replaced": []})


def read_state(spark: SparkSession, path: str, hit: list[int] | None = None) -> DataFrame:
    """The state, or the rows of some buckets; other buckets are not even listed."""
    _, manifest = read_manifest(spark, path)
    folders = [f"{path}/{folder}" for bucket, folder in sorted(manifest["where"].items())
               if hit is None or int(bucket) in hit]
    if not folders:
        return spark.createDataFrame([], STATE_SCHEMA)
    return spark.read.schema(STATE_SCHEMA).parquet(*folders)


def update_state(
    spark: SparkSession, path: str, changes: DataFrame, apply: Callable[[DataFrame, DataFrame], DataFrame]
) -> list[int]:
    """Replace the buckets that ``changes`` (rows with a ``url``) hit; returns them.

    ``apply(old, changes)`` gives the new state of the URLs in these buckets, as
    the transitions of ``operators.state`` do.  Folders that are replaced stay for
    one more update, so that queries that have begun can end.
    """
    number, manifest = read_manifest(spark, path)
    buckets = manifest["buckets"]
    with scope():
        changes = store(changes, "changes")
        # At most one row for each bucket.
        hit = sorted(r[0] for r in changes.select(bucket_of(F.col("url"), buckets)).distinct().collect() if r[0] is not None)
        if not hit:
            return []
        new = apply(read_state(spark, path, hit), changes)
        written = _write(new, path, number + 1, buckets, len(hit))
    where = {b: f for b, f in manifest["where"].items() if int(b) not in hit} | written
    replaced = [f for b, f in manifest["where"].items() if int(b) in hit]
    write_manifest(spark, path, number + 1, {"buckets": buckets, "where": where, "replaced": replaced})
    for folder in manifest["replaced"]:
        delete(spark, f"{path}/{folder}")
    return hit
