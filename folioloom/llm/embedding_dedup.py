"""Embedding near-duplicates: random-hyperplane sign hashing in several tables.

Equal vectors of a label are one class first, however many rows it has. A class gets, in each
table, the signs of its products with random hyperplanes; classes of the same label and signs meet.
Vectors of cosine c agree in a sign with probability 1 - arccos(c)/pi. The number of signs follows
from the number of classes, so that buckets stay small, and the number of tables from that, so
that a pair at the threshold is missed with probability `miss` at most; closer pairs less.

Where classes meet, the exact cosine in double precision decides. A pair counts in the first table
in which it meets. A task sends on, for each class, its number of links and the smallest class
that its links in this bucket lead to, never the pairs. Buckets beyond `CHUNK` classes are cut in
chunks that meet two by two, so every task has a bounded group and no pair is lost. The classes'
components are found with distributed rounds.

Labels that are null, and vectors that are null, zero or have null or non-finite parts, link with
nothing: such a row is its own component. Vectors of different lengths never link. Repeated rows
are vectors of their own; a null vec_id takes part but is nobody's smallest. Extra columns are
ignored.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.llm.common import connected_components, stored

COSINE = 0.98
MISS = 1e-6
BUCKET = 64  # classes in a bucket, on average, if all were of one label and evenly spread
CHUNK = 1024
SEED = 20240501


def plan(classes: int, cosine: float, miss: float) -> tuple[int, int]:
    """Signs in a table, and tables."""
    bits = min(40, max(4, math.ceil(math.log2(max(classes, 1) / BUCKET)) if classes > BUCKET else 4))
    together = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-together)))


def usable(vector: str):
    """The vector has parts, all of them finite numbers, and not all are zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def signatures(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """classes with `signs`: the signs as one number for each table."""

    def run(batches):
        planes = {}
        for batch in batches:
            vectors = batch.column("vector").to_pylist()
            signs = []
            for v in vectors:
                if len(v) not in planes:
                    planes[len(v)] = np.random.default_rng((SEED, len(v))).standard_normal((len(v), tables * bits))
                v = np.array(v, dtype=np.float64)
                side = ((v / np.abs(v).max()) @ planes[len(v)] > 0).reshape(tables, bits)
                signs.append(side @ (1 << np.arange(bits, dtype=np.int64)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(signs, pa.list_(pa.int64()))], names=[*batch.schema.names, "signs"])

    return classes.mapInArrow(run, T.StructType(
        [*classes.schema.fields, T.StructField("signs", T.ArrayType(T.LongType()))]))


def meet(rows: list, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Links in one group: class ids, numbers of linked vectors, smallest class that links lead to.

    rows: (class_id, n, vector, signs, chunk, table, pair_a, pair_b) columns of the group.
    """
    ids, n, vectors, signs, chunk, table, a, b = rows
    if len(ids) < 2:
        return None
    size = np.abs(vectors).max(axis=1, keepdims=True)
    unit = vectors / size
    norm = np.sqrt((unit * unit).sum(axis=1))
    left = np.flatnonzero(chunk == a)
    right = np.flatnonzero(chunk == b)
    close = (unit[left] @ unit[right].T) / (norm[left][:, None] * norm[right][None, :]) >= cosine
    i, j = np.nonzero(close)
    i, j = left[i], right[j]
    if a == b:
        i, j = i[i < j], j[i < j]
    if not len(i):
        return None
    new = np.ones(len(i), dtype=bool)
    for earlier in range(table):
        new &= signs[i, earlier] != signs[j, earlier]
    links = np.bincount(i[new], weights=n[j[new]], minlength=len(ids)) + np.bincount(
        j[new], weights=n[i[new]], minlength=len(ids))
    root = spread(ids, i, j)
    some = np.unique(np.concatenate([i, j]))
    return ids[some], links[some].astype(np.int64), root[some]


def spread(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest id that the links (i, j) lead to from each place."""
    root = ids.copy()
    while True:
        before = root.copy()
        least = np.minimum(root[i], root[j])
        np.minimum.at(root, i, least)
        np.minimum.at(root, j, least)
        if np.array_equal(before, root):
            return root


def groups(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[pa.Table]:
    """Runs of rows that are equal in the first `key` columns; the rows are sorted by them."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, part]) if rest is not None else part
        change = np.zeros(table.num_rows - 1, dtype=bool)
        for c in range(key):
            values = table.column(c).to_numpy()
            change |= values[1:] != values[:-1]
        bounds = [0, *(np.flatnonzero(change) + 1).tolist()]
        table = table.combine_chunks()
        for lo, hi in zip(bounds, bounds[1:]):
            yield table.slice(lo, hi - lo)
        rest = table.slice(bounds[-1])
    if rest is not None and rest.num_rows:
        yield rest


def class_links(classes: DataFrame, cosine: float, miss: float) -> DataFrame:
    """(class_id, links, root) from every group that has links.

    classes: (class_id, label, vector, n), no two with equal label and vector.
    """
    bits, tables = plan(classes.count(), cosine, miss)
    signed = stored(signatures(classes, bits, tables), "signed")
    places = signed.select("class_id", "label", F.size("vector").alias("width"),
                           F.posexplode("signs").alias("table", "bucket"))
    where = ["label", "width", "table", "bucket"]
    crowded = places.groupBy(*where).agg(F.count("*").alias("crowd")).where("crowd > 1")
    chunks = F.ceil(F.col("crowd") / CHUNK).cast("int")
    dealt = (places.join(crowded, where).withColumn("chunks", chunks)
             .withColumn("chunk", F.pmod(F.xxhash64("class_id"), F.col("chunks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .withColumn("pair_a", F.least("chunk", "other")).withColumn("pair_b", F.greatest("chunk", "other")))
    key = [*where, "pair_a", "pair_b"]
    met = dealt.select(*key, "class_id", "chunk").join(signed.select("class_id", "n", "vector", "signs"), "class_id")
    met = met.select(*key, "chunk", "class_id", "n", "vector", "signs").repartition(*key).sortWithinPartitions(*key)

    def run(batches):
        for group in groups(batches, len(key)):
            columns = [group.column(c).to_numpy() for c in ("class_id", "n")]
            width = group.column("width")[0].as_py()
            vectors = group.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            signs = group.column("signs").combine_chunks().flatten().to_numpy()
            found = meet([*columns, vectors.astype(np.float64).reshape(-1, width), signs.reshape(group.num_rows, -1),
                          group.column("chunk").to_numpy(), group.column("table")[0].as_py(),
                          group.column("pair_a")[0].as_py(), group.column("pair_b")[0].as_py()], cosine)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["class_id", "links", "root"])

    return met.mapInArrow(run, "class_id long, links long, root long")


def near_duplicates(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding",
                    label: str = "label", cosine: float = COSINE, miss: float = MISS) -> DataFrame:
    """Per row: (vec_id, n_links, component_id, kept)."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    able = usable("vector") & F.col("label").isNotNull()
    classes = stored(
        rows.where(able).groupBy("label", "vector").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
        .withColumn("class_id", F.monotonically_increasing_id()), "classes")
    found = stored(class_links(classes.select("class_id", "label", "vector", "n"), cosine, miss), "links")
    links = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    component = connected_components(found, "class_id", "root").withColumnRenamed("node", "class_id")
    known = (classes.join(links, "class_id", "left").join(component, "class_id", "left")
             .withColumn("component", F.coalesce("component", "class_id")))
    smallest = known.groupBy("component").agg(F.min("least").alias("component_id"))
    named = known.join(smallest, "component").select(
        "label", "vector", "component_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    linked = rows.where(able).join(named, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(able, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
