"""What several operators need: words, written intermediate tables, connected components."""

from __future__ import annotations

import pickle
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.sources.tables import drop, scope, store, tidy  # noqa: F401

#: The bytes A-Z lowered, and those that separate words of letters and digits.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256))
#: Rows of texts in work at a time in a task.
ARROW_ROWS = 2000


def space_words(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, with A-Z lowered. Null has none."""
    return text.encode("utf-8", "replace").translate(LOWER).split() if text else []


def letter_words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all non-ASCII characters, with A-Z lowered."""
    return text.encode("utf-8", "replace").translate(LETTERS).split() if text else []


def split_words(texts: pa.Array, table: bytes | None = None) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The white-space separated words of a column, after replacing bytes by the table.

    Gives (codes, starts, words): text i has the words numbered codes[starts[i]:starts[i + 1]], and
    words holds each different word once. Null has no words. The table may only change ASCII.
    """
    texts = pc.fill_null(texts.cast(pa.string()), "")
    n = len(texts)
    if table is not None and n:
        at = np.frombuffer(texts.buffers()[1], np.int32, n + 1, 4 * texts.offset)
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[at[0]:at[-1]] if raw is not None else np.zeros(0, np.uint8)
        data = np.frombuffer(table, np.uint8)[data]
        texts = pa.StringArray.from_buffers(n, pa.py_buffer((at - at[0]).astype(np.int32)), pa.py_buffer(data))
    lists = pc.ascii_split_whitespace(texts)
    starts = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.values[starts[0]:starts[-1]].dictionary_encode()
    codes, words = coded.indices.to_numpy(), coded.dictionary
    starts = starts - starts[0]
    empty = pc.index(words, pa.scalar("", words.type)).as_py()
    if empty >= 0:  # before leading and after trailing white space
        some = codes != empty
        starts = np.concatenate(([0], np.cumsum(some)))[starts]
        codes = codes[some]
    return codes, starts, words


def small_batches(spark: SparkSession) -> SparkSession:
    """Lets tasks exchange at most ARROW_ROWS rows at a time with Python, which bounds the memory
    of texts on both sides."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def release() -> None:
    """Gives memory of finished batches back to the machine: a process runs many tasks."""
    pa.default_memory_pool().release_unused()


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """The rows of df, written once and read back: later steps neither repeat nor depend on the
    work before, and a lost executor costs no more than the tasks it ran."""
    return store(df, f"llm-{name}", compression)


def ship(spark: SparkSession, value):
    """Broadcasts a value, of a bounded size, to the tasks. Gives the function that returns it
    there. Its classes travel with it, so executors need no copy of this library."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    here: list = []

    def get():
        if not here:
            here.append(pickle.loads(sent.value))
        return here[0]

    return get


def renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns in_0, in_1, ..., whatever they were called, and the new name of each old one: columns
    that an operator adds then never meet those of its input."""
    names = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    frame = docs.toDF(*(f"in_{i}" for i in range(len(docs.columns))))
    # A name may be asked for in another case, as in Spark.
    return frame, {c.lower(): n for c, n in reversed(names.items())} | names


def restored(frame: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs, under their old names, of a frame made from renamed(docs)."""
    return frame.select(*(F.col(f"in_{i}").alias(c) for i, c in enumerate(docs.columns)))


def add_columns(docs: DataFrame, text: str, fields: list[T.StructField], compute) -> DataFrame:
    """docs with columns that compute makes of the texts: compute(texts) -> one array per field.

    Columns of docs that have the names of the new ones are replaced.
    """
    names = [c for c in docs.columns if c not in {f.name for f in fields}]
    inner = docs.select(*(F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(names)),
                        F.col(f"`{text}`").cast("string").alias("added_text"))
    new = [T.StructField(f"added_{i}", f.dataType) for i, f in enumerate(fields)]
    schema = T.StructType(inner.schema.fields[:-1] + new)

    def run(batches):
        for batch in batches:
            old = batch.columns[:-1]
            yield pa.RecordBatch.from_arrays([*old, *compute(batch.columns[-1])], names=schema.names)
            release()

    added = inner.mapInArrow(run, schema)
    return added.select(*(F.col(f"in_{i}").alias(c) for i, c in enumerate(names)),
                        *(F.col(f"added_{i}").alias(f.name) for i, f in enumerate(fields)))


def split_of(doc_id: str, parts: int):
    """crc32 of the id as text, modulo parts. Null has none."""
    return F.crc32(F.col(doc_id).cast("string")) % parts


def label_of_ids(labels: DataFrame, label: str, *, doc_id: str, training) -> DataFrame:
    """(doc_id, label), one row for each labelled id that the condition `training` on the column
    doc_id marks. Several labels of an id count as the largest."""
    return labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label")).where(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("label").cast("int").alias("label")).where(training)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, *, doc_id: str, text: str,
                    most: int, training) -> DataFrame:
    """(text, label) of at most `most` labelled training documents of each class, by the hash of
    their ids. Several labels of an id count as the largest; an id with several texts counts once,
    with the largest. training: the condition on the column doc_id that marks rows to learn from.
    """
    marks = label_of_ids(labels, label, doc_id=doc_id, training=training)
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = marks.where("label = 0").orderBy(*order).limit(most).unionByName(
        marks.where("label = 1").orderBy(*order).limit(most))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    # Twice `most` ids and marks: a bounded broadcast.
    found = texts.join(F.broadcast(chosen), "doc_id")
    once = found.groupBy("doc_id", "label").agg(F.max(F.struct(F.coalesce("text", F.lit("")).alias("text"))).alias("t"))
    return once.select("doc_id", F.col("t.text").alias("text"), "label")


def running_sums(values: DataFrame, key: str, sums: list[str]) -> DataFrame:
    """values with `<sum>_before` for each of the sums: its total over all smaller keys. Keys are
    unique. Ranges of keys are summed apart; one row for each range comes to the driver."""
    ranged = stored(values.repartitionByRange(key).withColumn("part", F.spark_partition_id()), "ranged")
    parts = sorted(ranged.groupBy("part").agg(F.min(key).alias("least"), *(F.sum(s).alias(s) for s in sums)).collect(),
                   key=lambda r: r["least"])
    offsets, total = [], dict.fromkeys(sums, 0)
    for r in parts:
        offsets.append((r["part"], *total.values()))
        total = {s: total[s] + r[s] for s in sums}
    before = values.sparkSession.createDataFrame(offsets, "part int" + "".join(f", {s}_offset long" for s in sums))
    smaller = Window.partitionBy("part").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(F.broadcast(before), "part").select(key, *sums, *(
        (F.col(f"{s}_offset") + F.coalesce(F.sum(s).over(smaller), F.lit(0))).alias(f"{s}_before") for s in sums))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge, component being its smallest reachable node.

    Each round every node learns the grandparents of its neighbours, tells its parent, and
    jumps to its own grandparent; the number of rounds grows with the logarithm of the longest
    path. Rounds are written tables. Nodes are only joined to one row each, so a component or a
    parent of any size has no task of its own: minima are summed up before each shuffle, and the
    jump is a join of two plain exchanges, which Spark splits when it is skewed. Self-loops and
    repeated edges are allowed; an empty input has no rows.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    links = stored(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    labels = stored(links.groupBy(F.col("u").alias("node")).agg(F.min(F.least("u", "v")).alias("parent")), "labels")
    mark = None
    while True:
        jumped = labels.join(
            labels.select(F.col("node").alias("parent"), F.col("parent").alias("grand")), "parent", "left"
        ).select("node", "parent", F.coalesce("grand", "parent").alias("grand"))
        jumped = stored(jumped, "jumped")
        told = (links.join(jumped.select(F.col("node").alias("v"), "grand"), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("grand").alias("seen")))
        heard = jumped.join(told, "node", "left").select(
            F.explode(F.array(
                F.struct("node", F.least("grand", "seen").alias("parent")),
                F.struct(F.col("parent").alias("node"), F.least("grand", "seen").alias("parent")))).alias("x"))
        after = stored(heard.groupBy(F.col("x.node").alias("node")).agg(F.min("x.parent").alias("parent")), "labels")
        drop(jumped, labels)
        labels = after
        now = labels.agg(F.count("*"), F.sum(F.xxhash64("node", "parent").cast("decimal(38,0)"))).first()
        if now == mark:
            drop(links)
            return labels.withColumnRenamed("parent", "component")
        mark = now


cloudpickle.register_pickle_by_value(sys.modules[__name__])
