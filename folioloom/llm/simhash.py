"""SimHash near-duplicates: anchor-point covering.

Every text gets a 64-bit fingerprint: the majority, bit by bit, of the hashes of its word
shingles. Texts link when their fingerprints differ in at most `distance` bits.

Anchors are the words of a covering code: two binary Golay codes side by side, over 46 of the 64
bits. Each is perfect with covering radius 3, so every fingerprint has exactly one home anchor. If
fingerprints a and b differ in e1 bits of the first half and e2 of the second, b lies within
3 + e1 and 3 + e2 of a's home: it is enough to replicate b to the anchors within the covering
radius plus the threshold, e1 + e2 <= `distance`. At each anchor the fingerprints at home are
compared with the replicas, over all 64 bits. Nothing is missed at any distance up to 4.

Only different fingerprints are replicated: exact copies, however many, are one. A fingerprint
has at most 2,080 others within two bits, so links stay in proportion to fingerprints.

Null, empty and blank texts have the fingerprint zero and link like any other. Repeated rows each
give a row; a null id takes part, and a group of null ids alone has a null component. Extra
columns are ignored.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.llm.common import connected_components, renamed, restored, space_words, stored

SHINGLE = 3
DISTANCE = 2
SEED = 42
RADIUS = 3  # of the Golay code
GOLAY = 0b101011100011  # its generator polynomial
BITS = 23
PIECE = 1 << 16  # hashes that are counted at a time


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority of the bits of XXH64 over all word shingles; zero without words."""
    words = space_words(text)
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1).tolist()
    stops = (ends - 1).tolist()[min(shingle, len(words)) - 1:]
    total, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(stops), PIECE):
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[at:at + PIECE], stops[at:at + PIECE])],
                          dtype="<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(bit) for bit in np.flatnonzero(2 * total > len(stops)))


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint): the 64 bits as a long."""
    inner = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            bits = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(bits.view(np.int64))], names=["doc_id", "fingerprint"])

    return inner.mapInArrow(run, T.StructType([inner.schema["doc_id"], T.StructField("fingerprint", T.LongType())]))


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder by the generator polynomial: zero for the words of the code."""
    words = words.copy()
    for bit in range(BITS - 1, 10, -1):
        words ^= ((words >> np.uint64(bit)) & np.uint64(1)) * np.uint64(GOLAY << (bit - 11))
    return words


def error_table(distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All error words of up to RADIUS + distance bits, by syndrome: (words, beyond, starts).

    `beyond` is how many bits a word has more than RADIUS, zero at least. The words of syndrome s
    are those from starts[s] to starts[s + 1].
    """
    words, sizes, layer = [np.zeros(1, np.uint64)], [np.zeros(1, np.int64)], np.zeros(1, np.uint64)
    for size in range(1, RADIUS + distance + 1):
        top = np.where(layer > 0, np.floor(np.log2(np.maximum(layer, 1))).astype(np.int64), -1)
        layer = np.concatenate([layer[top < bit] | np.uint64(1 << bit) for bit in range(BITS)])
        words.append(layer)
        sizes.append(np.full(len(layer), size))
    errors, size = np.concatenate(words), np.concatenate(sizes)
    by = syndromes(errors)
    order = np.lexsort((size, by))
    starts = np.searchsorted(by[order], np.arange((1 << 11) + 1))
    return errors[order], np.maximum(0, size[order] - RADIUS), starts


def replicas(bits: DataFrame, distance: int) -> DataFrame:
    """(fingerprint, anchor) for every anchor within radius plus distance: the home anchor alone
    when the distance is zero."""

    def run(batches):
        errors, beyond, starts = error_table(distance)
        low = np.uint64((1 << BITS) - 1)
        for batch in batches:
            all_bits = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(all_bits), 4096):
                x = all_bits[at:at + 4096]
                halves = [x & low, (x >> np.uint64(BITS)) & low]
                s = [syndromes(h).astype(np.int64) for h in halves]
                count = [starts[i + 1] - starts[i] for i in s]
                n = count[0] * count[1]
                row = np.repeat(np.arange(len(x)), n)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                first = starts[s[0][row]] + nth // count[1][row]
                second = starts[s[1][row]] + nth % count[1][row]
                far = beyond[first] + beyond[second]
                some = far <= distance
                row, first, second = row[some], first[some], second[some]
                anchor = (halves[0][row] ^ errors[first]) | ((halves[1][row] ^ errors[second]) << np.uint64(BITS))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[row].view(np.int64)), pa.array(anchor.view(np.int64))],
                    names=["fingerprint", "anchor"])

    return bits.mapInArrow(run, "fingerprint long, anchor long")


def links(bits: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b) for all different fingerprints, a < b, that differ in at most `distance` bits.

    bits: one column, `fingerprint`, without repeats. Each link comes once, at a's home anchor.
    """
    if not 0 <= distance <= 4:
        raise ValueError("distance must be from 0 to 4")
    home = replicas(bits, 0).select("anchor", F.col("fingerprint").alias("a"))
    wide = int(bits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = replicas(bits.repartition(wide, "fingerprint"), distance).select("anchor", F.col("fingerprint").alias("b"))
    return home.join(near, "anchor").where(
        (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)).select("a", "b")


def simhash_groups(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                   distance: int = DISTANCE) -> DataFrame:
    """Per document (doc_id, fingerprint as 16 hex digits, component_id): the smallest doc_id that
    links lead to, the document's own included."""
    prints = stored(fingerprints(docs, doc_id=doc_id, text=text, shingle=shingle), "fingerprints")
    least = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "least")
    component = connected_components(links(least.select("fingerprint"), distance))
    known = least.join(component.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("component"))
    named = known.join(known.groupBy("component").agg(F.min("least").alias("component_id")), "component")
    return prints.join(named.select("fingerprint", "component_id"), "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             distance: int = DISTANCE) -> DataFrame:
    """The rows of docs that stay: of each group the row with the smallest id, and of rows with that
    same id one. Groups whose ids are all null keep one row."""
    rows, names = renamed(docs)
    # Rows get numbers: written, so that they stay the same.
    numbered = stored(rows.withColumn("number", F.monotonically_increasing_id()), "numbered")
    key = F.struct(F.col(names[doc_id]).isNull().alias("n"), F.col(names[doc_id]).alias("i"), F.col("number").alias("r"))
    named = simhash_groups(numbered.withColumn("key", key), doc_id="key", text=names[text], shingle=shingle, distance=distance)
    first = named.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id.r").alias("number"))
    return restored(numbered.join(first, "number", "left_semi"), docs)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
