"""Benchmark decontamination: a prefix-filtered set join of documents with benchmark items.

An item's windows are its runs of `window` words; an item with fewer words, but not none, is one
window. A window is the set of its word shingles at their places. A document holds the window if
it holds all of them, so one shingle, the rarest in the corpus, is a sufficient prefix: only
places with that shingle are candidates. A candidate must lie far enough from both ends of the
passage (position and length bounds) and is then compared word by word.

Documents are read once. A filter of the items' shingles, of `FILTER_BITS` bits at most whatever the size of
the benchmark, goes to the tasks; a passage of a document counts as found where enough shingles in a row
pass to make up a window. Only the shingles of such passages, each with the words around it, leave the
scan. They are counted; the counts go to the items by a join, and each window takes its rarest shingle. Windows
next to each other with the same prefix are one entry of the index, and so are equal entries of many items.
The index is joined to the passages by the prefix. The commonest shingles, each with a thousandth of all
places, at most a thousand, are dealt over `SALTS` keys. The joined rows hold the words of both sides and are
verified there. Nothing of the benchmark or the documents is held by the driver but the filter and a few sums.

Results belong to a document's id and text. Null and empty texts have no words: such documents are clean, such
items are in no document. Repeated item ids count once; repeated documents give one row each; null ids of items
are left out of the lists but their words are hit. `clean` keeps all columns of documents as they are;
`decontaminate` replaces those with the names of its results, whatever their case. Empty tables are allowed.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.llm.common import (
    LETTERS, drop, letter_words, release, renamed, restored, ship, split_words, stored, tidy)

WINDOW = 13
SHINGLE = 5
SEGMENT = 4096  # windows of an item that are indexed together
FILTER_BITS = 1 << 28
SLICE_BITS = 1 << 16
SALTS = 16
SHARE = 20
PART_BYTES = 4 << 20
SEED = 42


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))


def shingle_codes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A number for each k words in a row."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        out = (out ^ hashes[i:n + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def probes(codes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of each shingle in a filter; bits is a power of two."""
    mask = np.uint64(bits - 1)
    return (codes & mask).astype(np.int64), ((codes >> np.uint64(32)) & mask).astype(np.int64)


def parts(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """The texts in stretches of a bounded size, with their first row."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + PART_BYTES, "right")))
        yield at, texts.slice(at, end - at)
        at = end


def segments_of(items: DataFrame, item_id: str, text: str, window: int, shingle: int) -> DataFrame:
    """(segment, item, words, size, length, k): items in pieces of up to SEGMENT windows, with the words of a
    window and of its shingles."""
    inner = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = [w.decode() for w in letter_words(text)]
                length = min(window, len(words))
                for at in range(0, len(words) - length + 1 if words else 0, SEGMENT):
                    mine = words[at:at + SEGMENT + length - 1]
                    rows.append((item, " ".join(mine), len(mine), length, min(shingle, length)))
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(columns, (pa.string(), pa.string(), *[pa.int32()] * 3))],
                names=["item", "words", "size", "length", "k"])

    found = inner.mapInArrow(run, "item string, words string, size int, length int, k int")
    return stored(found.withColumn("segment", F.monotonically_increasing_id()), "segments")


def item_shingles(segments: DataFrame) -> DataFrame:
    """(segment, at, k, code)."""

    def run(batches):
        for batch in batches:
            for segment, words, k in zip(*(batch.column(c).to_pylist() for c in ("segment", "words", "k"))):
                codes = shingle_codes(word_hashes(words.split(" ")), k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(codes), segment)), pa.array(np.arange(len(codes), dtype=np.int32)),
                     pa.array(np.full(len(codes), k, dtype=np.int32)), pa.array(codes.view(np.int64))],
                    names=["segment", "at", "k", "code"])

    return segments.select("segment", "words", "k").mapInArrow(run, "segment long, at int, k int, code long")


def shingle_filter(shingles: DataFrame, bits: int) -> np.ndarray:
    """A bit for each probe of the shingles, packed: at most FILTER_BITS bits."""
    width, mask = min(SLICE_BITS, bits), F.lit(bits - 1).cast("long")
    places = shingles.select(F.explode(F.array(
        F.col("code").bitwiseAND(mask), F.shiftrightunsigned("code", 32).bitwiseAND(mask))).alias("place")).distinct()

    def merge(table: pa.Table) -> pa.Table:
        found = np.zeros(width, dtype=bool)
        found[table.column("place").to_numpy() % width] = True
        return pa.table({"slice": table.column("slice")[:1], "bits": pa.array([np.packbits(found).tobytes()])})

    slices = places.withColumn("slice", F.expr(f"place div {width}")).groupBy("slice").applyInArrow(
        merge, "slice long, bits binary")
    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in slices.toLocalIterator():  # one row for each slice of the filter
        out[row.slice * (width // 8):(row.slice + 1) * (width // 8)] = np.frombuffer(row.bits, np.uint8)
    return out


def passing(filter_bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
    out = np.ones(len(codes), dtype=bool)
    for place in probes(codes, 8 * len(filter_bits)):
        out &= (filter_bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
    return out


def stretches(hit: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of at least so many hits."""
    change = np.flatnonzero(np.diff(np.concatenate(([0], hit, [0])).astype(np.int8)))
    lo, hi = change[::2], change[1::2]
    some = hi - lo >= least
    return lo[some], hi[some]


def scan(docs: DataFrame, least: dict[int, int], filter_of, window: int, shingle: int) -> DataFrame:
    """One row for each document (key, n_words), and one for each shingle of a passage that may hold windows: (key, at,
    k, code, offset, context), its words with those that a window around it may reach, from `offset` words before.

    docs: (key, text). least: the fewest shingles in a row that make up a window, by the words of a shingle.
    """

    def run(batches):
        bits = filter_of()
        for batch in batches:
            for at, texts in parts(batch.column(1)):
                codes, starts, words = split_words(texts, LETTERS)
                keys = batch.column(0).slice(at, len(texts))
                yield rows_of(keys, n_words=np.diff(starts))
                hashes = word_hashes(words.to_pylist())[codes]
                words = words.to_numpy(zero_copy_only=False)
                for k, enough in least.items():
                    found = shingle_codes(hashes, k)
                    # No shingle reaches into the next text.
                    ends = np.repeat(starts[1:], np.diff(starts))[:len(found)]
                    hit = passing(bits, found) & (np.arange(len(found)) + k <= ends)
                    reach = window - k if k == shingle else 0
                    places, offsets, contexts = [], [], []
                    for lo, hi in zip(*stretches(hit, enough)):
                        line = words[codes[lo:hi + k - 1]].tolist()
                        for i in range(hi - lo):
                            first = max(0, i - reach)
                            places.append(lo + i)
                            offsets.append(i - first)
                            contexts.append(" ".join(line[first:i + k + reach]))
                    if places:
                        places = np.array(places)
                        text = np.searchsorted(starts, places, "right") - 1
                        yield rows_of(keys.take(pa.array(text)), at=places - starts[text],
                                      k=np.full(len(places), k), code=found[places].view(np.int64),
                                      offset=np.array(offsets), context=contexts)
            release()

    kinds = {"n_words": pa.int64(), "at": pa.int64(), "k": pa.int32(), "code": pa.int64(), "offset": pa.int32(),
             "context": pa.string()}

    def rows_of(keys: pa.Array, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [keys, *(pa.array(columns[c]).cast(kind) if c in columns else pa.nulls(len(keys), kind) for c, kind in kinds.items())],
            names=["key", *kinds])

    kind = docs.schema["key"].dataType.simpleString()
    return stored(docs.mapInArrow(
        run, f"key {kind}, n_words long, at long, k int, code long, offset int, context string"), "scan")


def prefixes(segments: DataFrame, shingles: DataFrame, counts: DataFrame) -> DataFrame:
    """(item, k, code, offset, context, length): the rarest shingle of each window whose shingles all occur in
    documents; of equally rare ones the first. Windows next to each other that share it are one row: `context` holds
    their words, and the shingle's are `offset` words from its start."""
    rare = shingles.join(counts, ["k", "code"]).groupBy("segment").agg(
        F.collect_list(F.struct("at", "code", "n")).alias("found"))  # at most one row for each place of a segment

    def run(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                words, places = row["words"].split(" "), row["size"] - row["k"] + 1
                n, codes = np.full(places, np.iinfo(np.int64).max), np.zeros(places, dtype=np.int64)
                at = np.array([x["at"] for x in row["found"]])
                n[at], codes[at] = [x["n"] for x in row["found"]], [x["code"] for x in row["found"]]
                around = np.lib.stride_tricks.sliding_window_view(n, row["length"] - row["k"] + 1)
                whole = around.max(axis=1) < np.iinfo(np.int64).max
                prefix = np.where(whole, np.arange(len(around)) + around.argmin(axis=1), -1)
                bounds = np.flatnonzero(np.diff(prefix, prepend=-2, append=-2))
                for lo, hi in zip(bounds.tolist(), bounds[1:].tolist()):
                    p = int(prefix[lo])
                    if p >= 0:
                        rows.append((row["item"], row["k"], int(codes[p]), p - lo,
                                     " ".join(words[lo:hi - 1 + row["length"]]), row["length"]))
            columns = list(zip(*rows)) or [[]] * 6
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds)],
                                             names=["item", "k", "code", "offset", "context", "length"])

    return segments.join(rare, "segment").select("item", "words", "size", "length", "k", "found").mapInArrow(
        run, "item string, k int, code long, offset int, context string, length int")


def same_words(a: list[str], b: list[str]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def windows_inside(place: list[str], offset: int, index: list[str], prefix: int, length: int) -> tuple[int, int]:
    """Which windows of an index entry, by their first word, stand around a place of a document (from, up to and
    without): both sides have the shingle, after so many words."""
    after = same_words(place[offset:], index[prefix:])
    before = same_words(place[:offset][::-1], index[:prefix][::-1])
    return prefix - before, prefix + after - length + 1


def verified(candidates: DataFrame) -> DataFrame:
    """(key, entry, first, last, length): the places of windows, from the first to the last word at which one begins."""

    def run(batches):
        for batch in batches:
            kept, firsts, lasts = [], [], []
            columns = ("at", "offset", "context", "prefix", "index", "length")
            for i, (at, offset, context, prefix, index, length) in enumerate(
                    zip(*(batch.column(c).to_pylist() for c in columns))):
                lo, hi = windows_inside(context.split(" "), offset, index.split(" "), prefix, length)
                if lo < hi:
                    kept.append(i)
                    firsts.append(at - prefix + lo)
                    lasts.append(at - prefix + hi - 1)
            some = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(some), batch.column("entry").take(some), pa.array(firsts, pa.int64()),
                 pa.array(lasts, pa.int64()), batch.column("length").take(some)],
                names=["key", "entry", "first", "last", "length"])

    kind, entry = (candidates.schema[c].dataType.simpleString() for c in ("key", "entry"))
    return candidates.mapInArrow(run, f"key {kind}, entry {entry}, first long, last long, length int")


def candidates(places: DataFrame, index: DataFrame, counts: DataFrame) -> DataFrame:
    """Places of documents with the entries of the index that have their shingle for a prefix."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    # Each has a thousandth of all places: there are a thousand at most.
    hot = F.broadcast(counts.where(F.col("n") > max(SALTS, total // 1000)).select("k", "code", F.lit(True).alias("hot")))
    spread = F.when(F.col("hot"), F.pmod(F.xxhash64("key", "at"), F.lit(SALTS)).cast("int")).otherwise(0)
    copies = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    left = places.join(hot, ["k", "code"], "left").withColumn("salt", spread).drop("hot")
    right = index.join(hot, ["k", "code"], "left").withColumn("salt", F.explode(copies)).drop("hot")
    return left.join(right, ["k", "code", "salt"]).select("key", "at", "offset", "context", "prefix", "index", "length", "entry")


def key_of(docs: DataFrame, doc_id: str, text: str):
    """A document's id and the hash of its text. The type is what written tables give back, so that joins need no cast."""
    kind = docs.select(F.col(f"`{doc_id}`").alias("i")).schema["i"].dataType.simpleString()
    return F.struct(F.col(f"`{doc_id}`").alias("id"), F.xxhash64(
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).alias("hash")).cast(f"struct<id:{kind},hash:bigint>")


def covered(places):
    """Words inside any of the places (start, end), which are sorted."""
    none = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("reached"))

    def add(sum_of, place):
        start, end = F.get(place, F.lit(0)), F.get(place, F.lit(1))
        return F.struct(
            (sum_of["total"] + F.greatest(F.lit(0), end - F.greatest(start, sum_of["reached"]))).alias("total"),
            F.greatest(sum_of["reached"], end).alias("reached"))

    return F.aggregate(places, none, add, lambda sum_of: sum_of["total"])


@tidy
def occurrences(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
                share: int = SHARE) -> DataFrame:
    """(key, n_words, n_hit, places, items, contaminated) for each id and text of documents; a written table.

    `places` are the (start, end) word positions of the windows found, `items` the ids of the
    items they are of. Contaminated: a word is hit, and at least one in `share` words is.
    """
    spark = docs.sparkSession
    segments = segments_of(items, item_id, item_text, window, shingle)
    about = segments.groupBy("k").agg(F.min("length").alias("least"), F.sum("size").alias("words")).collect()
    least = {r.k: r.least - r.k + 1 for r in about}
    shingles = item_shingles(segments)
    bits = min(FILTER_BITS, max(1 << 10, 1 << (32 * sum(r.words for r in about)).bit_length()))
    keyed = docs.select(key_of(docs, doc_id, text).alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    found = scan(keyed, least, ship(spark, shingle_filter(shingles, bits)), window, shingle)
    places = found.where("code IS NOT NULL").drop("n_words")
    counts = stored(places.groupBy("k", "code").agg(F.count("*").alias("n")), "counts")
    entry = F.struct(*(F.xxhash64(F.lit(i), "k", "offset", "length", "context").alias(f"h{i}") for i in (0, 1)))
    index = stored(prefixes(segments, shingles, counts).withColumn("entry", entry.cast("struct<h0:bigint,h1:bigint>")), "index")
    entries = index.select("entry", "k", "code", F.col("offset").alias("prefix"), F.col("context").alias("index"),
                           "length").distinct()
    owners = index.where("item IS NOT NULL").select("entry", "item").distinct()
    matches = stored(verified(candidates(places, entries, counts)), "matches")
    ranges = matches.groupBy("key").agg(F.collect_set(F.struct("first", "last", "length")).alias("ranges"))
    each = F.flatten(F.transform("ranges", lambda r: F.transform(
        F.sequence(r["first"], r["last"]), lambda start: F.array(start, start + r["length"]))))
    hit = ranges.select("key", F.array_sort(F.array_distinct(each)).alias("places"))
    named = matches.select("key", "entry").distinct().join(owners, "entry").groupBy("key").agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    n_words = found.where("n_words IS NOT NULL").groupBy("key").agg(F.max("n_words").alias("n_words"))
    result = n_words.join(hit, "key", "left").join(named, "key", "left").select(
        "key", "n_words", F.coalesce(covered(F.col("places")), F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("places", F.array().cast("array<array<bigint>>")).alias("places"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    result = stored(result.withColumn(
        "contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))), "occurrences")
    drop(segments, found, counts, index, matches)
    return result


RESULT = ("n_words", "n_hit", "places", "items", "contaminated")


def decontaminate(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """All columns of docs, and n_words, n_hit, places, items, contaminated."""
    rows, names = renamed(docs)
    found = occurrences(rows, items, doc_id=names[doc_id], text=names[text], **options)
    joined = rows.withColumn("key", key_of(rows, names[doc_id], names[text])).join(found, "key")
    kept = [(f"in_{i}", c) for i, c in enumerate(docs.columns) if c.lower() not in RESULT]
    return joined.select(*(F.col(i).alias(c) for i, c in kept), *RESULT)


def clean(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of docs that are not contaminated, as they are."""
    rows, names = renamed(docs)
    bad = occurrences(rows, items, doc_id=names[doc_id], text=names[text], **options).where("contaminated").select("key")
    kept = rows.withColumn("key", key_of(rows, names[doc_id], names[text])).join(bad, "key", "left_anti")
    return restored(kept, docs)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
