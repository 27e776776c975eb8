"""Language-model scoring: a weighted backoff automaton over smoothed n-grams of the whole corpus.

Counts are of the whole training part of the corpus: every word and every n-gram up to `order` words
long. The states of the automaton are the contexts that training texts hold, up to `order` - 1 words; the
root is the empty one. A state has an arc for each word that follows it in training, weighted by
the n-gram's count less a discount, over the state's count. For any other word its failure arc leads
to the state without the first word, weighted so that probabilities sum to one: what the discounts
leave, over what the shorter context gives the words that have no arc. At the root a word without an
arc has the probability that the discounts leave there. Reading a word leads to the longest state
that ends in it. A text is read from left to right, carrying the state, and its logarithms are added.

The automaton is never in one place. A state or arc is known by a hash of its words (`KEY_BITS`
bits); ranges of hashes are shards. Documents are cut into blocks of about `block_bytes` of text, stored
as word numbers. A block sends each shard the hashes of its different n-grams, sorted and packed, with
their training counts; it gets back the counts of the corpus in the same order, so hashes travel once.
A frequent n-gram is one entry a block, however often it occurs. For failure arcs a second round
does the same with contexts alone: each arc is summed up by the first block that holds it, and only
contexts that texts outside training walk are sent. Last, each block walks the part of the automaton that
its own texts reach. So a task holds one block, or one shard of about `shard_grams` entries; nothing
of the corpus is sent to the driver but a few sums. Messages are one for each block, shard and length:
where the corpus is many terabytes, raise `block_bytes` and `shard_grams` with the executors' memory.

Null and empty texts are the end token alone. Repeated rows give one row each, and all train. Extra
columns are ignored. Without training documents every token is unknown with probability one and
the base score divides by its smoothing alone. An empty table gives no rows.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.llm.common import LOWER, drop, release, split_of, stored, tidy

ORDER = 3
ADD = 0.1  # smoothing of the base score
BLOCK_BYTES = 8 << 20
SHARD_GRAMS = 2 << 20
PART_BYTES = 2 << 20
KEY_BITS = 56
BASE = 0x9E3779B97F4A7C15  # of the polynomial that hashes a word's bytes: odd, so it has an inverse
INVERSE = pow(BASE, -1, 1 << 64)
END = 0  # the hash of the end token; no word of a text is empty
#: White space: a blank, and the five characters from the tabulator on.
SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def parts(texts: pa.Array):
    """The texts in stretches of a bounded size, with their first row."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + PART_BYTES, "right")))
        yield at, texts.slice(at, end - at)
        at = end


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 as planes of their bytes, without the upper planes that are zero."""
    planes = np.ascontiguousarray(numbers, dtype="<u8").view(np.uint8).reshape(-1, 8).T
    n = (int(numbers.max()).bit_length() + 7) // 8 if len(numbers) else 0
    return bytes([n]) + planes[:n].tobytes()


def unpack(packed: bytes, size: int) -> np.ndarray:
    planes = np.zeros((size, 8), dtype=np.uint8)
    planes[:, :packed[0]] = np.frombuffer(packed, np.uint8, offset=1).reshape(packed[0], size).T
    return planes.view("<u8").reshape(-1)


def pack_bits(bits: np.ndarray) -> bytes:
    return np.packbits(bits).tobytes()


def unpack_bits(packed: bytes, size: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=size).astype(bool)


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number scattered over all 64 bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grouped(keys: np.ndarray, bits: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different numbers below 2 ** bits in order, a place of each, and the number of each place's own.

    Sorting plain numbers is much faster than sorting places by them: upper bits of a number and its place share
    one word. Where the bits left are not enough to tell two numbers apart, their order is mended.
    """
    n = len(keys)
    mask = np.uint64((1 << max(1, (n - 1).bit_length())) - 1) if n else np.uint64(1)
    both = np.sort(((keys << np.uint64(64 - bits)) & ~mask) | np.arange(n, dtype=np.uint64))
    order = (both & mask).astype(np.int64)
    values = keys[order]
    if (values[1:] < values[:-1]).any():
        again = np.argsort(values, kind="stable")
        order, values = order[again], values[again]
    new = np.ones(n, dtype=bool)
    new[1:] = values[1:] != values[:-1]
    number = np.empty(n, dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return values[new], order[new], number


_powers: list[np.ndarray] = []


def powers(n: int) -> list[np.ndarray]:
    """BASE ** i and BASE ** -i for i below n, modulo 2 ** 64."""
    if not _powers or len(_powers[0]) < n:
        _powers[:] = [np.multiply.accumulate(np.concatenate((
            np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)))) for base in (BASE, INVERSE)]
    return _powers


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each word, the bytes data[begin:end]: a polynomial of its bytes, scattered."""
    out, at = np.empty(len(begin), dtype=np.uint64), 0
    while at < len(begin):
        stop = max(at + 1, int(np.searchsorted(end, begin[at] + PART_BYTES, "right")))
        lo, hi = int(begin[at]), int(end[stop - 1])
        up, down = powers(max(PART_BYTES, hi - lo) + 1)
        sums = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum((data[lo:hi].astype(np.uint64) + np.uint64(1)) * up[:hi - lo], out=sums[1:])
        a, b = begin[at:stop] - lo, end[at:stop] - lo
        out[at:stop] = mixed((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        at = stop
    return out


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the white-space separated words of all texts, with A-Z lowered, and how many each text has."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    n = len(texts)
    at = np.frombuffer(texts.buffers()[1], np.int32, n + 1, 4 * texts.offset).astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[at[0]:at[-1]] if raw is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    data = np.frombuffer(LOWER, np.uint8)[data]
    letter = np.ones(len(data) + 2, dtype=bool)
    letter[0] = letter[-1] = False
    letter[1:-1] = ~SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True  # words end with their text
    begin = np.flatnonzero(letter[1:-1] & (~letter[:-2] | edge[:-1]))
    end = np.flatnonzero(letter[1:-1] & (~letter[2:] | edge[1:])) + 1
    return word_hashes(data, begin, end), np.diff(np.searchsorted(begin, at))


class Block:
    """Texts of one block as numbers of its words."""

    def __init__(self):
        self.hashes, self.sizes, self.ids, self.training, self.bytes = [], [], [], [], 0

    def add(self, ids: pa.Array, training: np.ndarray, texts: pa.Array) -> None:
        hashes, sizes = hashed_words(texts)
        self.hashes.append(np.insert(hashes, np.cumsum(sizes), np.uint64(END)))
        self.sizes.append(sizes + 1)
        self.ids.append(ids)
        self.training.append(training)
        self.bytes += int(pc.sum(pc.binary_length(texts)).as_py() or 0)

    def row(self, block: int, kind: pa.DataType) -> pa.RecordBatch:
        """The block as one row; words are numbered by their frequency, so that most numbers are small."""
        words, _, number = grouped(np.concatenate(self.hashes))
        order = np.argsort(-np.bincount(number, minlength=len(words)), kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))

        def one(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        return pa.RecordBatch.from_arrays(
            [pa.array([block]), one(pa.concat_arrays(self.ids).cast(kind)), one(pa.array(np.concatenate(self.training))),
             one(pa.array(np.concatenate(self.sizes))), pa.array([pack(rank[number])]),
             pa.array([words[order].astype("<u8").tobytes()]), pa.array([len(number)])],
            names=["block", "ids", "training", "sizes", "codes", "words", "tokens"])


def blocks_of(rows: DataFrame, block_bytes: int) -> DataFrame:
    """One row for each block: (block, ids, training, sizes, codes, words, tokens). rows: (doc_id, training, text)."""

    def run(batches):
        from pyspark import TaskContext

        block, number, kind = Block(), TaskContext.get().partitionId() << 24, None
        for batch in batches:
            kind = batch.schema.field(0).type
            training = batch.column(1).to_numpy(zero_copy_only=False)
            for at, part in parts(batch.column(2)):
                block.add(batch.column(0).slice(at, len(part)), training[at:at + len(part)], part)
                if block.bytes >= block_bytes:
                    yield block.row(number, kind)
                    block, number = Block(), number + 1
        if block.ids:
            yield block.row(number, kind)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return stored(rows.mapInArrow(
        run, f"block long, ids array<{kind}>, training array<boolean>, sizes array<long>, codes binary, "
             "words binary, tokens long"), "blocks", "zstd")


def rows_of(batch: pa.RecordBatch):
    """Blocks one after the other: a batch may hold several."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


class Level:
    """The different n-grams of one length in a block, sorted by their hash."""

    def __init__(self, keys: np.ndarray, at: np.ndarray, tokens: int):
        self.keys, first, same = grouped(keys, KEY_BITS)
        #: The number of the n-gram that ends at each token, -1 where the text is too short.
        self.number = np.full(tokens, -1, dtype=np.int32)
        self.number[at] = same
        #: A token at which each n-gram ends.
        self.ends = at[first]


class Grams:
    """The n-grams of a block's texts up to a length."""

    def __init__(self, row: dict, order: int):
        self.sizes = np.array(row["sizes"], dtype=np.int64)
        self.line = unpack(row["codes"], int(self.sizes.sum())).astype(np.int64)
        training = np.array(row["training"], dtype=bool)
        self.training = np.repeat(training, self.sizes)
        self.first = np.cumsum(self.sizes) - self.sizes
        place = np.arange(len(self.line)) - np.repeat(self.first, self.sizes)
        word = np.frombuffer(row["words"], "<u8").astype(np.uint64)[self.line]
        narrow, chain = np.uint64(64 - KEY_BITS), mixed(word)
        self.levels = [Level(chain >> narrow, np.arange(len(word)), len(word))]
        for k in range(2, order + 1):
            at = np.flatnonzero(place >= k - 1)
            longer = np.zeros_like(chain)
            longer[at] = mixed(chain[at - 1] * np.uint64(BASE) + word[at])
            chain = longer
            self.levels.append(Level(chain[at] >> narrow, at, len(word)))

    def count(self, level: Level) -> np.ndarray:
        """How often training texts of the block have each n-gram."""
        return np.bincount(level.number[self.training & (level.number >= 0)], minlength=len(level.keys))

    def outside(self, level: Level) -> np.ndarray:
        """Which n-grams texts outside training have."""
        found = np.zeros(len(level.keys), dtype=bool)
        found[level.number[~self.training & (level.number >= 0)]] = True
        return found


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges: sorted hashes lie in ascending shards."""
    return ((keys >> np.uint64(KEY_BITS - 32)) * np.uint64(shards)) >> np.uint64(32)


def messages(block: int, length: int, keys: np.ndarray, shards: int, columns: dict) -> pa.RecordBatch:
    """One row for each shard: the sorted hashes as differences, and packed columns of the same order."""
    bounds = np.searchsorted(shard_of(keys, shards), np.arange(shards + 1))
    some = np.flatnonzero(np.diff(bounds))
    spans = [(int(bounds[s]), int(bounds[s + 1])) for s in some]
    rest = [pa.array([(pack_bits if x.dtype == bool else pack)(x[a:b]) for a, b in spans], pa.binary()) for x in columns.values()]
    return pa.RecordBatch.from_arrays(
        [pa.array(some.astype(np.int32)), pa.array(np.full(len(some), block)), pa.array(np.full(len(some), length, dtype=np.int32)),
         pa.array(np.array([b - a for a, b in spans], dtype=np.int64)),
         pa.array([pack(np.diff(keys[a:b], prepend=np.uint64(0))) for a, b in spans], pa.binary()), *rest],
        names=["shard", "block", "length", "size", "keys", *columns])


MESSAGE = "shard int, block long, length int, size long, keys binary"


class Shard:
    """Entries of one length in a shard, of all blocks that sent some."""

    def __init__(self, table: pa.Table, length: int):
        mine = table.filter(pc.equal(table.column("length"), length)).sort_by("block")
        self.blocks, self.sizes = mine.column("block").to_pylist(), mine.column("size").to_pylist()
        self.bounds = np.cumsum([0, *self.sizes])
        self.table = mine
        keys = [np.cumsum(unpack(x, n)) for x, n in zip(mine.column("keys").to_pylist(), self.sizes)]
        found, _, self.same = grouped(np.concatenate(keys), KEY_BITS)
        self.n = len(found)

    def numbers(self, column: str) -> np.ndarray:
        return np.concatenate([unpack(x, n) for x, n in zip(self.table.column(column).to_pylist(), self.sizes)]).astype(np.int64)

    def bits(self, column: str) -> np.ndarray:
        return np.concatenate([unpack_bits(x, n) for x, n in zip(self.table.column(column).to_pylist(), self.sizes)])

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The sum over all entries of each hash."""
        total = np.zeros(self.n, dtype=np.int64)
        np.add.at(total, self.same, values)
        return total

    def each(self):
        """(block, its entries)."""
        return zip(self.blocks, map(slice, self.bounds[:-1], self.bounds[1:]))


def corpus_counts(blocks: DataFrame, order: int, shards: int) -> DataFrame:
    """(block, shard, length, counts, owned, walked, once, twice, known, total): for each block and shard the
    corpus counts of the block's n-grams, which of them it is the first to train on, and which of them texts
    outside training hold. Rows of block -1 have the number of n-grams counted once and twice, of all counted,
    and the sum of counts."""

    def send(batches):
        for batch in batches:
            for row in rows_of(batch):
                grams = Grams(row, order)
                for k, level in enumerate(grams.levels, 1):
                    yield messages(row["block"], k, level.keys, shards, {
                        "counts": grams.count(level), "outside": grams.outside(level)})
                release()

    def merge(table: pa.Table) -> pa.Table:
        out = []
        for k in sorted(set(table.column("length").to_pylist())):
            shard, number = Shard(table, k), table.column("shard")[0].as_py()
            counts = shard.numbers("counts")
            total = shard.sums(counts)
            trained = np.flatnonzero(counts)
            first = np.full(shard.n, -1, dtype=np.int64)
            first[shard.same[trained][::-1]] = trained[::-1]  # the last to be written is the first block's
            walked = np.zeros(shard.n, dtype=bool)
            walked[shard.same[shard.bits("outside")]] = True
            for block, mine in shard.each():
                same = shard.same[mine]
                out.append((block, number, k, len(same), pack(total[same]), pack_bits(first[same] == np.arange(mine.start, mine.stop)),
                            pack_bits(walked[same]), 0, 0, 0, 0))
            out.append((-1, number, k, 0, None, None, None, *(int(x) for x in (
                (total == 1).sum(), (total == 2).sum(), (total > 0).sum(), total.sum()))))
        return pa.table(list(map(pa.array, zip(*out))), names=COUNTS.names).cast(COUNTS)

    sent = blocks.select("block", "training", "sizes", "codes", "words").mapInArrow(
        send, f"{MESSAGE}, counts binary, outside binary")
    return stored(sent.groupBy("shard").applyInArrow(
        merge, "block long, shard int, length int, size long, counts binary, owned binary, walked binary, "
               "once long, twice long, known long, total long"), "counts", "zstd")


COUNTS = pa.schema([
    ("block", pa.int64()), ("shard", pa.int32()), ("length", pa.int32()), ("size", pa.int64()), ("counts", pa.binary()),
    ("owned", pa.binary()), ("walked", pa.binary()), ("once", pa.int64()), ("twice", pa.int64()), ("known", pa.int64()),
    ("total", pa.int64())])


def answers(found: list[dict], length: int, columns: dict) -> list[np.ndarray]:
    """Columns that the shards sent back for one length, in the order of the block's sorted hashes."""
    mine = sorted((x for x in found if x["length"] == length), key=lambda x: x["shard"])
    return [np.concatenate([np.zeros(0, kind), *((unpack_bits if kind is bool else unpack)(x[c], x["size"]).astype(kind) for x in mine)])
            for c, kind in columns.items()]


def with_answers(blocks: DataFrame, rows: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """blocks with what each got back from all shards, as one array."""
    mine = rows.where("block >= 0").groupBy("block").agg(
        F.collect_list(F.struct("shard", "length", "size", *columns)).alias(name))
    return blocks.join(mine, "block", "left")


def context_sums(walks: DataFrame, order: int, shards: int) -> DataFrame:
    """(block, shard, length, size, sums, arcs): for the contexts that texts of the block outside training walk,
    their number of arcs, and the sum of the counts that the words on these arcs have after the shorter context."""

    def send(batches):
        for batch in batches:
            for row in rows_of(batch):
                grams = Grams(row, order)
                counts, owned, walked = zip(*(answers(row["counted"], k, {"counts": np.int64, "owned": bool, "walked": bool})
                                              for k in range(1, order + 1)))
                for m in range(1, order):  # words of the context
                    level, shorter = grams.levels[m], grams.levels[m - 1]
                    mine = np.flatnonzero(owned[m])
                    context = shorter.number[level.ends[mine] - 1]
                    # The n-gram without its first word, as long as the context.
                    after = counts[m - 1][shorter.number[level.ends[mine]]]
                    sums = np.zeros(len(shorter.keys), dtype=np.int64)
                    np.add.at(sums, context, after)
                    arcs = np.bincount(context, minlength=len(shorter.keys))
                    asked = asked_contexts(grams, m, counts[m - 1])
                    some = walked[m - 1] & ((arcs > 0) | asked)
                    if some.any():
                        yield messages(row["block"], m, shorter.keys[some], shards, {
                            "sums": sums[some], "arcs": arcs[some], "asked": asked[some]})
                release()

    def merge(table: pa.Table) -> pa.Table:
        out = []
        for m in sorted(set(table.column("length").to_pylist())):
            shard, number = Shard(table, m), table.column("shard")[0].as_py()
            sums, arcs, asked = shard.sums(shard.numbers("sums")), shard.sums(shard.numbers("arcs")), shard.bits("asked")
            for block, mine in shard.each():
                same = shard.same[mine][asked[mine]]
                if len(same):
                    out.append((block, number, m, len(same), pack(sums[same]), pack(arcs[same])))
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*out) if out else [[]] * 6, SUMS)], schema=SUMS)

    sent = walks.select("block", "training", "sizes", "codes", "words", "counted").mapInArrow(
        send, f"{MESSAGE}, sums binary, arcs binary, asked binary")
    return stored(sent.groupBy("shard").applyInArrow(
        merge, "block long, shard int, length int, size long, sums binary, arcs binary"), "sums")


SUMS = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("length", pa.int32()), ("size", pa.int64()),
                  ("sums", pa.binary()), ("arcs", pa.binary())])


def asked_contexts(grams: Grams, m: int, counts: np.ndarray) -> np.ndarray:
    """Which n-grams of m words are states that the block's texts outside training walk."""
    return grams.outside(grams.levels[m - 1]) & (counts > 0)


def discount_of(once: int, twice: int) -> float:
    """Absolute discount from the numbers of n-grams seen once and twice."""
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


class Automaton:
    """The states and arcs that the texts of a block reach.

    A state is a context that training texts hold; its words being the last ones read, it is carried
    as their number. For each token and each number of words before it: whether the state of these words
    has an arc for the token, the arc's weight, and the weight of the state's failure arc.
    """

    def __init__(self, grams: Grams, row: dict, discounts: list[float], tokens: int, floor: float):
        self.grams, self.order = grams, len(grams.levels)
        self.counts = [answers(row["counted"], k, {"counts": np.int64})[0] for k in range(1, self.order + 1)]
        n = len(grams.line)
        self.arc = np.zeros((self.order, n), dtype=bool)
        self.weight = np.zeros((self.order, n))
        self.failure = np.zeros((self.order, n))
        for m in range(self.order):  # words of the state
            level = grams.levels[m]
            at = np.flatnonzero(level.number >= 0)
            count = self.counts[m][level.number[at]]
            before = self.counts[m - 1][grams.levels[m - 1].number[at - 1]] if m else np.full(n, tokens)
            self.arc[m, at] = count > 0
            some = count > 0
            self.weight[m, at[some]] = np.log10((count[some] - discounts[m]) / before[some])
            if m:
                self.failure[m, at] = self.failures(m, row, discounts, tokens)[grams.levels[m - 1].number[at - 1]]
        self.weight[0, ~self.arc[0]] = floor

    def failures(self, m: int, row: dict, discounts: list[float], tokens: int) -> np.ndarray:
        """Weights of the failure arcs of all states of m words that texts outside training walk; others, none of
        whose texts fails there, have zero."""
        level, counts = self.grams.levels[m - 1], self.counts[m - 1]
        asked = np.flatnonzero(asked_contexts(self.grams, m, counts))
        sums, arcs = answers(row["summed"] or [], m, {"sums": np.int64, "arcs": np.int64})
        own = counts[asked]
        shorter = self.counts[m - 2][self.grams.levels[m - 2].number[level.ends[asked]]] if m > 1 else np.full(len(asked), tokens)
        left = discounts[m] * arcs / own
        given = (sums - discounts[m - 1] * arcs) / shorter
        out = np.zeros(len(counts))
        out[asked] = np.log10(np.maximum(left, 1e-12) / np.maximum(1 - given, 1e-12))
        return out

    def walk(self) -> np.ndarray:
        """The log10 probability of each text: all texts are read from left to right, a word at a time."""
        order = np.argsort(-self.grams.sizes, kind="stable")
        first, sizes = self.grams.first[order], self.grams.sizes[order]
        state, total = np.zeros(len(order), dtype=np.int64), np.zeros(len(order))
        reading = np.searchsorted(-sizes, -np.arange(int(sizes.max(initial=0))), "left")  # texts longer than t
        for t, n in enumerate(reading.tolist()):
            at, here, sum_of = first[:n] + t, state[:n], total[:n]
            for m in range(self.order - 1, 0, -1):
                fails = (here == m) & ~self.arc[m, at]
                sum_of += np.where(fails, self.failure[m, at], 0.0)
                here = here - fails
            sum_of += self.weight[here, at]
            state[:n] = np.minimum(here + self.arc[here, at], self.order - 1)
        out = np.empty(len(order))
        out[order] = total
        return out


@tidy
def score(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", training=None, order: int = ORDER,
          block_bytes: int = BLOCK_BYTES, shard_grams: int = SHARD_GRAMS) -> DataFrame:
    """Per document: (doc_id, training, n_tokens, n_known, train_tokens, base_score, score).

    training: the condition on the column doc_id that marks documents to learn from; by default
    crc32 of the id modulo 10 is not 0.
    """
    if training is None:
        training = split_of("doc_id", 10) != 0
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(training, F.lit(True)).alias("training"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    blocks = blocks_of(rows, block_bytes)
    size = blocks.agg(F.sum("tokens")).first()[0] or 0
    shards = max(1, -(-order * size // shard_grams))
    counts = corpus_counts(blocks, order, shards)
    of_length = {r.length: r for r in counts.where("block < 0").groupBy("length").agg(
        *(F.sum(c).alias(c) for c in ("once", "twice", "known", "total"))).collect()}
    discounts = [discount_of(of_length[k].once, of_length[k].twice) if k in of_length else 0.5 for k in range(1, order + 1)]
    tokens, known = (of_length[1].total, of_length[1].known) if 1 in of_length else (0, 0)
    floor = math.log10(max(discounts[0] * known, 1e-300) / tokens) if tokens else 0.0
    walks = stored(with_answers(blocks, counts, "counted", ["counts", "owned", "walked"]), "walks", "zstd")
    drop(blocks, counts)
    sums = context_sums(walks, order, shards)

    def run(batches):
        for batch in batches:
            for row in rows_of(batch):
                grams = Grams(row, order)
                automaton = Automaton(grams, row, discounts, tokens, floor)
                c = automaton.counts[0][grams.levels[0].number]
                base = np.log10((c + ADD) / (tokens + ADD * (known + 1)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], batch.schema.field("ids").type.value_type), pa.array(row["training"]),
                     pa.array(grams.sizes), pa.array(np.add.reduceat((c > 0).astype(np.int64), grams.first)),
                     pa.array(np.full(len(grams.sizes), tokens)), pa.array(np.add.reduceat(base, grams.first)),
                     pa.array(automaton.walk())],
                    names=["doc_id", "training", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
                release()

    schema = T.StructType([
        rows.schema["doc_id"], T.StructField("training", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()),
        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    return with_answers(walks, sums, "summed", ["sums", "arcs"]).select(
        "ids", "training", "sizes", "codes", "words", "counted", "summed").mapInArrow(run, schema)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
