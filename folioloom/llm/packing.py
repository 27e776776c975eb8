"""Best-fit packing: a configuration linear program over the histogram of piece lengths.

Texts become token ids, are cut into pieces of at most `capacity` tokens, and the pieces are packed
into sequences. Only the histogram of lengths, at most `capacity` numbers, comes to the driver.
There the linear program "cover every length with the fewest patterns" is solved by
multiplicative weights: the weight of a length falls as it is covered; a knapsack dynamic program
prices all patterns, and gives for each of the least covered lengths the pattern of the largest weight
that holds it; each of these columns is used for a small step. All columns are kept, and steps go on until
every length is covered. Each pricing also bounds the program from below (no pattern weighs more than the
best), as do the pieces that cannot share a sequence, so the gap between the solution and the optimum is measured; with a gap above `EPSILON` the
program is solved again in finer steps.

Rounding takes each column as often as its whole part says, then once more by the largest fraction, as
long as pieces are left; full columns of few pieces come first, which leaves small pieces for the end. The
program of the pieces left over is solved and rounded in turn until `PLACED` of all pieces have a place.
The last ones are packed by best fit, largest first, the last two lengths of a sequence chosen
together: there the program has no more pieces than patterns, and nothing to balance. The plan is
a table of slots, whose size depends on `capacity` alone. Pieces are numbered within their length and take the
slot of their number, so the ids themselves are never shuffled to be packed.

A hot length is dealt over `SALTS` groups that are numbered apart and then moved up by their sums.

Null and empty texts have the end token alone. Repeated rows and ids are packed once for each row.
Special tokens inside a text count as the tokenizer counts them. Extra columns are ignored.
"""

from __future__ import annotations

import re
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.llm.common import release, renamed, ship, split_words, stored

CAPACITY = 2048
END = 0
EPSILON = 0.01  # of the optimum, that the program's solution may be above it
STEPS = (0.05, 0.025, 0.0125)  # share of a length that one step may cover, tried until the gap is met
COLUMNS = 128  # of one pricing
PLACED = 0.92  # share of pieces after which best fit takes the rest
SALTS = 256
PART_BYTES = 4 << 20  # of text in work at a time in a task
CACHE_WORDS = 150_000  # a task's process remembers the ids of two to three times as many words at most
#: Letters whose normal form and lower case are one known character, then punctuation that never
#: belongs to a contraction. Other words go through the whole tokenizer.
PLAIN = re.compile(r"([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-&(-/:-@\[-`{-~]*)")


class WordEncoder:
    """Token ids of single words, remembered. The tokenizer must treat words apart by
    white space independently, as those with a white-space dropping pre-tokenizer do."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        self.letters = {b: b for b in plain} | {b: 256 + i for i, b in enumerate(others)}
        sample = "Word café, naïve? STRAßE."
        whole = self.tokenizer.encode(sample, add_special_tokens=False).ids
        apart = b"".join(self.plain(PLAIN.fullmatch(w)) for w in sample.split())
        self.fast = whole == np.frombuffer(apart, "<u4").tolist()

    def part(self, text: str) -> bytes:
        ids = self.find(text)
        if ids is None:
            spelled = text.encode().decode("latin-1").translate(self.letters)
            ids = np.array([t.id for t in self.tokenizer.model.tokenize(spelled)], "<u4").tobytes()
            self.known[text] = ids
        return ids

    def plain(self, match: re.Match) -> bytes:
        ids = self.part(match[1].lower())
        return ids + self.part(match[2]) if match[2] else ids

    def find(self, word: str) -> bytes | None:
        """What is remembered; the half that was not asked for since the last turn is forgotten."""
        ids = self.known.get(word)
        if ids is None and (ids := self.older.get(word)) is not None:
            self.known[word] = ids
        return ids

    def encode(self, words: list[str]) -> list[bytes]:
        if len(self.known) > CACHE_WORDS:
            self.known, self.older = {}, self.known
        out = list(map(self.known.get, words))
        for i, ids in enumerate(out):
            if ids is None:
                word = words[i]
                ids = self.find(word)
                if ids is None:
                    if self.fast and (found := PLAIN.fullmatch(word)):
                        ids = self.plain(found)
                    else:
                        ids = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
                    self.known[word] = ids
                out[i] = ids
        return out


def encoder(path: str) -> WordEncoder:
    """One for each process and file: later tasks of the process find the words known."""
    held = sys.modules.setdefault("_folioloom_encoders", types.ModuleType("_folioloom_encoders"))
    if path not in vars(held):
        setattr(held, path, WordEncoder(path))
    return getattr(held, path)


def tokenize(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text",
             capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids) for every piece of at most `capacity` tokens.

    ids: little-endian unsigned 32-bit numbers. Every document ends in the token END.
    """
    inner = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        words_of = encoder(tokenizer)
        for batch in batches:
            size, at = np.cumsum(text_sizes(batch.column(1))), 0
            while at < batch.num_rows:
                before = size[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(size, before + PART_BYTES, "right")))
                yield pieces(words_of, batch.slice(at, end - at), capacity)
                at = end
            release()

    return inner.mapInArrow(run, T.StructType([
        inner.schema["doc_id"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())]))


def text_sizes(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def pieces(words_of: WordEncoder, batch: pa.RecordBatch, capacity: int) -> pa.RecordBatch:
    codes, starts, words = split_words(batch.column(1))
    encoded = words_of.encode(words.to_numpy(zero_copy_only=False).tolist())
    encoded.append(np.array([END], "<u4").tobytes())
    codes = np.insert(codes.astype(np.int64), starts[1:], len(encoded) - 1)
    sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
    ids = np.frombuffer(b"".join(encoded), "<u4")
    first = np.cumsum(sizes) - sizes
    n = sizes[codes]
    ends = np.cumsum(n)
    flat = ids[np.repeat(first[codes] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
    doc_ends = ends[starts[1:] + np.arange(batch.num_rows)]
    tokens = np.diff(doc_ends, prepend=0)
    count = -(-tokens // capacity)
    doc = np.repeat(np.arange(batch.num_rows), count)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = piece * capacity
    length = np.minimum(capacity, tokens[doc] - start)
    bounds = np.concatenate(([0], np.cumsum(length))).astype(np.int32) * 4
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
         pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(bounds), pa.py_buffer(flat)])],
        names=["doc_id", "piece", "start", "length", "ids"])


def price(weights: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Knapsack by dynamic programming, lengths taken any number of times: the largest weight of a pattern,
    and the length to take last in each room (0: leave one token). weights: by length, from 0."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    for room in range(1, capacity + 1):
        value = best[room - 1::-1] + weights[1:room + 1] if room > 1 else weights[1:2]
        top = int(value.argmax())
        if value[top] > best[room - 1]:
            best[room], last[room] = value[top], top + 1
        else:
            best[room] = best[room - 1]
    return float(best[capacity]), last


def pattern_with(length: int, last: np.ndarray, capacity: int) -> dict[int, int]:
    """The heaviest pattern that holds the length: pieces by length."""
    pattern, room = {length: 1}, capacity - length
    while room > 0:
        x = int(last[room])
        if x:
            pattern[x] = pattern.get(x, 0) + 1
        room -= x or 1
    return pattern


Pattern = tuple[tuple[int, int], ...]


def solve(lengths: np.ndarray, counts: np.ndarray, capacity: int, step: float) -> tuple[dict[Pattern, float], float]:
    """The program: how often each pattern is used, so that every length is covered by its count, and a lower
    bound of any solution. Patterns are sorted pairs of a length and its number."""
    n = np.zeros(capacity + 1)
    n[lengths] = counts
    left, used, bound = n.copy(), {}, 0.0
    while (still := lengths[left[lengths] > 0]).size:
        covered = 1 - left[still] / n[still]
        weights = np.full(capacity + 1, -np.inf)
        weights[still] = still * np.exp(-covered)
        most, last = price(weights, capacity)
        bound = max(bound, float((n[still] * weights[still]).sum()) / most)
        for length in still[np.argsort(covered, kind="stable")][:COLUMNS].tolist():
            pattern = pattern_with(length, last, capacity)
            items, times = np.array(list(pattern)), np.array(list(pattern.values()))
            amount = float((np.minimum(left[items], step * n[items]) / times).min())
            if amount > 0:
                left[items] -= amount * times
                left[items[left[items] < 1e-9 * n[items]]] = 0
                key = tuple(sorted(pattern.items()))
                used[key] = used.get(key, 0.0) + amount
    return used, bound


def size_bound(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> float:
    """A lower bound of the program: of lengths above half the capacity no two share a sequence, and shorter ones,
    down to a least length, only fit where the longer leave them room."""
    best = 0.0
    long = lengths > capacity / 2
    for least in np.unique(np.concatenate(([1], lengths[~long]))).tolist():
        alone = lengths > capacity - least
        shared, short = long & ~alone, ~long & (lengths >= least)
        room = (counts[shared] * (capacity - lengths[shared])).sum()
        more = max(0.0, float((counts[short] * lengths[short]).sum() - room) / capacity)
        best = max(best, float(counts[alone].sum() + counts[shared].sum()) + more)
    return best


def program(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[dict[Pattern, float], float]:
    """The solution of the program, and its gap: how far it is above the lower bound, relatively."""
    least = size_bound(lengths, counts, capacity)
    for step in STEPS:
        used, bound = solve(lengths, counts, capacity, step)
        gap = sum(used.values()) / max(least, bound) - 1 if used else 0.0
        if gap <= EPSILON:
            break
    return used, gap


def rounded(used: dict[Pattern, float], left: dict[int, int], most: int, capacity: int) -> list[tuple[Pattern, int]]:
    """Whole uses of the patterns, which place about `most` pieces; their pieces are taken from `left`."""
    def room(key: Pattern) -> int:
        return capacity - sum(x * n for x, n in key)

    order = sorted(used, key=lambda key: (room(key), sum(n for _, n in key), -(used[key] % 1), key))
    # Rounding up a pattern that leaves more room than the solution does on average would cost sequences.
    spare = sum(room(key) * amount for key, amount in used.items()) / sum(used.values())
    plan, placed = [], 0
    for up in (False, True):
        for key in order:
            if placed >= most:
                return plan
            if room(key) <= spare:
                times = min(1 if up else int(used[key]), *(left[x] // n for x, n in key))
                if times > 0:
                    for x, n in key:
                        left[x] -= times * n
                    placed += times * sum(n for _, n in key)
                    plan.append((key, times))
    return plan


def configurations(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns, as the number of pieces by length, and how many sequences use each: those of the rounded program,
    then those of best fit. Every piece has a place in exactly one sequence."""
    by_program, left = planned(lengths, counts, capacity)
    return by_program + best_fit(lengths, left, capacity)


def planned(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[list[tuple[dict[int, int], int]], np.ndarray]:
    """The plan of the rounded program, and how many pieces of each length it leaves."""
    left, plan = dict(zip(lengths.tolist(), counts.tolist())), []
    total = sum(left.values())
    while (most := sum(left.values()) - (1 - PLACED) * total) > 0:
        some = np.array([x for x in left if left[x]], dtype=np.int64)
        used, _ = program(some, np.array([left[x] for x in some.tolist()], dtype=np.float64), capacity)
        more = rounded(used, left, most, capacity)
        if not more:
            break
        plan += [(dict(key), times) for key, times in more]
    return plan, np.array(list(left.values()), dtype=np.int64)


def best_fit(lengths: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Fills sequences from the largest length left; the last two lengths are chosen together."""
    left, plan = left.copy(), []
    while left.any():
        room, pattern = capacity, np.zeros(len(lengths), dtype=np.int64)
        while True:
            some = np.flatnonzero((left > pattern) & (lengths <= room))
            if not len(some):
                break
            i = some[-1]
            if pattern.any():
                sizes = lengths[some]
                other = np.searchsorted(sizes, room - sizes, "right") - 1
                # One more piece of the same length must be there to be taken twice.
                twice = (other == np.arange(len(some))) & (left[some] - pattern[some] < 2)
                other = np.where(twice, other - 1, other)
                total = sizes + np.where(other >= 0, sizes[np.maximum(other, 0)], 0)
                if 2 * sizes[-1] > room:
                    i = some[len(total) - 1 - int(total[::-1].argmax())]
            pattern[i] += 1
            room -= int(lengths[i])
        at = np.flatnonzero(pattern)
        times = int((left[at] // pattern[at]).min())
        left[at] -= times * pattern[at]
        plan.append(({int(lengths[i]): int(pattern[i]) for i in at}, times))
    return plan


def slots(plan: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """For each pattern and length: the numbers of the pieces that it takes, and where they go."""
    rows, taken, sequence = [], {}, 0
    for pattern, times in plan:
        offset = 0
        for length, n in sorted(pattern.items(), reverse=True):
            lo = taken.get(length, 0)
            rows.append((length, lo, sequence, n, offset))
            taken[length] = lo + n * times
            offset += n * length
        sequence += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "number", "sequence", "each", "offset"), table.T.copy()))


def pack(pieces: DataFrame, *, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """The rows of pieces with `sequence_id` and `offset`: their place in sequences of at most
    `capacity` tokens, gapless from 0. Lengths are from 1 to capacity."""
    spark = pieces.sparkSession
    frame, names = renamed(pieces)
    size = names[length]
    rows = stored(frame.withColumn("row", F.monotonically_increasing_id())
                  .withColumn("salt", (F.col("row") % SALTS).cast("int")), "pieces")
    counts = stored(rows.groupBy(size, "salt").agg(F.count("*").alias("n")), "counts")
    # At most one row for each length up to the capacity.
    histogram = sorted((r[0], r[1]) for r in counts.groupBy(size).agg(F.sum("n")).collect())
    if any(not x or x > capacity or x < 1 for x, _ in histogram):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    plan = configurations(np.array([x for x, _ in histogram], dtype=np.int64),
                          np.array([n for _, n in histogram], dtype=np.int64), capacity)
    sent = ship(spark, slots(plan))
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(
        Window.partitionBy(size).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).select(size, "salt", "before")
    numbered = rows.join(before, [size, "salt"]).withColumn("number", F.col("before") + F.row_number().over(
        Window.partitionBy(size, "salt").orderBy("row")) - 1)
    kept = [(f"in_{i}", c) for i, c in enumerate(pieces.columns) if c.lower() not in ("sequence_id", "offset")]

    def place(batches):
        table = sent()
        keys = table["length"] * (1 << 48) + table["number"]
        for batch in batches:
            number = batch.column("number").to_numpy()
            sizes = batch.column(size).to_numpy().astype(np.int64)
            at = np.searchsorted(keys, sizes * (1 << 48) + number, "right") - 1
            nth = number - table["number"][at]
            each = table["each"][at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i, _ in kept), pa.array(table["sequence"][at] + nth // each),
                 pa.array(table["offset"][at] + nth % each * sizes)], names=[*(i for i, _ in kept), "sequence_id", "offset"])

    fields = [frame.schema[i] for i, _ in kept]
    placed = numbered.select(*dict.fromkeys([*(i for i, _ in kept), size, "number"])).mapInArrow(place, T.StructType(
        [*fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))
    return placed.select(*(F.col(i).alias(c) for i, c in kept), "sequence_id", "offset")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
