"""Periodic run detection: seeds of guaranteed overlap, extended along diagonals.

A run is a stretch of words that repeats itself: with smallest period q it is at least
max(least, times * q) words long, and neither neighbouring word carries the period on. Words i and
i + q are then equal on at least max(least - q, (times - 1) * q) places in a row of the diagonal q.

Periods are taken in bands (2^(j-1), 2^j]. The shortest stretch that any period of the band
guarantees is the length k of its seeds, and k is no less than any period of the band. So inside a run
the k words at i occur next at i + q exactly: an earlier occurrence would be a smaller period. It
is therefore enough to enumerate, for each k words, the pairs of an occurrence and the next one in the
same text, at most one pair for each word and band, whatever the text. The pairs whose lag is
in the band are the seeds of that lag; each is extended both ways, and a table of the furthest word
covered on each diagonal drops the seeds that lie in what was found before. Repetitions that turn
out too short are left out.

Runs of k words are named by doubling: the name of 2g words is the pair of names of g words and the
g words after them, and a name that occurs once in its text is forgotten. Ordinary text thus has
few places left after some words, and only texts that do repeat themselves reach the long bands.

Texts are never shuffled, and are processed whole; a task has texts of about `PART_BYTES` in work, or
one longer text. Null and empty texts have no words and no runs. Repeated rows and ids give one row
each. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.llm.common import release, split_words

LEAST = 6  # words of a run
TIMES = 4  # periods of a run
PART_BYTES = 4 << 20

#: Changes the words of a batch of texts before runs are searched: (ids, codes, starts) -> codes.
Rewrite = Callable[[pa.Array, np.ndarray, np.ndarray], np.ndarray]


def names_of(pairs: np.ndarray) -> np.ndarray:
    """A number from 0 for each value that occurs more than once; -1 for the others."""
    _, same, count = np.unique(pairs, return_inverse=True, return_counts=True)
    often = count > 1
    return np.where(often[same], (np.cumsum(often) - 1)[same], -1)


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of the pairs of two names; -1 where one is -1."""
    out = np.full(len(left), -1, dtype=np.int64)
    at = np.flatnonzero((left >= 0) & (right >= 0))
    if len(at):
        out[at] = names_of(left[at] * (int(right.max()) + 1) + right[at])
    return out


def shifted(names: np.ndarray, by: int) -> np.ndarray:
    """names[i + by], -1 beyond the end."""
    out = np.full(len(names), -1, dtype=np.int64)
    if by < len(names):
        out[:len(names) - by] = names[by:]
    return out


def guaranteed(period: int, least: int, times: int) -> int:
    """Places in a row on its diagonal that a run of this period, or of any larger one, has at least."""
    turn = max(period, least // times)
    return min(max(least - q, (times - 1) * q) for q in (turn, turn + 1))


def seeds(codes: np.ndarray, starts: np.ndarray, least: int, times: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, places, lags) of each band: k words at a place occur next in the same text a lag later."""
    sizes = np.diff(starts)
    longest = int(sizes.max(initial=0))
    text = np.repeat(np.arange(len(sizes)), sizes)
    # Names hold the text, so equal names are in one text.
    names = names_of(text * (int(codes.max(initial=0)) + 1) + codes)
    length, low, high = 1, 0, 1
    while max(least, times * (low + 1)) <= longest:
        k = guaranteed(low + 1, least, times)
        while 2 * length <= k:
            names, length = joined(names, shifted(names, length)), 2 * length
        if not (names >= 0).any():
            return
        # Two names that overlap cover k words.
        grams = joined(names, shifted(names, k - length)) if k > length else names
        at = np.flatnonzero(grams >= 0)
        order = np.argsort(grams[at], kind="stable")
        at, grams = at[order], grams[at[order]]
        lag = at[1:] - at[:-1]
        some = (grams[1:] == grams[:-1]) & (lag > low) & (lag <= high)
        if some.any():
            yield k, at[:-1][some], lag[some]
        low, high = high, 2 * high


def same_ahead(codes: np.ndarray, at: int, lag: int, end: int) -> int:
    """How many words from `at` on equal those a lag later, before `end`."""
    n, step = 0, 64
    while at + n + lag < end:
        width = min(step, end - lag - at - n)
        differ = codes[at + n:at + n + width] != codes[at + n + lag:at + n + lag + width]
        if differ.any():
            return n + int(differ.argmax())
        n, step = n + width, 2 * step
    return n


def same_behind(codes: np.ndarray, at: int, lag: int, begin: int) -> int:
    """How many words before `at` equal those a lag later, down to `begin`."""
    n, step = 0, 64
    while at - n > begin:
        width = min(step, at - n - begin)
        differ = (codes[at - n - width:at - n] != codes[at - n - width + lag:at - n + lag])[::-1]
        if differ.any():
            return n + int(differ.argmax())
        n, step = n + width, 2 * step
    return n


def find_runs(codes: np.ndarray, starts: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, by text, start and period. Text i has the words
    numbered codes[starts[i]:starts[i + 1]]."""
    if times < 3:
        raise ValueError("a run must have three periods at least")
    found = []
    for k, places, lags in seeds(codes, starts, least, times):
        order = np.lexsort((places, lags))
        places, lags = places[order], lags[order]
        bounds = np.flatnonzero(np.diff(lags, prepend=-1, append=-1))
        for lo, hi in zip(bounds, bounds[1:]):
            lag, of_lag, i = int(lags[lo]), places[lo:hi], 0
            texts = np.searchsorted(starts, of_lag, "right") - 1
            while i < len(of_lag):
                at, begin, end = int(of_lag[i]), int(starts[texts[i]]), int(starts[texts[i] + 1])
                first = at - same_behind(codes, at, lag, begin)
                covered = at + k + same_ahead(codes, at + k, lag, end)
                if covered + lag - first >= max(least, times * lag):
                    found.append((int(texts[i]), first - begin, covered + lag - first, lag))
                # The furthest word covered on this diagonal: seeds before it are part of this stretch.
                i = int(np.searchsorted(of_lag, covered))
    return np.array(sorted(found, key=lambda r: (r[0], r[1], r[3])), dtype=np.int64).reshape(-1, 4)


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words no run contains after its first period. runs: rows (start, length, period)."""
    depth = np.zeros(n + 1, dtype=np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth[:-1]) == 0


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Stretches of a batch of (id, text) with a bounded size of texts."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + PART_BYTES, "right")))
        yield batch.slice(at, end - at)
        at = end


def collapsed_text(words: list[str], runs: np.ndarray) -> str:
    if not len(runs):
        return " ".join(words)
    return " ".join(words[i] for i in np.flatnonzero(kept_words(len(words), runs)).tolist())


RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def runs_of(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES,
            rewrite: Rewrite | None = None) -> DataFrame:
    """Per document (doc_id, n_words, runs, collapsed).

    runs: array of (start, length, period), by start and then period. collapsed: the words that no run
    contains after its first period, joined by one space. `rewrite` may put other words of the same texts
    in the places of words before runs are searched.
    """
    inner = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = pa.list_(pa.struct([(f.name, pa.int64()) for f in RUN.fields]))

    def run(batches):
        for whole in batches:
            for batch in parts(whole):
                codes, starts, words = split_words(batch.column(1))
                codes = codes.astype(np.int64)
                if rewrite is not None:
                    codes = rewrite(batch.column(0), codes, starts)
                found = find_runs(codes, starts, least, times)
                bounds = np.searchsorted(found[:, 0], np.arange(batch.num_rows + 1))
                words = words.to_numpy(zero_copy_only=False)
                texts = [collapsed_text(words[codes[starts[i]:starts[i + 1]]].tolist(), found[bounds[i]:bounds[i + 1], 1:])
                         for i in range(batch.num_rows)]
                rows = pa.StructArray.from_arrays([pa.array(found[:, c + 1]) for c in range(3)], fields=list(kind.value_type))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.diff(starts)),
                     pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), rows).cast(kind), pa.array(texts, pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])
            release()

    return inner.mapInArrow(run, T.StructType([
        inner.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("collapsed", T.StringType())]))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
