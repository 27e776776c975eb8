"""Toxicity: maximum-scoring segments of token log-odds.

Every unit, a word or the first letters of longer words, gets its log-odds between toxic and clean
labelled texts that hold it. The prior is a Dirichlet one: the unit's share of all words in the
whole corpus. Units whose log-odds are not significant, or small, are neutral. A token's score is its word's,
else its beginning's, less a small cost for every token, so that random text scores below zero.

One linear scan of a text finds all maximal scoring segments: the toxic passages. Under the
corpus's shares of scores a clean text of m words has about K m exp(-lambda S) segments of score S
or more by chance (extreme-value statistics; lambda from the shares, K counted on all clean
labelled rows). A document's statistic is the sum of -log of that number over its significant
passages; the returned score, from 0 to 1, is `threshold` where the statistic separates all
labelled training rows best.

The lexicon is of at most `most` labelled rows of each class (a parameter), chosen by the hash of
their ids. It holds significant units of those rows alone, so its size does not grow with the
corpus. Corpus shares are counted over all documents; K and the cut come from all labelled
training rows, whose statistics are summed up in ranges. Scoring is one pass without a shuffle.

Null, empty and very short texts have no passage and a low score. Equal labelled texts count once
in the lexicon; an id with several texts counts once in K and the cut, with its longest one. Without labelled rows of both classes there is no lexicon and every score is 0. Labels, ids,
languages and sources are never used in a score. Extra columns are kept.
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

from folioloom.llm.common import (
    LETTERS, add_columns, label_of_ids, labelled_sample, running_sums, ship, split_of, split_words, stored)

MOST = 10_000  # labelled rows of each class in the fit
THRESHOLD = 0.3
PRIOR = 1000.0  # weight of the prior of all units together
FLOOR = 0.5  # least weight of the prior of one unit
SIGNIFICANT = 3.0  # standard errors that log-odds must be from zero
LARGE = 2.5  # least size of log-odds
LEAST = 2  # labelled texts of one class that a unit must be in
BEGINNING = 4  # letters of the unit that stands for longer words
COST = 0.05  # of every token
CHANCE = 1.0  # expected chance segments below which a passage is significant
PART_BYTES = 4 << 20

PASSAGES = T.ArrayType(T.StructType([
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("score", T.DoubleType())]))


def units(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each word its own unit and its beginning's ("the first letters *"), else an empty one."""
    own = words.to_numpy(zero_copy_only=False)
    long = pc.greater(pc.utf8_length(words), BEGINNING + 1)
    first = pc.binary_join_element_wise(pc.utf8_slice_codeunits(words, 0, BEGINNING), "*", "")
    return own, pc.if_else(long, first, "").to_numpy(zero_copy_only=False)


def parts(texts: pa.Array):
    """The texts in stretches of a bounded size."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + PART_BYTES, "right")))
        yield texts.slice(at, end - at)
        at = end


def maximal_segments(values: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score), by one scan.

    Sums run over the whole line. A candidate is joined with the nearest one that starts from a
    lower sum, if that one also ends at a lower sum. Each keeps the place of the nearest one
    that starts lower, so no candidate is passed twice.
    """
    found: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum after, lower
    total = 0.0
    for i, value in enumerate(values):
        before, total = total, total + value
        if value <= 0:
            continue
        first, left = i, before
        while True:
            at = len(found) - 1
            while at >= 0 and found[at][2] >= left:
                at = found[at][4]
            if at < 0 or found[at][3] >= total:
                break
            first, left = found[at][0], found[at][2]
            del found[at:]
        found.append((first, i, left, total, at))
    return [(a, b, right - left) for a, b, left, right, _ in found]


class Lexicon:
    """Scores of units, and the extreme-value statistics of segments."""

    def __init__(self, scores: dict[str, float], decay: float = 1.0, chance: float = 1.0):
        self.scores, self.decay, self.chance = scores, decay, chance
        self.cut, self.slope = math.inf, 1.0

    def tokens(self, words: pa.Array) -> np.ndarray:
        get = self.scores.get
        own, first = units(words)
        return np.fromiter((get(w) or get(b) or 0.0 for w, b in zip(own, first)), np.float64, len(own))

    def expected(self, score: float, words: int) -> float:
        return self.chance * max(words, 1) * math.exp(-self.decay * score)

    def segments(self, texts: pa.Array) -> list[tuple[int, list[tuple[int, int, float]]]]:
        """Number of words and the maximal segments of each text."""
        out = []
        for part in parts(texts):
            codes, starts, words = split_words(part, LETTERS)
            score = self.tokens(words)[codes]
            some = np.flatnonzero(score)
            lo = np.searchsorted(some, starts)
            for i in range(len(starts) - 1):
                at = some[lo[i]:lo[i + 1]]
                words_here = int(starts[i + 1] - starts[i])
                if not len(at) or not (score[at] > COST).any():
                    out.append((words_here, []))
                    continue
                # What lies between two scored tokens costs as much as it is long.
                gaps = -COST * (np.diff(at, prepend=starts[i] - 1) - 1)
                line = np.column_stack([gaps, score[at] - COST]).ravel().tolist()
                place = at - starts[i]
                out.append((words_here, [
                    (int(place[a // 2]), int(place[b // 2]), s) for a, b, s in maximal_segments(line)]))
        return out

    def statistic(self, words: int, segments: list[tuple[int, int, float]]) -> float:
        """Evidence of all significant passages, or of the best one when none is."""
        if not segments:
            return -20.0
        evidence = [-math.log(max(self.expected(s, words), 1e-300)) for _, _, s in segments]
        strong = [e for e in evidence if e >= -math.log(CHANCE)]
        return sum(strong) if strong else max(max(evidence), -20.0)

    def probability(self, statistic: float, threshold: float) -> float:
        if not math.isfinite(self.cut):
            return 0.0
        raw = min(50.0, max(-50.0, self.slope * (statistic - self.cut)))
        return 1 / (1 + (1 / threshold - 1) * math.exp(-raw))


def unit_counts(sample: DataFrame) -> DataFrame:
    """(unit, toxic, clean): in how many different labelled texts of each class a unit is."""
    once = sample.groupBy("text").agg(F.max("label").alias("label"))

    def run(batches):
        for batch in batches:
            for label in (0, 1):
                mine = batch.filter(pc.equal(batch.column(1), label))
                for part in parts(mine.column(0)):
                    codes, starts, words = split_words(part, LETTERS)
                    doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
                    for column in units(words):
                        names, at = np.unique(column.astype(str), return_inverse=True)
                        both = np.unique(doc * np.int64(max(len(names), 1)) + at[codes])
                        texts = np.bincount(both % max(len(names), 1), minlength=len(names))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(names, pa.string()), pa.array(np.full(len(names), label)), pa.array(texts)],
                            names=["unit", "label", "texts"])

    counted = once.select("text", "label").mapInArrow(run, "unit string, label long, texts long").where("unit <> ''")
    return counted.groupBy("unit").agg(*(
        F.sum(F.when(F.col("label") == mark, F.col("texts")).otherwise(0)).alias(alias)
        for mark, alias in ((1, "toxic"), (0, "clean"))))


def log_odds(toxic, clean, toxic_texts, clean_texts, share):
    """Log-odds under a Dirichlet prior, and their standard error."""
    a = PRIOR * share + FLOOR
    y, z = toxic + a, clean + a
    odds = np.log(y / (toxic_texts + 2 * a - y)) - np.log(z / (clean_texts + 2 * a - z))
    return odds, np.sqrt(1 / y + 1 / z)


def corpus_shares(docs: DataFrame, text: str, names: list[str]) -> tuple[dict[str, int], int]:
    """How often each of a bounded list of units occurs in all documents, and all their words."""
    place = ship(docs.sparkSession, {u: i for i, u in enumerate(names)})

    def run(batches):
        at = place()
        n, total = np.zeros(len(at) + 1, dtype=np.int64), 0
        for batch in batches:
            for part in parts(batch.column(0)):
                codes, _, words = split_words(part, LETTERS)
                count = np.bincount(codes, minlength=len(words))
                for column in units(words):
                    where = np.fromiter((at.get(u, -1) for u in column), np.int64, len(column))
                    np.add.at(n, where, count)
                total += len(codes)
        n[-1] = total
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], names=["unit", "n"])

    rows = (docs.select(F.col(f"`{text}`").cast("string").alias("t")).mapInArrow(run, "unit long, n long")
            .groupBy("unit").agg(F.sum("n").alias("n")).collect())  # one row for each unit of the list
    found = {r.unit: r.n for r in rows}
    return {u: found.get(i, 0) for i, u in enumerate(names)}, found.get(len(names), 0)


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", doc_id: str = "doc_id",
        text: str = "text", most: int = MOST, training=None) -> Lexicon:
    """Learns from the labelled rows that the condition `training` on doc_id marks."""
    if training is None:
        training = split_of("doc_id", 4) != 2
    sample = labelled_sample(docs, labels, label, doc_id=doc_id, text=text, most=most, training=training)
    model = learn(docs, stored(sample, "labelled"), text)
    if model is None:
        return Lexicon({})
    return calibrate(model, docs, label_of_ids(labels, label, doc_id=doc_id, training=training), doc_id, text)


def learn(docs: DataFrame, sample: DataFrame, text: str) -> Lexicon | None:
    """The lexicon, and how fast chance segments fall; none without texts of both classes."""
    total = sample.groupBy("text").agg(F.max("label").alias("label")).agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")).first()
    if not total.toxic or not total.clean:
        return None
    # Units that can become significant and large: those that would be so under the floor alone.
    y, z = F.col("toxic") + FLOOR, F.col("clean") + FLOOR
    odds = F.abs(F.log(y / (total.toxic + 2 * FLOOR - y)) - F.log(z / (total.clean + 2 * FLOOR - z)))
    rows = sorted(unit_counts(sample).where(
        (F.greatest("toxic", "clean") >= LEAST) & (odds >= LARGE) & (odds >= SIGNIFICANT * F.sqrt(1 / y + 1 / z))).collect())
    names = [r.unit for r in rows]
    seen, words = corpus_shares(docs, text, names)
    share = np.array([seen[u] / max(words, 1) for u in names])
    odds, error = log_odds(np.array([r.toxic for r in rows], float), np.array([r.clean for r in rows], float),
                           float(total.toxic), float(total.clean), share)
    scores = {u: float(o) for u, o, e in zip(names, odds, error) if abs(o) >= max(LARGE, SIGNIFICANT * e)}
    model = Lexicon(scores)
    # The background of the statistics is clean text: of a unit's share, the part in clean texts.
    pure = {u: s * (r.clean + FLOOR) / (r.clean + r.toxic + 2 * FLOOR) for u, r, s in zip(names, rows, share)}
    model.decay = decay([(o, pure[u]) for u, o in scores.items()])
    return model


def decay(scored: list[tuple[float, float]]) -> float:
    """The positive solution of sum of share * exp(lambda * score) = 1, neutral words included."""
    neutral = max(0.0, 1.0 - sum(s for _, s in scored))

    def excess(x):
        return sum(s * math.exp(min(700.0, x * (o - COST))) for o, s in scored) + neutral * math.exp(-x * COST) - 1

    lo, hi = 1e-6, 1.0
    while excess(hi) < 0 and hi < 64:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if excess(mid) < 0 else (lo, mid)
    return hi


def calibrate(model: Lexicon, docs: DataFrame, marks: DataFrame, doc_id: str, text: str) -> Lexicon:
    """Counts chance segments on all clean rows, and sets the cut and the slope by all rows of marks.

    The segments of all documents are found, so that no text is shuffled.
    """
    sent = ship(docs.sparkSession, model)
    inner = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).where("doc_id IS NOT NULL")

    def run(batches):
        lexicon = sent()
        for batch in batches:
            found = lexicon.segments(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in found], pa.int64()),
                 pa.array([[s for _, _, s in x] for _, x in found], pa.list_(pa.float64()))],
                names=["doc_id", "words", "scores"])

    measured = inner.mapInArrow(run, T.StructType([
        inner.schema["doc_id"], T.StructField("words", T.LongType()), T.StructField("scores", T.ArrayType(T.DoubleType()))]))
    rows = stored(measured.groupBy("doc_id").agg(F.max(F.struct("words", "scores")).alias("m")).join(
        marks, "doc_id").select("label", "m.words", "m.scores"), "measured")
    low = min((s for s in model.scores.values() if s > COST), default=1.0) - COST
    clean = rows.where("label = 0").agg(
        F.sum(F.size(F.filter("scores", lambda s: s >= low))).alias("number"), F.sum("words").alias("words")).first()
    model.chance = ((clean.number or 0) + 0.5) / (max(1, clean.words or 0) * math.exp(-model.decay * low))
    counted = ship(docs.sparkSession, model)

    def judge(batches):
        lexicon = counted()
        for batch in batches:
            found = [lexicon.statistic(n, [(0, 0, s) for s in x])
                     for n, x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["label", "value"])

    values = rows.select("label", "words", "scores").mapInArrow(judge, "label int, value double").groupBy("value").agg(
        F.count("*").alias("n"), F.sum(F.col("label").cast("long")).alias("toxic"))
    sums = stored(running_sums(values, "value", ["n", "toxic"]), "sums")
    total = sums.agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).first()
    # A cut just below each value: the rows from there on are called toxic. The best has the largest F1.
    f1 = 2 * (total.toxic - F.col("toxic_before")) / (total.n - F.col("n_before") + total.toxic)
    best = -sums.agg(F.max(F.struct(f1.alias("f1"), (-F.col("value")).alias("least"))).alias("b")).first().b.least
    below = sums.where(F.col("value") < best).agg(F.max("value")).first()[0]
    model.cut = best - 1e-6 if below is None else (below + best) / 2
    spread = sums.agg(F.sum(F.abs(F.col("value") - model.cut) * F.col("n"))).first()[0] / total.n
    model.slope = 3.0 / max(spread, 1e-6)
    return model


def score(docs: DataFrame, model: Lexicon, *, text: str = "text", threshold: float = THRESHOLD,
          column: str = "score", passages: str = "passages") -> DataFrame:
    """docs with `score` and `passages`: the significant passages (first word, last word, score)."""
    sent = ship(docs.sparkSession, model)

    def compute(texts):
        lexicon = sent()
        found = lexicon.segments(texts)
        return [
            pa.array([lexicon.probability(lexicon.statistic(n, x), threshold) for n, x in found], pa.float64()),
            pa.array([[{"first_word": a, "last_word": b, "score": s} for a, b, s in x
                       if lexicon.expected(s, n) <= CHANCE] for n, x in found],
                     pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("score", pa.float64())])))]

    return add_columns(docs, text, [
        T.StructField(column, T.DoubleType()), T.StructField(passages, PASSAGES)], compute)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
