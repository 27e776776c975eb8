"""Quality classifier: Bradley-Terry pairwise ranking.

A document's score is a weighted sum of features of its text. The weights make labelled good
documents beat labelled bad ones: for pairs of one good and one bad document they minimise the
logistic loss of the difference of scores. Documents are kept from that quantile of the scores of
all labelled training rows that equals the share of bad ones among them; there the returned score,
from 0 to 1, is `threshold`.

The fit of the weights uses at most `most` labelled rows of each class (a parameter), chosen by the
hash of their ids, whatever the size of the corpus; only their features come to the driver. The
quantile is taken of all labelled rows, whose scores are summed up in ranges. Scoring is one
pass without a shuffle.

Features are shares of kinds of characters and words, word lengths, and repetition, over the
whole text. Null and empty texts have zero features and get a score like any other. Repeated rows
get equal scores. Labels without a document and documents without a label are fine; an id with several
texts counts once in the quantile, with the largest score. Without rows of both classes there is no preference and every document is at the threshold. Labels, ids,
languages and sources are never features. Extra columns are kept.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.llm.common import (
    add_columns, label_of_ids, labelled_sample, running_sums, ship, split_of, split_words)

MOST = 10_000  # labelled rows of each class in the fit
OPPONENTS = 8  # pairs of each row
THRESHOLD = 0.7
RIDGE = 1e-3
PART_BYTES = 4 << 20

#: Kinds of characters that are counted in words, and of words, as RE2 patterns.
CHARACTERS = {
    "letters": r"\pL", "capitals": r"\p{Lu}", "digits": r"\pN", "marks": r"[!?]",
    "symbols": r"[#$%&*+/<=>@\\^_`|~{}\[\]]"}
WORDS = {
    "no letter": r"^\PL+$", "shouted": r"^\P{L}*\p{Lu}{2}[^\p{Ll}]*$", "decorated": r"[^\pL\pN\s.]{2,}$",
    "sentence end": r"[.!?]$", "comma": r",$", "address": r"(://|www\.|@)"}


def features(texts: pa.Array) -> np.ndarray:
    """One row per text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    parts, at = [], 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + PART_BYTES, "right")))
        parts.append(part_features(texts.slice(at, end - at)))
        at = end
    return np.concatenate(parts) if parts else np.zeros((0, width()))


def width() -> int:
    return part_features(pa.array([""])).shape[1]


def part_features(texts: pa.Array) -> np.ndarray:
    codes, starts, words = split_words(texts)
    docs = len(starts) - 1
    n = np.diff(starts)
    doc = np.repeat(np.arange(docs), n)
    many = np.maximum(n, 1)

    def total(values):
        return np.bincount(doc, weights=values, minlength=docs)

    long = pc.utf8_length(words).to_numpy().astype(np.float64)
    size = total(long[codes])
    spread = total(long[codes] ** 2) / many - (size / many) ** 2
    columns = [np.log1p(n), size / many, np.sqrt(np.maximum(spread, 0))]
    for pattern in CHARACTERS.values():
        count = pc.count_substring_regex(words, pattern).to_numpy().astype(np.float64)
        columns.append(total(count[codes]) / np.maximum(size, 1))
    for pattern in WORDS.values():
        found = pc.match_substring_regex(words, pattern).to_numpy(zero_copy_only=False).astype(np.float64)
        columns.append(total(found[codes]) / many)
    if len(codes):
        same = np.concatenate(([False], (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])))
    else:
        same = np.zeros(0, dtype=bool)
    columns.append(total(same) / many)
    wide = np.int64(len(words) + 1)
    columns.append(different(doc, codes.astype(np.int64), docs, int(wide)) / many)
    pair = codes[:-1].astype(np.int64) * wide + codes[1:]
    inside = doc[:-1] == doc[1:]
    columns.append(np.where(n > 1, different(doc[:-1][inside], pair[inside], docs, int(wide) ** 2) / np.maximum(n - 1, 1), 0))
    lines = pc.fill_null(pc.count_substring(texts, "\n"), 0).to_numpy(zero_copy_only=False)
    columns.append(lines / many)
    return np.column_stack(columns)


def different(doc: np.ndarray, keys: np.ndarray, docs: int, bound: int) -> np.ndarray:
    """How many different keys, all below the bound, each document has."""
    both = np.sort(doc * np.int64(bound) + keys)
    new = np.ones(len(both), dtype=bool)
    new[1:] = both[1:] != both[:-1]
    return np.bincount(both[new] // bound, minlength=docs).astype(np.float64)


class Ranking:
    """Weights of the standardised features, and the score from which documents are kept."""

    def __init__(self, x: np.ndarray, good: np.ndarray, threshold: float = THRESHOLD,
                 opponents: int = OPPONENTS, ridge: float = RIDGE):
        self.threshold = threshold
        self.weights, self.cut = None, 0.0
        if not good.any() or good.all():
            return
        self.mean = x.mean(axis=0)
        self.scale = np.maximum(x.std(axis=0), 1e-9)
        x = (x - self.mean) / self.scale
        first, second = np.flatnonzero(good), np.flatnonzero(~good)
        # Every row of the larger class meets `opponents` of the other, all of them in turn.
        k = np.arange(max(len(first), len(second)) * opponents)
        step = k // max(len(first), len(second))
        difference = x[first[k % len(first)]] - x[second[(k + step * 7919) % len(second)]]
        self.weights = np.zeros(x.shape[1])
        for _ in range(25):
            p = 1 / (1 + np.exp(np.clip(difference @ self.weights, -50, 50)))
            slope = difference.T @ p / len(p) - ridge * self.weights
            bend = (difference * (p * (1 - p))[:, None]).T @ difference / len(p) + ridge * np.eye(x.shape[1])
            move = np.linalg.solve(bend, slope)
            self.weights = self.weights + move
            if np.abs(move).max() < 1e-6:
                break

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """From 0 to 1; the threshold stands at the cut."""
        if self.weights is None:
            return np.full(len(x), self.threshold)
        raw = self.raw(x) - self.cut
        return 1 / (1 + (1 / self.threshold - 1) * np.exp(np.clip(-raw, -50, 50)))


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", doc_id: str = "doc_id",
        text: str = "text", most: int = MOST, threshold: float = THRESHOLD, training=None) -> Ranking:
    """Learns from the labelled rows that the condition `training` on doc_id marks."""
    if training is None:
        training = split_of("doc_id", 4) != 2
    sample = labelled_sample(docs, labels, label, doc_id=doc_id, text=text, most=most, training=training)

    def measure(batches):
        for batch in batches:
            x = features(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(list(x), pa.list_(pa.float64()))],
                names=["doc_id", "label", "x"])

    kind = sample.schema["doc_id"]
    rows = sample.mapInArrow(measure, T.StructType([
        kind, T.StructField("label", T.IntegerType()), T.StructField("x", T.ArrayType(T.DoubleType()))])).collect()
    rows.sort(key=lambda r: (r["x"], r["label"]))
    x = np.array([r["x"] for r in rows], dtype=np.float64).reshape(len(rows), width())
    model = Ranking(x, np.array([r["label"] == 1 for r in rows], dtype=bool), threshold)
    if model.weights is not None:
        marks = label_of_ids(labels, label, doc_id=doc_id, training=training)
        model.cut = cut_of(docs, marks, model, doc_id=doc_id, text=text)
    return model


def cut_of(docs: DataFrame, marks: DataFrame, model: Ranking, *, doc_id: str, text: str) -> float:
    """Between the two scores of labelled documents that have as many rows at or below them as there
    are bad ones, and one more. All documents are scored, so that no text is shuffled."""
    sent = ship(docs.sparkSession, model)
    inner = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).where("doc_id IS NOT NULL")

    def measure(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sent().raw(features(batch.column(1))))], names=["doc_id", "raw"])

    scored = inner.mapInArrow(measure, T.StructType([inner.schema["doc_id"], T.StructField("raw", T.DoubleType())]))
    values = scored.groupBy("doc_id").agg(F.max("raw").alias("raw")).join(marks, "doc_id").groupBy("raw").agg(
        F.count("*").alias("n"), F.sum(1 - F.col("label")).alias("bad"))
    sums = running_sums(values, "raw", ["n", "bad"])
    bad = sums.agg(F.sum("bad")).first()[0]
    upto = F.col("n_before") + F.col("n")
    low, high = sums.agg(F.min(F.when(upto >= bad, F.col("raw"))), F.min(F.when(upto > bad, F.col("raw")))).first()
    return (low + high) / 2


def score(docs: DataFrame, model: Ranking, *, text: str = "text", column: str = "score") -> DataFrame:
    """docs with the column `score`; documents at model.threshold or more are kept."""
    sent = ship(docs.sparkSession, model)

    def compute(texts):
        return [pa.array(sent().score(features(texts)))]

    return add_columns(docs, text, [T.StructField(column, T.DoubleType())], compute)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
