"""Hard-negative mining: inner products bounded along a spanning tree of the anchors.

A row's score for an anchor is the inner product of their whole-number vectors. Anchors are taken in
blocks of at most `BLOCK_BYTES`, each with the spanning tree of its anchors by their smallest
distances. A task goes over its rows with the tree: at the root all scores are known; a child's score of
a row is that of its parent, plus or minus the length of the edge times the row's norm. Only rows whose
bounds reach the child's window are scored again; what a row's score is bounded by goes on to the child's
own children. Bounds are rounded outwards, and scores are exact.

There are two passes. The first finds each anchor's positives, the best rows of its own label: its
window is whatever may beat the best that this task has found so far. The second finds, for each
positive, the best rows of other labels in the window from `low` to `high` hundredths of the positive's
score: rows that no positive's window holds, or that cannot be among the best, are not scored.

Rows are shuffled once, to drop repeats, and then read in place once for each block and pass; each
task sends on as many rows for each anchor (and positive) as may at most be returned. A block of
anchors is what is sent to the tasks: bounded, whatever the number of anchors.

Rows without an id or a label, and rows whose vector is null, empty or has null or non-finite parts,
take no part. Rows with equal id, label and vector count once; other rows of an anchor's own id
are no partners of it. Equal scores are ordered by id, then by label. Vectors of other lengths than
the anchor's have no score. Scores beyond 64 bits count as the last number that has them. Extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.llm.common import ship, stored

POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100
BLOCK_BYTES = 4 << 20  # of anchors' vectors in a broadcast
ROWS = 8192  # in work at a time in a task
EXACT = 1 << 53  # up to here, sums of products are exact in double precision
MOST = (1 << 63) - 1


def scores_of(vectors: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers in double precision."""
    if not len(vectors):
        return np.zeros(0, dtype=np.int64)
    bound = float(np.abs(vectors).max()) * float(np.abs(anchor).max()) * len(anchor)
    if bound < EXACT:
        return (vectors @ anchor).astype(np.int64)
    whole = [int(x) for x in anchor]
    return np.array([max(-MOST - 1, min(MOST, sum(int(x) * y for x, y in zip(v, whole)))) for v in vectors],
                    dtype=np.int64)


class Tree:
    """The smallest spanning tree of some anchors with vectors of one length, in an order in which a
    child comes after its parent and the largest subtree last: few bounds are held at a time."""

    def __init__(self, vectors: np.ndarray):
        n = len(vectors)
        parent, edge = np.full(n, -1), np.zeros(n)
        near, best = np.full(n, np.inf), np.zeros(n, dtype=np.int64)
        left = np.ones(n, dtype=bool)
        added, at = [], 0
        for _ in range(n):
            left[at] = False
            added.append(at)
            away = np.sqrt(((vectors - vectors[at]) ** 2).sum(axis=1))
            closer = left & (away < near)
            near[closer], best[closer] = away[closer], at
            if left.any():
                at = int(np.where(left, near, np.inf).argmin()) if np.isfinite(near[left]).any() else int(left.argmax())
                parent[at], edge[at] = best[at], near[at] if np.isfinite(near[at]) else np.inf
        size = np.ones(n, dtype=np.int64)
        children: list[list[int]] = [[] for _ in range(n)]
        for x in reversed(added[1:]):
            size[parent[x]] += size[x]
            children[parent[x]].append(x)
        self.order, stack = [], [0] if n else []
        while stack:
            x = stack.pop()
            self.order.append(x)
            stack += sorted(children[x], key=lambda c: -size[c])
        self.parent, self.edge = parent, edge * (1 + 1e-9)
        #: The last child to need a node's bounds.
        self.last = {int(parent[x]): x for x in self.order}

    def walk(self, vectors: np.ndarray, anchors: np.ndarray, wanted):
        """Goes over all anchors. wanted(i, low, high) -> (which rows, take): `take` gets the scores of
        those rows; bounds are in double precision."""
        norms = np.sqrt((vectors * vectors).sum(axis=1)) * (1 + 1e-9)
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for x in self.order:
            p = int(self.parent[x])
            if p < 0 or not np.isfinite(self.edge[x]):
                low, high = np.full(len(vectors), -np.inf), np.full(len(vectors), np.inf)
            else:
                low, high = held.pop(p) if self.last[p] == x else held[p]
                reach = self.edge[x] * norms
                low, high = low - reach, high + reach
            at, take = wanted(x, low, high)
            scores = scores_of(vectors[at], anchors[x])
            take(at, scores)
            if x in self.last:
                # A score beyond the exact range is known to its rounding.
                slack = np.abs(scores) * 1e-9
                low[at], high[at] = scores - slack, scores + slack
                held[x] = low, high


class Best:
    """The best rows so far: at most `n`, by score and then smaller id and label."""

    def __init__(self, n: int):
        self.n, self.score = n, np.zeros(0, dtype=np.int64)
        self.id, self.label = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def least(self) -> float:
        """A row with a smaller score is not among the best."""
        return self.score[-1] if len(self.score) == self.n else -np.inf

    def add(self, score: np.ndarray, ids: np.ndarray, label: np.ndarray) -> None:
        score = np.concatenate([self.score, score])
        ids, label = np.concatenate([self.id, ids]), np.concatenate([self.label, label])
        # Complement, not minus: the smallest number has no negative.
        order = np.lexsort((label, ids, ~score))[:self.n]
        self.score, self.id, self.label = score[order], ids[order], label[order]


class Block:
    """Anchors of a block, and their trees by length of vector. windows: for each anchor the scores
    of its positives, if they are known."""

    def __init__(self, rows: list):
        self.id = np.array([r.vec_id for r in rows], dtype=np.int64)
        self.label = np.array([r.label for r in rows], dtype=np.int64)
        vectors = [np.array(r.vector, dtype=np.float64) for r in rows]
        self.of = {n: np.flatnonzero([len(v) == n for v in vectors]) for n in {len(v) for v in vectors}}
        self.vectors = {n: np.array([vectors[i] for i in at]) for n, at in self.of.items()}
        self.windows = [sorted({p.score for p in r.positives}) for r in rows] if rows and "positives" in rows[0] else []

    def trees(self, n: int, by_label: bool):
        """(anchors' places, tree) of the anchors with vectors of length n."""
        at = self.of[n]
        groups = [at[self.label[at] == x] for x in np.unique(self.label[at])] if by_label else [at]
        place = np.zeros(len(self.id), dtype=np.int64)
        place[at] = np.arange(len(at))
        return [(g, self.vectors[n][place[g]], Tree(self.vectors[n][place[g]])) for g in groups]


def chunks(batches):
    """(ids, labels, vectors) of up to about ROWS rows whose vectors have one length."""
    held: dict[int, list] = {}

    def table(rows):
        return tuple(np.concatenate(x) for x in zip(*rows))

    for batch in batches:
        lists = batch.column("vector")
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        ends = np.cumsum(sizes)
        ids, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
        for n in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == n)
            vectors = flat[(ends[at] - n)[:, None] + np.arange(n)]
            rows = held.setdefault(n, [])
            rows.append((ids[at], labels[at], vectors))
            if sum(len(r[0]) for r in rows) >= ROWS:
                yield n, table(held.pop(n))
    for n, rows in held.items():
        yield n, table(rows)


def found_rows(found: dict, names: list[str]) -> pa.RecordBatch:
    keys, best = list(found), list(found.values())
    n = [len(b.score) for b in best]
    columns = [pa.array(np.repeat(np.array([k[i] for k in keys], dtype=np.int64), n)) for i in range(len(names) - 3)]
    rest = [np.concatenate([getattr(b, c) for b in best]) if best else np.zeros(0, dtype=np.int64)
            for c in ("id", "label", "score")]
    return pa.RecordBatch.from_arrays([*columns, *map(pa.array, rest)], names=names)


def positives_of(rows: DataFrame, block, most: int) -> DataFrame:
    """(anchor, partner, partner_label, score): each task's best partners of the anchors."""

    def run(batches):
        anchors, trees = block(), {}
        found: dict[tuple, Best] = {}
        for n, (ids, labels, vectors) in chunks(batches):
            if n not in anchors.of:
                continue
            if n not in trees:
                trees[n] = anchors.trees(n, True)
            for at, of, tree in trees[n]:
                mine = np.flatnonzero(labels == anchors.label[at[0]])
                if not len(mine):
                    continue
                ids_of, labels_of = ids[mine], labels[mine]

                def wanted(x, low, high):
                    a = int(at[x])
                    best = found.setdefault((a,), Best(most))

                    def take(some, scores):
                        other = ids_of[some] != anchors.id[a]
                        best.add(scores[other], ids_of[some][other], labels_of[some][other])

                    return np.flatnonzero(high >= best.least()), take

                tree.walk(vectors[mine], of, wanted)
        yield found_rows(found, ["anchor", "partner", "partner_label", "score"])

    return rows.mapInArrow(run, "anchor long, partner long, partner_label long, score long")


def negatives_of(rows: DataFrame, block, most: int, low: int, high: int) -> DataFrame:
    """(anchor, positive_score, partner, partner_label, score): each task's best rows of other labels in
    the windows of the anchors' positives."""

    def run(batches):
        anchors, trees = block(), {}
        found: dict[tuple, Best] = {}
        for n, (ids, labels, vectors) in chunks(batches):
            if n not in anchors.of:
                continue
            if n not in trees:
                trees[n] = anchors.trees(n, False)
            for at, of, tree in trees[n]:

                def wanted(x, least, greatest):
                    a = int(at[x])
                    other = (labels != anchors.label[a]) & (ids != anchors.id[a])
                    near = np.zeros(len(ids), dtype=bool)
                    windows = [(-(-low * p // 100), high * p // 100, p) for p in anchors.windows[a]
                               if low * p <= high * p]
                    for first, last, p in windows:
                        best = found.setdefault((a, p), Best(most))
                        near |= (greatest >= max(first, best.least())) & (least <= last)

                    def take(some, scores):
                        for first, last, p in windows:
                            inside = (scores >= first) & (scores <= last)
                            found[a, p].add(scores[inside], ids[some][inside], labels[some][inside])

                    return np.flatnonzero(other & near), take

                tree.walk(vectors, of, wanted)
        yield found_rows(found, ["anchor", "positive_score", "partner", "partner_label", "score"])

    return rows.mapInArrow(run, "anchor long, positive_score long, partner long, partner_label long, score long")


def best_of(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The first `most` of each key, with their rank from 1. A key has as many rows as tasks send."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "partner", "partner_label")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def blocks_of(anchors: DataFrame, block_bytes: int) -> list[int]:
    """Numbers of blocks, by the hash of the anchor: twice as many as would hold the vectors."""
    size = anchors.agg(F.coalesce(F.sum(F.size("vector") * 8 + 64), F.lit(0))).first()[0]
    return list(range(1 if size <= block_bytes else -(-2 * size // block_bytes)))


def mine(rows: DataFrame, *, anchor, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH, vec_id: str = "vec_id", label: str = "label", vector: str = "vector",
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    rows have whole-number vectors (as double). anchor: the condition on the column vec_id that marks
    anchors. A negative satisfies low * positive_score <= 100 * negative_score <= high * positive_score.
    """
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    able = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
                       F.col(vector).cast("array<double>").alias("vector"))
    able = stored(able.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & ~bad)
                  .dropDuplicates(), "rows")
    # Rows of one id may differ: anchors are numbered.
    anchors = stored(able.where(anchor).withColumn("anchor_no", F.monotonically_increasing_id()), "anchors")
    blocks = blocks_of(anchors, block_bytes)
    block_of = F.pmod(F.xxhash64("anchor_no"), F.lit(len(blocks)))

    def passes(frame: DataFrame, find, keys: list[str], most: int) -> DataFrame:
        """find() over each block of anchors, with its numbers of anchors put back."""
        out = None
        for number in blocks:
            held = sorted(frame.where(block_of == number).collect(), key=lambda r: r.anchor_no)  # one block
            numbers = frame.sparkSession.createDataFrame(
                [(i, r.anchor_no, r.vec_id) for i, r in enumerate(held)], "anchor long, anchor_no long, anchor_id long")
            part = find(able, ship(frame.sparkSession, Block(held))).join(F.broadcast(numbers), "anchor").drop("anchor")
            out = part if out is None else out.unionByName(part)
        return best_of(out, ["anchor_no", *keys], most)

    pairs = stored(passes(anchors, lambda df, block: positives_of(df, block, positives), [], positives), "positives")
    known = anchors.join(pairs.groupBy("anchor_no").agg(
        F.collect_set(F.struct("score")).alias("positives")), "anchor_no")
    mined = passes(known, lambda df, block: negatives_of(df, block, negatives, low, high), ["positive_score"], negatives)
    return pairs.select("anchor_no", F.col("partner").alias("positive_id"), F.col("score").alias("positive_score")).join(
        mined.withColumnRenamed("partner", "negative_id").withColumnRenamed("score", "negative_score"),
        ["anchor_no", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
