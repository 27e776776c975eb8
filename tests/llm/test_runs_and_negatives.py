"""Periodic runs and hard negatives against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioloom.llm import hard_negatives, periodic_runs, queries


def runs_brute(words, least=6, times=4):
    """(start, length, period) of every diagonal's stretches that are long enough and have no smaller period."""
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, times * q) and not any(
                    all(words[x] == words[x + p] for x in range(i, i + length - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def row_brute(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = runs_brute(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            digest(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def text_of(rng, size):
    words = []
    while len(words) < size:
        base = [rng.choice("abAB") * rng.randint(1, 2) for _ in range(rng.randint(1, 9))]
        words += (base * 9)[:rng.randint(1, 6 * len(base))]
    return "".join(w + rng.choice([" ", "\t", "\n", "\x0b", " \r\x0c", "  "]) for w in words[:size])


def order(row):
    return tuple((x is not None, x) for x in row)


def test_periodic_runs_equal_brute_force(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, text_of(rng, rng.randint(0, 120))) for i in range(400)]
    rows += [(500, None), (501, ""), (502, " \n "), (503, "x " * 3000), (504, "é\x1f \xa0é " * 40), (3, rows[3][1]),
             (505, " ".join(f"w{i % 700}" for i in range(2900))), (None, "a " * 8), (None, None)]
    spark.createDataFrame([(i, t, 9, "x") for i, t in rows], "doc_id long, text string, start int, runs string").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = queries.op13_periodic_runs(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=order) == sorted((row_brute(i, t) for i, t in rows), key=order)


def test_periodic_runs_of_other_lengths(spark):
    rng = random.Random(6)
    for _ in range(300):
        least, times = rng.choice([(1, 3), (6, 4), (20, 3), (70, 3), (9, 5)])
        texts = [text_of(rng, rng.randint(0, 100)).split() for _ in range(rng.randint(1, 4))]
        vocabulary = {w: i for i, w in enumerate({w for t in texts for w in t})}
        codes = np.array([vocabulary[w] for t in texts for w in t], dtype=np.int64)
        starts = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        want = [(i, *r) for i, t in enumerate(texts) for r in runs_brute(t, least, times)]
        assert [tuple(r) for r in periodic_runs.find_runs(codes, starts, least, times).tolist()] == want
    assert periodic_runs.runs_of(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.find_runs(codes, starts, 6, 2)


def mine_brute(rows, every=100, positives=5, negatives=5):
    rows = {(i, label, v) for i, label, v in rows if i is not None and label is not None and v
            and all(x is not None and math.isfinite(x) for x in v)}
    found = []
    for a in (r for r in rows if r[0] % every == 0):
        scored = sorted((-sum(int(x) * int(y) for x, y in zip(a[2], r[2])), r[0], r[1]) for r in rows
                        if r[0] != a[0] and len(r[2]) == len(a[2]))
        for s, i, _ in [x for x in scored if x[2] == a[1]][:positives]:
            inside = [x for x in scored if x[2] != a[1] and 80 * -s <= 100 * -x[0] <= 100 * -s]
            found += [(a[0], i, k, x[1], -s, -x[0]) for k, x in enumerate(inside[:negatives], 1)]
    return sorted(found)


def frame_of(spark, rows):
    return spark.createDataFrame([(i, label, v, "x", 1) for i, label, v in rows],
                                 "vec_id long, label int, vector array<double>, rank string, Score int")


@pytest.mark.parametrize("block_bytes", [4 << 20, 2_000])
def test_hard_negatives_equal_brute_force(spark, block_bytes):
    rng = random.Random(8)
    middles = [[rng.randint(-40, 90) for _ in range(8)] for _ in range(6)]
    rows = []
    for i in range(900):
        middle = rng.choice(middles)
        rows.append((i, rng.randint(0, 4), tuple(float(x + rng.randint(-9, 9)) for x in middle)))
    rows += [(1000 + i, i % 5, rows[7][2]) for i in range(30)]  # ties
    rows += [rows[100], rows[100], rows[31], (2000, 1, (0.0,) * 8), (2100, 2, (1.0, 2.0)), (2101, 2, (1.0, 1.0)), (2102, 3, (1.0, 1.0))]
    rows += [(3000, None, rows[0][2]), (3001, 1, None), (3100, 1, (float("nan"),) * 8), (3200, 1, (None,) * 8),
             (3300, 1, (float("inf"),) * 8), (3400, 1, ()), (None, 1, rows[0][2])]
    rows += [(4000, 1, (2.0 ** 40, 3.0)), (4001, 1, (2.0 ** 20, 2.0 ** 10)), (4002, 2, (2.0 ** 20, 2.0 ** 9))]
    got = hard_negatives.mine(frame_of(spark, rows), anchor=F.col("vec_id") % 100 == 0, block_bytes=block_bytes)
    want = mine_brute(rows)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100


def test_tree_bounds_drop_rows_without_scoring():
    """Anchors close together: most rows are never scored again."""
    rng = np.random.default_rng(4)
    anchors = np.floor(rng.normal(size=(1, 16)) * 200) + np.floor(rng.normal(size=(50, 16)) * 2)
    rows = np.floor(rng.normal(size=(4000, 16)) * 200)
    tree, scored = hard_negatives.Tree(anchors), []

    def wanted(x, low, high):
        exact = rows @ anchors[x]
        assert (low <= exact).all() and (exact <= high).all()
        at = np.flatnonzero(high >= np.sort(exact)[-5])
        return at, lambda some, scores: scored.append(len(some))

    tree.walk(rows, anchors, wanted)
    assert scored[0] == 4000 and np.mean(scored[1:]) < 1000


def test_no_anchors_and_no_rows(spark):
    rows = [(i, i % 2, (1.0, float(i))) for i in range(1, 20)]
    mined = hard_negatives.mine(frame_of(spark, rows), anchor=F.col("vec_id") % 100 == 0)
    assert mined.collect() == [] and mined.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert hard_negatives.mine(frame_of(spark, []), anchor=F.col("vec_id") % 100 == 0).collect() == []
