"""Consistent weighted sampling against brute force and the similarity it estimates."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from folioloom.llm import queries, weighted_sampling as W

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def bag(text, shingle=1):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return collections.Counter()
    return collections.Counter(" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1)))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def drawn(term, s):
    seed = xxhash.xxh64_intdigest(struct.pack("<q", term), 42)
    seed = xxhash.xxh64_intdigest(struct.pack("<i", s // W.AT_ONCE * W.AT_ONCE), seed)
    first = xxhash.xxh64_intdigest(struct.pack("<i", s % W.AT_ONCE), xxhash.xxh64_intdigest(struct.pack("<Q", seed), 42))
    return first, xxhash.xxh64_intdigest(struct.pack("<Q", first), 42)


def print_brute(text, shingle=1):
    """Every term is worked out for every sample."""
    terms = [(signed(xxhash.xxh64_intdigest(t.encode(), 42)), n) for t, n in bag(text, shingle).items()]
    out = ""
    for s in range(W.SAMPLES):
        best = None
        for term, weight in terms:
            first, second = drawn(term, s)
            u = [((x >> by & (1 << n) - 1) + 0.5) * 2.0 ** -n
                 for x, by, n in ((first, 0, 21), (first, 21, 21), (first, 42, 22), (second, 0, 32), (second, 32, 32))]
            minus_r = math.log(u[0] * u[1])
            level = math.floor(u[2] - math.log(weight) / minus_r)
            value = int((math.log(-math.log(u[3] * u[4])) + minus_r * (level - u[2] + 1)) * (1 << W.VALUE_BITS))
            named = (term ^ level * 1000003) & 0xFFFFFFFF
            best = min(best, (value, named)) if best else (value, named)
        out += f"{best[1] & 0xFFFF if best else 0:04x}"
    return out


def texts(seed, n):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "straße", "Ab", "aB"]
    return [" ".join(pick.choice(words) * pick.randint(1, 2) for _ in range(pick.randint(0, 70))) for _ in range(n)]


ODD = [None, "", " \t\n", "one", "One\x0bone ONE", "\x1f\xa0 é", "x " * 4000, "a\U0001F600b " * 9]


@pytest.mark.parametrize("shingle", [1, 3])
def test_fingerprints_equal_brute_force(spark, shingle):
    rows = list(enumerate(ODD + texts(3, 30)))
    frame = spark.createDataFrame(rows, "key long, text string").withColumn("term", F.lit("clash"))
    got = {r.key: r.fingerprint for r in W.fingerprints(frame, ["key"], shingle=shingle).collect()}
    assert got == {i: print_brute(t, shingle) for i, t in rows}


def test_likeness_estimates_generalised_jaccard(spark):
    pick, pairs = random.Random(9), []
    for i in range(300):
        a = [f"w{pick.randrange(40)}" for _ in range(pick.randint(20, 90))]
        b = list(a)
        for _ in range(pick.randint(0, 80)):
            b[pick.randrange(len(b))] = f"w{pick.randrange(90)}"
        pairs.append((i, " ".join(a), " ".join(b)))
    frame = spark.createDataFrame(pairs, "key long, a string, b string")
    sides = [W.fingerprints(frame, ["key"], text=c).withColumnRenamed("fingerprint", c) for c in "ab"]
    got = {r.key: r.near for r in sides[0].join(sides[1], "key").select("key", W.likeness(F.col("a"), F.col("b")).alias("near")).collect()}
    error = []
    for i, a, b in pairs:
        x, y = bag(a), bag(b)
        true = sum((x & y).values()) / sum((x | y).values())
        error.append((got[i] - true) / math.sqrt(max(true * (1 - true), 0.02) / W.SAMPLES))
    assert abs(np.mean(error)) < 0.35 and 0.7 < np.std(error) < 1.2


def row_brute(rows):
    """The contract: each document with the next by (id, hash of the text), in a circle."""
    def hashed(t):
        return signed(xxhash.xxh64_intdigest((t or "").encode(), 42))

    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashed(r[1])))
    out = []
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        t, following = t or "", following or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + following[:half]
        own, other, after = print_brute(t), print_brute(edited), print_brute(following)

        def near(a, b):
            return sum(a[k:k + 4] == b[k:k + 4] for k in range(0, len(a), 4)) / W.SAMPLES

        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), own, other, near(own, other), near(own, after)))
    return out


def order(row):
    return tuple((x is not None, x) for x in row)


def test_op11_equals_brute_force(spark, tmp_path):
    rows = [(7 * i % 41, t) for i, t in enumerate(ODD + texts(4, 25))]
    rows += [(5, rows[3][1]), (5, rows[3][1]), (6, "tie a"), (6, "tie b"), (None, "no id"), rows[10], rows[10]]
    spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, hash string, kind int").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = queries.op11_weighted_sampling(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted(map(tuple, got.collect()), key=order) == sorted(row_brute(rows), key=order)


def test_op11_of_one_document_and_of_none(spark, tmp_path):
    for name, rows in (("one", [(1, "ab cd")]), ("none", [])):
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = [tuple(r) for r in queries.op11_weighted_sampling(spark, f"{tmp_path}/{name}").collect()]
        assert got == row_brute(rows)
