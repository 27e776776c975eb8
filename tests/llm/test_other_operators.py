"""Packing, embeddings, the two classifiers, tool calls and URL rules."""

from __future__ import annotations

import json
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioloom.llm import embedding_dedup, packing, quality, tool_calls, toxicity, url_rules
from folioloom.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, score string, piece int, label int, length string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "extra", 7, 1, "x") for i, t in rows], DOCS)


ODD = ["", None, " ", "it's 'tis don't A1b2 x_y", "ªº µm Éá İstanbul ΣΑΣ Σ", "a<|endoftext|>b <|startoftext|>", "ﬁ ½ ² ñ x y ́a", "​÷×",
       " \x1cA\x1db\x85c ", "WORD, word. (word) \"word\"", "word " * 3000, "Straße!!! na\u0308ive"]


def test_tokens_are_those_of_the_tokenizer(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    rows = list(enumerate(ODD)) + [(3, ODD[3]), (None, "null id")]
    got = {}
    for r in packing.tokenize(docs_of(spark, rows), tokenizer_path("word_bpe_49k.json"), capacity=50).collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.length == len(ids) and r.start == 50 * r.piece
        got.setdefault(r.doc_id, {}).setdefault(r.piece, []).append(ids)
    for i, text in rows:
        want = whole.encode(text or "", add_special_tokens=False).ids + [0]
        pieces = got[i]
        assert sum((pieces[k][0] for k in sorted(pieces)), []) == want
        assert all(len(x[0]) == 50 for k, x in pieces.items() if k < len(pieces) - 1)
    assert len(got[3][0]) == 2


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_packing_is_gapless_and_close_to_the_bound(spark, seed):
    pick = random.Random(seed)
    sizes = [pick.choice([1, 7, 300, 1000, 1025, 2048, pick.randint(1, 2048)]) for _ in range(3000)] + [2048] * 500
    table = spark.createDataFrame([(i, n, "x") for i, n in enumerate(sizes)], "id long, length long, sequence_id string")
    rows = packing.pack(table).collect()
    assert sorted(r.id for r in rows) == list(range(len(sizes)))
    bound = max(-(-sum(sizes) // 2048), sum(n > 1024 for n in sizes))
    assert check_packing(rows, 2048) <= 1.02 * bound + 1


def test_packing_of_nothing_and_of_one_hot_length(spark):
    empty = spark.createDataFrame([], "id long, length long")
    assert packing.pack(empty).count() == 0
    rows = packing.pack(spark.range(5000).select("id", F.lit(700).cast("long").alias("length"))).collect()
    assert check_packing(rows, 2048) == 2500
    with pytest.raises(ValueError):
        packing.pack(spark.range(1).select("id", F.lit(0).cast("long").alias("length")))


def test_pricing_finds_the_best_pattern():
    pick = random.Random(4)
    for _ in range(30):
        lengths = np.array(sorted(pick.sample(range(1, 30), 5)))
        weights = np.array([pick.random() for _ in lengths])
        best = np.zeros(41)
        for room in range(1, 41):
            best[room] = max([best[room - 1]] + [best[room - n] + w for n, w in zip(lengths, weights) if n <= room])
        by_length = np.full(41, -np.inf)
        by_length[lengths] = weights
        most, last = packing.price(by_length, 40)
        assert most == pytest.approx(best[40])
        for length in lengths.tolist():
            pattern = packing.pattern_with(length, last, 40)
            assert pattern[length] >= 1 and sum(x * n for x, n in pattern.items()) <= 40
            weight = sum(by_length[x] * n for x, n in pattern.items())
            assert weight == pytest.approx(best[40 - length] + by_length[length])


def histogram(sizes):
    lengths, counts = np.unique(np.array(sizes), return_counts=True)
    return lengths, counts


@pytest.mark.parametrize("seed", [1, 2])
def test_program_covers_every_length_within_its_gap(seed):
    rng = np.random.default_rng(seed)
    sizes = np.clip(np.exp(rng.normal(6.3, 0.9, 5000)).astype(int), 1, 2048)
    lengths, counts = histogram(sizes)
    used, gap = packing.program(lengths, counts.astype(float), 2048)
    covered = dict.fromkeys(lengths.tolist(), 0.0)
    for pattern, amount in used.items():
        assert amount > 0 and sum(x * n for x, n in pattern) <= 2048
        for x, n in pattern:
            covered[x] += n * amount
    assert gap <= packing.EPSILON
    assert sum(used.values()) <= (1 + packing.EPSILON) * max(sizes.sum() / 2048, packing.size_bound(lengths, counts, 2048))
    for x, n in zip(lengths.tolist(), counts.tolist()):
        assert covered[x] == pytest.approx(n, rel=1e-6)


@pytest.mark.parametrize("sizes", [[1500] * 400, [1500] * 400 + [300] * 200, list(range(900, 1500)) * 3, [3], [2048] * 7 + [1]])
def test_program_of_pieces_that_fit_badly(sizes):
    lengths, counts = histogram(sizes)
    used, gap = packing.program(lengths, counts.astype(float), 2048)
    assert gap <= packing.EPSILON or sum(used.values()) < packing.size_bound(lengths, counts, 2048) + 1
    plan = packing.configurations(lengths, counts, 2048)
    placed = {}
    for pattern, times in plan:
        assert sum(x * n for x, n in pattern.items()) <= 2048
        for x, n in pattern.items():
            placed[x] = placed.get(x, 0) + n * times
    assert placed == dict(zip(lengths.tolist(), counts.tolist()))
    assert sum(times for _, times in plan) <= 1.01 * packing.size_bound(lengths, counts, 2048) + 2


def test_program_places_nine_tenths_of_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    pieces = packing.tokenize(docs, tokenizer_path("word_bpe_49k.json")).groupBy("length").count().collect()
    lengths, counts = (np.array(x, dtype=np.int64) for x in zip(*sorted(map(tuple, pieces))))
    plan, left = packing.planned(lengths, counts, 2048)
    assert left.sum() <= 0.1 * counts.sum()
    sequences = sum(times for _, times in plan + packing.best_fit(lengths, left, 2048))
    assert sequences <= -(-int((lengths * counts).sum()) // 2048) * 1.001 + 1
    print("sequences", sequences, "best fit alone", sum(times for _, times in packing.best_fit(lengths, counts, 2048)))


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, 5, "x") for r in rows],
                                 "vec_id long, embedding array<float>, label int, n long, component_id string")


def test_embedding_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CHUNK", 16)
    make = np.random.default_rng(7)
    base = make.standard_normal((40, 24)).astype(np.float32)
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(base)]
    for i in range(120):  # near copies around and beside the threshold
        v = base[i % 3] + make.standard_normal(24).astype(np.float32) * 0.02 * (i % 12)
        rows.append((100 + i, v.tolist(), (i % 3) % 2))
    rows += [(300, rows[0][1], 0), (301, rows[0][1], 0), (302, [2 * x for x in rows[0][1]], 0), (303, rows[0][1], 1),
             (304, rows[0][1], None), (305, None, 0), (306, [0.0] * 24, 0), (307, [math.nan] * 24, 0),
             (308, [None] + rows[0][1][1:], 0), (309, [math.inf] + rows[0][1][1:], 0), (310, [], 0), (311, rows[0][1][:5], 0)]
    good = {}
    for i, v, label in rows:
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = (np.array(v, dtype=np.float32).astype(float), label)
    links, parent = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, la) in good.items():
        for j, (b, lb) in good.items():
            if i < j and la == lb and len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= 0.98:
                links[i] += 1
                links[j] += 1
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    found = embedding_dedup.near_duplicates(vectors_of(spark, rows))
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found.collect()} == {
        i: (links[i], root(i), root(i) == i) for i in links}
    assert embedding_dedup.near_duplicates(vectors_of(spark, [])).count() == 0


def test_plan_misses_as_little_as_asked():
    for classes in (1, 100, 10**5, 10**10):
        bits, tables = embedding_dedup.plan(classes, 0.98, 1e-6)
        assert (1 - (1 - math.acos(0.98) / math.pi) ** bits) ** tables <= 1e-6 * 1.0001


def prose(pick, n=60):
    return " ".join(pick.choice(["the", "river", "ran", "under", "old", "stone", "bridges,", "and", "lights.", "Boats"]) for _ in range(n))


def test_quality_ranks_held_out_documents(spark):
    pick, rows, labels = random.Random(8), [], []
    for i in range(400):
        good = i % 4 != 0
        text = prose(pick) if good else pick.choice(
            [" ".join(w + "$$$" for w in prose(pick).split()), prose(pick).upper() + "!!", "buy now " * 40, " | ".join(prose(pick).split())])
        rows.append((i, text))
        labels.append((i, int(good)))
    rows += [(500, None), (501, ""), (0, rows[0][1]), (None, "null id"), (502, "word " * 30_000)]
    marks = spark.createDataFrame(labels + [(None, 1), (999, 0), (3, 1), (7, None)], "doc_id long, quality int")
    docs = docs_of(spark, rows)
    model = quality.fit(docs, marks)
    scored = quality.score(docs, model)
    assert scored.count() == len(rows) and sorted(scored.columns) == sorted(docs.columns)
    for r in scored.where("doc_id < 400").collect():
        assert 0 <= r.score <= 1
        if zlib.crc32(str(r.doc_id).encode()) % 4 == 2:
            assert (r.score >= quality.THRESHOLD) == (r.doc_id % 4 != 0)
    none = quality.fit(docs, marks.where("quality = 1"))
    assert {r.score for r in quality.score(docs, none).collect()} == {quality.THRESHOLD}
    assert quality.score(docs.limit(0), model).count() == 0


def test_quality_rejects_the_share_of_bad_labels_beyond_the_sample(spark):
    pick, rows, labels = random.Random(13), [], []
    for i in range(600):  # classes overlap: the texts say little about the label
        good = pick.random() < 0.85
        rows.append((i, prose(pick, pick.randint(20, 90)) + " !" * pick.randint(0, 6 if good else 8)))
        labels.append((i, int(good)))
    docs = docs_of(spark, rows)
    scored = quality.score(docs, quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"), most=30)).collect()
    marks = {i: good for i, good in labels if zlib.crc32(str(i).encode()) % 4 != 2}
    rejected = sum(r.score < quality.THRESHOLD for r in scored if r.doc_id in marks)
    assert rejected == sum(not good for good in marks.values())


def segments_brute(values):
    """All maximal segments: split at the best segment (leftmost, shortest), then left and right."""
    best = None
    for i in range(len(values)):
        for j in range(i, len(values)):
            s = sum(values[i:j + 1])
            if s > 0 and (best is None or s > best[2] + 1e-12 or abs(s - best[2]) <= 1e-12 and j - i < best[1] - best[0]):
                best = (i, j, s)
    if best is None:
        return []
    i, j, s = best
    return segments_brute(values[:i]) + [best] + [(a + j + 1, b + j + 1, x) for a, b, x in segments_brute(values[j + 1:])]


def test_maximal_segments_equal_recursive_definition():
    pick = random.Random(9)
    for _ in range(300):
        values = [pick.choice([-1.7, -0.93, -0.31, 0.57, 1.21, 2.09]) + pick.random() / 100 for _ in range(pick.randint(0, 14))]
        got = toxicity.maximal_segments(values)
        want = segments_brute(values)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want], values
        assert [s for _, _, s in got] == pytest.approx([s for _, _, s in want])


def test_toxicity_finds_passages_in_held_out_documents(spark):
    pick, rows, labels = random.Random(10), [], []
    bad = ["idiot", "scum", "moron", "trash"]
    for i in range(400):
        words = prose(pick).split()
        if i % 4 == 0:
            for _ in range(3):
                words.insert(pick.randint(10, 30), pick.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    rows += [(500, None), (501, ""), (0, rows[0][1]), (None, "null id"), (502, prose(pick, 20_000))]
    marks = spark.createDataFrame(labels + [(None, 1), (999, 0), (3, 0)], "doc_id long, toxic int")
    docs = docs_of(spark, rows)
    scored = toxicity.score(docs, toxicity.fit(docs, marks))
    got = scored.collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None and r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2:
            assert (r.score >= toxicity.THRESHOLD) == (r.doc_id % 4 == 0)
            words = re.findall("[a-z]+", r.text.lower())
            marked = {k for p in r.passages for k in range(p.first_word, p.last_word + 1)}
            assert all(k in marked for k, w in enumerate(words) if w in bad)
        elif r.doc_id in (500, 501, 502, None):
            assert r.score < toxicity.THRESHOLD
    none = toxicity.fit(docs, marks.where("toxic = 0"))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), none).count() == 0


def test_toxicity_cut_is_best_over_all_labelled_rows(spark):
    pick, rows, labels = random.Random(14), [], []
    for i in range(1000):
        bad = i % 10 == 0
        words = prose(pick, 40).split()
        number = pick.choice([1, 1, 2, 3]) if bad else int(pick.random() < 0.2)
        rows.append((i, " ".join(words + ["idiot"] * number)))
        labels.append((i, int(bad)))
    docs = docs_of(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), most=60)
    marks = {i: bad for i, bad in labels if zlib.crc32(str(i).encode()) % 4 != 2}
    judged = [(r.score, marks[r.doc_id]) for r in toxicity.score(docs, model).collect() if r.doc_id in marks]
    toxic = sum(marks.values())

    def f1(cut):
        called = [bad for score, bad in judged if score >= cut]
        return 2 * sum(called) / (len(called) + toxic)

    assert f1(toxicity.THRESHOLD) == max(f1(score) for score, _ in judged)


MESSAGES = ("conv_id long, turn long, kind string, call_id string, name string, arguments string, "
            "depends_on array<string>, content string, level string, first string")
SCHEMA = {"type": "object", "required": ["q"], "additionalProperties": False,
          "properties": {"q": {"type": "string", "minLength": 1}, "k": {"type": "integer", "minimum": 1, "maximum": 9},
                         "in": {"enum": ["a", "b"]}, "l": {"type": "array", "items": {"type": ["number", "null"]}}}}


def test_tool_calls_are_linked_ordered_and_checked(spark):
    call = lambda i, arguments, needs=(), name="find", turn=1: (
        1, turn, "call", i, name, arguments, list(needs), None, "x", "y")
    answer = lambda i, text, turn=2: (1, turn, "result", i, None, None, None, text, "x", "y")
    rows = [
        call("a", '{"q":"é","k":2}'), answer("a", "first"), answer("a", "second", 5),
        call("b", '{"k":12,"q":""}', ["a", "missing", None]), call("c", '{"q":"x","in":"z","extra":1}', ["b", "a"]),
        call("d", "not json", ["e"]), call("e", None, ["d"]), call("f", '{"q": 1e999}', ["d"]), answer("g", None),
        call(None, '{"q":"x"}'), answer(None, "lost"), call("h", '{"l":[1,null,"x"],"q":"x"}', name="none"),
        call("i", '{"q":"late"}', turn=9), call("i", '{"q":"early"}', turn=4), call("j", '{"l":[1,null,"x"],"q":"x"}'), call("k", "[1]"),
        (None, None, "other", None, None, None, None, None, None, None)]
    got = tool_calls.link(spark.createDataFrame(rows, MESSAGES), {"find": SCHEMA}).collect()
    by = {r.call_id: r for r in got}
    assert len(got) == 12 + 1 and sum(r.status == "no id" for r in got) == 2
    assert {k: (r.status, r.level) for k, r in by.items() if k} == {
        "a": ("linked", 0), "b": ("unanswered", 1), "c": ("unanswered", 2), "d": ("cyclic", None), "e": ("cyclic", None),
        "f": ("cyclic", None), "g": ("orphan", None), "h": ("unanswered", 0), "i": ("unanswered", 0),
        "j": ("unanswered", 0), "k": ("unanswered", 0)}
    assert by["a"].json == '{"arguments":{"k":2,"q":"é"},"depends_on":[],"id":"a","name":"find","result":["first","second"]}'
    assert (by["a"].n_results, by["i"].n_calls, json.loads(by["i"].json)["arguments"]["q"]) == (2, 2, "early")
    assert by["a"].valid and by["b"].errors == ["$.k: more than 9", "$.q: shorter than 1"]
    assert by["c"].errors == ["$.extra: unknown", "$.in: not one of the allowed values"]
    assert by["d"].errors == by["e"].errors == by["f"].errors == ["$: not JSON"]
    assert by["h"].errors == ["no tool named none"] and by["j"].errors == ["$.l[2]: not of type number or null"]
    assert by["k"].errors == ["$: not of type object"]
    assert tool_calls.link(spark.createDataFrame([], MESSAGES), {}).count() == 0


def test_identifiers_belong_to_their_conversation(spark):
    rows = [r for conv in (1, 2, None) for r in (
        (conv, 1, "call", "call_1", "find", '{"q":"x"}', ["call_0", "call_2"], None, "x", 1),
        (conv, 3, "call", "call_2", "find", '{"q":"y"}', None, None, "x", 1),
        (conv, 4, "result", "call_1", None, None, None, f"b {conv}", "x", 1), (conv, 2, "result", "call_1", None, None, None, f"a {conv}", "x", 1))]
    rows += [(1, 0, "call", "call_0", "find", '{"q":"z"}', None, None, "x", 1)]
    got = {(r.conv_id, r.call_id): r for r in tool_calls.link(spark.createDataFrame(rows, MESSAGES), {"find": SCHEMA}).collect()}
    assert len(got) == 7
    for conv in (1, 2, None):
        r = got[conv, "call_1"]
        assert (r.level, r.n_calls, r.n_results, r.status) == (1, 1, 2, "linked")
        assert json.loads(r.json)["result"] == [f"a {conv}", f"b {conv}"]


def link_brute(messages):
    """Status, level and results of every identifier of every conversation."""
    late = 1 << 63
    out, convs = {}, {}
    for conv, turn, kind, call_id, *_, needs, content, _, _ in messages:
        if call_id is not None and kind in ("call", "result"):
            of = convs.setdefault(conv, {}).setdefault(call_id, {"call": [], "result": []})
            of[kind].append((late if turn is None else turn, needs if kind == "call" else content))
    for conv, found in convs.items():
        needs = {c: {n for n in (min(x["call"], key=lambda m: m[0])[1] or []) if n in found and found[n]["call"]}
                 for c, x in found.items() if x["call"]}
        level = {}
        while True:
            ready = {c: 1 + max((level[n] for n in ns), default=-1) for c, ns in needs.items() if c not in level and ns <= level.keys()}
            if not ready:
                break
            level |= ready
        for c, x in found.items():
            status = ("orphan" if not x["call"] else "cyclic" if c not in level else "linked" if x["result"] else "unanswered")
            out[conv, c] = (status, level.get(c), len(x["call"]), len(x["result"]), sorted(t for _, t in x["result"]))
    return out


@pytest.mark.parametrize("block", [50_000, 3])
def test_linking_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(tool_calls, "BLOCK", block)
    monkeypatch.setattr(tool_calls, "TURNS", 4 * block)
    pick, rows = random.Random(17), []
    for conv in (1, 2, 3, None):
        for turn in range(25):
            needs = [f"c{pick.randrange(30)}" for _ in range(pick.randint(0, 2))]
            if pick.random() < 0.7:
                needs = [n for n in needs if int(n[1:]) < turn]
            rows.append((conv, turn, "call", f"c{turn}", "find", '{"q":"x"}', needs, None, "x", 1))
            if pick.random() < 0.7:
                rows += [(conv, turn, "result", f"c{pick.randrange(30)}", None, None, None, f"r{turn}", "x", 1)] * pick.randint(1, 2)
    rows += [(3, 99, "call", "c4", "find", "{}", ["c3"], None, "x", 1)]
    got = {}
    for r in tool_calls.link(spark.createDataFrame(rows, MESSAGES), {"find": SCHEMA}).collect():
        said = json.loads(r.json)["result"]
        said = said if isinstance(said, list) else [said] if r.n_results else []
        got[r.conv_id, r.call_id] = (r.status, r.level, r.n_calls, r.n_results, sorted(said))
    assert got == link_brute(rows)


def test_a_ladder_of_ten_thousand_calls(spark):
    calls = spark.range(10_000).select(
        F.col("id").cast("string").alias("call_id"), F.filter(F.array(
            F.when(F.col("id") > 0, F.col("id") - 1), F.when(F.col("id") > 1, F.col("id") - 2)),
            lambda x: x.isNotNull()).cast("array<string>").alias("depends_on"))
    assert {int(r.call_id): r.level for r in tool_calls.levels(calls).collect()} == {i: i for i in range(10_000)}


def test_levels_of_chains_stars_and_graphs(spark):
    pick = random.Random(11)
    needs = {str(i): [str(i - 1)] if i else [] for i in range(70)}
    needs |= {f"s{i}": ["0"] for i in range(20)}
    needs |= {f"g{i}": [f"g{pick.randrange(i)}" for _ in range(pick.randint(0, 3))] if i else [] for i in range(40)}
    needs |= {"x": ["y"], "y": ["z"], "z": ["x"], "w": ["z"], "v": ["w", "0"], "self": ["self"], "u": ["v"], "gone": ["no such"]}
    want = {}

    def level(call, path=()):
        if call in path:
            return None
        if call not in want:
            found = [level(n, (*path, call)) for n in set(needs[call]) if n in needs]
            if None in found:
                return None
            want[call] = 1 + max(found) if found else 0
        return want[call]

    for call in needs:
        level(call)
    calls = spark.createDataFrame(list(needs.items()), "call_id string, depends_on array<string>")
    assert {r.call_id: r.level for r in tool_calls.levels(calls).collect()} == want


URLS = ["http://example.com/en/x", "https://WWW.Example.com/en/", "http://www.example.com/en", "http://a.b.net/es/1?x", "http://net/fr/",
        "http://notexample.com/en/", "http://example.com", "no scheme", "", None, "x://y://z.com/", "http://cheap-pills.org/", "ftp://é.com/%",
        "http://a.org/q?PHPSESSID=1", "http://a.org/feed/rss2.xml", "http://a.net/ES/", "http://a.com:80/en/", "http://acom/",
        "http://com/", "http:///com/", "http://x.com/\nen"] + ["http://hot.example.com/en/1"] * 30


def judge_brute(url):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = lower(re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    best = max(((len(h + p), h + p, v) for h, p, v in url_rules.HOST_RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)), default=(0, None, None))
    listed = any(re.search(".*".join(map(re.escape, t.lower().split("*"))), (url or "").lower(), re.S) for t in url_rules.TEXT_RULES)
    return host, path, best[1], best[2] or ("block" if listed else "allow")


@pytest.mark.parametrize("broadcast_rules", [50_000, 0])
def test_url_rules_equal_brute_force(spark, broadcast_rules):
    pages = spark.createDataFrame([(i % 40, u, "x", 1) for i, u in enumerate(URLS)], "page_id long, url string, rule string, token int")
    rules = url_rules.rules_of(spark)
    got = sorted(tuple(map(str, r)) for r in url_rules.judge(pages, rules, broadcast_rules=broadcast_rules).collect())
    assert got == sorted(tuple(map(str, (i % 40, *judge_brute(u)))) for i, u in enumerate(URLS))
    assert url_rules.judge(pages.limit(0), rules).count() == 0
    tokens = pages.select(url_rules.tokens_of(F.coalesce("url", F.lit(""))).alias("tokens"))
    filed = {r.rule: r.token for r in url_rules.index_of(rules, tokens).collect()}
    assert filed["com/"] == "com" and filed["example.com/en/"] in ("example", "en") and filed["net/fr/"] in ("net", "fr")
    assert [rule for rule, token in filed.items() if not token] == ["xxx-"]
