"""Decontamination, SimHash, licenses and the language model against brute force."""

from __future__ import annotations

import collections
import math
import random
import re
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from folioloom.llm import common, decontaminate, licenses, ngram_lm, simhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, n_words string, places int, label int"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def texts(n, seed, vocabulary=30):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["É", "straße", "İx", "K"]
    return [" ".join(pick.choice(words) for _ in range(pick.randint(0, 60))) for _ in range(n)]


def docs_of(spark, rows):
    """Documents with extra columns whose names clash with results and inner names."""
    return spark.createDataFrame([(i, t, "extra", 7, 1) for i, t in rows], DOCS)


def windows_brute(rows, items, size=13):
    found = {}
    for item, text in items:
        words = WORD.findall(low(text))
        for k in range(max(1, len(words) - size + 1) if words else 0):
            found.setdefault(tuple(words[k:k + size]), set()).add(item)
    out = []
    for doc, text in rows:
        words, hit, owners = WORD.findall(low(text)), set(), set()
        for window, names in found.items():
            for k in range(len(words) - len(window) + 1):
                if tuple(words[k:k + len(window)]) == window:
                    hit.update(range(k, k + len(window)))
                    owners |= names
        out.append((doc, len(words), len(hit), sorted(str(x) for x in owners if x is not None),
                    len(hit) > 0 and 20 * len(hit) >= len(words)))
    return out


@pytest.mark.parametrize("segment, salts", [(4096, 16), (2, 1)])
def test_decontamination_equals_brute_force(spark, monkeypatch, segment, salts):
    monkeypatch.setattr(decontaminate, "SEGMENT", segment)
    monkeypatch.setattr(decontaminate, "SALTS", salts)
    base = texts(12, 1)
    items = [(1, base[0]), (2, "w1, W2"), (3, None), (4, ""), (5, base[1]), (5, base[1]), (None, "w3 w3 w3"), (6, "ÉW1 É")]
    rows = list(enumerate(base)) + [(90, None), (91, ""), (92, " .!"), (0, base[0]), (None, base[0]),
                                    (93, "x " * 3000 + base[0] + " y" * 5000), (94, "w2 " + base[1].upper())]
    found = decontaminate.decontaminate(
        docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in found.collect()]
    key = lambda r: (r[0] is None, str(r))
    assert sorted(got, key=key) == sorted(windows_brute(rows, items), key=key)
    assert found.columns.count("n_words") == 1


def test_decontamination_of_repetitive_texts_equals_brute_force(spark):
    """Few words, so that windows overlap, repeat and share their rarest shingles."""
    pick = random.Random(31)
    words = ["a", "b", "c"]
    items = [(i, " ".join(pick.choice(words) for _ in range(pick.choice([2, 5, 7, 13, 14, 20, 45])))) for i in range(25)]
    rows = []
    for i in range(60):
        text = [pick.choice(words) for _ in range(pick.randint(0, 60))]
        for _ in range(pick.randint(0, 3)):
            item = pick.choice(items)[1].split()
            lo = pick.randrange(len(item))
            at = pick.randint(0, len(text))
            text[at:at] = item[lo:lo + pick.randint(1, 30)]
        rows.append((i, " ".join(text)))
    found = decontaminate.decontaminate(docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in found.collect()}
    assert got == {r[0]: r[1:] for r in windows_brute(rows, items)}
    places = {r.doc_id: [tuple(p) for p in r.places] for r in found.collect()}
    for doc, text in rows[:20]:
        line, want = WORD.findall(low(text)), set()
        for _, item in items:
            of = WORD.findall(low(item))
            n = min(13, len(of))
            for k in range(len(of) - n + 1):
                want |= {(j, j + n) for j in range(len(line) - n + 1) if line[j:j + n] == of[k:k + n]}
        assert places[doc] == sorted(want)


def test_decontamination_of_empty_tables(spark):
    docs, items = docs_of(spark, [(1, "a b")]), spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit, r.contaminated) for r in decontaminate.decontaminate(docs, items).collect()] == [(2, 0, False)]
    none = docs_of(spark, [])
    assert decontaminate.decontaminate(none, spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0


def print_brute(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    runs = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_brute(prints, distance):
    parent = {i: i for i, _ in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(prints):
        for j, b in prints[k + 1:]:
            if (a ^ b).bit_count() <= distance and root(i) != root(j):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return {i: root(i) for i in parent}


def test_simhash_equals_brute_force(spark):
    base = texts(25, 2, 400)
    rows = list(enumerate(base + [t + " tail" for t in base[:10]] + [base[3], "", None, " \t", "one", "One two"]))
    prints = [(i, print_brute(t)) for i, t in rows]
    want = components_brute(prints, 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_groups(docs_of(spark, rows)).collect()}
    assert got == {i: (f"{p:016x}", want[i]) for i, p in prints}
    kept = [r.doc_id for r in simhash.keep_one(docs_of(spark, rows)).collect()]
    assert sorted(kept) == sorted(set(want.values()))


def test_simhash_keeps_one_of_repeated_rows_and_null_ids(spark):
    rows = [(3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (None, "q r s t u"), (None, "q r s t u"), (4, None)]
    kept = simhash.keep_one(docs_of(spark, rows))
    assert kept.columns == docs_of(spark, rows).columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [
        ("3", "a b c d"), ("4", "None"), ("None", "q r s t u")]
    assert simhash.keep_one(docs_of(spark, [])).count() == 0
    assert simhash.simhash_groups(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("distance", [0, 1, 2, 4])
def test_links_at_every_distance(spark, distance):
    pick, all_bits = random.Random(distance), set()
    for _ in range(60):
        x = pick.getrandbits(64)
        all_bits.add(x)
        for k in (1, 2, 3, 4, 5):
            y = x
            for b in pick.sample(range(64), k):
                y ^= 1 << b
            all_bits.add(y)
    signed = [x - (1 << 64) if x >> 63 else x for x in all_bits]
    got = {tuple(r) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "fingerprint long"), distance).collect()}
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= distance}


def test_components_of_long_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 500 + i) for i in range(50)] + [(9, 9), (1, 2), (2, 1), (None, 4)]
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {500 + i: 7 for i in range(50)} | {7: 7, 9: 9, 1: 1, 2: 1}
    assert got == want
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_licenses_equal_brute_force(spark):
    bits = ["under the MIT License.", "Apache License, Version 2.0", "CC BY-NC 4.0", "under the\nmit-license", "filler words here",
            "apache license version 20", "under the Kit license", "under the mİt license", "x"]
    pick = random.Random(3)
    rows = [(i, " ".join(pick.choice(bits) for _ in range(pick.randint(0, 12)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "mit"), (0, rows[0][1]), (None, bits[0]), (73, "word " * 20_000 + bits[0])]
    phrases = [(p.split(), label) for p, label in licenses.PHRASES]
    want = []
    for doc, text in rows:
        words = WORD.findall(low(text))
        hits = [(k, label) for p, label in phrases for k in range(len(words) - len(p) + 1) if words[k:k + len(p)] == p]
        places = [k for k, _ in hits]
        want.append((doc, len(words), len(hits), min(places, default=None), max(places, default=None),
                     ",".join(sorted({label for _, label in hits}))))
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
           for r in licenses.scan(docs_of(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert licenses.scan(docs_of(spark, [])).count() == 0


def test_licenses_find_changed_passages(spark):
    words = licenses.PASSAGES[0][0].split()
    changed = words[:8] + ["really"] + words[8:15] + words[16:]
    rows = [(1, "before " * 5 + " ".join(changed) + " after"), (2, " ".join(words[:6])), (3, " ".join(words)),
            (4, " ".join(sorted(words)))]
    got = {r.doc_id: (r.labels, r.n_base, r.score) for r in licenses.scan(docs_of(spark, rows)).collect()}
    assert got[1][0] == "mit" and got[1][1] == 0 and 0.6 <= got[1][2] < 1
    assert got[2] == ("", 0, 0.0) and got[3] == ("mit", 0, 1.0) and got[4] == ("", 0, 0.0)


def test_licenses_tell_templates_with_a_shared_beginning_apart(spark):
    by = "This work is licensed under a Creative Commons Attribution"
    rows = [(1, f"{by} 4.0 International License."), (2, f"{by}-ShareAlike 4.0 License."), (3, f"{by}-NonCommercial 4.0 License."),
            (4, f"{by} 4.0 License. The pictures are {by}-ShareAlike 4.0."), (5, "licensed under a Creative Commons")]
    got = {r.doc_id: r.labels for r in licenses.scan(docs_of(spark, rows)).collect()}
    assert got == {1: "cc-by", 2: "cc-by-sa", 3: "cc-by-nc", 4: "cc-by,cc-by-sa", 5: ""}


MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
       "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
       "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
       "persons to whom the Software is furnished to do so")
BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
       "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
       "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this "
       "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. ")
BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES"
ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
ISC_END = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE"


def gnu(what, name, version):
    return (f"This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name}General Public "
            f"License as published by the Free Software Foundation{version}")


def creative(kind):
    return f"This work is licensed under a Creative Commons Attribution{kind} 4.0 International License."


LICENSES = {
    MIT + ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all "
          "copies or substantial portions of the Software.": "mit",
    MIT + ". THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED": "mit-0",
    BSD + BSD_END: "bsd-2",
    BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
          "derived from this software without specific prior written permission. " + BSD_END: "bsd-3",
    ISC + ", provided that the above copyright notice and this permission notice appear in all copies. " + ISC_END: "isc",
    ISC + ". " + ISC_END: "0bsd",
    gnu("program", "", "."): "gpl",
    gnu("program", "", "; either version 2 of the License, or (at your option) any later version."): "gpl-2",
    gnu("program", "", ", either version 3 of the License, or (at your option) any later version."): "gpl-3",
    gnu("library", "Lesser ", "; either version 2.1 of the License, or (at your option) any later version."): "lgpl",
    gnu("program", "Lesser ", ", either version 3 of the License, or any later version."): "lgpl",
    gnu("program", "Affero ", ", either version 3 of the License, or (at your option) any later version."): "agpl",
    gnu("program", "Other ", ", either version 3 of the License."): "",
    creative(""): "cc-by", creative("-NoDerivatives"): "cc-by-nd", creative("-ShareAlike"): "cc-by-sa", creative("-NonCommercial"): "cc-by-nc",
    creative("-NonCommercial-ShareAlike"): "cc-by-nc-sa", creative("-NonCommercial-NoDerivatives"): "cc-by-nc-nd",
    creative("-ShareAlike") + " Pictures: " + creative("-NoDerivatives"): "cc-by-nd,cc-by-sa",
    "The person has waived all copyright and related or neighboring rights to this work": "cc0",
    "made available under the terms of the Eclipse Public License 2.0": "epl",
}


def test_licenses_of_a_family_have_their_exact_labels(spark):
    cases = list(LICENSES.items()) + [("\n * ".join(t.split()), label) for t, label in LICENSES.items()]
    cases += [("word " * 40 + t.upper() + " word" * 40, label) for t, label in LICENSES.items()]
    got = {r.doc_id: r.labels for r in licenses.scan(docs_of(spark, [(i, t) for i, (t, _) in enumerate(cases)])).collect()}
    assert {cases[i][0]: label for i, label in got.items()} == dict(cases)


def spans_brute(text):
    """Passages found, by trying every way to read the text: the votes of each template on its diagonals."""
    words, sure = WORD.findall(low(text)), []
    templates = [(t, name, (), False, True) for t, name in licenses.PHRASES] + [
        (*licenses.passage(p), False) for p in licenses.PASSAGES]
    runs_of = [licenses.runs_in(t, 3) for t, *_ in templates]
    place = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    for (t, label, must, general, phrase), runs in zip(templates, runs_of):
        votes = [(p, a, p - a) for p, run in enumerate(place) for a, r in enumerate(runs) if r == run]
        if phrase:
            for d in {v[2] for v in votes}:
                if sum(v[2] == d for v in votes) == len(runs):
                    sure.append((t, label, general, True, d, d + len(runs) + 1))
            continue
        kept = {}
        for p, a, d in votes:
            company = sum(abs(v[2] - d) <= licenses.DRIFT for v in votes)
            if p not in kept or (-company, a) < kept[p][0]:
                kept[p] = ((-company, a), a, d)
        spans, last = [], None
        for p in sorted(kept):
            _, a, d = kept[p]
            if last is None or p - last[0] > licenses.GAP or abs(d - last[1]) > licenses.DRIFT:
                spans.append([])
            spans[-1].append((p, a))
            last = (p, d)
        others = {r for (x, name, *_), rs in zip(templates, runs_of) if name != label for r in rs}
        for span in spans:
            hit = {a for _, a in span}
            musts = {i for i, r in enumerate(runs) if any(r in licenses.runs_in(m, 3) for m in must)}
            own = {i for i, r in enumerate(runs) if r not in others}
            told = musts <= hit if musts else bool(own & hit) if own else len(hit) == len(runs)
            if len(hit) / len(runs) >= licenses.VERIFIED and told:
                sure.append((t, label, general, False, span[0][0], span[-1][0] + 2))
    plain = lambda t: " " + " ".join(licenses.template_words(t)) + " "
    free = [s for s in sure if s[3] or not any(
        not h[3] and h[1] != s[1] and len(plain(s[0])) < len(plain(h[0])) and plain(s[0]) in plain(h[0])
        and s[4] <= h[5] and s[5] >= h[4] for h in sure)]
    said = {}
    for s in free:
        if not s[2] and not s[3]:
            said.setdefault(licenses.family_of(s[1]), set()).add(s[1])
    labels = {s[1] for s in free if not s[2] or s[1] in said.get(licenses.family_of(s[1]), {s[1]})}
    return ",".join(sorted(labels))


def test_license_labels_equal_brute_force(spark):
    pick, rows, known = random.Random(23), [], list(LICENSES)
    for i in range(150):
        words = " word ".join(pick.sample(known, pick.randint(1, 2))).split()
        for _ in range(pick.randint(0, 12)):
            at = pick.randrange(len(words))
            words[at:at + pick.randint(0, 2)] = [pick.choice(words)] * pick.randint(0, 2)
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.labels for r in licenses.scan(docs_of(spark, rows)).collect()}
    assert got == {i: spans_brute(t) for i, t in rows}


def test_language_model_counts_and_base_score(spark):
    base = texts(40, 5, 80)
    rows = list(enumerate(base)) + [(50, None), (51, ""), (0, base[0]), (None, "w1 only"), (52, "w1 " * 9000), (53, "İW  w2 w2")]
    train = [i is None or zlib.crc32(str(i).encode()) % 10 != 0 for i, _ in rows]
    tokens = [low(t).encode().split() + [b""] for _, t in rows]
    count = collections.Counter(w for line, use in zip(tokens, train) if use for w in line)
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), len(line), sum(count[w] > 0 for w in line), n,
                   round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in line), 6))
                  for (i, _), line in zip(rows, tokens))
    found = ngram_lm.score(docs_of(spark, rows), block_bytes=2000).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == want
    assert all(math.isfinite(r.score) and r.score <= 1e-9 for r in found)


def test_language_model_equals_direct_backoff_and_sums_to_one(spark):
    rows = list(enumerate(texts(60, 6, 12)))
    everything = F.lit(True)
    got = {r.doc_id: r.score for r in ngram_lm.score(docs_of(spark, rows), training=everything).collect()}
    lines = [low(t).encode().decode().split() + [""] for _, t in rows]
    n = sum(map(len, lines))
    grams = [collections.Counter(tuple(line[i:i + k]) for line in lines for i in range(len(line) - k + 1)) for k in (1, 2, 3)]
    kept = grams[1:]

    def discount(counts):
        ones, twos = (sum(1 for c in counts.values() if c == k) for k in (1, 2))
        return ngram_lm.discount_of(ones, twos)

    d = [discount(x) for x in grams]

    def p(word, context):
        if not context:
            return (grams[0][(word,)] - d[0]) / n if grams[0][(word,)] else d[0] * len(grams[0]) / n
        arcs = {g[-1]: c for g, c in kept[len(context) - 1].items() if g[:-1] == context}
        if not arcs:
            return p(word, context[1:])
        total = grams[len(context) - 1][context]
        if word in arcs:
            return (arcs[word] - d[len(context)]) / total
        left = 1 - sum((c - d[len(context)]) / total for c in arcs.values())
        return left / (1 - sum(p(w, context[1:]) for w in arcs)) * p(word, context[1:])

    for i, line in enumerate(lines[:25]):
        want = sum(math.log10(p(w, tuple(line[max(0, k - 2):k]))) for k, w in enumerate(line))
        assert got[i] == pytest.approx(want, rel=1e-9), i
    vocabulary = [w for (w,) in grams[0]]
    for context in ((), ("w1",), ("w1", "w2"), ("w3", "w3")):
        assert sum(p(w, context) for w in vocabulary) + p("never", context) == pytest.approx(1)


def test_language_model_without_documents_or_training(spark):
    assert ngram_lm.score(docs_of(spark, [])).count() == 0
    (row,) = ngram_lm.score(docs_of(spark, [(1, "a b")]), training=F.lit(False)).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0) and math.isfinite(row.score)


def test_language_model_keeps_ngrams_of_rare_words(spark):
    rows = list(enumerate(texts(600, 12, 4000))) + [(700, "rare pair here"), (701, "rare pair here"), (702, "rare pair there")]
    train = [zlib.crc32(str(i).encode()) % 10 != 0 for i, _ in rows]
    lines = [low(t).split() + [""] for _, t in rows]
    grams = [collections.Counter(tuple(line[i:i + k]) for line, use in zip(lines, train) if use
                                 for i in range(len(line) - k + 1)) for k in (1, 2, 3)]
    n = sum(grams[0].values())
    assert min(grams[0].values()) < 2e-4 * n  # words that a share of all tokens would leave out
    d = [ngram_lm.discount_of(*(sum(1 for c in x.values() if c == k) for k in (1, 2))) for x in grams]
    after = {}
    for x in grams[1:]:
        for g, c in x.items():
            after.setdefault(g[:-1], {})[g[-1]] = c

    def p(word, context):
        if not context:
            return (grams[0][(word,)] - d[0]) / n if grams[0][(word,)] else d[0] * len(grams[0]) / n
        arcs, total = after.get(context), grams[len(context) - 1][context]
        if not arcs:
            return p(word, context[1:])
        if word in arcs:
            return (arcs[word] - d[len(context)]) / total
        left = 1 - sum((c - d[len(context)]) / total for c in arcs.values())
        return left / (1 - sum(p(w, context[1:]) for w in arcs)) * p(word, context[1:])

    got = {r.doc_id: r.score for r in ngram_lm.score(docs_of(spark, rows), block_bytes=20_000).collect()}
    assert not all(train)
    for (i, _), line in zip(rows, lines):
        want = sum(math.log10(p(w, tuple(line[max(0, k - 2):k]))) for k, w in enumerate(line))
        assert got[i] == pytest.approx(want, rel=1e-9), i
