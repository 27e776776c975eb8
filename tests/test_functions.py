"""Text, URL and number rules on hand-made cases."""

from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from folioloom.functions import numbers as N, text as T, urls as U


def apply(spark, fn, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r.x for r in df.select("i", fn(F.col("s")).alias("x")).orderBy("i").collect()]


def test_strip_html_order_and_entities(spark):
    assert apply(
        spark, T.strip_html,
        "a&amp;lt;b", "x&#x41;y&#65;z", "&#١٢;q", "<p>one</p><p>two\n\n three</p>",
        "&nbsp;a b\u0085c\x1cd&nbsp;", "&quot;&gt;&lt;", "1 < 2", "", None,
    ) == ["a<b", "x&#x41;yz", "q", "one two three", "a b c d", '"><', "1 < 2", "", None]


def test_clean_text_deletes_control_after_collapsing(spark):
    assert apply(spark, T.clean_text, "a \x01 b", "\x00\x07", "a\x1fb", " 　x y ", None) \
        == ["a  b", "", "a b", "x y", None]


def test_word_count(spark):
    assert apply(spark, T.word_count, "a \x01 b", "a  b", "", "  ", "one", None,
                 "كلمة أخرى") == [3, 2, 0, 0, 1, 0, 2]
    assert apply(spark, lambda c: T.word_count(T.clean_text(c)), "a \x01 b") == [2]


def test_content_hash(spark):
    want = hashlib.md5("سلامxy".encode()).hexdigest()
    assert apply(spark, T.content_hash, "سلام x\n\x02y", "", None, " ") == [
        want, "", "", hashlib.md5(b"").hexdigest()]
    assert apply(spark, lambda c: T.content_hash(T.clean_text(c), cleaned=True),
                 "سلام x\n\x02y") == [want]


PY_CONTROL = "[\x00-\x08\x0b-\x0c\x0e-\x1f\x7f-\x9f]"


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.one_of(
    st.sampled_from("<>&;#ab \t\n\x0b\x1c\x85\xa0 　\x01\x7f١"),
    st.characters(blacklist_categories=("Cs",))), max_size=40), min_size=1, max_size=30))
def test_text_rules_agree_with_python(spark, values):
    def py_strip_html(s):
        s = re.sub(r"<[^>]+>", " ", s)
        for entity, char in T.ENTITIES:
            s = s.replace(entity, char)
        return re.sub(r"\s+", " ", re.sub(r"&#\d+;", "", s)).strip()

    def py_clean(s):
        return re.sub(PY_CONTROL, "", re.sub(r"\s+", " ", s)).strip()

    assert apply(spark, T.strip_html, *values) == [py_strip_html(v) for v in values]
    assert apply(spark, T.clean_text, *values) == [py_clean(v) for v in values]
    assert apply(spark, T.strip, *values) == [v.strip() for v in values]
    assert apply(spark, T.word_count, *values) == [len(v.split()) for v in values]


@pytest.mark.parametrize("url, article", [
    ("https://s/٢٠٢٤/٠١/x", True),
    ("https://s/2024/01/x", True),
    ("https://s/news/?x", False),
    ("https://s/NEWS/1", True),
    ("https://s/news/tag/a", False),
    ("https://s/about", False),
    ("https://s/feeds/news/1", False),
    ("https://s/news/1#top", False),
])
def test_article_urls(spark, url, article):
    assert apply(spark, U.is_article_url, url) == [article]


@pytest.mark.parametrize("patterns", [
    U.NON_ARTICLE_PATTERNS, U.ARTICLE_PATTERNS, ("/a|b", "/c"), ("/?x", "/y/"), ("/+z", "#"),
    (r"\.html$", "x*y"), ("^https", "/q"), ("[ab]c", r"\?"), (r"\d{2}", r"/\d"), ("b",), (),
])
def test_joined_patterns_match_as_each_alone(spark, patterns):
    urls = ["https://s/a", "b", "/c", "x", "/y/", "//z", "#", "p.html", "p.htmlx", "y", "xxy",
            "bc", "?", "12", "/٣", "https://s/news/1?", "", "https://s/feed", "/2024/05/"]
    got = apply(spark, lambda c: U.url_matches(c, patterns), *urls)
    assert got == [any(re.search(p, u) is not None for p in patterns) for u in urls]


def test_url_section(spark):
    assert apply(spark, U.url_section, "https://h/ar/sPORT news/1.html", "https://h/ar/sport",
                 "https://h/ar/a/b/c", "nothing") == ["Sport news", None, "A", None]
    assert apply(spark, lambda c: U.url_section(c, r"site\.example"),
                 "https://site.example/ar/x/1", "https://other/ar/x/1") == ["X", None]


def test_percent_and_eta(spark):
    df = spark.createDataFrame(
        [(100, 1.0), (200_000, 1.0), (0, 1.0), (5, 0.0), (86_400, 1.0), (86_399, 1.0)],
        "p bigint, r double")
    assert [r[0] for r in df.select(N.eta(F.col("p"), F.col("r"))).collect()] == [
        "~1 hours", "~3 days", "Done!", "Calculating...", "~1 days", "~24 hours"]
    df = spark.createDataFrame([(1, 3), (1, 0), (0, 7), (2, 2)], "a bigint, b bigint")
    assert [r[0] for r in df.select(N.percent(F.col("a"), F.col("b"))).collect()] == [
        33.3, 0.0, 0.0, 100.0]


def test_percent_rounds_by_the_binary_value(spark):
    from decimal import ROUND_HALF_UP, Decimal

    pairs = [(a, b) for b in (7, 16, 400, 800, 1000, 2000) for a in range(0, b + 1, 1 + b // 150)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a bigint, b bigint")
    got = [r.x for r in df.select("i", N.percent(F.col("a"), F.col("b")).alias("x")).orderBy("i").collect()]
    assert got == [float(Decimal(a / b * 100).quantize(Decimal("0.1"), ROUND_HALF_UP)) for a, b in pairs]
