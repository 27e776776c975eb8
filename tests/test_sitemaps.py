from __future__ import annotations

from folioloom.operators import merge as M
from folioloom.sources import sitemaps as S
from helpers import rows

NS = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
VIDEO = 'xmlns:video="http://www.google.com/schemas/sitemap-video/1.1"'


def docs(spark, *pairs):
    return spark.createDataFrame(list(pairs), "doc_url string, body string")


def test_urlset(spark):
    body = (f'<?xml version="1.0"?><urlset {NS} {VIDEO}>'
            "<url><loc>https://s/news/1</loc><lastmod>2024</lastmod></url>"
            "<url><loc>https://s/tag/x</loc></url>"
            "<url><loc></loc></url><url><lastmod>2020</lastmod></url>"
            "<url><loc>https://s/news/2</loc><lastmod></lastmod>"
            "<video:video><video:loc>https://s/v?1</video:loc>"
            "<video:publication_date>2023</video:publication_date></video:video>"
            "<video:video><video:loc>https://s/v/2</video:loc></video:video>"
            "<video:video><video:title>no place</video:title></video:video></url></urlset>")
    d = docs(spark, ("a", body), ("cut", body[:-30]), ("junk", "hello"), ("null", None),
             ("empty", f"<urlset {NS}></urlset>"))
    assert rows(S.urlset_entries(d), "pos") == [
        ("a", 0, "https://s/news/1", "2024"), ("a", 4, "https://s/news/2", None)]
    assert rows(S.video_entries(d), "pos") == [
        ("a", 5, "https://s/v?1", "2023"), ("a", 6, "https://s/v/2", None)]


def test_namespaces_count_and_prefixes_do_not(spark):
    loc = "<{0}loc>https://s/news/{1}</{0}loc>"
    other = 'xmlns:image="http://www.google.com/schemas/sitemap-image/1.1"'
    d = docs(
        spark,
        ("prefixed", f'<sm:urlset xmlns:sm="{S.SITEMAP}"><sm:url>{loc.format("sm:", 1)}</sm:url></sm:urlset>'),
        ("image", f"<urlset {NS} {other}><url>{loc.format('image:', 2)}{loc.format('', 3)}</url></urlset>"),
        ("none", f"<urlset><url>{loc.format('', 4)}</url></urlset>"),
        ("first", f"<urlset {NS}><url>{loc.format('', 5)}{loc.format('', 6)}</url></urlset>"),
        ("inner", f"<urlset {NS}><url><loc>https://s/news/7<b>x</b>y</loc></url></urlset>"),
        ("deeper", f"<urlset {NS}><x><url><y>{loc.format('', 8)}</y>{loc.format('', 9)}</url></x></urlset>"),
        ("text", f"<urlset {NS}><url><loc><![CDATA[https://s/news/1-a&]]>b&amp;c<!-- no --></loc></url></urlset>"))
    assert rows(S.urlset_entries(d).select("doc_url", "url"), "doc_url") == [
        ("deeper", "https://s/news/9"), ("first", "https://s/news/5"), ("image", "https://s/news/3"),
        ("inner", "https://s/news/7"), ("prefixed", "https://s/news/1"), ("text", "https://s/news/1-a&b&c")]


def test_documents_that_are_not_one_well_formed_root(spark):
    good = f"<urlset {NS}><url><loc>https://s/news/1</loc></url></urlset>"
    bad = (good + "junk>", good + "<x/>", good + good, good + "x", "x" + good, good[:-1], good.replace("</loc>", ""),
           good.replace("1<", "&nope;<"), good.replace("xmlns", "xmlns:a"), good.replace("<url>", "<b:url>"), "", " ")
    assert S.urlset_entries(docs(spark, *[(str(i), b) for i, b in enumerate(bad)])).count() == 0
    fine = (good + " \n", good + "<!-- end -->", '<?xml version="1.0"?>\n<!DOCTYPE urlset>' + good, "\ufeff" + good)
    assert S.urlset_entries(docs(spark, *[(str(i), b) for i, b in enumerate(fine)])).count() == len(fine)
    bomb = '<!DOCTYPE u [<!ENTITY a "' + "x" * 1000 + '">' + "".join(
        f'<!ENTITY a{i} "{("&a" + (str(i - 1) if i else "") + ";") * 50}">' for i in range(6)) + "]>"
    assert S.urlset_entries(docs(spark, ("bomb", bomb + good.replace("1<", "&a5;<")))).count() == 0


def test_expand_skips_missing_and_reads_a_plain_index(spark):
    child = f"<urlset {NS}><url><loc>https://s/news/{{}}</loc></url></urlset>"
    index = (f"<sitemapindex {NS}><sitemap><loc>b</loc></sitemap>"
             "<sitemap><loc>gone</loc></sitemap><sitemap><loc>a</loc></sitemap>"
             "<sitemap><loc>b</loc></sitemap></sitemapindex>")
    d = docs(spark, ("a", child.format(1)), ("b", child.format(2)), ("other", child.format(3)))
    idx = docs(spark, ("idx", index), ("flat", child.format(9)), ("bad", "<x"))
    assert rows(S.index_children(idx), "sitemap_no") == [
        ("idx", 0, "b"), ("idx", 1, "gone"), ("idx", 2, "a"), ("idx", 3, "b")]
    assert rows(S.expand_sitemaps(d, idx), "index_url", "sitemap_no") == [
        ("flat", 0, "flat", 0, "https://s/news/9", None),
        ("idx", 0, "b", 0, "https://s/news/2", None),
        ("idx", 2, "a", 0, "https://s/news/1", None),
        ("idx", 3, "b", 0, "https://s/news/2", None)]


def test_repeated_listings_do_not_change_the_merge(spark):
    """One sitemap makes up a third of all listings."""
    def child(*entries):
        return f"<urlset {NS}>" + "".join(
            f"<url><loc>https://s/news/{u}</loc><lastmod>{m}</lastmod></url>" for u, m in entries
        ) + "</urlset>"

    d = docs(spark, ("hot", child((1, "9"), (2, "9"))), ("x", child((1, "5"), (3, "5"))),
             ("y", child((2, "4"), (3, ""))), ("z", child((3, "1"))))
    order = (["hot", "x", "hot", "y", "z", "hot"] * 40) + ["x"]
    idx = docs(spark, *[(f"idx{k}", f"<sitemapindex {NS}>" + "".join(
        f"<sitemap><loc>{u}</loc></sitemap>" for u in order[k:]) + "</sitemapindex>") for k in range(3)])
    news = spark.createDataFrame([], "url string, lastmod string")
    every, last = (M.merge_entries(S.expand_sitemaps(d, idx, keep_repeats=k), news) for k in (True, False))
    assert rows(every, "url") == rows(last, "url")
    assert S.expand_sitemaps(d, idx, keep_repeats=False).count() == 7


def merged(spark, main, news):
    m = spark.createDataFrame([(u, l, i) for i, (u, l) in enumerate(main)],
                              "url string, lastmod string, pos bigint")
    n = spark.createDataFrame(news, "url string, lastmod string")
    return dict(rows(M.merge_entries(m, n, ("pos",))))


def test_merge_rules(spark):
    assert merged(spark, [("a", "2024"), ("a", None)], []) == {"a": None}
    assert merged(spark, [("a", None), ("a", "2020")], []) == {"a": "2020"}
    assert merged(spark, [("a", None)], [("a", "2024")]) == {"a": "2024"}
    assert merged(spark, [("a", "2024")], [("a", "2023"), ("a", None)]) == {"a": "2024"}
    assert merged(spark, [("a", "2024")], [("a", "2024-01")]) == {"a": "2024-01"}
    assert merged(spark, [], [("b", None), ("b", "1"), ("b", None)]) == {"b": "1"}


def test_merge_with_a_hot_url_equals_a_loop(spark):
    """A third of all rows share one URL; the partial aggregates absorb it."""
    main = [("hot" if i % 3 == 0 else f"u{i % 97}", None if i % 7 == 0 else f"{i % 41:02d}")
            for i in range(6000)]
    news = [("hot" if i % 3 == 1 else f"u{i % 131}", None if i % 5 == 0 else f"{i % 37:02d}")
            for i in range(6000)]
    want = dict(main)
    for url, lastmod in news:
        old = want.setdefault(url, None)
        if lastmod and (old is None or lastmod > old):
            want[url] = lastmod
    assert merged(spark, main, news) == want


def test_counts(spark):
    main = spark.createDataFrame([("a",), ("a",), ("b",)], "url string")
    news = spark.createDataFrame([("b",), ("c",)], "url string")
    state = spark.createDataFrame([("a",), ("z",)], "url string")
    assert rows(M.source_counts(main, news, state)) == [(3, 2, 3, 2)]
    assert rows(M.unique_urls(main, news)) == [(3,)]
    empty = main.where("false")
    assert rows(M.source_counts(empty, empty, state)) == [(0, 0, 0, 2)]


def test_documents_are_read_whole_or_not_at_all(spark):
    from folioloom.sources import sitemaps
    page = "<url><loc>https://s/news/{}</loc></url>"
    bodies = {
        "good": f"<urlset {NS}>{page.format(1)}</urlset>\n",
        "entity": f"<urlset {NS}>{page.format(1)}<url><loc>https://s/news/&undefined;</loc></url>{page.format(3)}</urlset>",
        "tail": f"<urlset {NS}>{page.format(1)}</urlset>garbage<",
        "words": f"<urlset {NS}>{page.format(1)}</urlset>garbage",
        "cut": f"<urlset {NS}>{page.format(1)}<url><loc>https://s/ne",
        "null": None}
    docs = spark.createDataFrame(list(bodies.items()), "doc_url string, body string")
    assert [r.doc_url for r in sitemaps.urlset_entries(docs).collect()] == ["good"]


def test_the_first_of_several_elements_counts(spark):
    from folioloom.sources import sitemaps
    body = (f"<urlset {NS} xmlns:image='i'><url><loc>https://s/news/1</loc><loc>https://s/news/2</loc><image:loc>https://s/news/3</image:loc>"
            "<lastmod><b>2024</b></lastmod></url><url><lastmod>2024</lastmod><loc>https://s/news/4</loc></url></urlset>")
    docs = spark.createDataFrame([("d", body)], "doc_url string, body string")
    assert [(r.url, r.lastmod) for r in sitemaps.urlset_entries(docs).collect()] == [
        ("https://s/news/1", None), ("https://s/news/4", "2024")]


def test_a_task_holds_few_documents_at_a_time(spark, monkeypatch):
    """A batch of many documents is handed on in parts; nulls and broken documents keep their places."""
    import pyarrow as pa
    body = f"<urlset {NS}>" + "".join(f"<url><loc>https://s/news/{i}</loc></url>" for i in range(500)) + "</urlset>"
    bodies = [None if i % 7 == 3 else "<x" if i % 7 == 5 else body for i in range(400)] + [None] * 30
    parts = list(S.read_batches(iter([pa.array(bodies, pa.string()), pa.array([], pa.string()), pa.array(["<x"])])))
    assert max(sum(len(d["entries"]) for d in p.to_pylist() if d) for p in parts) <= S.BATCH_ELEMENTS + 500
    assert [d and len(d["entries"]) for p in parts for d in p.to_pylist()] == [500 if b == body else None for b in bodies] + [None]
    monkeypatch.setattr(S, "BATCH_ELEMENTS", 3)
    d = docs(spark, *[(str(i), b) for i, b in enumerate(bodies)]).coalesce(1)
    got = S.urlset_entries(d).groupBy("doc_url").count().collect()
    assert {r.doc_url: r["count"] for r in got} == {str(i): 500 for i, b in enumerate(bodies) if b == body}
