from __future__ import annotations


from folioloom.functions.markup import compile_rules, find_elements
from folioloom.operators import extract as X
from helpers import plan, rows

RULES = compile_rules(X.ALL_SELECTORS)


def picked(html):
    return [(sorted(e["selectors"]), html[e["start"]:e["start"] + e["length"]])
            for e in find_elements(html, RULES)]


def test_nested_and_unclosed_elements():
    html = '<div class="body"><div>in</div><p>x</div>after<main>m'
    assert picked(html) == [
        (["div.body"], '<div class="body"><div>in</div><p>x</div>'), (["main"], "<main>m")]


def test_comments_scripts_and_odd_attributes_are_skipped():
    html = ('<!-- <h1>no</h1> --><script>var a="<h1>no</h1>"</script><style>h1{}</style>'
            '<h1 data-x="a>b" CLASS=\'title  big\'>yes</h1><h1')
    assert picked(html) == [(["h1", "h1.title"], '<h1 data-x="a>b" CLASS=\'title  big\'>yes</h1>')]


def test_broken_markup_stays_linear(spark):
    """Half a megabyte of openings that never close."""
    for junk in ("<", "<a ", '<a href="', "<!--", "<script>", "<div class='x", "</p"):
        find_elements("<h1>t</h1>" + junk * (500_000 // len(junk)), RULES)
    a = extract(spark, "<h1>t</h1><article>ok" + "<b" * 250_000)
    assert a.title == "t" and a.content.startswith("ok<b<b") and len(a.content) == 500_002
    assert picked('<h1 title="a<b">x</h1><p "><h1>y</h1>') == [
        (["h1"], '<h1 title="a<b">x</h1>'), (["h1"], "<h1>y</h1>")]


def test_scopes():
    html = ('<div class="entry-header"><h1>a</h1></div><article><h1>b</h1>'
            '<div class="content x">c</div></article><nav class="breadcrumb"><a>d</a></nav>'
            '<div class="content">no</div><a>no</a>')
    assert picked(html) == [
        ([".entry-header h1", "h1"], "<h1>a</h1>"),
        (["article"], '<article><h1>b</h1><div class="content x">c</div></article>'),
        (["article h1", "h1"], "<h1>b</h1>"),
        (["article div.content"], '<div class="content x">c</div>'),
        (["nav.breadcrumb a"], "<a>d</a>")]


def test_implied_end_tags():
    html = '<ul><li class="tags">a<li class="tags">b</ul><p class="author">x<p>y'
    assert picked(html) == [
        ([".tags"], '<li class="tags">a'), ([".tags"], '<li class="tags">b'),
        ([".author"], '<p class="author">x')]


def extract(spark, html, url="https://h/ar/sport/1.html", **options):
    pages = spark.createDataFrame([(1, url, html)], "page_id int, url string, html string")
    return X.extract_articles(pages, **options).collect()[0]


def test_whole_article(spark):
    a = extract(spark, """<html><head><meta property="og:description" content=" two ">
      <meta name='description' content=''></head><body>
      <h1 class="title">plain</h1><h1 class="entry-title"> Caf&eacute; <i>&amp; co</i> </h1>
      <time class="published" datetime="2024-05-06"></time>
      <div class="author"><a rel='author'>  </a></div><b rel="author">Ann</b>
      <main>main text</main>
      <div class="article-body">one<script>s</script></div><div class="article-body">two &#39;x&#x27;</div>
      <div class="tags">t1</div><div class="tags">t1</div><div class="tag-list">""" + "z" * 100 + """</div>
      <article><img src="http://i/1"><img data-src="http://i/2"><img src="" data-src="http://i/3">
      <img src="/rel"></article></body></html>""")
    assert (a.title, a.author, a.published_date, a.description) == (
        "Café & co", "Sport", "2024-05-06", "two")     # only the first match counts
    assert a.content == "one s two x&#x27;"
    assert (a.tags, a.images) == ("t1, t1", "http://i/1,http://i/2")
    assert (a.category, a.language, a.word_count, a.error) == (None, "ar", 4, None)


def test_missing_fields(spark):
    a = extract(spark, "<p>nothing here</p>", language="fr")
    assert (a.title, a.content, a.tags, a.images, a.word_count) == (None, None, None, None, 0)
    assert (a.author, a.language) == ("Sport", "fr")
    assert extract(spark, None).error == "no readable markup"
    assert extract(spark, "").error is None


def test_title_attribute_and_src_fallback(spark):
    assert extract(spark, '<h1 title=" from title "><img></h1>').title == "from title"
    pages = spark.createDataFrame([('<article><img src="http://i/9"></article>',)], "html string")
    assert X.scan_pages(pages).select(X.first_value(X.IMAGES)).collect()[0][0] == "http://i/9"


def test_text_is_what_lies_between_tags(spark):
    def title(inner):
        return extract(spark, f'<h1 class="title">{inner}</h1>').title

    assert title('<a title="x > y">Hello there</a>') == "Hello there"
    assert title("a<!-- <b>no</b> --> b<br/>c") == "a bc"
    assert title("1 < 2<i data-x='</h1>'> and</i> 3") == "1 < 2 and 3"
    a = extract(spark, '<h1>t</h1><i class="author">A<b title="> B">nn</b> O<span class="author">x</span></i>'
                       '<span class="date" title=">">2024<i a=">">-01</i></span><p class="category">c<i x=">">d</i></p>')
    assert (a.author, a.published_date, a.category) == ("Ann Ox", "2024-01", "cd")
    assert extract(spark, '<p class="author">Ann <b').author == "Ann <b"
    assert extract(spark, '<p class="author">Ann <!-- Bob').author == "Ann"


def test_a_page_that_raises_costs_its_own_row(spark, monkeypatch):
    from folioloom.functions import markup

    find = markup.find_elements

    def fails(page, rules):
        if "BOOM" in page:
            raise RuntimeError("bad page " + "x" * 9000)
        return find(page, rules)

    monkeypatch.setattr(markup, "find_elements", fails)
    pages = spark.createDataFrame([(f"https://h/ar/a/{i}.html", f"<h1>t{i}</h1>" + ("BOOM" if i % 3 == 0 else ""))
                                   for i in range(30)] + [("https://h/x", None)], "url string, html string")
    articles = X.extract_articles(pages)
    found = {r.url: r for r in articles.collect()}
    assert len(found) == 31 and found["https://h/ar/a/1.html"].title == "t1"
    bad = found["https://h/ar/a/3.html"]
    assert bad.title is None and bad.content is None and bad.error.startswith("RuntimeError: bad page x") and len(bad.error) == 500
    assert sorted(r.pages for r in X.failed_pages(articles).collect()) == [1, 10]


def test_references(spark):
    assert extract(spark, "<h1>a&amp;b&ampc&#65;&#x42;&nope;&amp;lt;</h1>").title == "a&b&ampcAB&nope;&lt;"


def test_content_falls_through_blank_selectors(spark):
    a = extract(spark, '<div class="body"> &nbsp; </div><article>text</article>')
    assert a.content == "text"
    # Control characters are not blank: the choice is made before they go.
    assert extract(spark, '<div class="body">\x01</div><article>text</article>').content is None


def test_valid_article_bounds(spark):
    cases = [("t" * 5, "c" * 101, "u"), ("t" * 6, "c" * 100, "u"), ("t" * 6, "c" * 101, "u"),
             (" " + "t" * 5 + " ", "c" * 101, "u"), ("t" * 6, "c" * 101, ""),
             (None, "c" * 101, "u"), ("t" * 6, None, "u"), ("t" * 6, "c" * 101, None)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)],
                               "i int, title string, content string, url string")
    assert rows(X.valid_article(df).select("i")) == [(2,)]


def test_pages_are_scanned_once_and_pruned(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.createDataFrame([(1, "u", "<h1>x</h1>", "junk")],
                          "page_id int, url string, html string, other string").write.parquet(path)
    df = X.valid_article(X.extract_articles(spark.read.parquet(path))).select("url")
    text = plan(df)
    assert text.count("ArrowEvalPython") == 1
    assert "ReadSchema: struct<url:string,html:string>" in text


def test_long_pages_keep_their_end(spark):
    a = extract(spark, "<article>" + "word " * 200_000 + "last</article>")
    assert a.word_count == 200_001 and a.content.endswith("word last")


def elements(markup, *selectors):
    from folioloom.functions.markup import compile_rules, find_elements
    return [markup[e["body"]:e["start"] + e["length"]] for e in find_elements(markup, compile_rules(selectors))]


def test_long_quoted_values_do_not_hide_elements():
    for n in (900, 1_200, 200_000):
        assert elements(f'<div class="x" data-j="a<{"y" * n}>">in</div>', "div.x") == ["in</div>"]


def test_custom_elements_are_not_scripts():
    page = "<script-loader></script-loader><style-guide>a</style-guide><script>'<h1>no</h1>'</script ><h1>T</h1>"
    assert elements(page, "h1") == ["T</h1>"]


def test_unquoted_values_may_end_in_a_slash():
    assert elements("<a href=/x/>Name</a>", "a") == ["Name</a>"]
    assert elements("<a href= />Name</a>", "a") == ["Name</a>"]
    assert elements("<a/>x<a b='c'/>y<a b />z", "a") == ["", "", ""]


def test_broken_markup_is_read_in_linear_time():
    import time
    for page in ("<" * 300_000, "<a b='" * 60_000, "<a b=" * 60_000, "<script>" * 60_000, "<!--" * 60_000, "<a " * 60_000,
                 "<a =  " * 60_000 + "'"):
        start = time.perf_counter()
        elements(page + "<h1>T", "h1")
        assert time.perf_counter() - start < 2
