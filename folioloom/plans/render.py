"""Sitemap documents rendered from rows, for queries that parse XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from folioloom.plans.fixtures import SITE

NEWS_URL = SITE + "sitemaps/news.xml"
CHILDREN_PER_INDEX = 100

_URLSET = (
    '<?xml version="1.0" encoding="UTF-8"?>'
    '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    ' xmlns:video="http://www.google.com/schemas/sitemap-video/1.1">')
_INDEX = '<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'


def child_url(doc_no: Column) -> Column:
    return F.concat(F.lit(SITE + "sitemaps/"), doc_no.cast("string"), F.lit(".xml"))


def index_url(index_no: Column) -> Column:
    return F.concat(F.lit(SITE + "sitemaps/index-"), index_no.cast("string"), F.lit(".xml"))


def _element(name: str, value: Column) -> Column:
    return F.when(value.isNull(), "").otherwise(
        F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>")))


def _entry_xml(row: DataFrame) -> Column:
    video = F.when(F.col("video_url").isNull(), "").otherwise(F.concat(
        F.lit("<video:video>"), _element("video:loc", F.col("video_url")),
        _element("video:publication_date", F.col("video_date")), F.lit("</video:video>")))
    return F.concat(
        F.lit("<url>"), _element("loc", F.col("url")),
        _element("lastmod", F.col("lastmod")),
        video if "video_url" in row.columns else F.lit(""), F.lit("</url>"))


def render_urlsets(entries: DataFrame, doc_url: Column, order: Column) -> DataFrame:
    """One document per ``doc_no``; a document holds a bounded key range."""
    xml = F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct(order.alias("k"), _entry_xml(entries).alias("x")))),
        lambda e: e["x"]), "")
    return entries.groupBy("doc_no").agg(xml.alias("xml")).select(
        "doc_no", doc_url.alias("doc_url"),
        F.concat(F.lit(_URLSET), "xml", F.lit("</urlset>")).alias("body"))


def _replaced(body: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        body = F.replace(body, F.lit(old), F.lit(new))
    return body


def sitemap_docs(entries: DataFrame) -> DataFrame:
    """All sitemaps of ``sitemap_entry``.

    Some are cut short or go on after their root; some bind the namespace to a
    prefix; some have an image's place before the page's.
    """
    docs = render_urlsets(entries, child_url(F.col("doc_no")), F.col("entry_key"))
    body, turn = F.col("body"), F.col("doc_no") % 40
    prefixed = _replaced(
        body, ("<urlset xmlns=", "<sm:urlset xmlns:sm="), ("</urlset>", "</sm:urlset>"),
        *((f"<{end}{name}>", f"<{end}sm:{name}>") for name in ("url", "loc", "lastmod") for end in ("", "/")))
    with_images = _replaced(
        body, ("<urlset ", '<urlset xmlns:image="http://www.google.com/schemas/sitemap-image/1.1" '),
        ("<url>", "<url><image:loc>https://site.example/news/img.html</image:loc>"))
    return docs.withColumn("body", F.when(turn == 13, F.substr(body, F.lit(1), F.length(body) - 20))
                           .when(turn == 17, F.concat(body, F.lit("junk>")))
                           .when(turn == 21, F.concat(body, F.lit("<x/>")))
                           .when(turn == 29, prefixed).when(turn == 5, with_images).otherwise(body))


def gone_url(doc_no: Column) -> Column:
    return F.concat(F.lit(SITE + "sitemaps/gone-"), doc_no.cast("string"), F.lit(".xml"))


def index_docs(entries: DataFrame) -> DataFrame:
    """Index documents: every sitemap, each followed by one that is missing."""
    children = entries.select("doc_no").distinct()
    loc = F.concat(*[
        part for url in (child_url(F.col("doc_no")), gone_url(F.col("doc_no")))
        for part in (F.lit("<sitemap><loc>"), url, F.lit("</loc></sitemap>"))])
    return (
        children
        .groupBy(F.floor(F.col("doc_no") / CHILDREN_PER_INDEX).alias("index_no"))
        .agg(F.array_join(F.transform(
            F.sort_array(F.collect_list(F.struct("doc_no", loc.alias("x")))),
            lambda e: e["x"]), "").alias("xml"))
        .select(index_url(F.col("index_no")).alias("doc_url"),
                F.concat(F.lit(_INDEX), "xml", F.lit("</sitemapindex>")).alias("body")))


def news_docs(news: DataFrame) -> DataFrame:
    """The news sitemap as fetched many times, each fetch with its entries."""
    entries = news.withColumn(
        "doc_no", F.floor(F.col("batch_key") / 100))
    return render_urlsets(entries, F.lit(NEWS_URL), F.struct("batch_key", "line")) \
        .drop("doc_no")
