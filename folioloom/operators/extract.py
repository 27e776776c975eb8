"""Pages to articles.

``scan_pages`` adds one column with the elements the selectors pick; the field
rules are column expressions over it.  Filter pages by URL before the scan:
filters do not move below it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from folioloom.functions.markup import elements_function
from folioloom.functions.text import (
    blank_to_null, drop_control, drop_tags, once, strip, strip_html, word_count)
from folioloom.functions.urls import ANY_HOST, url_section

# Selectors per field, tried in this order (fixed values).
TITLE = ("h1.article-title", "h1.entry-title", "h1.post-title", "h1.title",
         ".entry-header h1", "article h1", "h1")
AUTHOR = (".author-name", ".author", ".by-author", ".author a", "[rel='author']",
          ".post-author", ".article-author", "span.author", ".writer-name")
PUBLISHED = ("span.date", "time.entry-date", "time.published", "time.post-date",
             ".post-date", ".article-date", "time[datetime]")
CONTENT = (".content-body", "div.body", "div.article-body", "div.entry-content",
           "div.post-content", "div.article-content", "article div.content",
           "div.post-body", ".article-body", "article", "main")
CATEGORY = ("meta[property='article:section']", ".category", ".post-category",
            ".article-category", ".breadcrumbs a", "nav.breadcrumb a", ".section-name")
TAGS = (".tags", ".post-tags", ".article-tags", ".tag-list")
IMAGES = ("div.entry-content img", "article img", ".post-content img",
          ".article-body img")
DESCRIPTION = ("meta[name='description']", "meta[property='og:description']")

# Bounds of a valid article and of a tag, in characters (fixed values).
MIN_TITLE, MIN_CONTENT, MAX_TAG = 5, 100, 100
NO_MARKUP = "no readable markup"

FIRST_VALUE_SELECTORS = TITLE + AUTHOR + PUBLISHED + CATEGORY + DESCRIPTION
ALL_SELECTORS = tuple(dict.fromkeys(FIRST_VALUE_SELECTORS + CONTENT + TAGS + IMAGES))


def scan_pages(pages: DataFrame, wanted: Sequence[str] = ALL_SELECTORS) -> DataFrame:
    """``pages`` with what the wanted selectors find in them, from one scan.

    ``elements``: ``start, length, text`` (trimmed), ``value`` (the text, else
    the attribute ``content``, ``title`` or ``src``), ``datetime`` and
    ``image``.  ``picks``: per selector, the positions of its elements.
    ``scan_error``: why a page has neither.
    """
    scan = elements_function(ALL_SELECTORS, FIRST_VALUE_SELECTORS, wanted)

    def shaped(e: Column) -> Column:
        text, *attributes = [
            blank_to_null(strip(e[n])) for n in ("text", "content", "title", "src")]
        return F.struct(
            e["start"].alias("start"), e["length"].alias("length"), text.alias("text"),
            F.coalesce(text, *attributes).alias("value"),
            e["datetime"].alias("datetime"),
            F.coalesce(e["src"], e["data-src"]).alias("image"))

    return (
        pages.withColumn("found", scan(F.col("html")))
        .withColumn("elements", F.transform("found.elements", shaped))
        .withColumn("picks", F.col("found.picks"))
        .withColumn("scan_error", F.when(F.col("found").isNull(), F.lit(NO_MARKUP)).otherwise(F.col("found.error")))
        .drop("found"))


def _picks(selector: str) -> str:
    return f"get(picks, {ALL_SELECTORS.index(selector)})"


def _first(selectors: Sequence[str], field: str) -> Column:
    """First non-null ``field`` of the first element of each selector in turn."""
    return F.expr("coalesce(" + ", ".join(
        f"get(elements, get({_picks(s)}, 0)).{field}" for s in selectors) + ")")


def _texts(selector: str) -> Column:
    """Text of every element of a selector, from its markup."""
    def text(i: Column) -> Column:
        e = F.get("elements", i)
        return strip_html(F.substr(F.col("html"), e["start"] + 1, e["length"]))

    return F.transform(F.expr(_picks(selector)), text)


def _non_blank(col: Column) -> Column:
    return once(col, blank_to_null)


def first_value(selectors: Sequence[str]) -> Column:
    """Text of the first match, else its ``content``, ``title`` or ``src``."""
    return _first(selectors, "value")


def title() -> Column:
    return strip(drop_tags(first_value(TITLE)))


def author(host: str = ANY_HOST) -> Column:
    return F.coalesce(_first(AUTHOR, "text"), url_section(F.col("url"), host))


def published_date() -> Column:
    shown = once(first_value(PUBLISHED), lambda v: F.coalesce(
        blank_to_null(strip(drop_tags(v))), v))
    return F.coalesce(shown, _first(PUBLISHED, "datetime"))


def content() -> Column:
    """Text of all matches of the first selector that has any text."""
    # Each text comes out of strip_html collapsed and trimmed, so joining the
    # non-empty ones by a space leaves only control characters to clean.
    texts = [
        F.array_join(F.filter(_texts(s), lambda t: t != ""), " ") for s in CONTENT]
    chosen = F.coalesce(*[_non_blank(t) for t in texts])
    return _non_blank(F.trim(drop_control(chosen)))


def category() -> Column:
    return first_value(CATEGORY)


def description() -> Column:
    return first_value(DESCRIPTION)


def tags() -> Column:
    """Every short non-empty text of the tag selectors, repeats included."""
    texts = F.concat(*[F.coalesce(_texts(s), F.array()) for s in TAGS])
    short = F.filter(texts, lambda t: F.length(t).between(1, MAX_TAG - 1))
    return _non_blank(F.array_join(short, ", "))


def images() -> Column:
    """Absolute image sources; ``data-src`` counts where ``src`` is absent."""
    picks = F.concat(*[F.coalesce(F.expr(_picks(s)), F.array()) for s in IMAGES])
    sources = F.transform(picks, lambda i: F.get("elements", i)["image"])
    return _non_blank(F.array_join(
        F.filter(sources, lambda s: F.startswith(s, F.lit("http"))), ","))


def extract_articles(
    pages: DataFrame,
    language: str = "ar",
    host: str = ANY_HOST,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The article of each page; columns ``keep`` of ``pages`` come along.

    A page that cannot be read keeps its row, without what its markup would
    give and with an ``error``; the job goes on.  ``failed_pages`` counts them.
    """
    scanned = scan_pages(pages.select(*keep, "url", "html"))
    fields = scanned.select(
        *keep, "url", title().alias("title"), content().alias("content"),
        author(host).alias("author"), published_date().alias("published_date"),
        category().alias("category"), tags().alias("tags"), images().alias("images"),
        description().alias("description"),
        F.col("scan_error").alias("error"))
    row = F.struct(
        *keep, "url", "title", "content", "author", "published_date", "category",
        "tags", "images", "description", F.lit(language).alias("language"),
        word_count(F.col("content")).alias("word_count"), "error")
    # Passing the row through a generator computes each field once: a later
    # filter on title or content is not copied below the expressions.
    return fields.select(F.inline(F.array(row)))


def failed_pages(articles: DataFrame) -> DataFrame:
    """``error, pages``: how many pages could not be read, by the reason."""
    return articles.where(F.col("error").isNotNull()).groupBy("error").agg(F.count("*").alias("pages"))


def is_valid_article() -> Column:
    """Does a row have a title, enough content and a URL?"""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    return (
        (F.length(strip(text("title"))) > MIN_TITLE)
        & (F.length(strip(text("content"))) > MIN_CONTENT)
        & (text("url") != ""))


def valid_article(articles: DataFrame) -> DataFrame:
    return articles.where(is_valid_article())
