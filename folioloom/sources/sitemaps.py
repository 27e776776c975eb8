"""Sitemap documents to URL rows.

Input is a table ``(doc_url, body)`` of fetched XML.  The sitemap protocol
bounds a document at 50,000 entries, so a document is a sound unit of parsing;
its entries are exploded right after the parse and never gathered again.
Elements are known by their namespace, whatever their prefix. A document that
is not one well-formed root, with nothing after it, yields no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from xml.parsers import expat

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from folioloom.functions.urls import is_article_url

# Namespaces (fixed values).
SITEMAP = "http://www.sitemaps.org/schemas/sitemap/0.9"
VIDEO = "http://www.google.com/schemas/sitemap-video/1.1"

PARSED_TYPE = (
    "struct<children:array<string>,entries:array<struct<url:string,lastmod:string,is_video:boolean>>>")
#: A batch that a task hands on ends with the document that brings it to so many elements.
BATCH_ELEMENTS = 10_000
_ARROW_TYPE = pa.struct([
    ("children", pa.list_(pa.string())),
    ("entries", pa.list_(pa.struct([("url", pa.string()), ("lastmod", pa.string()), ("is_video", pa.bool_())])))])


class _Reader:
    """Takes a document element by element, whatever prefixes its namespaces have.

    An item is an element whose direct children are wanted: of several with one
    name the first counts, with its text up to an element inside it.
    """

    ITEMS = {
        f"{SITEMAP} sitemap": {f"{SITEMAP} loc": "url"},
        f"{SITEMAP} url": {f"{SITEMAP} loc": "url", f"{SITEMAP} lastmod": "lastmod"},
        f"{VIDEO} video": {f"{VIDEO} loc": "url", f"{VIDEO} publication_date": "lastmod"}}

    def __init__(self):
        self.found: dict[str, list[dict]] = {name: [] for name in self.ITEMS}
        self.open: list[tuple[dict | None, dict]] = []    # per open element: its item, what the item wants
        self.target: tuple[dict, str] | None = None       # what text belongs to

    def start(self, name: str, attributes: dict) -> None:
        self.target = None
        item, wanted = self.open[-1] if self.open else (None, {})
        field = wanted.get(name)
        if field and field not in item:
            item[field] = ""
            self.target = (item, field)
        if name in self.ITEMS and self.open:              # the root itself is no item
            self.found[name].append({})
            self.open.append((self.found[name][-1], self.ITEMS[name]))
        else:
            self.open.append((None, {}))

    def end(self, name: str) -> None:
        self.target = None
        self.open.pop()

    def text(self, data: str) -> None:
        if self.target:
            item, field = self.target
            item[field] += data


def read_document(body: str | None) -> dict | None:
    """The sitemaps a document lists, and its pages followed by its videos.

    None unless the whole body is one well-formed XML document.
    """
    if body is None:
        return None
    reader, parser = _Reader(), expat.ParserCreate(namespace_separator=" ")
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler = reader.start, reader.end
    parser.CharacterDataHandler = reader.text
    try:
        parser.Parse(body, True)
    except (expat.ExpatError, ValueError):
        return None
    children, pages, videos = reader.found.values()
    return {
        "children": [c.get("url") or None for c in children],
        "entries": [
            {"url": e.get("url") or None, "lastmod": e.get("lastmod") or None, "is_video": is_video}
            for found, is_video in ((pages, False), (videos, True)) for e in found]}


def read_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """What each document holds, in batches of about ``BATCH_ELEMENTS`` elements.

    A batch that comes in may have thousands of documents. They are read one by
    one, so a task holds the elements of one batch that goes out, not of all of them.
    """
    for bodies in batches:
        read, elements = [], 0
        for body in bodies:
            doc = read_document(body.as_py())
            read.append(doc)
            elements += len(doc["children"]) + len(doc["entries"]) if doc else 0
            if elements >= BATCH_ELEMENTS:
                yield pa.array(read, type=_ARROW_TYPE)
                read, elements = [], 0
        if read:
            yield pa.array(read, type=_ARROW_TYPE)


def _parsed(body: Column) -> Column:
    """``struct<children, entries>`` of each document, null where it is not well-formed."""
    def parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return read_batches(batches)

    # Ship the reader itself, so that executors need no copy of this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    parse.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    # Non-deterministic: Spark then does not parse a second time inside a filter.
    return F.arrow_udf(parse, PARSED_TYPE).asNondeterministic()(body)


def parse_entries(docs: DataFrame) -> DataFrame:
    """Every page and video entry with its position in the document.

    Page entries must look like articles; video entries are taken as they are.
    Columns of ``docs`` other than ``body`` are carried along.
    """
    carried = [c for c in docs.columns if c != "body"]
    return (
        docs.select(*carried, _parsed(F.col("body")).alias("doc"))
        .select(*carried, F.posexplode("doc.entries").alias("pos", "entry"))
        .select(*carried, F.col("pos").cast("bigint").alias("pos"), "entry.*")
        .where(F.col("url").isNotNull() & (F.col("is_video") | is_article_url(F.col("url")))))


def urlset_entries(docs: DataFrame) -> DataFrame:
    """Article entries of plain sitemaps."""
    return parse_entries(docs).where(~F.col("is_video")).drop("is_video")


def video_entries(docs: DataFrame) -> DataFrame:
    """Video entries; ``lastmod`` is the publication date."""
    return parse_entries(docs).where("is_video").drop("is_video")


def index_children(index_docs: DataFrame) -> DataFrame:
    """``(index_url, sitemap_no, doc_url)``: the sitemaps an index lists, in order."""
    return (
        index_docs
        .select(F.col("doc_url").alias("index_url"), _parsed(F.col("body")).alias("doc"))
        .select("index_url", F.posexplode("doc.children").alias("sitemap_no", "doc_url"))
        .select("index_url", F.col("sitemap_no").cast("bigint").alias("sitemap_no"), "doc_url")
        .where(F.col("doc_url").isNotNull()))


def expand_sitemaps(
    docs: DataFrame, index_docs: DataFrame, keep_repeats: bool = True
) -> DataFrame:
    """Entries of all sitemaps listed by the index documents.

    Columns: ``index_url, sitemap_no, doc_url, pos, url, lastmod``; the first
    two and ``pos`` give the order in which a sequential reader sees the
    entries.  A listed sitemap without a document is skipped.  An index that
    lists nothing is read as a sitemap itself.

    A sitemap listed several times is read as often.  Where only the last
    entry of a URL counts, ``keep_repeats=False`` reads it once, in the place
    of its last listing, however often it is listed.
    """
    children = index_children(index_docs)
    if not keep_repeats:
        children = children.groupBy("doc_url").agg(
            F.max(F.struct("index_url", "sitemap_no")).alias("last")
        ).select("last.*", "doc_url")
    listed = docs.select("doc_url", "body").join(children, "doc_url")
    plain = (
        index_docs.withColumn("doc", _parsed(F.col("body")))
        .where(F.coalesce(F.size("doc.children"), F.lit(0)) <= 0)
        .select("doc_url", "body", F.col("doc_url").alias("index_url"),
                F.lit(0).cast("bigint").alias("sitemap_no")))
    return parse_entries(listed.unionByName(plain)).select(
        "index_url", "sitemap_no", "doc_url", "pos", "url", "lastmod")


def news_entries(docs: DataFrame, news_url: str) -> DataFrame:
    """Entries of the news sitemap, found by its URL."""
    return parse_entries(docs.where(F.col("doc_url") == news_url)).drop("is_video")
