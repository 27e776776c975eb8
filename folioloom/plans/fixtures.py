"""Tables the registered queries share, derived from the given tables.

Each is one SELECT that Spark and DuckDB both run unchanged, with ``{name}``
for the tables it reads.  Every one covers its whole source table, and the
number of keys grows with the data.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SITE = "https://site.example/"

_SECTION = """CASE {key} % 8 WHEN 0 THEN 'news' WHEN 1 THEN 'politics' WHEN 2 THEN 'business'
              WHEN 3 THEN 'Sports' WHEN 4 THEN 'culture' WHEN 5 THEN 'technology'
              WHEN 6 THEN 'tag' ELSE 'about' END"""


def _url(key: str) -> str:
    return f"""concat('{SITE}', {_SECTION.replace("{key}", key)}, '/', CAST({key} AS STRING),
         CASE WHEN {key} % 11 = 0 THEN '?page=2' ELSE '.html' END)"""


def _turn(key: str, n: int, choices: list[str], where: str = "true") -> str:
    """One of n expressions by the key; the last one where the condition does not hold."""
    return (f"CASE WHEN NOT ({where}) THEN {choices[-1]} "
            + " ".join(f"WHEN {key} % {n} = {i} THEN {x}" for i, x in enumerate(choices)) + " END")


_IMAGES = """concat('<img src="http://img.example/', CAST(doc_id AS STRING), '.png">',
              '<img src="/rel.png" data-src="http://img.example/no.png">',
              '<img data-src="http://img.example/late.png">')"""

FIXTURES = {
    # Repeated URLs, null dates, mixed case, rejected sections, query strings.
    "sitemap_main": f"""
SELECT {_url("o_custkey")} AS url,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL
            ELSE substr(CAST(o_orderdate AS STRING), 1, 10) END AS lastmod,
       o_orderkey AS pos
FROM {{orders}}""",

    # Overlaps sitemap_main and has URLs of its own.
    "sitemap_news": f"""
SELECT {_url("l_partkey")} AS url,
       CASE WHEN l_orderkey % 3 = 0 THEN NULL
            ELSE substr(CAST(l_shipdate AS STRING), 1, 10) END AS lastmod,
       l_orderkey AS batch_key, l_linenumber AS line
FROM {{lineitem}}""",

    # All statuses, null and non-null retry counts.
    "crawl_state": f"""
SELECT url,
       CASE WHEN k % 5 = 0 THEN NULL ELSE '1996-06-01' END AS lastmod,
       TIMESTAMP '2024-01-01 00:00:00' + k * INTERVAL '1' SECOND AS first_seen,
       CASE WHEN k % 4 < 2 THEN 'done' WHEN k % 4 = 2 THEN 'pending' ELSE 'error' END AS status,
       CASE WHEN k % 4 <> 2 OR k % 3 = 1
            THEN TIMESTAMP '2024-02-01 00:00:00' + k * INTERVAL '1' SECOND END AS crawled_at,
       CASE WHEN k % 4 < 2 THEN concat('batch_', CAST(k % 17 AS STRING)) END AS batch_id,
       CASE WHEN k % 4 < 2 THEN md5(url) END AS content_hash,
       CASE WHEN k % 4 = 3 THEN 'HTTP 500' END AS error_message,
       CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(k % 7 AS INT) END AS scrape_count
FROM (SELECT {_url("c_custkey")} AS url, c_custkey AS k FROM {{customer}}) t""",

    # Four attempts per URL, one of them beyond the limit of three.
    "attempts": f"""
SELECT *, md5(url) AS content_hash FROM (
SELECT concat('{SITE}news/', CAST(CAST(floor(event_id / 4) AS BIGINT) AS STRING), '.html') AS url,
       CAST(event_id % 4 + 1 AS INT) AS attempt,
       ts,
       CASE WHEN value > 60 THEN NULL WHEN event_type = 'purchase' THEN 429
            WHEN event_type = 'signup' THEN 503 WHEN event_type = 'error' THEN 404
            WHEN value < 5 THEN 500 ELSE 200 END AS http_status,
       value > 15 AS valid,
       CASE WHEN value > 60 AND user_id % 2 = 0 THEN concat('timeout ', props) END AS exception,
       event_id
FROM {{events}}) t""",

    "checkpoints": """
SELECT concat('crawl_', CAST(o_orderkey AS STRING)) AS crawl_id,
       CASE WHEN o_orderkey % 10 = 0 THEN 'full' ELSE 'incremental' END AS mode,
       CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running' ELSE 'failed' END AS status,
       o_orderdate AS start_time,
       CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + coalesce(secs, 0) * INTERVAL '1' SECOND END AS end_time,
       CAST(0 AS BIGINT) AS total_urls,
       CASE WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN CAST(0 AS BIGINT) ELSE coalesce(n, 0) END AS processed_urls,
       CASE WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN CAST(0 AS BIGINT) ELSE coalesce(ok, 0) END AS successful_urls,
       CASE WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN CAST(0 AS BIGINT) ELSE coalesce(n - ok, 0) END AS failed_urls
FROM {orders} LEFT JOIN (
  SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag <> 'R') AS ok,
         CAST(sum(l_quantity) AS BIGINT) AS secs
  FROM {lineitem} GROUP BY l_orderkey) l ON o_orderkey = l_orderkey""",

    # What the rendered sitemaps contain: at most 500 pages in a document.
    "sitemap_entry": f"""
SELECT CAST(floor(o_orderkey / 500) AS BIGINT) AS doc_no,
       o_orderkey AS entry_key,
       {_url("o_orderkey")} AS url,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL
            ELSE substr(CAST(o_orderdate AS STRING), 1, 10) END AS lastmod,
       CASE WHEN o_custkey % 4 = 0
            THEN concat('{SITE}video/', CAST(o_orderkey AS STRING)) END AS video_url,
       CASE WHEN o_custkey % 3 <> 0
            THEN substr(CAST(o_orderdate AS STRING), 1, 10) END AS video_date
FROM {{orders}}""",

    # Markup written from columns, so the expected fields are known unparsed.
    # Every field is marked up in turn in each way that a selector looks for.
    "article_pages": f"""
SELECT doc_id AS page_id,
       concat('{SITE}', lang, '/', source, '/', CAST(doc_id AS STRING), '.html') AS url,
       concat('<html><head>', {_turn("doc_id", 2, [
           """concat('<meta name="description" content="about ', CAST(doc_id AS STRING), '">')""",
           """concat('<meta property="og:description" content="about ', CAST(doc_id AS STRING), '">')"""])},
              '</head><body><!-- <h1 class="article-title">not this</h1> -->',
              '<script-loader></script-loader><style-guide></style-guide>',
              {_turn("doc_id", 7, [f"'{m}'" for m in (
                  '<h1 class="article-title">', '<h1 class="entry-title">', '<h1 class="post-title">', '<h1 class="title">',
                  '<div class="entry-header"><h1>', '<article><h1>', '<h1>')], "c < 9")},
              CASE WHEN doc_id % 5 = 0 THEN 'Title <b title="x > y">of ' ELSE 'Title <b>of ' END, source, '</b></h1>',
              {_turn("doc_id", 7, ["''", "''", "''", "''", "'</div>'", "'</article>'", "''"], "c < 9")},
              CASE WHEN doc_id % 3 = 0 THEN ''
                   ELSE concat({_turn("doc_id", 8, [f"'{m}'" for m in (
                       '<i class="author-name">', '<span class="by author">', '<i class="by-author">', '<div class="author"><a>',
                       '<a rel="author" href=/by/>', '<i class="post-author">', '<i class="article-author">',
                       '<i class="writer-name">')])}, 'Writer ', source,
                       {_turn("doc_id", 8, [f"'{m}'" for m in (
                           "</i>", "</span>", "</i>", "</a></div>", "</a>", "</i>", "</i>", "</i>")])}) END,
              CASE WHEN doc_id % 4 = 0
                   THEN concat('<time datetime="2024-02-', CAST(10 + doc_id % 19 AS STRING), '"></time>')
                   ELSE concat({_turn("doc_id", 6, [f"'{m}'" for m in (
                       '<span class="date">', '<time class="entry-date">', '<time class="published">', '<time class="post-date">',
                       '<span class="post-date">', '<span class="article-date">')])},
                       '2024-01-', CAST(10 + doc_id % 20 AS STRING),
                       {_turn("doc_id", 6, [f"'{m}'" for m in (
                           "</span>", "</time>", "</time>", "</time>", "</span>", "</span>")])}) END,
              {_turn("c", 11, [f"'{m}'" for m in (
                  '<div class="content-body"', '<div class="body"', '<div class="article-body"', '<div class="entry-content"',
                  '<div class="post-content"', '<div class="article-content"', '<article><div class="content"',
                  '<div class="post-body"', '<section class="article-body"', '<article', '<main')])},
              CASE WHEN doc_id % 3 = 0 THEN concat(' data-note="a < b ', repeat('x', 5000), '"') ELSE '' END, '>',
              '<div><p>',
              replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'),
              '</p><a href=/up/></a></div>',
              CASE WHEN c IN (2, 3, 6, 8, 9) THEN {_IMAGES} ELSE '' END,
              {_turn("c", 11, [f"'{m}'" for m in (
                  "</div>", "</div>", "</div>", "</div>", "</div>", "</div>", "</div></article>", "</div>", "</section>",
                  "</article>", "</main>")])},
              CASE WHEN c IN (2, 3, 6, 8, 9) THEN '' ELSE concat('<section class="post-content">', {_IMAGES}, '</section>') END,
              {_turn("doc_id", 7, [
                  """concat('<meta property="article:section" content="', lang, '">')"""] + [
                  f"concat('{start}', lang, '{stop}')" for start, stop in (
                      ('<b class="category">', "</b>"), ('<b class="post-category">', "</b>"), ('<b class="article-category">', "</b>"),
                      ('<div class="breadcrumbs"><a>', "</a></div>"), ('<nav class="breadcrumb"><a>', "</a></nav>"),
                      ('<b class="section-name">', "</b>"))])},
              {_turn("doc_id", 2, ["'<div class=tags>'", "'<div class=post-tags>'"])}, lang, '</div>',
              {_turn("doc_id", 2, ["""'<div class="article-tags"><i>'""", """'<div class="tag-list"><i>'"""])}, source, '</i></div>',
              '</body></html>') AS html
FROM (SELECT *, CAST(floor(doc_id / 7) AS BIGINT) % 11 AS c FROM {{documents}}) d""",
}

_REFERENCE = re.compile(r"\{(\w+)\}")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or one of the derived ones, as a DataFrame."""
    if name not in FIXTURES:
        return read_table(spark, sf_dir, name)
    sql = FIXTURES[name]
    return spark.sql(sql, **{
        n: fixture(spark, sf_dir, n) for n in set(_REFERENCE.findall(sql))})


def fixture_sql(name: str) -> str:
    """The same table as SQL over the pre-registered views."""
    return _REFERENCE.sub(r"\1", FIXTURES[name])
