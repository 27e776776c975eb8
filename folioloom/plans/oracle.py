"""The registered queries as SQL that DuckDB runs on the given tables."""

from __future__ import annotations

import re

from folioloom.functions.text import ENTITIES
from folioloom.functions.urls import ARTICLE_PATTERNS, NON_ARTICLE_PATTERNS
from folioloom.plans.fixtures import FIXTURES, SITE, fixture_sql

# RE2's own class is ASCII only, so Unicode whitespace is spelled out.
WHITESPACE = (
    r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
WS = f"[{WHITESPACE}]"
_CONTROL = r"[\x00-\x08\x0b-\x0c\x0e-\x1f\x{7f}-\x{9f}]"


# --- expression builders ------------------------------------------------------

def collapse(x: str) -> str:
    return f"regexp_replace({x}, '{WS}+', ' ', 'g')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def drop_tags(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]+>', '', 'g')"


def strip_html(x: str) -> str:
    x = f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"
    for entity, char in ENTITIES:
        x = f"replace({x}, '{entity}', '{char}')"
    x = f"regexp_replace({x}, '&#\\p{{Nd}}+;', '', 'g')"
    return strip(collapse(x))


def clean(x: str) -> str:
    return strip(f"regexp_replace({collapse(x)}, '{_CONTROL}', '', 'g')")


def content_hash(x: str) -> str:
    return (f"CASE WHEN coalesce({x}, '') = '' THEN '' "
            f"ELSE md5(replace({clean(x)}, ' ', '')) END")


def word_count(x: str) -> str:
    return f"coalesce(len(regexp_extract_all({x}, '[^{WHITESPACE}]+')), 0)"


def any_of(patterns) -> str:
    return "|".join(patterns).replace(r"\d", r"\p{Nd}")


def is_article(url: str) -> str:
    return (f"(NOT regexp_matches(lower({url}), '{any_of(NON_ARTICLE_PATTERNS)}') "
            f"AND regexp_matches(lower({url}), '{any_of(ARTICLE_PATTERNS)}'))")


def percent(a: str, b: str) -> str:
    x = f"({a}::DOUBLE / {b} * 100)"
    return (f"CASE WHEN NOT {b} > 0 THEN 0.0::DOUBLE WHEN {x} * 4 = floor({x} * 4) "
            f"THEN floor({x} * 10 + 0.5) / 10 ELSE CAST(printf('%.1f', {x}) AS DOUBLE) END")


def seconds(a: str, b: str) -> str:
    return f"((epoch_us({b}) - epoch_us({a})) / 1000000.0::DOUBLE)"


# --- derived tables used by several queries -------------------------------------

VIEWS = {name: fixture_sql(name) for name in FIXTURES}

VIEWS["main_articles"] = f"SELECT * FROM sitemap_main WHERE {is_article('url')}"
VIEWS["news_articles"] = f"SELECT * FROM sitemap_news WHERE {is_article('url')}"
# arg_max_null keeps a null date of the last occurrence.
VIEWS["merged"] = """
SELECT coalesce(m.url, n.url) AS url,
       CASE WHEN m.lastmod IS NULL THEN n.lastmod WHEN n.lastmod IS NULL THEN m.lastmod
            WHEN n.lastmod > m.lastmod THEN n.lastmod ELSE m.lastmod END AS lastmod
FROM (SELECT url, arg_max_null(lastmod, pos) AS lastmod FROM main_articles GROUP BY url) m
FULL OUTER JOIN (SELECT url, max(lastmod) AS lastmod FROM news_articles GROUP BY url) n
  ON m.url = n.url"""

VIEWS["state_results"] = """
SELECT url, coalesce(scrape_count, 0) % 2 = 0 AS ok, scrape_count FROM crawl_state"""

VIEWS["page_articles"] = f"""
SELECT page_id, url,
       {strip(drop_tags("replace(replace(replace(replace(regexp_replace(h1, '<[^>]+>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&amp;', '&')"))} AS title,
       nullif({clean(strip_html("article"))}, '') AS content
FROM (SELECT page_id, url,
             regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1, 's') AS h1,
             regexp_extract(html, '<article>.*?</article>', 0, 's') AS article
      FROM pages) p"""

_ESCAPED = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
VIEWS["document_articles"] = f"""
SELECT doc_id AS page_id,
       concat('{SITE}', lang, '/', source, '/', CAST(doc_id AS VARCHAR), '.html') AS url,
       concat('Title of ', source) AS title,
       nullif({clean(strip_html(_ESCAPED))}, '') AS content,
       CASE WHEN doc_id % 3 = 0 THEN concat(upper(source[1]), lower(source[2:]))
            ELSE concat('Writer ', source) END AS author,
       CASE WHEN doc_id % 4 = 0 THEN concat('2024-02-', CAST(10 + doc_id % 19 AS VARCHAR))
            ELSE concat('2024-01-', CAST(10 + doc_id % 20 AS VARCHAR)) END AS published_date,
       lang AS category,
       concat(lang, ', ', source) AS tags,
       concat('http://img.example/', CAST(doc_id AS VARCHAR), '.png,http://img.example/late.png') AS images,
       concat('about ', CAST(doc_id AS VARCHAR)) AS description
FROM documents"""

_VALID = f"""length({strip("coalesce(title, '')")}) > 5 AND length({strip("coalesce(content, '')")}) > 100
  AND coalesce(url, '') <> ''"""
_NO_FIELDS = ", ".join(f"CAST(NULL AS VARCHAR) AS {f}" for f in (
    "published_date", "category", "tags", "images", "description"))
# The given pages name no author: the second path segment stands for one.
VIEWS["valid_pages"] = f"""
SELECT *, nullif(concat(upper(segment[1]), lower(segment[2:])), '') AS author, {_NO_FIELDS}
FROM (SELECT *, regexp_extract(url, '://[^/]+/[^/]+/([^/]+)/', 1) AS segment FROM page_articles) t WHERE {_VALID}"""
VIEWS["valid_documents"] = f"SELECT * FROM document_articles WHERE {_VALID}"
for _kind in ("page", "document"):
    VIEWS[f"{_kind}_batches"] = f"""
SELECT *, CAST(floor(rank / 20) AS BIGINT) AS batch_no, rank % 20 AS page_no
FROM (SELECT *, row_number() OVER (ORDER BY md5(url), url) - 1 AS rank FROM valid_{_kind}s) t"""

VIEWS["recent"] = "SELECT * FROM checkpoints ORDER BY start_time DESC, crawl_id DESC LIMIT 20"
VIEWS["attempt_runs"] = "SELECT *, CAST(CAST(ts AS DATE) AS VARCHAR) AS crawl_id FROM attempts"
VIEWS["sitemap_read"] = """
SELECT *, concat('https://site.example/sitemaps/', CAST(doc_no AS VARCHAR), '.xml') AS doc_url,
       row_number() OVER (PARTITION BY doc_no ORDER BY entry_key) - 1 AS url_pos,
       count(*) OVER (PARTITION BY doc_no) AS n_urls,
       count(video_url) OVER (PARTITION BY doc_no ORDER BY entry_key) - 1 AS video_pos
FROM sitemap_entry WHERE doc_no % 40 NOT IN (13, 17, 21)"""
VIEWS["sitemap_pages"] = f"""
SELECT doc_no, doc_url, url_pos AS pos, url, lastmod FROM sitemap_read WHERE {is_article('url')}"""
VIEWS["sitemap_videos"] = """
SELECT doc_no, doc_url, n_urls + video_pos AS pos, video_url AS url, video_date AS lastmod
FROM sitemap_read WHERE video_url IS NOT NULL"""
VIEWS["sitemap_all"] = "SELECT * FROM sitemap_pages UNION ALL SELECT * FROM sitemap_videos"
VIEWS["expanded"] = """
SELECT concat('https://site.example/sitemaps/index-', CAST(CAST(floor(doc_no / 100) AS BIGINT) AS VARCHAR), '.xml') AS index_url,
       2 * (doc_no - 100 * CAST(floor(doc_no / 100) AS BIGINT)) AS sitemap_no,
       doc_url, pos, url, lastmod
FROM sitemap_all"""
VIEWS["refreshed"] = """
SELECT coalesce(m.url, n.url) AS url,
       CASE WHEN m.lastmod IS NULL THEN n.lastmod WHEN n.lastmod IS NULL THEN m.lastmod
            WHEN n.lastmod > m.lastmod THEN n.lastmod ELSE m.lastmod END AS lastmod
FROM (SELECT url, arg_max_null(lastmod, row(index_url, sitemap_no, pos)) AS lastmod
      FROM expanded GROUP BY url) m
FULL OUTER JOIN (SELECT url, max(lastmod) AS lastmod FROM news_articles GROUP BY url) n
  ON m.url = n.url"""

_STATE = ("url, lastmod, first_seen, status, crawled_at, batch_id, content_hash, "
          "error_message, scrape_count")
_NOW = "TIMESTAMP '2024-03-01 00:00:00'"


def _outcomes(keys: str, source: str) -> str:
    return f"""
SELECT {keys}, coalesce(r.outcome, 'error') AS outcome,
       CASE WHEN r IS NULL THEN 'All 3 fetch attempts failed' ELSE r.error END AS error,
       first, last
FROM (SELECT {keys}, min(ts) AS first, max(ts) AS last,
             arg_min(struct_pack(outcome := CASE WHEN error IS NULL THEN 'success' ELSE 'error' END,
                                 error := error), attempt) FILTER (WHERE settles) AS r
      FROM (SELECT *,
              CASE WHEN exception IS NOT NULL THEN attempt >= 3
                   ELSE http_status IS NULL OR http_status NOT IN (429, 503) END AS settles,
              CASE WHEN exception IS NOT NULL THEN substr(exception, 1, 300)
                   WHEN http_status IS NULL THEN 'HTTP No response'
                   WHEN http_status = 200 AND coalesce(valid, false) THEN NULL
                   WHEN http_status = 200 THEN 'No content extracted or validation failed'
                   WHEN http_status = 404 THEN 'HTTP 404 Not Found'
                   ELSE concat('HTTP ', CAST(http_status AS VARCHAR)) END AS error
            FROM {source} WHERE attempt <= 3) a
      GROUP BY {keys}) g"""


def _fold() -> str:
    """The rule step by step: outcomes of (run, URL) in order, one crawl each."""
    return f"""
SELECT url,
       CASE WHEN last_error IS NULL THEN 'done' WHEN scrape_count >= 3 THEN 'error' ELSE 'pending' END AS status,
       crawled_at, content_hash, substr(last_error, 1, 500) AS error_message, scrape_count
FROM (SELECT url, CAST(count(*) FILTER (WHERE outcome = 'error') AS INT) AS scrape_count, max(last) AS crawled_at,
             CASE WHEN count(*) FILTER (WHERE outcome = 'success') > 0 THEN md5(url) END AS content_hash,
             arg_max_null(error, row(last, crawl_id)) AS last_error
      FROM ({_outcomes('crawl_id, url', 'attempt_runs')}) o GROUP BY url) t"""


def _marked(ok: str, bad: str) -> str:
    """State rows after a done or a bad result; conditions say which applies."""
    return f"""
SELECT url, lastmod, first_seen,
       CASE WHEN {ok} THEN 'done' WHEN NOT ({bad}) THEN status
            WHEN coalesce(scrape_count, 0) + 1 >= 3 THEN 'error' ELSE 'pending' END AS status,
       CASE WHEN {ok} OR {bad} THEN {_NOW} ELSE crawled_at END AS crawled_at,
       CASE WHEN {ok} THEN 'run-7' ELSE batch_id END AS batch_id,
       CASE WHEN {ok} THEN md5(concat(url, 'x')) ELSE content_hash END AS content_hash,
       CASE WHEN {ok} THEN NULL WHEN {bad} THEN substr(repeat(url, 20), 1, 500) ELSE error_message END AS error_message,
       CASE WHEN {bad} THEN CAST(coalesce(scrape_count, 0) + 1 AS INT) ELSE scrape_count END AS scrape_count
FROM crawl_state"""


_OK = "coalesce(scrape_count, 0) % 2 = 0"
_LATEST_RATE = f"""
SELECT coalesce((SELECT CASE WHEN s > 0 THEN processed_urls / s ELSE 0.0 END
  FROM (SELECT *, {seconds('start_time', 'end_time')} AS s FROM recent
        WHERE status = 'completed' ORDER BY start_time DESC, crawl_id DESC LIMIT 1) t), 0.0) AS rate"""
_TODAY = "(SELECT CAST(max(start_time) AS DATE) FROM checkpoints)"
_FIELDS = ("url", "title", "content", "author", "published_date", "category", "tags", "images", "description", "language")
_DIGEST = ("md5(string_agg(concat_ws('|', " + ", ".join(f"coalesce({f}, '-')" for f in _FIELDS)
           + ", CAST(word_count AS VARCHAR)), chr(10) ORDER BY page_no))")


def _run_urls() -> str:
    """URLs of pages and of fetch attempts, none known before, after a run: every fourth batch
    fails, and so do fetches by their outcome."""
    return f"""
SELECT p.url, CASE WHEN b.url IS NOT NULL AND batch_no % 4 <> 3 THEN 'done' ELSE 'pending' END AS status,
       CASE WHEN b.url IS NOT NULL AND batch_no % 4 <> 3 THEN concat('run-', CAST(batch_no AS VARCHAR)) END AS batch_id,
       CASE WHEN b.url IS NOT NULL AND batch_no % 4 <> 3 THEN {content_hash('b.content')} END AS content_hash,
       CASE WHEN b.url IS NULL THEN 'No content extracted or validation failed'
            WHEN batch_no % 4 = 3 THEN 'Batch insert failed: no space' END AS error_message,
       CASE WHEN b.url IS NULL OR batch_no % 4 = 3 THEN CAST(1 AS INT) END AS scrape_count, true AS crawled
FROM pages p LEFT JOIN page_batches b ON p.url = b.url
UNION ALL
SELECT url, 'pending', NULL, NULL, error, CASE WHEN outcome = 'error' THEN CAST(1 AS INT) END, outcome = 'error'
FROM ({_outcomes('url', 'attempts')}) o"""


def _packed(batches: str) -> str:
    return f"""
SELECT concat('run-', CAST(batch_no AS VARCHAR)) AS batch_id, CAST(count(*) AS INT) AS page_count,
       {_DIGEST} AS digest
FROM (SELECT *, 'ar' AS language, {word_count('content')} AS word_count FROM {batches}) t GROUP BY batch_no"""


ORACLES = {
    # Sources and sinks
    "sitemap_urlset": "SELECT doc_url, pos, url, lastmod FROM sitemap_pages",
    "sitemap_video": "SELECT doc_url, pos, url, lastmod FROM sitemap_videos",
    "sitemap_index": """
SELECT concat('https://site.example/sitemaps/index-', CAST(index_no AS VARCHAR), '.xml') AS index_url,
       sitemap_no, concat('https://site.example/sitemaps/', kind, CAST(doc_no AS VARCHAR), '.xml') AS doc_url
FROM (SELECT DISTINCT doc_no, CAST(floor(doc_no / 100) AS BIGINT) AS index_no, k.kind,
             2 * (doc_no - 100 * CAST(floor(doc_no / 100) AS BIGINT)) + k.offs AS sitemap_no
      FROM sitemap_entry, (VALUES ('', 0), ('gone-', 1)) k(kind, offs)) t""",
    "sitemap_expand": "SELECT * FROM expanded",
    "news_sitemap": "SELECT url, lastmod FROM news_articles",
    "state_scan": "SELECT url, status, crawled_at, content_hash FROM crawl_state",
    "batch_sink": _packed("page_batches"),
    "dry_run_summary": f"SELECT batch_id, page_count FROM ({_packed('page_batches')}) b",

    # Filters and projections
    "article_url_filter": "SELECT url, lastmod, pos FROM main_articles",
    "valid_article": f"""
SELECT page_id, url FROM document_articles
WHERE length(title) > 5 AND length({strip("coalesce(content, '')")}) > 100""",
    "pending_filter": "SELECT * FROM crawl_state WHERE status = 'pending'",
    "stale_run_filter": """
SELECT * FROM checkpoints WHERE NOT (status = 'running' AND coalesce(processed_urls, 0) = 0)""",
    "crawled_filter": "SELECT * FROM crawl_state WHERE crawled_at IS NOT NULL",
    "batch_projection": """
SELECT url, title, content, CAST(NULL AS VARCHAR) AS author, CAST(NULL AS VARCHAR) AS published_date,
       CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS tags, CAST(NULL AS VARCHAR) AS images,
       CAST(NULL AS VARCHAR) AS description, 'ar' AS language, CAST(0 AS INT) AS word_count
FROM page_articles""",

    # Extraction
    "extract_title": "SELECT page_id, title FROM page_articles",
    "extract_author": "SELECT page_id, author FROM document_articles",
    "extract_published": "SELECT page_id, published_date FROM document_articles",
    "extract_content": "SELECT page_id, content FROM page_articles",
    "extract_category": "SELECT page_id, category FROM document_articles",
    "extract_tags": "SELECT page_id, tags FROM document_articles",
    "extract_images": "SELECT page_id, images FROM document_articles",
    "extract_description": "SELECT page_id, description FROM document_articles",
    "word_count": f"SELECT page_id, CAST({word_count('content')} AS INT) AS word_count, 'ar' AS language FROM page_articles",
    "extract_articles": f"""
SELECT page_id, url, title, content, author, published_date, category, tags, images, description,
       'ar' AS language, CAST({word_count('content')} AS INT) AS word_count, CAST(NULL AS VARCHAR) AS error
FROM document_articles""",
    "selector_fallback": """
SELECT page_id, title AS from_text, description AS from_content, images_first AS from_src
FROM (SELECT *, concat('http://img.example/', CAST(page_id AS VARCHAR), '.png') AS images_first
      FROM document_articles) t""",

    # Scalar functions
    "strip_html": f"SELECT page_id, {strip_html('html')} AS text FROM pages",
    "clean_text": f"SELECT doc_id, {clean('text')} AS text FROM documents",
    "content_hash": f"SELECT doc_id, {content_hash('text')} AS content_hash FROM documents",
    "error_truncate": """
SELECT doc_id, substr(text, 1, 500) AS state_message, substr(text, 1, 300) AS fetch_message,
       substr(text, 1, 200) AS batch_message FROM documents""",
    "url_lower_match": f"""
SELECT page_id, regexp_matches(lower(url), '{any_of(NON_ARTICLE_PATTERNS)}') AS rejected,
       regexp_matches(lower(url), '{any_of(ARTICLE_PATTERNS)}') AS accepted FROM pages""",
    "day_of_run": "SELECT crawl_id, CAST(start_time AS DATE) AS day FROM checkpoints",
    "pct_1dp": f"""
SELECT crawl_id, {percent('successful_urls', 'processed_urls')} AS percent FROM checkpoints""",

    # Joins and keyed updates
    "sitemap_merge": "SELECT url, lastmod FROM merged",
    "insert_if_absent": f"""
SELECT {_STATE} FROM crawl_state
UNION ALL
SELECT url, lastmod, {_NOW}, 'pending', NULL, NULL, NULL, NULL, NULL FROM merged
WHERE url NOT IN (SELECT url FROM crawl_state)""",
    "new_vs_done": """
SELECT count(*) FILTER (WHERE s.url IS NULL) AS new_count,
       count(*) FILTER (WHERE s.url IS NOT NULL) AS done_count
FROM merged m LEFT JOIN (SELECT url FROM crawl_state WHERE crawled_at IS NOT NULL) s ON m.url = s.url""",
    "mark_done": _marked(_OK, "false"),
    "mark_error": _marked("false", f"NOT ({_OK})"),
    "reset_done": """
SELECT url, lastmod, first_seen, CASE WHEN status = 'done' THEN 'pending' ELSE status END AS status,
       CASE WHEN status <> 'done' THEN crawled_at END AS crawled_at,
       CASE WHEN status <> 'done' THEN batch_id END AS batch_id,
       content_hash, error_message, scrape_count FROM crawl_state""",
    "reset_errors": """
SELECT url, lastmod, first_seen,
       CASE WHEN status = 'error' AND coalesce(scrape_count, 0) < 5 THEN 'pending' ELSE status END AS status,
       crawled_at, batch_id, content_hash,
       CASE WHEN NOT (status = 'error' AND coalesce(scrape_count, 0) < 5) THEN error_message END AS error_message,
       scrape_count FROM crawl_state""",
    "apply_batch_outcome": f"""
SELECT p.url, CAST(NULL AS VARCHAR) AS lastmod, TIMESTAMP '2024-01-15 00:00:00' AS first_seen,
       CASE WHEN batch_no % 4 <> 3 AND batch_no IS NOT NULL THEN 'done' ELSE 'pending' END AS status,
       CASE WHEN batch_no IS NOT NULL THEN {_NOW} END AS crawled_at,
       CASE WHEN batch_no % 4 <> 3 THEN concat('run-', CAST(batch_no AS VARCHAR)) END AS batch_id,
       CASE WHEN batch_no % 4 <> 3 THEN {content_hash('b.content')} END AS content_hash,
       CASE WHEN batch_no % 4 = 3 THEN concat('Batch insert failed: quota exceeded for run-', CAST(batch_no AS VARCHAR)) END AS error_message,
       CASE WHEN batch_no % 4 = 3 THEN CAST(1 AS INT) END AS scrape_count
FROM pages p LEFT JOIN page_batches b ON p.url = b.url
UNION ALL SELECT {_STATE} FROM crawl_state""",
    "checkpoint_upsert": """
SELECT crawl_id, mode, CASE WHEN status = 'running' THEN 'completed' ELSE status END AS status, start_time,
       CASE WHEN status = 'running' THEN TIMESTAMP '2002-01-01 00:00:00' ELSE end_time END AS end_time,
       total_urls, CASE WHEN status = 'running' THEN processed_urls + 1 ELSE processed_urls END AS processed_urls,
       successful_urls, CASE WHEN status = 'running' THEN failed_urls + 1 ELSE failed_urls END AS failed_urls
FROM checkpoints
UNION ALL
SELECT 'crawl_new', 'full', 'running', TIMESTAMP '2002-01-01 00:00:00', NULL, 0, NULL, NULL, NULL""",

    # Aggregations
    "state_stats": """
SELECT count(*) AS total, count(*) FILTER (WHERE status = 'pending') AS pending,
       count(*) FILTER (WHERE status = 'done') AS done, count(*) FILTER (WHERE status = 'error') AS error
FROM crawl_state""",
    "pending_count": "SELECT count(*) AS pending FROM crawl_state WHERE status = 'pending'",
    "run_summary": f"""
SELECT crawl_id, count(*) AS processed, count(*) FILTER (WHERE outcome = 'success') AS successful,
       count(*) FILTER (WHERE outcome = 'error') AS failed,
       CASE WHEN {seconds('min(first)', 'max(last)')} > 0
            THEN count(*) / {seconds('min(first)', 'max(last)')} ELSE 0.0 END AS rate
FROM ({_outcomes('crawl_id, url', 'attempt_runs')}) o GROUP BY crawl_id""",
    "batch_pack": _packed("document_batches"),
    "attempt_outcome": f"SELECT url, outcome, error FROM ({_outcomes('url', 'attempts')}) o",
    "state_fold": _fold(),
    "progress": f"""
SELECT done, total, {percent('done', 'total')} AS percent_done
FROM (SELECT count(*) FILTER (WHERE status = 'done') AS done, count(*) AS total FROM crawl_state) t""",
    "success_rate": f"""
SELECT processed, successful, {percent('successful', 'processed')} AS success_rate
FROM (SELECT CAST(coalesce(sum(processed_urls), 0) AS BIGINT) AS processed,
             CAST(coalesce(sum(successful_urls), 0) AS BIGINT) AS successful
      FROM recent WHERE status = 'completed') t""",
    "latest_rate": _LATEST_RATE,
    "eta": f"""
SELECT pending, rate,
       CASE WHEN pending = 0 THEN 'Done!' WHEN rate <= 0 THEN 'Calculating...'
            WHEN pending / rate / 86400 < 1
            THEN concat('~', CAST(CAST(ceil(pending / rate / 3600) AS BIGINT) AS VARCHAR), ' hours')
            ELSE concat('~', CAST(CAST(ceil(pending / rate / 86400) AS BIGINT) AS VARCHAR), ' days') END AS eta
FROM (SELECT count(*) AS pending FROM crawl_state WHERE status = 'pending') p, ({_LATEST_RATE}) r""",
    "daily_series": f"""
SELECT d.day, CAST(coalesce(c.processed, 0) AS BIGINT) AS processed
FROM (SELECT {_TODAY} - CAST(i AS INT) AS day FROM range(14) t(i)) d
LEFT JOIN (SELECT CAST(start_time AS DATE) AS day, sum(processed_urls) AS processed
           FROM checkpoints GROUP BY 1) c ON c.day = d.day""",
    "today_total": f"""
SELECT CAST(coalesce(sum(processed_urls), 0) AS BIGINT) AS processed FROM recent
WHERE CAST(start_time AS DATE) = {_TODAY}""",
    "url_dedup": """
SELECT count(DISTINCT url) AS unique_urls
FROM (SELECT url FROM main_articles UNION ALL SELECT url FROM news_articles) t""",
    "source_counts": """
SELECT (SELECT count(*) FROM main_articles) AS main_count, (SELECT count(*) FROM news_articles) AS news_count,
       (SELECT count(*) FROM merged) AS total_found, (SELECT count(*) FROM crawl_state) AS tracked""",

    # Top-k
    "pending_queue": "SELECT * FROM crawl_state WHERE status = 'pending' ORDER BY first_seen, url LIMIT 100",
    "recent_crawled": """
SELECT url, status, crawled_at, content_hash FROM crawl_state WHERE crawled_at IS NOT NULL
ORDER BY crawled_at DESC, url LIMIT 50""",
    "recent_checkpoints": "SELECT * FROM checkpoints ORDER BY start_time DESC, crawl_id DESC LIMIT 10",
    "runs_table": """
SELECT substr(crawl_id, 1, 30) AS crawl_id, status, processed_urls, successful_urls, failed_urls, start_time
FROM recent WHERE NOT (status = 'running' AND coalesce(processed_urls, 0) = 0)
ORDER BY start_time DESC, recent.crawl_id DESC LIMIT 10""",
    "max_urls": "SELECT * FROM crawl_state WHERE status = 'pending' ORDER BY first_seen, url LIMIT 250",
    "preview": "SELECT url FROM merged ORDER BY url LIMIT 10",

    # Streaming: the same as over the whole log
    "stream_state_fold": _fold(),
    "stream_daily": f"""
SELECT CAST(last AS DATE) AS day, count(*) AS processed
FROM ({_outcomes('crawl_id, url', 'attempt_runs')}) o GROUP BY 1""",

    # Change detection
    "content_changed": """
SELECT m.url, CASE WHEN s.content_hash IS NULL THEN 'new' WHEN s.content_hash = m.new_hash THEN 'unchanged'
                   ELSE 'changed' END AS change
FROM (SELECT url, arg_max_null(CASE WHEN pos % 2 = 0 THEN md5(concat(url, 'x')) ELSE md5(url) END, pos) AS new_hash
      FROM sitemap_main GROUP BY url) m LEFT JOIN crawl_state s ON m.url = s.url""",
    "lastmod_changed": """
SELECT m.url, s.lastmod AS old_lastmod, m.lastmod FROM merged m JOIN crawl_state s ON m.url = s.url
WHERE m.lastmod IS NOT NULL AND (s.lastmod IS NULL OR m.lastmod > s.lastmod)""",

    # Whole jobs
    "sitemap_refresh": """
SELECT count(*) AS total, count(*) FILTER (WHERE status = 'pending') AS pending,
       count(*) FILTER (WHERE status = 'done') AS done, count(*) FILTER (WHERE status = 'error') AS error
FROM (SELECT url, status FROM crawl_state
      UNION ALL SELECT url, 'pending' FROM refreshed WHERE url NOT IN (SELECT url FROM crawl_state)) t""",
    "check_new": """
SELECT (SELECT count(*) FROM main_articles) AS main_count, (SELECT count(*) FROM news_articles) AS news_count,
       count(*) AS total_found, (SELECT count(*) FROM crawl_state) AS tracked,
       count(*) FILTER (WHERE s.url IS NULL) AS new_count, count(*) FILTER (WHERE s.url IS NOT NULL) AS done_count
FROM merged m LEFT JOIN (SELECT url FROM crawl_state WHERE crawled_at IS NOT NULL) s ON m.url = s.url""",
    "crawl_cycle": f"""
SELECT url, status, batch_id, content_hash, error_message, scrape_count FROM ({_run_urls()}) r""",
    # URLs that wait after the resets take the outcome of their fetch.
    "crawl_cycle_full": f"""
SELECT s.url,
       CASE WHEN r.crawled THEN CASE WHEN coalesce(s.scrape_count, 0) + 1 >= 3 THEN 'error' ELSE 'pending' END
            ELSE s.status END AS status,
       s.batch_id, s.content_hash, CASE WHEN r.crawled THEN r.error_message ELSE s.error_message END AS error_message,
       CASE WHEN r.crawled THEN CAST(coalesce(s.scrape_count, 0) + 1 AS INT) ELSE s.scrape_count END AS scrape_count
FROM (SELECT url, CASE WHEN status = 'done' OR status = 'error' AND coalesce(scrape_count, 0) < 5
                       THEN 'pending' ELSE status END AS status,
             CASE WHEN status = 'done' THEN NULL ELSE batch_id END AS batch_id, content_hash,
             CASE WHEN status = 'error' AND coalesce(scrape_count, 0) < 5 THEN NULL ELSE error_message END AS error_message,
             scrape_count
      FROM crawl_state) s
LEFT JOIN ({_run_urls()}) r ON s.url = r.url AND s.status = 'pending'
UNION ALL
SELECT url, status, batch_id, content_hash, error_message, scrape_count
FROM ({_run_urls()}) r WHERE url NOT IN (SELECT url FROM crawl_state)""",
    "record_run": f"""
SELECT * FROM checkpoints
UNION ALL
SELECT 'run', 'full', 'completed', TIMESTAMP '2024-03-01 00:00:00', TIMESTAMP '2024-03-01 01:00:00', CAST(0 AS BIGINT),
       count(*), count(*) FILTER (WHERE status = 'done'), count(*) FILTER (WHERE status <> 'done')
FROM ({_run_urls()}) r WHERE crawled""",
}
_WORD = re.compile(r"\b[a-z_]+\b")


def _with_views(sql: str) -> str:
    """``sql`` behind the derived tables it needs, in dependency order."""
    needed: list[str] = []

    def need(text: str) -> None:
        for name in _WORD.findall(text):
            if name in VIEWS and name not in needed:
                need(VIEWS[name])
                needed.append(name)

    need(sql)
    if not needed:
        return sql
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    return f"WITH {ctes}\n{sql}"


# A state rewritten by buckets is the same state.
ORACLES |= {f"{name}_in_place": ORACLES[full] for name, full in (
    ("insert", "insert_if_absent"), ("mark_done", "mark_done"), ("mark_error", "mark_error"))}


def oracle_sql() -> dict[str, str]:
    return {name: _with_views(sql) for name, sql in ORACLES.items()}
