"""URL rules."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Fixed values.
NON_ARTICLE_PATTERNS = (
    r"/tag/",
    r"/author/",
    r"/page/",
    r"/feed",
    r"/feed/",
    r"/comment-page",
    r"\?",
    r"#",
    r"/category/",
    r"/search/",
    r"/archives/",
    r"/sitemap",
    r"/wp-json",
)

# Fixed values.
ARTICLE_PATTERNS = (
    r"/\d{4}/\d{2}/",
    r"/news/",
    r"/politics/",
    r"/business/",
    r"/sports/",
    r"/culture/",
    r"/technology/",
)

ANY_HOST = r"://[^/]+"


# A pattern that shows plainly which character every match starts with.
_PLAIN_START = re.compile(r"(?:([\w/#-])|\\(\W))(?![*+?{])[^|]*")


def any_of(patterns: Sequence[str]) -> str:
    """One Java pattern for all; ``\\d`` widened to every decimal digit of Unicode.

    Where the patterns show their first character, a look at that character
    passes over most positions of a URL before any alternative is tried.
    """
    starts = [m and (m[1] or m[2]) for m in map(_PLAIN_START.fullmatch, patterns)]
    slashed = [p[1:] for p, start in zip(patterns, starts) if start == "/" and p[0] == "/"]
    parts = [p for p, start in zip(patterns, starts) if not (start == "/" and p[0] == "/")]
    if slashed:
        parts.append(f"/(?:{'|'.join(slashed)})")
    pattern = "|".join(parts)
    if all(starts):
        first = "".join(re.escape(c) for c in sorted(set(starts)))
        pattern = f"(?=[{first}])(?:{pattern})"
    return pattern.replace(r"\d", r"\p{Nd}")


def url_matches(url: Column, patterns: Sequence[str]) -> Column:
    """Does any pattern occur in the lower-cased URL?"""
    if not patterns:
        return F.lit(False)
    return F.lower(url).rlike(any_of(patterns))


def is_article_url(
    url: Column,
    reject: Sequence[str] = NON_ARTICLE_PATTERNS,
    accept: Sequence[str] = ARTICLE_PATTERNS,
) -> Column:
    """Rejecting patterns win over accepting ones; no match at all is a reject."""
    return ~url_matches(url, reject) & url_matches(url, accept)


def url_section(url: Column, host: str = ANY_HOST) -> Column:
    """Second path segment, capitalised, when a further ``/`` follows it."""
    segment = F.nullif(
        F.regexp_extract(url, f"{host}/[^/]+/([^/]+)/", 1), F.lit(""))
    return F.concat(
        F.upper(F.substring(segment, 1, 1)),
        F.lower(F.substr(segment, F.lit(2))))
