"""Text rules as column expressions (all JVM-side).

Whitespace means what Unicode calls whitespace plus the four separators
U+001C..U+001F; Java's ``\\s`` is ASCII only unless told otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# All of it one by one (fixed values), and as a Java pattern.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000")
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
# Control characters that are deleted (fixed values).
CONTROL = r"[\x00-\x08\x0b-\x0c\x0e-\x1f\x{7f}-\x{9f}]"
# What counts as a tag and as a decimal reference (fixed values): a tag, or (group 1) an unclosed one up to the end of the text, which stays.
# Taking that tail in one match keeps texts full of "<" linear.
TAG = r"(<[^>]*+\z)|<[^>]++>"
DECIMAL_REFERENCE = r"&#\p{Nd}+;"

# Decoded one after the other, in this order (fixed values).
ENTITIES = (
    ("&nbsp;", " "),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
)


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def once(col: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(col)`` for an ``fn`` that names its argument several times.

    Binding the value to a lambda makes Spark compute a dear ``col`` once,
    inside conditional expressions too.
    """
    return F.get(F.transform(F.array(col), fn), F.lit(0))


def collapse(col: Column) -> Column:
    """Each run of whitespace becomes one space."""
    return F.regexp_replace(col, WHITESPACE_RUN, " ")


def strip(col: Column) -> Column:
    """Whitespace removed from both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def drop_tags(col: Column) -> Column:
    return F.regexp_replace(col, TAG, "$1")


def _decode(col: Column) -> Column:
    for entity, char in ENTITIES:
        col = F.replace(col, F.lit(entity), F.lit(char))
    return _where_found("&#", col, lambda t: F.regexp_replace(t, DECIMAL_REFERENCE, ""))


def _where_found(mark: str, col: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` for texts that contain ``mark``; finding it is cheaper than a pattern."""
    return once(col, lambda t: F.when(F.contains(t, F.lit(mark)), fn(t)).otherwise(t))


def strip_html(col: Column) -> Column:
    """Markup to one line of text: tags, five entities, decimal references."""
    text = F.regexp_replace(col, TAG, "$1 ")
    return F.trim(collapse(_where_found("&", text, _decode)))


def drop_control(col: Column) -> Column:
    return F.regexp_replace(col, CONTROL, "")


def clean_text(col: Column) -> Column:
    """Whitespace collapsed, control characters deleted, ends trimmed."""
    return F.trim(drop_control(collapse(col)))


def content_hash(col: Column, cleaned: bool = False) -> Column:
    """MD5 of the text without whitespace; empty string when there is no text.

    ``cleaned`` says that the text is the result of a cleaning already.
    """
    packed = F.replace(col if cleaned else clean_text(col), F.lit(" "), F.lit(""))
    return F.when(F.coalesce(col, F.lit("")) == "", F.lit("")).otherwise(F.md5(packed))


def word_count(col: Column) -> Column:
    """Number of whitespace-separated tokens, 0 for null."""
    words = once(F.trim(collapse(col)), lambda t: F.when(t == "", 0).otherwise(
        F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1))
    return F.coalesce(words, F.lit(0))


def truncate(col: Column, n: int) -> Column:
    return F.substring(col, 1, n)
