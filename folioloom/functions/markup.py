"""Finding elements in HTML: the one Arrow function of the package.

Nested elements cannot be matched by a regular expression, so each page goes
once through a small tag scanner.  It reports where the elements chosen by a
list of selectors start and stop; everything done with them afterwards is
column expressions.  Selectors have the form ``[scope ]target``, each part
being ``tag``, ``.class``, ``tag.class``, ``[attr='v']``, ``tag[attr='v']``
or ``tag[attr]``.
"""

from __future__ import annotations

import html as html_lib
import re
import sys
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

ELEMENT_FIELDS = ("content", "title", "src", "data-src", "datetime")
FOUND_TYPE = (
    "struct<elements:array<struct<start:int,length:int,text:string,"
    "content:string,title:string,src:string,`data-src`:string,datetime:string>>,"
    "picks:array<array<int>>,error:string>")
_ARROW_TYPE = pa.struct([
    ("elements", pa.list_(pa.struct(
        [("start", pa.int32()), ("length", pa.int32()), ("text", pa.string())]
        + [(name, pa.string()) for name in ELEMENT_FIELDS]))),
    ("picks", pa.list_(pa.list_(pa.int32()))), ("error", pa.string())])
MAX_ERROR = 500

_PART = re.compile(r"(\w*)(?:\.([\w-]+))?(?:\[(\w+)(?:='([^']*)')?\])?$")
# A whole tag: end mark, name, attributes.  Quotes count after an equals sign only.
_TAG = re.compile(
    r"<(/?)([a-zA-Z][^\s/><]*+)((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=(?!\s*+[\"']))*+)>")
_OPENING = re.compile(r"</?[a-zA-Z]")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in ("script", "style")}
_ATTRIBUTE = re.compile(
    r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_REFERENCE = re.compile(r"&#?\w+;")

# HTML rules (fixed values): elements without an end tag, and start tags that
# end an open paragraph or an open element of their own kind.
VOID = frozenset(
    "area base br col embed hr img input link meta source track wbr".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6"
    " header hr main nav ol p pre section table ul".split())
ENDS_SAME = frozenset("li option tr td th dt dd".split())


def _decoded(text: str) -> str:
    """Character references decoded; one without its semicolon is plain text."""
    return _REFERENCE.sub(lambda m: html_lib.unescape(m[0]), text) if "&" in text else text


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), _decoded("".join(values)))
    return found


def _key(part: str) -> tuple[str, str, str]:
    """What an element must show for a part to match: a key, an attribute, its value."""
    tag, css_class, attr, value = (g or "" for g in _PART.match(part).groups())
    return tag + ("." + css_class if css_class else "") + ("[" + attr if attr else ""), attr, value


def compile_rules(selectors: Sequence[str]) -> tuple:
    """The selectors by the key of their target, the scopes by their own key."""
    targets: dict[str, list[tuple]] = {}
    scopes: dict[str, str] = {}
    names = {"class"}
    for selector in selectors:
        *scope, target = selector.split(" ")
        key, attr, value = _key(target)
        targets.setdefault(key, []).append((selector, attr, value, scope[0] if scope else ""))
        names.update([attr] if attr else [])
        scopes.update((_key(s)[0], s) for s in scope)
    return targets, scopes, names, re.compile("|".join(sorted(names)), re.I)


def read_tags(html: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """Start, stop, whether it is an end tag, lower-case name and attribute text of each tag.

    Comments and the tags of scripts and styles have an empty name.  What lies
    between is text.  A quoted value runs to its next quote, however far.  A comment or a tag
    that never ends takes the rest of the page.  The contents of scripts and
    styles are no markup.  The page is read once from left to right.
    """
    at = html.find("<")
    while at >= 0:
        found = _TAG.match(html, at)
        if not found:
            if html.startswith("<!--", at):
                stop = html.find("-->", at + 4) + 3
                if stop < 3:
                    yield at, len(html), False, "", ""
                    return
                yield at, stop, False, "", ""
                at = html.find("<", stop)
            elif _OPENING.match(html, at):      # a tag that never ends
                return
            else:
                at = html.find("<", at + 1)
            continue
        mark, tag, rest = found.groups()
        stop, end, tag = found.end(), bool(mark), tag.lower()
        if not end and tag in _RAW_END:
            yield at, stop, False, "", ""
            closing = _RAW_END[tag].search(html, stop)
            if not closing:
                return
            at = closing.start()
            stop = html.find(">", at) + 1
            if not stop:
                return
            yield at, stop, False, "", ""
            at = html.find("<", stop)
            continue
        yield at, stop, end, tag, rest
        at = html.find("<", stop)


def closes_itself(rest: str) -> bool:
    """Whether a start tag ends in a slash that is not part of an unquoted value."""
    if not rest.endswith("/"):
        return False
    cut = max(map(rest.rfind, " \t\n\r\f\"'")) + 1
    return "=" not in rest[cut:] and not rest[:cut].rstrip().endswith("=")


def find_elements(html: str, rules: tuple) -> list[dict]:
    """The elements of a page that at least one selector picks.

    Their texts are ``pieces[first:last]`` of the page: what was read between tags
    while they were open.
    """
    targets, scopes, names, asked_for = rules
    found: list[dict] = []
    pieces: list[str] = []
    read = 0
    stack: list[tuple] = []                  # open elements: (tag, record, scopes it opens)
    inside: Counter = Counter({"": 1})       # scopes open at this point

    def close(depth: int, stop: int) -> None:
        while len(stack) > depth:
            _, record, opened = stack.pop()
            if record:
                record["length"], record["last"] = stop - record["start"], len(pieces)
            for scope in opened:
                inside[scope] -= 1

    for start, stop, end, tag, rest in read_tags(html):
        pieces.append(html[read:start])
        read = stop
        if not tag:
            continue
        if end:
            if stack and stack[-1][0] == tag:
                close(len(stack) - 1, stop)
                continue
            for depth in range(len(stack) - 2, -1, -1):
                if stack[depth][0] == tag:
                    close(depth + 1, start)
                    close(depth, stop)
                    break
            continue
        if stack:
            top = stack[-1][0]
            if (top == "p" and tag in ENDS_PARAGRAPH) or (top == tag and tag in ENDS_SAME):
                close(len(stack) - 1, start)
        record, opened, attrs, keys = None, (), {}, (tag,)
        if rest and asked_for.search(rest):
            attrs = _attributes(rest)
            marks = ["." + c for c in attrs.get("class", "").split()]
            marks += ["[" + a for a in attrs if a in names]
            keys = {tag, *marks, *(tag + mark for mark in marks)}
        for key in keys:
            if key in scopes:
                opened += (scopes[key],)
            for selector, attr, value, scope in targets.get(key, ()):
                if inside[scope] and (not value or attrs[attr] == value):
                    if record is None:
                        attrs = attrs or (_attributes(rest) if rest else attrs)
                        record = {"selectors": [], "start": start, "length": stop - start,
                                  "body": stop, "first": len(pieces), "last": len(pieces)}
                        for name in ELEMENT_FIELDS:
                            record[name] = attrs.get(name)
                        found.append(record)
                    record["selectors"].append(selector)
        if tag not in VOID and not closes_itself(rest):
            stack.append((tag, record, opened))
            for scope in opened:
                inside[scope] += 1
    pieces.append(html[read:])
    close(0, len(html))
    for record in found:
        record["pieces"] = pieces
    return found


def elements_function(
    selectors: Sequence[str], text_selectors: Sequence[str], wanted: Sequence[str] | None = None
):
    """An Arrow function from markup to ``struct<elements, picks, error>``.

    Only the ``wanted`` of the selectors are looked for (by default all).
    Null for a null page.  A page that raises has an ``error`` alone.  ``picks[i]`` lists the elements selector ``i`` picks, in document order, as
    positions in ``elements``; it is null when there are none.  ``start``
    counts characters from 0.  ``text`` (character references decoded) is
    filled for elements of ``text_selectors`` only, so that large bodies are
    not copied.  The function is marked non-deterministic: that keeps Spark
    from running the scan a second time inside a filter.
    """
    rules, wants_text = compile_rules(wanted or selectors), frozenset(text_selectors)
    number = {selector: i for i, selector in enumerate(selectors)}

    def scan_page(page: str) -> dict:
        elements = find_elements(page, rules)
        picks: list = [None] * len(number)
        for position, element in enumerate(elements):
            element.pop("body")
            picked, pieces = element.pop("selectors"), element.pop("pieces")
            first, last = element.pop("first"), element.pop("last")
            for selector in picked:
                i = number[selector]
                if picks[i] is None:
                    picks[i] = []
                picks[i].append(position)
            if not wants_text.isdisjoint(picked):
                element["text"] = _decoded("".join(pieces[first:last]))
        return {"elements": elements, "picks": picks, "error": None}

    def kept_apart(page: str | None) -> dict | None:
        """A page that cannot be scanned costs its own row, not the task."""
        if page is None:
            return None
        try:
            return scan_page(page)
        except Exception as problem:
            said = f"{type(problem).__name__}: {problem}"[:MAX_ERROR]
            return {"elements": None, "picks": None, "error": said}

    def scan(pages: pa.Array) -> pa.Array:
        return pa.array([kept_apart(p) for p in pages.to_pylist()], type=_ARROW_TYPE)

    # Ship the scanner itself, so that executors need no copy of this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    scan.__annotations__ = {"pages": pa.Array, "return": pa.Array}
    return F.arrow_udf(scan, FOUND_TYPE).asNondeterministic()
