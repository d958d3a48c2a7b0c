"""HTML columns: visible text, elements, attributes."""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsluice.functions.text import collapse, mapped, strip, unescape

# Elements without content, and elements whose content is no text.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = "script|style|template"

_HIDDEN = rf"(?is)<!--.*?(?:-->|\z)|<({HIDDEN_TAGS})\b.*?(?:</\1\s*>|\z)"
# Inside a tag a quote counts only after "=".
_IN_TAG = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
_TAG = rf"(?s)<[a-zA-Z]{_IN_TAG}>|</[a-zA-Z][^>]*+>|<[!?][^>]*+>"
_NODE, _PART = "\x02", "\x01"
_LD_TYPE = r"""(?:"application/ld\+json"|'application/ld\+json'|application/ld\+json(?=[\s>]))"""
_LD_JSON = (
    rf"""(?is)<!--.*?(?:-->|\z)|<script\b[^>]*?\stype\s*=\s*{_LD_TYPE}[^>]*>(.*?)</script\s*>"""
    r"""|<(?:script|style)\b.*?(?:</(?:script|style)\s*>|\z)"""
)


def visible_markup(c: Column) -> Column:
    """Markup without comments, scripts, styles and templates."""
    return F.regexp_replace(c, _HIDDEN, " ")


def with_text(df: DataFrame, source: Column, name: str, squeeze: bool = True) -> DataFrame:
    """Add ``name``: the text of an HTML column, one space between text nodes.

    Tags are cut before references are decoded, so an escaped ``<`` stays text.
    ``squeeze=False`` keeps whitespace inside a text node as it is. NULL and empty
    input give the empty string.
    """
    bare = df.withColumn(name, F.regexp_replace(visible_markup(source), _TAG, " " if squeeze else _NODE))
    decoded = bare.withColumn(name, unescape(F.col(name)))
    text = collapse(F.col(name)) if squeeze else _join_nodes(F.col(name))
    return decoded.withColumn(name, F.coalesce(text, F.lit("")))


def _join_nodes(text: Column) -> Column:
    nodes = F.transform(F.split(text, _NODE), strip)
    return F.array_join(F.filter(nodes, lambda node: node != ""), " ")


def with_texts(df: DataFrame, source: Column, name: str) -> DataFrame:
    """Add ``name``: the texts of an array of HTML values, as ``with_text(squeeze=False)``."""
    bare = F.transform(source, lambda part: F.regexp_replace(visible_markup(part), _TAG, _NODE))
    # One string, so that references are decoded once per row.
    packed = df.withColumn(name, F.array_join(bare, _PART))
    decoded = packed.withColumn(name, unescape(F.col(name)))
    return decoded.withColumn(name, F.transform(F.split(F.col(name), _PART), _join_nodes))


def start_tags(markup: Column, tag: str) -> Column:
    """Attribute text of every start tag of one name, in document order."""
    return F.regexp_extract_all(markup, F.lit(rf"(?is)<{tag}(?=[\s/])({_IN_TAG})>"), F.lit(1))


def attribute(attrs: Column, name: str) -> Column:
    """Value of one attribute inside a start tag, NULL if it is missing or empty."""
    value = r"""(?:"[^"]*"|'[^']*'|[^\s>"']+)"""
    before = rf"""(?:[\s/]*(?!{name}[\s=])[^\s=>/"']++(?:\s*=\s*{value})?)*?"""
    raw = F.regexp_extract(attrs, rf"(?is)^{before}[\s/]*{name}\s*=\s*({value})", 1)
    return F.nullif(F.regexp_replace(raw, r"""^["']|["']$""", ""), F.lit(""))


def ld_json_scripts(html: Column) -> Column:
    """Bodies of the ``application/ld+json`` scripts in document order, blank ones left out."""
    bodies = F.regexp_extract_all(html, F.lit(_LD_JSON), F.lit(1))
    return F.filter(bodies, lambda body: F.length(F.trim(body)) > 0)


def meta_content(html: Column, prop: str) -> Column:
    """Content of the first ``meta`` whose property comes before its content; NULL if none."""
    escaped = re.escape(prop)
    pattern = rf"""(?i)<meta[^>]+property=["']{escaped}["'][^>]+content=["']([^"']+)["']"""
    return F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))


_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style)\b.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*){_IN_TAG}>",
    re.IGNORECASE | re.DOTALL,
)


def _element_spans(html: str, wanted: frozenset[str]) -> list[tuple[int, int, str]]:
    """(start, end, tag) of the wanted elements; unclosed ones end with their parent."""
    spans: list[tuple[int, int, str]] = []
    open_tags: list[tuple[str, int]] = []
    n_open: Counter[str] = Counter()

    def close_last(end: int) -> str:
        name, start = open_tags.pop()
        n_open[name] -= 1
        if name in wanted:
            spans.append((start, end, name))
        return name

    for token in _TOKEN.finditer(html):
        name = (token["name"] or "").lower()
        if not name or (not token["close"] and name in VOID_TAGS):
            continue
        if not token["close"]:
            open_tags.append((name, token.start()))
            n_open[name] += 1
            if token[0].endswith("/>"):
                close_last(token.end())
        elif n_open[name]:
            while close_last(token.start()) != name:
                pass
    while open_tags:
        close_last(len(html))
    return sorted(spans)


def elements(html: Column, *tags: str, outermost: bool = False) -> Column:
    """map<tag, array<markup>>: all elements of the named tags in document order.

    Follows the nesting rules of a lenient parser, which a regular expression
    cannot: an unclosed element runs to the end of its parent, an end tag closes
    everything opened after its start tag. ``outermost`` leaves out elements
    inside an element of the same tag.
    """
    wanted = frozenset(tags)

    @F.arrow_udf("map<string,array<string>>")
    def collect(pages: pa.Array) -> pa.Array:
        def one(page: str | None) -> list[tuple[str, list[str]]]:
            found: dict[str, list[str]] = {tag: [] for tag in wanted}
            reach = dict.fromkeys(wanted, -1)
            for start, end, tag in _element_spans(page or "", wanted):
                if outermost and start < reach[tag]:
                    continue
                reach[tag] = max(reach[tag], end)
                found[tag].append(page[start:end])
            return list(found.items())

        kind = pa.map_(pa.string(), pa.list_(pa.string()))
        return mapped(pages.fill_null(""), one, kind)

    return collect.asNondeterministic()(html)
