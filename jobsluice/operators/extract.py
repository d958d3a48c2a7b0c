"""Records out of captured pages."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsluice.functions import html as H
from jobsluice.functions import variant as V
from jobsluice.functions.binding import bind
from jobsluice.functions.dates import DEADLINE_LABELS, POSTING_LABELS, before_t, labelled_day
from jobsluice.functions.text import (
    WS,
    filled,
    first_filled,
    mapped,
    strip,
    unescape,
    with_clean_text,
)
from jobsluice.functions.urls import SiteRule, absolute_url, clean_href, drop_fragment, is_detail_url

# A link to a department, and the wording of a listing card.
DEPARTMENT_LINK = r"/(organisation|justice\.ge\.ch)"
WORKLOAD_TEXT = (
    rf"(?iu)Taux d.?activit[eé]{WS}*({WS[:-1]}0-9%a-zA-Z.,\-]+?)(?:R[ée]mun[ée]ration|Classe|$)"
)
CLASS_TEXT = rf"(?iu)classe{WS}*([0-9]+)"
PAY_TEXT = rf"(?iu)R[ée]mun[ée]ration{WS}*([^|]+)"

# The keys under which one site nests its structured data.
GRAPH_KEYS = ("@graph", "graph", "itemListElement")


def page_links(pages: DataFrame, origin: str, carry: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Every link of a page: the carried columns, ``pos`` (0-based) and absolute ``url`` without fragment."""
    tags = H.start_tags(H.visible_markup(F.col("html")), "a")
    hrefs = F.filter(F.transform(tags, lambda tag: H.attribute(tag, "href")), lambda href: href.isNotNull())
    found = pages.select(*carry, F.posexplode(hrefs).alias("pos", "href"))
    found = found.withColumn("href", unescape(F.col("href")))

    def resolve(href: Column) -> Column:
        return F.when(href != "", drop_fragment(absolute_url(href, origin)))

    url = bind(clean_href(F.col("href")), resolve)
    return found.withColumn("url", url).drop("href").filter(F.col("url").isNotNull())


def detail_links(pages: DataFrame, rule: SiteRule, carry: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Links of a page that are detail pages under the rule, repeats included."""
    return page_links(pages, rule.origin, carry).filter(is_detail_url(F.col("url"), rule))


def extract_links(pages: DataFrame, rule: SiteRule) -> DataFrame:
    """Distinct detail links with the first page and place they occur at.

    Only ``(url, page_id, pos)`` is shuffled, never the markup.
    """
    first = detail_links(pages, rule).groupBy("url").agg(F.min(F.struct("page_id", "pos")).alias("_first"))
    return first.select("url", "_first.page_id", F.col("_first.pos").cast("bigint").alias("pos"))


def listing_cards(
    pages: DataFrame, rule: SiteRule, carry: tuple[str, ...] = ("page_id",), limits: Mapping[str, int] | None = None
) -> DataFrame:
    """Listing cards: ``li`` elements holding a link to a detail page.

    The first matching link names the card; title is the text of its first link.
    Per page and URL the first card wins, so an outer ``li`` beats a nested one.
    ``limits`` (such as ``CARD_LIMITS``) cuts the texts, None keeps them whole.
    """
    card = pages.select(*carry, F.posexplode(H.elements(F.col("html"), "li")["li"]).alias("pos", "_card"))
    card = card.withColumn("_html", H.visible_markup(F.col("_card")))
    # An anchor with its own text, up to its end tag or the end of the card.
    anchors = F.regexp_extract_all(F.col("_html"), F.lit(r"(?is)<a[\s/][^>]*>.*?(?:</a\s*>|\z)"), F.lit(0))
    card = card.withColumn("_links", F.filter(anchors, lambda a: H.attribute(_attrs(a), "href").isNotNull()))
    hrefs = F.transform("_links", lambda a: H.attribute(_attrs(a), "href"))
    card = card.withColumn("_hrefs", hrefs)
    card = card.withColumn("href", F.get(F.filter("_hrefs", lambda h: h.rlike(rule.card_link)), F.lit(0)))
    card = card.filter(F.col("href").isNotNull()).withColumn("href", unescape(F.col("href")))
    card = card.withColumn("href", clean_href(F.col("href")))
    card = card.withColumn("url", drop_fragment(absolute_url(F.col("href"), rule.origin)))
    card = card.filter(is_detail_url(F.col("url"), rule))
    department = F.filter("_links", lambda a: F.coalesce(H.attribute(_attrs(a), "href").rlike(DEPARTMENT_LINK), F.lit(False)))
    card = card.withColumns({"_title": F.get("_links", F.lit(0)), "_dept": F.get(department, F.lit(0))})
    for source, name in (("_title", "title"), ("_dept", "departement"), ("_html", "_text")):
        card = H.with_text(card, F.col(source), name, squeeze=False)
    pay_class = F.regexp_extract("_text", CLASS_TEXT, 1)
    card = card.withColumns(
        {
            "taux": F.regexp_extract("_text", WORKLOAD_TEXT, 1),
            "_pay": F.regexp_extract("_text", PAY_TEXT, 1),
            "_class": F.when(pay_class != "", F.concat(F.lit("classe "), pay_class)),
        }
    )
    card = card.withColumnRenamed("_pay", "remuneration")
    card = with_clean_text(card, _limits(CARD_LIMITS, limits))
    fields = F.struct("pos", "title", "departement", "taux", F.coalesce("_class", "remuneration").alias("remuneration"))
    first = card.groupBy(*carry, "url").agg(F.min_by(fields, "pos").alias("_card"))
    return first.select(*carry, "url", "_card.*").withColumn("pos", F.col("pos").cast("bigint"))


def _attrs(tag: Column) -> Column:
    return F.regexp_extract(tag, r"(?is)^<[a-z][^\s>/]*([^>]*)>", 1)


def _postings(scripts: list[str], keys: tuple[str, ...] | None) -> Iterator[dict]:
    """JobPosting nodes of the scripts, parents before children, in source order."""
    for script in scripts:
        try:
            todo = [json.loads(script)]
        except (ValueError, RecursionError):
            continue
        while todo:
            node = todo.pop()
            if isinstance(node, list):
                todo.extend(reversed(node))
            elif isinstance(node, dict):
                if str(node.get("@type") or "").lower() == "jobposting":
                    yield node
                children = node.values() if keys is None else [node.get(k) for k in keys]
                todo.extend(child for child in reversed(list(children)) if isinstance(child, (dict, list)))


def first_posting(scripts: Column, keys: tuple[str, ...] | None) -> Column:
    """JSON of the first JobPosting node in an array of scripts, NULL if none.

    Source order of the keys decides which node is first; a VARIANT sorts its
    keys, so the walk runs on the parsed text. ``keys`` limits the walk to the
    children under those keys, None walks every value.
    """

    @F.arrow_udf("string")
    def pick(pages: pa.Array) -> pa.Array:
        def one(found: list[str] | None) -> str | None:
            node = None if found is None else next(_postings(found, keys), None)
            return None if node is None else json.dumps(node, ensure_ascii=False)

        return mapped(pages, one, pa.string())

    hinted = F.filter(scripts, lambda s: F.contains(F.lower(s), F.lit("jobposting")) | F.contains(s, F.lit("\\u")))
    return pick.asNondeterministic()(F.when(F.size(hinted) > 0, scripts))


def ldjson_jobposting(
    pages: DataFrame, keys: tuple[str, ...] | None, limits: Mapping[str, int | None], cut_date: bool = False
) -> DataFrame:
    """Add title, company, location, description and posting_date of the embedded JobPosting.

    ``limits`` names the texts to clean and how long each may get, None for any length. ``ok`` is false where a text
    that must be cleaned is no string: such a page counts as a failed fetch.
    """
    found = pages.withColumn("_node", first_posting(H.ld_json_scripts(F.col("html")), keys))
    found = found.withColumn("_node", F.try_parse_json("_node"))
    node = F.col("_node")
    address = "$.jobLocation.address"
    paths = {
        "title": ("$.title",),
        "company": ("$.hiringOrganization.name",),
        "location": (f"{address}.addressLocality", f"{address}.addressRegion"),
        "description": ("$.description",),
        "posting_date": ("$.datePosted",),
    }
    # A path through a value that is no object gives NULL.
    found = V.with_truthy_texts(found, "_node", paths)
    checked = {f"_kind{n}": V.kind(V.child(node, p)) for n, name in enumerate(limits) for p in paths[name][:1]}
    region = V.kind(V.child(node, f"{address}.addressRegion"))
    found = found.withColumns({**checked, "_region": region})
    ok = F.lit(True)
    for n, name in enumerate(limits):
        kind = F.col(f"_kind{n}")
        if name == "location":
            first = V.truthy_text(node, paths[name][0]).isNotNull()
            kind = F.when(first, kind).otherwise(F.col("_region"))
        ok = ok & (F.col(name).isNull() | (kind == "STRING"))
    found = found.withColumn("ok", F.coalesce(ok, F.lit(True))).drop("_node", "_region", *checked)
    found = with_clean_text(found, limits)
    if "posting_date" not in limits:
        found = found.withColumn("posting_date", strip(F.col("posting_date")))
        found = found.withColumn("posting_date", filled(F.col("posting_date")))
    if cut_date:
        found = found.withColumn("posting_date", before_t(F.col("posting_date")))
    return found


# Which texts of the embedded JobPosting are cleaned per site, and the usual limits of
# these and other texts. Nothing is cut unless limits are passed.
POSTING_LIMITS = {
    "jobup": {"title": 180, "company": 140, "location": 120, "description": 1200, "posting_date": 32},
    "talent": {"title": 180, "company": 160, "location": 120, "description": 3500},
}
CARD_LIMITS = {"title": 240, "departement": 160, "taux": 120, "remuneration": 120}
PAGE_LIMITS = {"title": 240, "description": 2200}


def _limits(usual: Mapping[str, int], limits: Mapping[str, int] | None) -> dict[str, int | None]:
    """A limit for every text of ``usual``: the given one, or None."""
    return {name: (limits or {}).get(name) for name in usual}


def meta_property(pages: DataFrame, prop: str, name: str) -> DataFrame:
    """Add ``name``: the trimmed content of a ``meta`` property, NULL if the page has none."""
    return pages.withColumn(name, strip(H.meta_content(F.col("html"), prop)))


def detail_record_graph(pages: DataFrame, limits: Mapping[str, int] | None = None) -> DataFrame:
    """Detail record of a site with a JSON graph; ``og:`` properties fill title and description."""
    limits = _limits(POSTING_LIMITS["jobup"], limits)
    rec = ldjson_jobposting(pages, GRAPH_KEYS, limits)
    rec = meta_property(rec, "og:title", "_og_title")
    rec = meta_property(rec, "og:description", "_og_description")
    rec = with_clean_text(rec, {"_og_title": limits["title"], "_og_description": limits["description"]})
    rec = rec.withColumns(
        {
            "title": first_filled(F.col("title"), F.col("_og_title")),
            "description": first_filled(F.col("description"), F.col("_og_description")),
            "posting_date": filled(before_t(strip(F.col("posting_date")))),
        }
    )
    return rec.drop("_og_title", "_og_description", "html")


def detail_record_nested(
    pages: DataFrame, source: str = "talent", limits: Mapping[str, int] | None = None
) -> DataFrame:
    """Detail record of a site with a JobPosting at any depth."""
    rec = ldjson_jobposting(pages, None, _limits(POSTING_LIMITS["talent"], limits), cut_date=True)
    return rec.withColumn("source", F.lit(source)).drop("html")


def page_detail(pages: DataFrame, limits: Mapping[str, int] | None = None) -> DataFrame:
    """Detail record of a page without structured data: headline, first long paragraph, dates."""
    parts = H.elements(F.col("html"), "main", "article", "h1", "p", outermost=True)
    rec = pages.withColumn("_parts", parts)
    # A paragraph inside another one is never the first long one, so outermost ones are enough.
    rec = rec.withColumns(
        {
            "_main": F.coalesce(*[F.get(F.col("_parts")[tag], F.lit(0)) for tag in ("main", "article")], F.col("html")),
            "title": F.get(F.col("_parts")["h1"], F.lit(0)),
            "_paras": F.col("_parts")["p"],
        }
    ).drop("_parts")
    rec = H.with_text(rec, F.col("_main"), "_text", squeeze=False)
    rec = H.with_text(rec, F.col("title"), "title")
    rec = H.with_texts(rec, F.col("_paras"), "_paras")
    rec = rec.withColumn("description", F.get(F.filter("_paras", lambda p: F.length(p) > 80), F.lit(0)))
    rec = with_clean_text(rec, _limits(PAGE_LIMITS, limits))
    rec = rec.withColumns(
        {
            "posting_date": labelled_day(F.col("_text"), POSTING_LABELS),
            "date_limite": labelled_day(F.col("_text"), DEADLINE_LABELS),
        }
    )
    return rec.drop("html", "_main", "_paras", "_text")


def total_pages_reported(html: Column) -> Column:
    """Page count a listing page reports, at least 1; NULL if it reports none."""
    named = [F.regexp_extract(html, rf'"{name}"{WS}*:{WS}*([0-9]+)', 1) for name in ("totalPages", "total_pages")]
    count = F.coalesce(*[filled(n) for n in named]).try_cast("bigint")
    return F.when(count.isNotNull(), F.greatest(F.lit(1), count))


def total_pages_linked(html: Column) -> Column:
    """Largest page number in the paging links, NULL if none is above 1."""
    numbers = F.regexp_extract_all(html, F.lit(r"[?&]p=([0-9]+)"), F.lit(1))
    largest = F.array_max(F.transform(numbers, lambda n: n.try_cast("bigint")))
    return F.when(largest > 1, largest)
