"""Listing URLs: the (search, page) table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsluice.functions.text import strip


def quote_plus(c: Column) -> Column:
    """Form encoding; only letters, digits and ``_.-~`` stay as they are."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _unquote(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def search_url(base: str, params: Mapping[str, Column]) -> Column:
    """First listing page of a search; a NULL parameter is left out."""
    pairs = [F.when(v.isNotNull(), F.concat(F.lit(f"{name}="), quote_plus(v))) for name, v in params.items()]
    query = F.concat_ws("&", *pairs)
    return F.when(query == "", F.lit(base)).otherwise(F.concat(F.lit(base + "?"), query))


def search_term(c: Column) -> Column:
    """Trimmed search term, NULL if blank."""
    return F.nullif(strip(c), F.lit(""))


def page_url(url: Column, page: Column, param: str = "page", first: int = 1) -> Column:
    """The URL with the page parameter set.

    Page 1 carries no parameter; ``first=0`` counts pages from 0. A repeated
    parameter keeps its first place and its last value, blank values stay.
    """
    head = F.regexp_extract(url, r"^([^?#]*)", 1)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(url, r"^[^#]*(#.+)$", 1)
    parts = F.filter(F.split(query, "&"), lambda p: p != "")
    name = lambda p: _unquote(F.regexp_extract(p, r"^([^=]*)", 1))
    value = lambda p: _unquote(F.regexp_extract(p, r"^[^=]*=(.*)$", 1))
    pairs = F.transform(parts, lambda p: F.struct(name(p).alias("k"), value(p).alias("v")))
    number = F.when(page > 1, (page - 1 + first).cast("string"))
    names = F.array_distinct(F.transform(pairs, lambda kv: kv["k"]))
    names = F.when(number.isNull(), F.filter(names, lambda k: k != param)).otherwise(
        F.array_distinct(F.concat(names, F.array(F.lit(param))))
    )

    def encoded(k: Column) -> Column:
        last = F.element_at(F.filter(pairs, lambda kv: kv["k"] == k), -1)["v"]
        return F.concat(quote_plus(k), F.lit("="), quote_plus(F.when(k == param, number).otherwise(last)))

    text = F.array_join(F.transform(names, encoded), "&")
    return F.concat(head, F.when(text != "", F.concat(F.lit("?"), text)).otherwise(F.lit("")), fragment)


def listing_urls(searches: DataFrame, param: str = "page", first: int = 1) -> DataFrame:
    """One row per search and page. ``searches`` has ``url`` and ``total_pages``."""
    pages = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("total_pages").cast("bigint")))
    rows = searches.withColumn("page_no", pages)
    return rows.withColumn("page_url", page_url(F.col("url"), F.col("page_no"), param, first))
