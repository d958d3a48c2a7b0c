"""Unpacking API payloads."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsluice.functions import variant as V


@dataclass(frozen=True)
class Envelope:
    """Where a payload keeps its items and its total, in the order they are tried."""

    items: Sequence[str]
    totals: Sequence[str] = ()
    bare_list: bool = True


# The envelopes of the API sources.
ENVELOPES = {
    "jobroom": Envelope(("content", "jobs", "results"), ("totalElements", "total")),
    "adzuna": Envelope(("results",), ("count",), bare_list=False),
    "rapidapi": Envelope(("jobs", "data", "result", "results")),
}


def unpack_envelope(payloads: DataFrame, envelope: Envelope) -> DataFrame:
    """One row per item: the carried columns, ``pos``, ``total`` and the VARIANT ``item``.

    ``payloads`` has the text column ``payload``. The first key holding a list
    wins; items that are no objects are dropped; ``total`` is the first integer.
    A payload that is not one JSON value as a whole has no items.
    """
    carry = [c for c in payloads.columns if c != "payload"]
    total, items = _parts(envelope)
    rows = _parsed(payloads).select(*carry, total.alias("total"), F.posexplode(items).alias("pos", "item"))
    return rows.filter(V.is_object(F.col("item"))).withColumn("pos", F.col("pos").cast("bigint"))


def payload_pages(payloads: DataFrame, envelope: Envelope) -> DataFrame:
    """One row per payload: the carried columns, ``total`` and ``n_rows``, its number of items.

    A page without items, or one that cannot be read, is a page with 0 rows: it ends a walk.
    """
    carry = [c for c in payloads.columns if c != "payload"]
    total, items = _parts(envelope)
    n_rows = F.size(F.filter(items, V.is_object)).cast("bigint")
    return _parsed(payloads).select(*carry, total.alias("total"), F.greatest(n_rows, F.lit(0)).alias("n_rows"))


def _parsed(payloads: DataFrame) -> DataFrame:
    return payloads.withColumn("_body", V.strict_json(F.col("payload")))


def _parts(envelope: Envelope) -> tuple[Column, Column]:
    """The total and the list of items of a payload body."""
    body = F.col("_body")
    lists = [V.list_items(body, f"$.{key}") for key in envelope.items]
    if envelope.bare_list:
        lists.append(V.list_items(body, "$"))
    totals = [V.integer_at(body, f"$.{key}") for key in envelope.totals]
    return F.coalesce(*totals, F.lit(None).cast("bigint")), F.coalesce(*lists)
