"""RSS feeds."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsluice.functions.dates import rfc2822_day
from jobsluice.functions.html import with_text
from jobsluice.functions.text import strip, with_clean_text


# The usual limits of the texts of a feed.
FEED_LIMITS = {"title": 240, "summary": 1200}


def rss_items(docs: DataFrame, limits: Mapping[str, int] | None = None) -> DataFrame:
    """Items of feeds held as text: ``url``, ``title``, ``posting_date``, ``summary``.

    ``docs`` has ``path`` and ``text``. Items without a link are dropped, of a
    repeated link the last item stays. ``limits`` (such as ``FEED_LIMITS``) cuts the
    texts, None keeps them whole.
    """
    elements = F.regexp_extract_all("text", F.lit(r"(?s)<item[\s>].*?</item\s*>"), F.lit(0))
    items = docs.select("path", F.posexplode(elements).alias("pos", "_xml"))
    fields = "link string, title string, pubDate string, description string"
    items = items.withColumn("_item", F.from_xml("_xml", fields)).select(
        "path",
        "pos",
        strip(F.col("_item.link")).alias("url"),
        F.col("_item.title").alias("title"),
        strip(F.col("_item.pubDate")).alias("_date"),
        F.col("_item.description").alias("summary"),
    )
    items = items.filter(F.col("url") != "")
    rest = [c for c in items.columns if c != "url"]
    last = items.groupBy("url").agg(F.max_by(F.struct(*rest), F.struct("path", "pos")).alias("_row"))
    rows = last.select("url", "_row.*").withColumn("posting_date", rfc2822_day(F.col("_date")))
    rows = with_text(rows, F.col("summary"), "summary")
    rows = with_clean_text(rows, {name: (limits or {}).get(name) for name in FEED_LIMITS})
    return rows.select("url", "title", "posting_date", "summary")
