"""Joining the parts of a record that come from different captures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsluice.functions.text import first_filled


def feed_left_join(records: DataFrame, feed: DataFrame) -> DataFrame:
    """Feed columns next to every record, joined on the exact URL.

    ``feed`` has one row per ``url``; its other columns get the prefix ``feed_``.
    Spark broadcasts the feed only if its measured size allows.
    """
    renamed = feed.select("url", *[F.col(c).alias(f"feed_{c}") for c in feed.columns if c != "url"])
    return records.join(renamed, "url", "left")


def assemble_ge(cards: DataFrame, details: DataFrame, feed: DataFrame) -> DataFrame:
    """Records out of listing cards, detail pages and the feed.

    Title: detail, card, feed; day: detail, feed. A card without a detail page
    has no record.
    """
    detail = details.select(
        "url", F.col("title").alias("_title"), F.col("description").alias("_description"), "posting_date", "date_limite"
    )
    rows = feed_left_join(cards.join(detail, "url"), feed)
    rest = [c for c in cards.columns if c not in ("url", "title", "departement", "taux", "remuneration", "source")]
    return rows.select(
        *rest,
        first_filled(F.col("_title"), F.col("title"), F.col("feed_title")).alias("title"),
        "departement",
        "taux",
        "remuneration",
        F.col("_description").alias("description"),
        F.col("feed_summary").alias("summary"),
        first_filled(F.col("posting_date"), F.col("feed_posting_date")).alias("posting_date"),
        "date_limite",
        "url",
        F.lit("ge").alias("source"),
    )
