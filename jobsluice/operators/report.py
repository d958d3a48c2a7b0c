"""Counts a run reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsluice.operators.filters import is_pending, is_recent
from jobsluice.operators.keys import added_keys


def run_report(
    details: DataFrame,
    current: DataFrame,
    merged: DataFrame,
    as_of: date,
    max_days: int | None,
    language: bool = True,
) -> DataFrame:
    """One row: records kept, failed fetches, records out of the window, dropped by language.

    ``details`` has ``ok`` (the page could be read) and ``posting_date``. Dropped by
    language is what was kept but added no key, at least 0, and 0 without the
    language filter.
    """
    recent = is_recent(F.col("posting_date"), as_of, max_days)
    pages = details.select("ok", recent.alias("recent"))
    added = added_keys(current, merged).select(F.lit(None).cast("boolean").alias("ok"), F.lit(True).alias("recent"))
    row = pages.unionByName(added).agg(
        F.count_if(F.col("ok") & F.col("recent")).alias("n_ok"),
        F.count_if(~F.col("ok")).alias("n_errors"),
        F.count_if(F.col("ok") & ~F.col("recent")).alias("n_out_of_window"),
        F.count_if(F.col("ok").isNull()).alias("_added"),
    )
    dropped = F.greatest(F.col("n_ok") - F.col("_added"), F.lit(0)) if language else F.lit(0)
    return row.withColumn("n_language", dropped.cast("bigint")).drop("_added")


def enrich_report(df: DataFrame, **flags: bool) -> DataFrame:
    """One row: all records, records the classifier gets, records skipped."""
    todo = is_pending(**flags)
    return df.agg(
        F.count("*").alias("n_total"), F.count_if(todo).alias("n_processed"), F.count_if(~todo).alias("n_skipped")
    )


def snapshot_header(jobs: DataFrame) -> DataFrame:
    """Per source and canton: records and how many are reserved for registered seekers."""
    flagged = F.count_if(F.coalesce(F.col("rav_exclusive"), F.lit(False)))
    return jobs.groupBy("source", "canton").agg(
        F.count("*").alias("total"), flagged.alias("rav_exclusive_count")
    )
