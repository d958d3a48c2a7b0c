"""The unified record, output layouts and the policies of the sources."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

JOB_SCHEMA = """
    id BIGINT, source STRING, url STRING, external_id STRING, title STRING, company STRING, location STRING,
    postal_code STRING, canton STRING, departement STRING, taux STRING, remuneration STRING, workload STRING,
    contract_type STRING, contract_time STRING, salary STRING, salary_min DOUBLE, salary_max DOUBLE,
    posting_date STRING, expiry_date STRING, date_limite STRING, days_ago INT, rav_exclusive BOOLEAN,
    language_codes ARRAY<STRING>, description STRING, summary STRING,
    professions STRING, professions_error STRING
"""

# The columns of the CSV output of each source.
CSV_LAYOUTS = {
    "jobup": "id title company location posting_date url description".split(),
    "talent": "id title company location posting_date url source description".split(),
    "ge": (
        "id source title departement taux remuneration posting_date date_limite url description summary"
    ).split(),
    "jobroom": (
        "id source title company location canton posting_date expiry_date workload contract_type rav_exclusive "
        "url description"
    ).split(),
    "adzuna": (
        "id source title company location posting_date salary_min salary_max contract_time contract_type url "
        "description"
    ).split(),
}


@dataclass(frozen=True)
class Policy:
    """How the generic run treats one source."""

    source: str
    record_key: bool = False  # key on URL or title|company|location instead of URL alone
    fresh_days: bool = True  # recency limit on new records
    output_days: bool = True  # recency limit on the written table
    language: str | None = None  # "fr_en" on both sides of the merge, "fr" on new records
    streak: str | None = "a"  # variant of the known-streak cut
    stop_after_known: int = 120
    seen: str = "all"  # which keys the next run knows: all, merged, persisted, fresh
    backfill_ids: bool = True
    days: int = 30
    page_size: int | None = None


# The defaults of the sources.
POLICIES = {
    p.source: p
    for p in (
        Policy("jobup", fresh_days=False, stop_after_known=200),
        Policy("talent", output_days=False, language="fr_en", seen="merged"),
        Policy("ge", seen="persisted"),
        Policy("jobroom", language="fr", streak="b", page_size=25),
        Policy("adzuna", streak="b"),
        Policy("indeed", record_key=True, fresh_days=False, output_days=False, streak=None, seen="fresh",
               backfill_ids=False),
        Policy("linkedin", record_key=True, fresh_days=False, output_days=False, streak=None, seen="fresh",
               backfill_ids=False),
    )
}


def to_job_schema(df: DataFrame) -> DataFrame:
    """Give a source's records the unified columns; missing ones are NULL."""
    empty = df.sparkSession.createDataFrame([], JOB_SCHEMA)
    present = {f.name: f.dataType for f in empty.schema.fields}
    known = df.select([F.col(c).cast(present[c]).alias(c) for c in df.columns if c in present])
    return empty.unionByName(known, allowMissingColumns=True)


# Bits of a position that hold the place on the page.
PLACE_BITS = 20


def listing_order(page_no: Column, pos: Column) -> Column:
    """One sortable position out of page number and place on the page.

    A page has room for 2^20 places; a place beyond them is an error and never meets the next page.
    """
    place = pos.cast("bigint")
    too_far = F.raise_error(F.concat(F.lit("place on a listing page is out of range: "), place.cast("string")))
    ord_ = F.shiftleft(page_no.cast("bigint"), PLACE_BITS) + place
    return F.when((place < 0) | (place >= 1 << PLACE_BITS), too_far.cast("bigint")).otherwise(ord_)
