"""Row filters: recency, language, blank keys, pending records."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsluice.functions import language as lang
from jobsluice.functions.dates import age_days, iso_day
from jobsluice.functions.text import strip


def is_recent(day_text: Column, as_of: date, max_days: int | None) -> Column:
    """True inside the window ``0 <= age <= max_days``; no limit keeps everything."""
    if not max_days or max_days <= 0:
        return F.lit(True)
    return F.coalesce(age_days(as_of, iso_day(day_text)).between(0, max_days), F.lit(False))


def within_days(df: DataFrame, as_of: date, max_days: int | None, column: str = "posting_date") -> DataFrame:
    return df.filter(is_recent(F.col(column), as_of, max_days))


def with_age(df: DataFrame, as_of: date, column: str = "posting_date") -> DataFrame:
    """Add ``days_ago``, NULL where the day does not parse."""
    return df.withColumn("days_ago", age_days(as_of, iso_day(F.col(column))))


def with_language_flag(df: DataFrame, test: str | None, name: str = "lang_ok") -> DataFrame:
    """Add ``name``: the record passes the language test ``fr_en``, ``fr`` or none."""
    title, description = F.col("title"), F.col("description")
    if test is None:
        passed = F.lit(True)
    elif test == "fr_en":
        passed = lang.reads_as_french_or_english(title, description)
    else:
        passed = lang.reads_as_french(title, description)
        if "language_codes" in df.columns:
            tagged = F.exists("language_codes", lambda code: F.lower(code) == "fr")
            passed = F.coalesce(tagged, F.lit(False)) | passed
    return df.withColumn(name, passed)


def french_or_english(df: DataFrame) -> DataFrame:
    """Keep records whose title and description read as French or English."""
    return with_language_flag(df, "fr_en", "_keep").filter("_keep").drop("_keep")


def french(df: DataFrame) -> DataFrame:
    """Keep records tagged ``fr`` in ``language_codes``, or reading as French."""
    return with_language_flag(df, "fr", "_keep").filter("_keep").drop("_keep")


def drop_blank_key(df: DataFrame, key: str = "url") -> DataFrame:
    """Drop rows whose trimmed key is empty; the key is left trimmed."""
    return df.withColumn(key, strip(F.col(key))).filter(F.col(key) != "")


def is_labelled(professions: Column, strip_blanks: bool = True) -> Column:
    """True if a record already has labels; ``strip_blanks=False`` lets blanks count."""
    text = F.coalesce(professions, F.lit(""))
    return (strip(text) if strip_blanks else text) != ""


def is_pending(force_all: bool = False, retry_errors: bool = False, strip_blanks: bool = True) -> Column:
    """Condition for the records that go to the classifier."""
    if force_all:
        return F.lit(True)
    todo = ~is_labelled(F.col("professions"), strip_blanks)
    if not retry_errors:
        todo = todo & (strip(F.coalesce(F.col("professions_error"), F.lit(""))) == "")
    return todo


def pending_rows(df: DataFrame, **flags: bool) -> DataFrame:
    return df.filter(is_pending(**flags))
