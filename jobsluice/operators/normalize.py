"""API payload items to flat records. Each input has a VARIANT column ``item``."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsluice.functions import variant as V
from jobsluice.functions.dates import age_days, iso_day
from jobsluice.functions.text import filled, first_chars, strip, stripped

# Languages tried after the preferred one, the address of a detail
# page, the length to which a description is usually cut.
FALLBACK_LANGUAGES = ("fr", "de", "it", "en")
DETAIL_URL = "https://www.job-room.ch/job-search/detail/"
DESCRIPTION_LIMIT = 2500


def _text(v: Column, path: str) -> Column:
    """Stripped text, NULL if the value is falsy or blank."""
    return stripped(V.truthy_text(v, path))


def _or_na(c: Column) -> Column:
    return F.coalesce(c, F.lit("N/A"))


def date_prefix(c: Column) -> Column:
    """The first ten characters of a trimmed date text."""
    return filled(F.substring(strip(c), 1, 10))


def pick_description(items: Column, language: str) -> Column:
    """struct<title, description> out of an array of language versions.

    The first version of the preferred language counts even if it is blank; if
    both of its fields are blank the fallback languages are tried in turn, and
    what is still missing comes from the first element of the array.
    ``items``: array<struct<lang, title, description>>, already stripped, with
    NULL elements for entries that are no objects.
    """

    def version(code: str) -> Column:
        return F.get(F.filter(items, lambda d: d.isNotNull() & (d["lang"] == code)), F.lit(0))

    def usable(d: Column) -> Column:
        return F.when(d["title"].isNotNull() | d["description"].isNotNull(), d)

    tried = (language, *(code for code in FALLBACK_LANGUAGES if code != language))
    best = F.coalesce(*[usable(version(code)) for code in tried])
    first = F.get(items, F.lit(0))
    return F.struct(
        F.coalesce(best["title"], first["title"]).alias("title"),
        F.coalesce(best["description"], first["description"]).alias("description"),
    )


def language_codes(items: Column) -> Column:
    """Sorted distinct language codes; a version without one counts as the empty code."""
    codes = F.transform(F.filter(items, lambda d: d.isNotNull()), lambda d: d["lang"])
    return F.array_sort(F.array_distinct(codes))


def workload_label(low: Column, high: Column) -> Column:
    """``a-b%``, ``b%`` or the empty string; both bounds are numbers or NULL, cut toward zero."""
    lo, hi = (F.coalesce(c, F.lit(0)).cast("bigint").cast("string") for c in (low, high))
    return (
        F.when(low.isNotNull() & high.isNotNull(), F.concat(lo, F.lit("-"), hi, F.lit("%")))
        .when(high.isNotNull(), F.concat(hi, F.lit("%")))
        .otherwise(F.lit(""))
    )


def contract_label(permanent: Column) -> Column:
    """Label of a three-valued flag."""
    return F.when(permanent, F.lit("permanent")).when(~permanent, F.lit("temporary")).otherwise(F.lit(""))


def url_fallback(external_url: Column, external_id: Column) -> Column:
    """The external URL, else the detail page of the id, else the empty string."""
    detail = F.concat(F.lit(DETAIL_URL), filled(external_id))
    return F.coalesce(filled(external_url), detail, F.lit(""))


def normalize_jobroom(
    df: DataFrame, as_of: date, language: str = "fr", description_chars: int | None = None
) -> DataFrame:
    """Flat records of the public job-room payload.

    ``description_chars`` cuts the description (``DESCRIPTION_LIMIT`` is the usual size).
    """
    rest = [c for c in df.columns if c != "item"]
    wrapped = V.child(F.col("item"), "$.jobAdvertisement")
    rows = df.withColumn("_ad", F.when(wrapped.isNotNull(), wrapped).otherwise(F.col("item")))
    ad, content = F.col("_ad"), F.col("_content")
    rows = rows.withColumn("_content", V.child(ad, "$.jobContent"))
    versions = F.transform(
        V.list_items(content, "$.jobDescriptions"),
        lambda d: F.when(
            V.is_object(d),
            F.struct(
                F.lower(F.coalesce(V.truthy_text(d, "$.languageIsoCode"), F.lit(""))).alias("lang"),
                _text(d, "$.title").alias("title"),
                _text(d, "$.description").alias("description"),
            ),
        ),
    )
    empty = F.array().cast("array<struct<lang:string,title:string,description:string>>")
    rows = rows.withColumn("_versions", F.coalesce(versions, empty))
    rows = rows.withColumn("_pick", pick_description(F.col("_versions"), language))
    rows = V.with_truthy_texts(
        rows,
        "_ad",
        {
            "_posted": ("$.publication.startDate", "$.createdTime"),
            "_expiry": ("$.publication.endDate",),
            "external_id": ("$.id", "$.stellennummerEgov"),
            "_reporting": ("$.reportingObligation",),
        },
    )
    rows = V.with_truthy_texts(
        rows,
        "_content",
        {
            "company": ("$.employer.name",),
            "location": ("$.location.city", "$.location.communalName"),
            "postal_code": ("$.location.zipCode",),
            "canton": ("$.location.cantonCode",),
            "url": ("$.externalUrl",),
        },
    )
    trimmed = ("external_id", "company", "location", "postal_code", "canton", "url")
    rows = rows.withColumns({name: strip(F.col(name)) for name in trimmed})
    rows = rows.withColumns(
        {
            "posting_date": date_prefix(F.col("_posted")),
            "_text": strip(first_chars(F.col("_pick.description"), description_chars)),
            "_low": V.number_at(content, "$.employment.workloadPercentageMin"),
            "_high": V.number_at(content, "$.employment.workloadPercentageMax"),
            "_permanent": V.boolean_at(content, "$.employment.permanent"),
        }
    )
    blank = F.lit("")
    return rows.select(
        *rest,
        _or_na(F.col("_pick.title")).alias("title"),
        _or_na(filled(F.col("company"))).alias("company"),
        _or_na(filled(F.col("location"))).alias("location"),
        F.coalesce("postal_code", blank).alias("postal_code"),
        F.coalesce("canton", blank).alias("canton"),
        "posting_date",
        date_prefix(F.col("_expiry")).alias("expiry_date"),
        age_days(as_of, iso_day(F.col("posting_date"))).alias("days_ago"),
        workload_label(F.col("_low"), F.col("_high")).alias("workload"),
        contract_label(F.col("_permanent")).alias("contract_type"),
        F.col("_reporting").isNotNull().alias("rav_exclusive"),
        url_fallback(F.col("url"), F.col("external_id")).alias("url"),
        F.coalesce("external_id", blank).alias("external_id"),
        language_codes(F.col("_versions")).alias("language_codes"),
        F.lit("jobroom").alias("source"),
        filled(F.col("_text")).alias("description"),
    )


def normalize_adzuna(df: DataFrame, description_chars: int | None = None) -> DataFrame:
    """Flat records of the Adzuna payload; salary and contract pass through.

    ``description_chars`` cuts the description (``DESCRIPTION_LIMIT`` is the usual size).
    """
    item = F.col("item")
    rest = [c for c in df.columns if c != "item"]
    texts = {
        "title": ("$.title",),
        "company": ("$.company.display_name",),
        "location": ("$.location.display_name",),
        "posting_date": ("$.created",),
        "_url": ("$.redirect_url",),
        "_ref": ("$.adref",),
        "description": ("$.description",),
        "external_id": ("$.id",),
    }
    rows = V.with_truthy_texts(df, "item", texts)
    rows = rows.withColumns({name: strip(F.col(name)) for name in texts})
    return rows.select(
        *rest,
        *[_or_na(filled(F.col(name))).alias(name) for name in ("title", "company", "location")],
        date_prefix(F.col("posting_date")).alias("posting_date"),
        F.coalesce(filled(F.col("_url")), filled(F.col("_ref")), F.lit("")).alias("url"),
        first_chars(filled(F.col("description")), description_chars).alias("description"),
        V.number_at(item, "$.salary_min").alias("salary_min"),
        V.number_at(item, "$.salary_max").alias("salary_max"),
        V.string_at(item, "$.contract_time").alias("contract_time"),
        V.string_at(item, "$.contract_type").alias("contract_type"),
        F.coalesce("external_id", F.lit("")).alias("external_id"),
        F.lit("adzuna").alias("source"),
    )


# The names a field may have in the aggregated feed, and its default.
FIELD_ALIASES = {
    "title": (("job_title", "title"), "N/A"),
    "company": (("employer_name", "company", "company_name"), "N/A"),
    "location": (("job_city", "location"), "N/A"),
    "posting_date": (("job_posted_at_datetime_utc", "date_posted"), None),
    "salary": (("job_salary", "salary"), ""),
    "description": (("job_description", "description"), None),
    "url": (("job_apply_link", "job_url", "url"), ""),
    "source": (("job_publisher", "site"), "indeed_rapidapi"),
}


def normalize_alias(df: DataFrame, default_source: str = "indeed_rapidapi") -> DataFrame:
    """Flat records of the aggregated feed: the first truthy alias of every field, untrimmed."""
    rest = [c for c in df.columns if c != "item"]
    paths = {name: tuple(f"$.{alias}" for alias in aliases) for name, (aliases, _) in FIELD_ALIASES.items()}
    defaults = {name: default for name, (_, default) in FIELD_ALIASES.items()} | {"source": default_source}
    rows = V.with_truthy_texts(df, "item", paths)
    return rows.select(
        *rest, *[F.coalesce(F.col(n), F.lit(d).cast("string")).alias(n) for n, d in defaults.items()]
    )


def with_default_source(df: DataFrame, source: str) -> DataFrame:
    """Set ``source`` where it is missing; NULL counts as missing."""
    return df.withColumn("source", F.coalesce(F.col("source"), F.lit(source)))
