"""Text, date and language queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from jobsluice.functions import dates as D
from jobsluice.functions.text import collapse, with_clean_text
from jobsluice.operators import filters
from jobsluice.operators.enrich import PROMPT_CHARS, with_prompt
from jobsluice.operators.normalize import date_prefix
from jobsluice.queries.registry import fmt, query, table

AS_OF = date(1999, 6, 30)


@query(
    "clean_text",
    """
    WITH d AS (
      SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS body, source FROM documents)
    SELECT doc_id,
           nullif(left('« ' || body || ' & ' || source || ' é', 1200), '') AS body,
           nullif(left(trim(source || ' · ' || left(body, 3)), 4), '') AS tag
    FROM d
    """,
)
def clean_text(spark, sf):
    docs = table(spark, sf, "documents")
    raw = docs.select(
        "doc_id",
        F.concat(F.lit(" &laquo;\n "), "text", F.lit("\t&amp; "), "source", F.lit(" &#233;\x85")).alias("body"),
        F.concat(F.lit(" "), "source", F.lit("&nbsp;&middot; "), F.substring(collapse(F.col("text")), 1, 3)).alias("tag"),
    )
    return with_clean_text(raw, {"body": 1200, "tag": 4})


# One text form of the order date per priority: five forms, three of them days.
_FORMS_SQL = """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderpriority AS form FROM orders
"""


def _order_days(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select("o_orderkey", day.alias("day"), F.col("o_orderpriority").alias("form"))


def _iso_forms(spark, sf):
    rows = _order_days(spark, sf)
    text = (
        F.when(F.col("form") == "1-URGENT", fmt(F.col("day"), "yyyy-MM-dd"))
        .when(F.col("form") == "2-HIGH", F.concat(fmt(F.col("day"), "yyyy-MM-dd"), F.lit("T23:30:00-05:00")))
        .when(F.col("form") == "3-MEDIUM", fmt(F.col("day"), "yyyyMMdd"))
        .when(F.col("form") == "4-NOT SPECIFIED", F.concat(fmt(F.col("day"), "yyyy-MM-dd"), F.lit(" later")))
    )
    return rows.withColumn("posting_date", text)


_ISO_SQL = f"""
    d AS (
      SELECT o_orderkey, day, form,
             CASE form WHEN '1-URGENT' THEN strftime(day, '%Y-%m-%d')
                       WHEN '2-HIGH' THEN strftime(day, '%Y-%m-%d') || 'T23:30:00-05:00'
                       WHEN '3-MEDIUM' THEN strftime(day, '%Y%m%d')
                       WHEN '4-NOT SPECIFIED' THEN strftime(day, '%Y-%m-%d') || ' later' END AS posting_date,
             CASE WHEN form IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
                  THEN date_diff('day', day, DATE '{AS_OF}') END AS age
      FROM ({_FORMS_SQL}))
"""


@query(
    "within_days",
    f"WITH {_ISO_SQL} SELECT o_orderkey, posting_date FROM d WHERE age BETWEEN 0 AND 400",
)
def within_days(spark, sf):
    return filters.within_days(_iso_forms(spark, sf), AS_OF, 400).select("o_orderkey", "posting_date")


@query(
    "days_ago",
    f"WITH {_ISO_SQL} SELECT o_orderkey, posting_date, CAST(age AS INTEGER) AS days_ago FROM d",
)
def days_ago(spark, sf):
    return filters.with_age(_iso_forms(spark, sf), AS_OF).select("o_orderkey", "posting_date", "days_ago")


@query(
    "date_prefix",
    f"""
    WITH {_ISO_SQL}
    SELECT o_orderkey, left(posting_date, 10) AS first_ten, split_part(posting_date, 'T', 1) AS before_t FROM d
    """,
)
def prefixes(spark, sf):
    rows = _iso_forms(spark, sf)
    padded = F.concat(F.lit(" "), F.col("posting_date"), F.lit(" "))
    return rows.select(
        "o_orderkey",
        date_prefix(padded).alias("first_ten"),
        D.before_t(F.col("posting_date")).alias("before_t"),
    )


def _french_text(form, day):
    return (
        F.when(form == "1-URGENT", fmt(day, "dd.MM.yyyy"))
        .when(form == "2-HIGH", fmt(day, "d/M/yyyy"))
        .when(form == "3-MEDIUM", F.concat(F.lit(" "), fmt(day, "yyyy-M-d"), F.lit(" ")))
        .when(form == "4-NOT SPECIFIED", fmt(day, "dd.MM.yy"))
        .otherwise(fmt(day, "dd.MM/yyyy"))
    )


@query(
    "parse_fr_date",
    f"""
    SELECT o_orderkey,
           CASE WHEN form IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN strftime(day, '%Y-%m-%d') END AS day_text
    FROM ({_FORMS_SQL})
    """,
)
def parse_fr_date(spark, sf):
    rows = _order_days(spark, sf)
    text = _french_text(F.col("form"), F.col("day"))
    return rows.select("o_orderkey", D.french_day(text).alias("day_text"))


@query(
    "parse_rfc2822_day",
    f"""
    SELECT o_orderkey, CASE WHEN form <> '5-LOW' THEN strftime(day, '%Y-%m-%d') END AS day_text
    FROM ({_FORMS_SQL})
    """,
)
def parse_rfc2822_day(spark, sf):
    rows = _order_days(spark, sf)
    text = F.when(F.col("form") == "5-LOW", F.concat(F.lit("Mon, 31 Foo "), fmt(F.col("day"), "yyyy"))).otherwise(
        F.concat(F.lit("Mon, "), fmt(F.col("day"), "dd MMM yyyy"), F.lit(" 23:59:59 -0900"))
    )
    return rows.select("o_orderkey", D.rfc2822_day(text).alias("day_text"))


@query(
    "labelled_dates",
    f"""
    SELECT o_orderkey,
           CASE WHEN form IN ('1-URGENT', '2-HIGH') THEN strftime(day, '%Y-%m-%d')
                ELSE strftime(day + 1, '%Y-%m-%d') END AS posting_date,
           CASE WHEN form IN ('1-URGENT', '2-HIGH') THEN strftime(day + 30, '%Y-%m-%d') END AS date_limite
    FROM ({_FORMS_SQL})
    """,
)
def labelled_dates(spark, sf):
    rows = _order_days(spark, sf)
    form, day = F.col("form"), F.col("day")
    text = F.concat(
        F.lit("Offre 12. PUBLIÉ le : "),
        _french_text(form, day),
        F.lit(" (Mise en ligne : "),
        fmt(F.date_add(day, 1), "dd.MM.yyyy"),
        F.lit(") DÉLAI de candidature au soir du "),
        _french_text(form, F.date_add(day, 30)),
    )
    return rows.select(
        "o_orderkey",
        D.labelled_day(text, D.POSTING_LABELS).alias("posting_date"),
        D.labelled_day(text, D.DEADLINE_LABELS).alias("date_limite"),
    )


def _sql_list(words):
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _hits_sql(pattern, hints):
    counts = ", ".join(
        f"len(list_intersect(words, {_sql_list(hints[code])})) AS n_{code}" for code in ("fr", "en", "de", "it")
    )
    return f"""
    t AS (SELECT *, list_distinct(regexp_extract_all(lower(coalesce(title, '') || ' ' || coalesce(text, '')),
                                                     '{pattern}')) AS words FROM d),
    h AS (SELECT *, {counts} FROM t)
    """


# Titles add hint words of the four languages, so that all branches are taken.
_TITLE_SQL = """
    d AS (
      SELECT doc_id, text, lang,
             CASE lang WHEN 'fr' THEN 'Responsable équipe' WHEN 'en' THEN 'Team position'
                       WHEN 'de' THEN 'Stelle für Arbeit' END AS title FROM documents)
"""


def _titled(spark, sf):
    lang = F.col("lang")
    title = (
        F.when(lang == "fr", "Responsable équipe")
        .when(lang == "en", "Team position")
        .when(lang == "de", "Stelle für Arbeit")
    )
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", "lang", title.alias("title"), F.col("text").alias("description"))


@query(
    "lang_fr_en",
    f"""
    WITH {_TITLE_SQL}, {_hits_sql(filters.lang.ACCENTED_TOKEN, filters.lang.ACCENTED_HINTS)}
    SELECT doc_id, lang FROM h
    WHERE (n_fr >= 2 OR n_en >= 2) AND greatest(n_fr, n_en) >= greatest(n_de, n_it)
    """,
)
def lang_fr_en(spark, sf):
    return filters.french_or_english(_titled(spark, sf)).select("doc_id", "lang")


@query(
    "lang_fr",
    f"""
    WITH {_TITLE_SQL}, {_hits_sql(filters.lang.PLAIN_TOKEN, filters.lang.PLAIN_HINTS)}
    SELECT doc_id, lang FROM h
    WHERE lang = 'es' OR (n_fr >= 2 AND n_fr >= greatest(n_en, n_de, n_it))
    """,
)
def lang_fr(spark, sf):
    rows = _titled(spark, sf).withColumn(
        "language_codes", F.when(F.col("lang") == "es", F.array(F.lit("es"), F.lit("FR"))).otherwise(F.array("lang"))
    )
    # French documents are tagged otherwise here, so that the words decide for them.
    codes = F.when(F.col("lang") == "fr", F.array(F.lit("")))
    rows = rows.withColumn("language_codes", F.coalesce(codes, "language_codes"))
    return filters.french(rows).select("doc_id", "lang")


@query(
    "prompt_text",
    """
    SELECT doc_id,
           CASE WHEN title <> '' OR body <> ''
                THEN 'Titre: ' || title || chr(10) || 'Description: ' || left(body, 4000) END AS prompt
    FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN '' ELSE source END AS title,
                 trim(regexp_replace(text, '\\s+', ' ', 'g')) AS body FROM documents)
    """,
)
def prompt_text(spark, sf):
    docs = table(spark, sf, "documents")
    title = F.when(F.col("lang") != "en", F.concat(F.lit(" "), "source", F.lit("\n")))
    body = F.concat(F.lit("<div><p>"), F.regexp_replace("text", "\n", "<br>"), F.lit("</p></div>"))
    rows = docs.select("doc_id", title.alias("title"), body.alias("description"))
    return with_prompt(rows, chars=PROMPT_CHARS).select("doc_id", "prompt")
