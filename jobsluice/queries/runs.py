"""Whole runs: from captured listings to the new job table and seen state."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from jobsluice.functions import language as lang
from jobsluice.functions.urls import SiteRule
from jobsluice.operators.extract import page_links
from jobsluice.operators.normalize import normalize_adzuna, normalize_alias
from jobsluice.operators.report import run_report
from jobsluice.plans.collect import API_PAGE_RULES, collect_feed_items, collect_listing, collect_pages
from jobsluice.queries.merges import merge_sql
from jobsluice.queries.pages import _LINKS_SQL
from jobsluice.queries.registry import json_pages, query, table
from jobsluice.schema import POLICIES, Policy
from jobsluice.queries.texts import _TITLE_SQL, _hits_sql
from jobsluice.sources.payloads import ENVELOPES, unpack_envelope

AS_OF = date(2024, 1, 30)
URL = "https://jobs.example.com/u/"

# The interface lists all events, 50 a page; page 1 reports no total. The current table
# holds the purchases of the first three days, with ids; the state the signups of the
# first day.
_API_SQL = f"""
    e AS (SELECT '{URL}' || user_id || '/' || event_type AS url, event_id // 50 + 1 AS page_no, event_id AS pos, ts,
                 event_type AS title, strftime(ts, '%Y-%m-%d') AS posting_date, user_id, event_id FROM events),
    cur AS (SELECT * FROM e WHERE title = 'purchase' AND ts < TIMESTAMP '2024-01-04'),
    known AS (SELECT url FROM cur UNION SELECT url FROM e WHERE title = 'signup' AND ts < TIMESTAMP '2024-01-02'),
    scan AS (SELECT *, url IN (SELECT url FROM known) AS known FROM e),
    streaks AS (SELECT *, pos + 1 - coalesce(max(CASE WHEN NOT known THEN pos + 1 END) OVER (ORDER BY pos), 0) AS streak
                FROM scan),
    cut AS (SELECT coalesce(min(pos) FILTER (streak >= 6), max(pos)) AS cut_pos FROM streaks),
    walked AS (SELECT scan.* FROM scan, cut WHERE pos <= cut_pos),
    fresh AS (SELECT * FROM walked WHERE NOT known
                AND date_diff('day', CAST(ts AS DATE), DATE '{AS_OF}') BETWEEN 0 AND 28),
    r AS (SELECT url, event_id + 1 AS id, 0 AS batch, pos, title, posting_date FROM cur
          UNION ALL SELECT url, NULL, 1, pos, title, posting_date FROM fresh),
    {merge_sql(columns="url, title, posting_date")}
"""


def _api_run(spark, sf):
    events = table(spark, sf, "events")
    url = F.concat(F.lit(URL), F.col("user_id").cast("string"), F.lit("/"), "event_type")
    item = F.struct(
        F.col("event_type").alias("title"),
        url.alias("redirect_url"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("created"),
        F.col("event_id").alias("id"),
    )
    pages = json_pages(events, item, "event_id", 50)
    payload = F.concat(F.lit('{"count": null, "results": '), "items", F.lit("}"))
    items = unpack_envelope(pages.select("page_no", payload.alias("payload")), ENVELOPES["adzuna"])
    listing = normalize_adzuna(items.drop("total")).withColumnRenamed("pos", "pos_on_page")
    listing = listing.withColumn("run_id", F.lit("r1"))
    rows = events.select(
        "ts",
        "event_type",
        (F.col("event_id") + 1).alias("id"),
        F.col("event_id").alias("pos"),
        url.alias("url"),
        F.col("event_type").alias("title"),
        F.date_format("ts", "yyyy-MM-dd").alias("posting_date"),
    )
    before = lambda day: F.col("ts") < F.lit(day).cast("timestamp_ntz")
    current = rows.filter((F.col("event_type") == "purchase") & before("2024-01-04")).drop("ts", "event_type")
    seen = rows.filter((F.col("event_type") == "signup") & before("2024-01-02")).select(F.col("url").alias("key"))
    return collect_listing(
        listing, current, seen.distinct(), POLICIES["adzuna"], AS_OF, days=28, stop_after_known=6
    )


@query(
    "run_api_source",
    f"""
    WITH {_API_SQL}
    SELECT id, url, title, posting_date FROM merged
    WHERE date_diff('day', CAST(posting_date AS DATE), DATE '{AS_OF}') BETWEEN 0 AND 28
    """,
)
def run_api_source(spark, sf):
    return _api_run(spark, sf).written.select("id", "url", "title", "posting_date")


@query(
    "run_api_source_seen",
    f"WITH {_API_SQL} SELECT url AS key FROM known UNION SELECT url FROM walked UNION SELECT url FROM merged",
)
def run_api_source_seen(spark, sf):
    return _api_run(spark, sf).seen


# The listing is all documents, 25 a page. The address is source, language and size
# class; French ones carry their language code, the others are read. Documents with a
# good label in the first half of the list are current.
_LANG_SQL = f"""
    {_TITLE_SQL}, {_hits_sql(lang.PLAIN_TOKEN, lang.PLAIN_HINTS)},
    e AS (SELECT doc_id AS pos, doc_id // 25 + 1 AS page_no, title, text,
                 'https://d.example.com/' || source || '/' || h.lang || '/' || (n_chars // 50) AS url,
                 strftime(DATE '2024-01-01' + CAST(n_chars % 40 AS INTEGER), '%Y-%m-%d') AS posting_date,
                 h.lang = 'fr' OR (n_fr >= 2 AND n_fr >= greatest(n_en, n_de, n_it)) AS french
          FROM h JOIN documents USING (doc_id, text)),
    cur AS (SELECT e.* FROM e JOIN labels ON doc_id = pos WHERE quality = 1 AND pos < (SELECT max(pos) / 2 FROM e)),
    scan AS (SELECT *, url IN (SELECT url FROM cur) AS known FROM e),
    fresh AS (SELECT * FROM scan WHERE NOT known AND french
                AND date_diff('day', CAST(posting_date AS DATE), DATE '{AS_OF}') BETWEEN 0 AND 20),
    r AS (SELECT url, pos + 1 AS id, 0 AS batch, pos, title, posting_date FROM cur
          UNION ALL SELECT url, NULL, 1, pos, title, posting_date FROM fresh),
    {merge_sql(columns="url, title, posting_date")}
"""


@query(
    "run_language_source",
    f"""
    WITH {_LANG_SQL}
    SELECT id, url, title, posting_date FROM merged
    WHERE date_diff('day', CAST(posting_date AS DATE), DATE '{AS_OF}') BETWEEN 0 AND 20
    """,
)
def run_language_source(spark, sf):
    docs = table(spark, sf, "documents")
    code = F.col("lang")
    title = (
        F.when(code == "fr", "Responsable équipe").when(code == "en", "Team position").when(code == "de", "Stelle für Arbeit")
    )
    size = F.floor(F.col("n_chars") / 50).cast("string")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("n_chars") % 40).cast("int"))
    rows = docs.select(
        "doc_id",
        title.alias("title"),
        F.col("text").alias("description"),
        F.concat_ws("/", F.lit("https://d.example.com"), "source", "lang", size).alias("url"),
        F.date_format(day, "yyyy-MM-dd").alias("posting_date"),
        F.when(code == "fr", F.array(F.lit("FR"))).otherwise(F.array(F.lit(""))).alias("language_codes"),
    )
    listing = rows.withColumns(
        {
            "source": F.lit("jobroom"),
            "run_id": F.lit("r1"),
            "page_no": (F.floor(F.col("doc_id") / 25) + 1).cast("bigint"),
            "pos_on_page": F.col("doc_id") % 25,
        }
    )
    middle = rows.agg((F.max("doc_id") / 2).alias("m")).first()["m"]
    good = table(spark, sf, "labels").filter("quality = 1").select("doc_id")
    current = rows.filter(F.col("doc_id") < middle).join(good, "doc_id", "left_semi")
    current = current.withColumn("id", F.col("doc_id") + 1).withColumnRenamed("doc_id", "pos")
    seen = spark.createDataFrame([], "key string")
    run = collect_listing(
        listing.drop("doc_id"),
        current.drop("language_codes"),
        seen,
        POLICIES["jobroom"],
        AS_OF,
        days=20,
        page_rule=API_PAGE_RULES["jobroom"],
    )
    return run.written.select("id", "url", "title", "posting_date")


# The aggregated feed lists all parts; every third size has no URL, so the key falls
# back to title, company and place. The current table holds parts above a price.
_FEED_SQL = f"""
    p AS (SELECT CASE WHEN p_size % 3 = 0 THEN '' ELSE '{URL}' || p_name || '/' || p_brand END AS url, p_name AS title,
                 p_brand AS company, p_type AS location, p_partkey AS pos, p_retailprice FROM part),
    k AS (SELECT *, coalesce(nullif(url, ''), lower(title || '|' || company || '|' || location)) AS key FROM p),
    cur AS (SELECT * FROM k WHERE p_retailprice > 950),
    fresh AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY pos) AS n FROM k)
              WHERE n = 1 AND key NOT IN (SELECT key FROM cur)),
    r AS (SELECT url, title, company, location, key AS rkey, CASE WHEN company < 'Brand#2' THEN NULL ELSE pos + 1 END AS id,
                 0 AS batch, pos FROM cur
          UNION ALL SELECT url, title, company, location, key, NULL, 1, pos FROM fresh)
"""


@query(
    "run_feed_source",
    f"""
    WITH {_FEED_SQL.replace("k AS (SELECT *,", "kk AS (SELECT *,").replace("FROM k ", "FROM kk ").replace("FROM k)", "FROM kk)")},
    {merge_sql(key="rkey", backfill=False, columns="url, title, company, location")}
    SELECT id, url, title, company, location FROM merged
    """,
)
def run_feed_source(spark, sf):
    part = table(spark, sf, "part")
    url = F.when(F.col("p_size") % 3 == 0, F.lit("")).otherwise(
        F.concat(F.lit(URL), "p_name", F.lit("/"), "p_brand")
    )
    item = F.struct(
        F.col("p_name").alias("job_title"),
        F.col("p_brand").alias("company_name"),
        F.col("p_type").alias("location"),
        url.alias("job_url"),
    )
    pages = json_pages(part, item, "p_partkey", 100)
    payload = F.concat(F.lit('{"data": '), "items", F.lit("}"))
    items = unpack_envelope(pages.select("page_no", payload.alias("payload")), ENVELOPES["rapidapi"])
    listing = normalize_alias(items.drop("total"))
    listing = listing.withColumn("pos", (F.col("page_no") - 1) * 100 + F.col("pos")).drop("page_no")
    current = part.filter("p_retailprice > 950").select(
        F.when(~(F.col("p_brand") < "Brand#2"), F.col("p_partkey") + 1).alias("id"),
        F.col("p_partkey").alias("pos"),
        url.alias("url"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("company"),
        F.col("p_type").alias("location"),
    )
    seen = spark.createDataFrame([], "key string")
    run = collect_feed_items(listing, current, seen, POLICIES["indeed"], AS_OF)
    return run.written.select("id", "url", "title", "company", "location")


OPEN_SITE = SiteRule("demo", "https://jobs.example.com", "example.com", "/")

# The listing is the pages table, one page each; a detail page is built for every link.
# Links on French pages are the current table and known from there.
_PAGES_SQL = f"""
    {_LINKS_SQL},
    l0 AS (SELECT page_id, pos, url, page_id * 1000 + pos AS ord, page_id + 1 AS page_no FROM links),
    cur AS (SELECT l0.url, min(ord) AS ord FROM l0 JOIN pages p USING (page_id) WHERE contains(html, 'lang="fr"')
            GROUP BY l0.url),
    known AS (SELECT url FROM cur),
    f AS (SELECT url, min(ord) AS ord, min(page_no) AS page_no FROM l0 GROUP BY url),
    scan AS (SELECT *, url IN (SELECT url FROM known) AS known, row_number() OVER (ORDER BY ord) AS rn FROM f
             WHERE page_no > 1),
    streaks AS (SELECT *, rn - coalesce(max(CASE WHEN NOT known THEN rn END) OVER (ORDER BY ord), 0) AS streak FROM scan),
    counts AS (SELECT p.page_id + 1 AS page_no, count(l0.url) AS n FROM pages p LEFT JOIN l0 USING (page_id) GROUP BY ALL),
    stop AS (SELECT coalesce(min(ord) FILTER (streak >= 8), (SELECT max(ord) FROM l0)) AS cut_ord,
                    (SELECT coalesce(min(page_no), 1000000000) FROM counts WHERE page_no > 1 AND n = 0) AS end_page
             FROM streaks),
    walked AS (SELECT f.* FROM f, stop WHERE ord <= cut_ord AND page_no < end_page),
    fresh AS (SELECT url, ord, 'Job ' || substr(url, 26) AS title, '2024-01-' || (10 + length(url) % 20) AS posting_date
              FROM walked WHERE url NOT IN (SELECT url FROM known)),
    r AS (SELECT url, ord + 1 AS id, 0 AS batch, ord AS pos, 'old' AS title, '2024-01-15' AS posting_date FROM cur
          UNION ALL SELECT url, NULL, 1, ord, title, posting_date FROM fresh),
    {merge_sql(columns="url, title, posting_date")}
"""


def _site_run(spark, sf):
    pages = table(spark, sf, "pages")
    list_pages = pages.select(
        F.lit("demo").alias("source"),
        F.lit("r1").alias("run_id"),
        (F.col("page_id") + 1).alias("page_no"),
        F.lit(200).alias("status"),
        "html",
    )
    links = page_links(pages.select("page_id", "html"), OPEN_SITE.origin)
    node = F.to_json(
        F.struct(
            F.lit("JobPosting").alias("@type"),
            F.concat(F.lit("Job "), F.substring("url", 26, 1000)).alias("title"),
            F.concat(F.lit("2024-01-"), (F.length("url") % 20 + 10).cast("string"), F.lit("T00:00")).alias("datePosted"),
        )
    )
    html = F.concat(F.lit('<html><script type="application/ld+json">{"graph": ['), node, F.lit("]}</script></html>"))
    details = links.select("url").distinct().withColumn("html", html)
    french = links.join(pages.filter(F.contains("html", F.lit('lang="fr"'))).select("page_id"), "page_id", "left_semi")
    order = F.min(F.col("page_id") * 1000 + F.col("pos"))
    current = french.groupBy("url").agg(order.cast("bigint").alias("pos")).select(
        (F.col("pos") + 1).alias("id"),
        "pos",
        "url",
        F.lit("old").alias("title"),
        F.lit("2024-01-15").alias("posting_date"),
    )
    seen = spark.createDataFrame([], "key string")
    return collect_pages(
        list_pages,
        details,
        current,
        seen,
        OPEN_SITE,
        Policy("demo", fresh_days=False),
        AS_OF,
        days=17,
        stop_after_known=8,
        page_rule="empty",
    )


@query(
    "run_html_source",
    f"""
    WITH {_PAGES_SQL}
    SELECT id, url, title, posting_date FROM merged
    WHERE date_diff('day', CAST(posting_date AS DATE), DATE '{AS_OF}') BETWEEN 0 AND 17
    """,
)
def run_html_source(spark, sf):
    return _site_run(spark, sf).written.select("id", "url", "title", "posting_date")


# Details: all orders; a zero price stands for a page that could not be read. Merged:
# the customers of the orders in the window whose segment passes the language filter.
@query(
    "run_report",
    """
    WITH o AS (SELECT o_custkey, o_totalprice >= 20000 AS ok,
                      date_diff('day', CAST(o_orderdate AS DATE), DATE '1999-06-30') BETWEEN 0 AND 90 AS recent FROM orders),
    added AS (SELECT count(DISTINCT o_custkey) AS n FROM o JOIN customer ON c_custkey = o_custkey
              WHERE ok AND recent AND c_acctbal > 0 AND c_mktsegment <> 'MACHINERY')
    SELECT count(*) FILTER (ok AND recent) AS n_ok, count(*) FILTER (NOT ok) AS n_errors,
           count(*) FILTER (ok AND NOT recent) AS n_out_of_window,
           greatest(count(*) FILTER (ok AND recent) - any_value(n), 0) AS n_language
    FROM o, added
    """,
)
def report(spark, sf):
    url = F.concat(F.lit(URL), F.col("c_custkey").cast("string"))
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        (F.col("o_totalprice") >= 20000).alias("ok"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("posting_date"),
    )
    customers = table(spark, sf, "customer")
    current = customers.filter("c_acctbal <= 0").select(url.alias("url"))
    recent = orders.filter("ok AND posting_date BETWEEN '1999-04-01' AND '1999-06-30'").select("c_custkey").distinct()
    kept = customers.filter("c_mktsegment <> 'MACHINERY'").join(recent, "c_custkey", "left_semi").select(url.alias("url"))
    return run_report(orders, current, current.union(kept), date(1999, 6, 30), 90)
