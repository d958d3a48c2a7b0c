"""Whole runs of single sources: what ends a listing, what a run writes, remembers and reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from jobsluice.functions.urls import SITE_RULES
from jobsluice.operators.extract import page_links, total_pages_reported
from jobsluice.operators.normalize import normalize_adzuna
from jobsluice.plans.collect import API_PAGE_RULES, REPORT, collect_listing, collect_pages
from jobsluice.queries.merges import merge_sql
from jobsluice.queries.pages import _CARD_URL, _LINKS_SQL, _card_pages
from jobsluice.queries.registry import fmt, json_pages, query, table
from jobsluice.schema import POLICIES
from jobsluice.sources.feed import rss_items
from jobsluice.sources.payloads import ENVELOPES, payload_pages, unpack_envelope

AS_OF = date(2024, 1, 30)
API_URL = "https://jobs.example.com/v/"


def _recent_sql(column, days):
    return f"date_diff('day', CAST({column} AS DATE), DATE '{AS_OF}') BETWEEN 0 AND {days}"


# An interface lists all events, 50 a page. Purchases of the first three days are current. One run ends where half of
# all addresses, the total that pages after the first report, have been listed; the other at a page without items
# after three quarters of the pages.
_EVENTS_SQL = f"""
    e AS (SELECT '{API_URL}' || user_id || '/' || event_type AS url, event_id // 50 + 1 AS page_no, event_id AS pos, ts,
                 event_type AS title, strftime(ts, '%Y-%m-%d') AS posting_date FROM events),
    cur AS (SELECT * FROM e WHERE title = 'purchase' AND ts < TIMESTAMP '2024-01-04')
"""
_REST_SQL = f"""
    fresh AS (SELECT e.* FROM e, stop WHERE page_no <= last_page AND url NOT IN (SELECT url FROM cur)
                AND {_recent_sql("posting_date", 28)}),
    r AS (SELECT url, pos + 1 AS id, 0 AS batch, pos, title, posting_date FROM cur
          UNION ALL SELECT url, NULL, 1, pos, title, posting_date FROM fresh),
    {merge_sql(columns="url, title, posting_date")}
    SELECT id, url, title, posting_date FROM merged WHERE {_recent_sql("posting_date", 28)}
"""


def _event_run(spark, sf, total=False, empty_page=False):
    events = table(spark, sf, "events")
    url = F.concat(F.lit(API_URL), F.col("user_id").cast("string"), F.lit("/"), "event_type")
    item = F.struct(
        F.col("event_type").alias("title"),
        url.alias("redirect_url"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("created"),
        F.col("event_id").alias("id"),
    )
    pages = json_pages(events, item, "event_id", 50)
    facts = events.agg(F.max("event_id").alias("last"), F.count_distinct("user_id", "event_type").alias("n")).first()
    count, items = F.lit("null"), F.col("items")
    if total:
        count = F.when(F.col("page_no") > 1, F.lit(str(facts["n"] // 2))).otherwise("null")
    if empty_page:
        items = F.when(F.col("page_no") == (facts["last"] // 50 + 1) * 3 // 4 + 1, F.lit("[]")).otherwise(items)
    payload = F.concat(F.lit('{"count": '), count, F.lit(', "results": '), items, F.lit("}"))
    payloads = pages.select("page_no", payload.alias("payload"))
    captured = payload_pages(payloads, ENVELOPES["adzuna"]).withColumns({"source": F.lit("adzuna"), "run_id": F.lit("r1")})
    listing = normalize_adzuna(unpack_envelope(payloads, ENVELOPES["adzuna"]).drop("total"))
    listing = listing.withColumnRenamed("pos", "pos_on_page").withColumn("run_id", F.lit("r1"))
    early = (F.col("event_type") == "purchase") & (F.col("ts") < F.lit("2024-01-04").cast("timestamp_ntz"))
    current = events.filter(early).select(
        (F.col("event_id") + 1).alias("id"),
        F.col("event_id").alias("pos"),
        url.alias("url"),
        F.col("event_type").alias("title"),
        F.date_format("ts", "yyyy-MM-dd").alias("posting_date"),
    )
    run = collect_listing(
        listing,
        current,
        spark.createDataFrame([], "key string"),
        POLICIES["adzuna"],
        AS_OF,
        days=28,
        stop_after_known=0,
        pages=captured,
        page_rule=API_PAGE_RULES["adzuna"],
    )
    return run.written.select("id", "url", "title", "posting_date")


@query(
    "run_total_source",
    f"""
    WITH {_EVENTS_SQL},
    n AS (SELECT page_no, count(*) AS n FROM (SELECT min(page_no) AS page_no FROM e GROUP BY url) GROUP BY page_no),
    upto AS (SELECT p.page_no, sum(coalesce(n, 0)) OVER (ORDER BY p.page_no) AS listed
             FROM (SELECT DISTINCT page_no FROM e) p LEFT JOIN n USING (page_no)),
    stop AS (SELECT coalesce(min(page_no) FILTER (page_no > 1 AND listed >= (SELECT count(DISTINCT url) FROM e) // 2),
                             max(page_no)) AS last_page FROM upto),
    {_REST_SQL}
    """,
)
def run_total_source(spark, sf):
    return _event_run(spark, sf, total=True)


@query(
    "run_empty_page_source",
    f"WITH {_EVENTS_SQL}, stop AS (SELECT max(page_no) * 3 // 4 AS last_page FROM e), {_REST_SQL}",
)
def run_empty_page_source(spark, sf):
    return _event_run(spark, sf, empty_page=True)


# The listings of both sites are the pages table with the links in the form of the site; links of French pages are
# current. A page is built for every link: it cannot be read at some lengths, and its text has the language and the day
# of its length.
_TEXTS = {
    0: ("Responsable avec vous", "Nous cherchons pour notre mission"),
    1: ("Team position", "Work with you, skills and experience required"),
    2: ("Stelle", "Arbeit mit Erfahrung und Aufgaben für Sie"),
}
_TITLE_SQL = " ".join(f"WHEN {n} THEN '{title}'" for n, (title, _) in _TEXTS.items())


def _walk_sql(prefix, known, streak, last_page):
    """``walked``: distinct links in order up to the streak of known ones or the last page."""
    return f"""
    {_LINKS_SQL},
    l0 AS (SELECT page_id, '{prefix}' || substr(url, 26) AS url, page_id * 1000 + pos AS ord, page_id + 1 AS page_no FROM links),
    f AS (SELECT url, min(ord) AS ord, min(page_no) AS page_no, length(url) % 11 <> 5 AS ok,
                 CASE length(url) % 3 {_TITLE_SQL} END AS title, length(url) % 3 < 2 AS fr_en,
                 '2024-01-' || (10 + length(url) % 20) AS posting_date FROM l0 GROUP BY url),
    of_lang AS (SELECT l0.url, min(ord) AS ord, contains(html, 'lang="fr"') AS french FROM l0 JOIN pages USING (page_id)
                WHERE contains(html, 'lang="fr"') OR contains(html, 'lang="de"') GROUP BY ALL),
    cur AS (SELECT of_lang.url, of_lang.ord, f.title, fr_en FROM of_lang JOIN f USING (url) WHERE french),
    master AS (SELECT url, ord FROM of_lang WHERE NOT french),
    scan AS (SELECT *, url IN ({known}) AS known, row_number() OVER (ORDER BY ord) AS rn FROM f WHERE page_no > 1),
    streaks AS (SELECT *, rn - coalesce(max(CASE WHEN NOT known THEN rn END) OVER (ORDER BY ord), 0) AS streak FROM scan),
    counts AS (SELECT p.page_id + 1 AS page_no, count(l0.url) AS n FROM pages p LEFT JOIN l0 USING (page_id) GROUP BY ALL),
    stop AS (SELECT (SELECT coalesce(min(ord) FILTER (streak >= {streak}), (SELECT max(ord) FROM l0)) FROM streaks) AS cut_ord,
                    ({last_page}) AS last_page),
    walked AS (SELECT f.* FROM f, stop WHERE ord <= cut_ord AND page_no <= last_page)
    """


def _link_tables(spark, sf, rule, path):
    """Listing pages, detail pages, and links with their first place on the pages of a language."""
    pages = table(spark, sf, "pages")
    pages = pages.withColumn("html", F.replace("html", F.lit('href="/'), F.lit(f'href="{path}')))
    listing = pages.select(
        F.lit(rule.name).alias("source"),
        F.lit("r1").alias("run_id"),
        (F.col("page_id") + 1).alias("page_no"),
        F.lit(200).alias("status"),
        "html",
    )
    links = page_links(pages.select("page_id", "html"), rule.origin).filter(F.startswith("url", F.lit(rule.origin + path)))
    size = F.length("url")
    kind, day = size % 3, F.concat(F.lit("2024-01-"), (size % 20 + 10).cast("string"))
    title, text = (F.element_at(F.array(*[F.lit(_TEXTS[n][k]) for n in _TEXTS]), kind + 1) for k in (0, 1))
    parts = {"@type": F.lit("JobPosting"), "title": title, "description": text, "datePosted": F.concat(day, F.lit("T00:00"))}
    node = F.to_json(F.struct(*[column.alias(name) for name, column in parts.items()]))
    node = F.when(size % 11 == 5, F.lit('{"@type": "JobPosting", "title": 5}')).otherwise(node)
    html = F.concat(F.lit('<html><script type="application/ld+json">{"graph": ['), node, F.lit("]}</script></html>"))
    details = links.select("url").distinct().withColumn("html", html)

    def first_on(language):
        of_lang = pages.filter(F.contains("html", F.lit(f'lang="{language}"'))).select("page_id")
        place = F.min(F.col("page_id") * 1000 + F.col("pos")).cast("bigint")
        return links.join(of_lang, "page_id", "left_semi").groupBy("url").agg(place.alias("pos")).withColumn("title", title)

    return listing, details, first_on


# The language site: a limit on new links, records in two languages, all of them written, only written ones remembered.
_TALENT = SITE_RULES["talent"]
_TALENT_SQL = f"""
    {_walk_sql(f"{_TALENT.origin}/view?id=", "SELECT url FROM cur", 8,
               "SELECT coalesce(min(page_no) - 1, 1000000000) FROM counts WHERE page_no > 1 AND n = 0")},
    new AS (SELECT * FROM walked WHERE url NOT IN (SELECT url FROM cur) ORDER BY ord LIMIT 100),
    fresh AS (SELECT * FROM new WHERE ok AND {_recent_sql("posting_date", 17)})
"""


def _talent_run(spark, sf):
    listing, details, first_on = _link_tables(spark, sf, _TALENT, "/view?id=")
    current = first_on("fr").select(
        (F.col("pos") + 1).alias("id"),
        "pos",
        "url",
        "title",
        F.when(F.col("title") == "Stelle", F.lit("mit Arbeit")).otherwise("experience").alias("description"),
        F.lit("2023-01-15").alias("posting_date"),
    )
    seen = spark.createDataFrame([], "key string")
    return collect_pages(
        listing, details, current, seen, _TALENT, POLICIES["talent"], AS_OF, days=17, stop_after_known=8, max_jobs=100,
        detail="nested",
    )


@query(
    "run_two_language_source",
    f"""
    WITH {_TALENT_SQL},
    r AS (SELECT url, ord + 1 AS id, 0 AS batch, ord AS pos, title, '2023-01-15' AS posting_date, fr_en FROM cur
          UNION ALL SELECT url, NULL, 1, ord, title, posting_date, fr_en FROM fresh),
    kept AS (SELECT * FROM r WHERE fr_en),
    {merge_sql(rows="kept", columns="url, title, posting_date")}
    SELECT id, url, title, posting_date FROM merged
    """,
)
def run_two_language_source(spark, sf):
    return _talent_run(spark, sf).written.select("id", "url", "title", "posting_date")


@query(
    "run_site_report",
    f"""
    WITH {_TALENT_SQL}
    SELECT (SELECT count(*) FROM walked) AS n_links, count(*) AS n_new,
           count(*) FILTER (ok AND {_recent_sql("posting_date", 17)}) AS n_ok, count(*) FILTER (NOT ok) AS n_errors,
           count(*) FILTER (ok AND NOT {_recent_sql("posting_date", 17)}) AS n_out_of_window,
           (SELECT count(*) FROM fresh WHERE NOT fr_en) AS n_language
    FROM new
    """,
)
def run_site_report(spark, sf):
    return _talent_run(spark, sf).report.select(*REPORT)


# The two-level site: links of German pages are the master, which ends the walk but gives no known link; page 1 reports
# how many pages count.
_JOBUP = SITE_RULES["jobup"]
_JOBUP_SQL = f"""
    {_walk_sql(f"{_JOBUP.origin}/fr/emplois/detail/", "SELECT url FROM cur UNION SELECT url FROM master", 60,
               "SELECT (max(page_id) + 1) * 2 // 3 FROM pages")},
    fresh AS (SELECT * FROM walked WHERE ok AND url NOT IN (SELECT url FROM cur)),
    r AS (SELECT url, ord * 2 + 1 AS id, 0 AS batch, ord AS pos, 'mid' AS title, '2024-01-20' AS posting_date FROM master
          UNION ALL SELECT url, NULL, 1, ord, title, posting_date FROM fresh),
    {merge_sql(columns="url, title, posting_date")},
    second AS (
      WITH r AS (SELECT url, ord + 1 AS id, 0 AS batch, ord AS pos, 'old' AS title, '2024-01-15' AS posting_date FROM cur
                 UNION ALL SELECT url, NULL, 1, -id, title, posting_date FROM merged),
      {merge_sql(columns="url, title, posting_date")}
      SELECT * FROM merged)
"""


@query(
    "run_two_level_source",
    f"""
    WITH {_JOBUP_SQL}
    SELECT 'master' AS level, id, url, title, posting_date FROM merged
    UNION ALL SELECT 'output', id, url, title, posting_date FROM second WHERE {_recent_sql("posting_date", 17)}
    """,
)
def run_two_level_source(spark, sf):
    listing, details, first_on = _link_tables(spark, sf, _JOBUP, "/fr/emplois/detail/")
    n_pages = (table(spark, sf, "pages").agg(F.max("page_id").alias("m")).first()["m"] + 1) * 2 // 3
    told = F.concat("html", F.lit(f'<script>{{"totalPages": {n_pages}}}</script>'))
    listing = listing.withColumn("html", F.when(F.col("page_no") == 1, told).otherwise(F.col("html")))
    listing = listing.withColumn("total", total_pages_reported(F.col("html")))

    def known(language, at, title, day):
        return first_on(language).select(
            at.cast("bigint").alias("id"), "pos", "url", F.lit(title).alias("title"), F.lit(day).alias("posting_date")
        )

    current = known("fr", F.col("pos") + 1, "old", "2024-01-15")
    master = known("de", F.col("pos") * 2 + 1, "mid", "2024-01-20")
    seen = spark.createDataFrame([], "key string")
    run = collect_pages(
        listing, details, current, seen, _JOBUP, POLICIES["jobup"], AS_OF, days=17, stop_after_known=60, master=master
    )
    columns = ["id", "url", "title", "posting_date"]
    levels = [df.select(F.lit(name).alias("level"), *columns) for name, df in (("master", run.master), ("output", run.written))]
    return levels[0].unionByName(levels[1])


# The card site: eight suppliers a page; after half of the pages one comes again, which ends the walk. Every fifth
# supplier is current, some pages are missing, some name no day, a feed fills in for a third.
_GE = SITE_RULES["ge"]
_SUMMARY = "mot " * 30
_GE_SQL = f"""
    s AS (SELECT s_suppkey AS pos, '{_GE.origin}{_CARD_URL}' || s_suppkey AS url, s_name, 'Département ' || n_name AS departement,
                 CASE WHEN s_nationkey % 2 = 0 THEN 'classe ' || s_nationkey ELSE n_name END AS remuneration
          FROM supplier JOIN nation ON s_nationkey = n_nationkey),
    walked AS (SELECT * FROM s WHERE pos // 8 < (SELECT (max(pos) // 8 + 1) // 2 FROM s)),
    d AS (SELECT *, CASE WHEN pos % 4 = 0 THEN 'Titre ' ELSE 'Poste ' END || s_name AS title, trim('{_SUMMARY}') AS description,
                 CASE WHEN pos % 3 = 0 THEN 'En bref ' || s_name END AS summary,
                 CASE WHEN pos % 2 = 0 THEN '2024-01-' || lpad(CAST(1 + pos % 28 AS VARCHAR), 2, '0')
                      WHEN pos % 3 = 0 THEN '2024-01-' || (11 + pos % 10) END AS posting_date,
                 '2024-03-01' AS date_limite FROM walked WHERE pos % 5 <> 0 AND pos % 7 <> 3),
    fresh AS (SELECT * FROM d WHERE posting_date IS NOT NULL AND {_recent_sql("posting_date", 20)}),
    r AS (SELECT url, CASE WHEN pos % 10 = 0 THEN pos + 1 END AS id, 0 AS batch, pos, 'old' AS title, NULL AS departement,
                 NULL AS remuneration, NULL AS description, NULL AS summary, '2024-01-' || (10 + pos % 15) AS posting_date,
                 NULL AS date_limite FROM s WHERE pos % 5 = 0
          UNION ALL SELECT url, NULL, 1, pos, title, departement, remuneration, description, summary, posting_date, date_limite
          FROM fresh),
    {merge_sql(columns="url, title, departement, remuneration, description, summary, posting_date, date_limite")},
    written AS (SELECT * EXCLUDE (key) FROM merged WHERE {_recent_sql("posting_date", 20)})
"""
_GE_COLUMNS = ["id", "url", "title", "departement", "remuneration", "description", "summary", "posting_date", "date_limite"]


def _card_run(spark, sf):
    pages = _card_pages(spark, sf)
    half = (pages.agg(F.max("page_id").alias("m")).first()["m"] + 1) // 2
    at = F.col("page_id")
    again = F.when(at == half - 1, F.array(at + 1, at + 2)).otherwise(F.array(at + F.when(at < half, 1).otherwise(2)))
    listing = pages.select(
        F.lit("ge").alias("source"), F.lit("r1").alias("run_id"), F.explode(again).alias("page_no"),
        F.lit(200).alias("status"), "html",
    )
    number = F.col("s_suppkey")
    suppliers = table(spark, sf, "supplier")
    url = F.concat(F.lit(_GE.origin + _CARD_URL), number.cast("string"))
    head = F.when(number % 4 == 0, F.concat(F.lit("<h1>Titre "), "s_name", F.lit("</h1>"))).otherwise("<h1> </h1>")
    day = F.concat(F.lit("Publié le "), F.lpad((number % 28 + 1).cast("string"), 2, "0"), F.lit(".01.2024"))
    html = F.concat(
        head,
        F.lit("<article>"),
        F.when(number % 2 == 0, day).otherwise(""),
        F.lit(f" <p>{_SUMMARY}</p> date limite 1.3.2024</article>"),
    )
    details = suppliers.filter(number % 7 != 3).select(url.alias("url"), html.alias("html"))
    item = F.concat(
        F.lit("<item><title>x</title><link>"),
        url,
        F.lit("</link><pubDate>Sun, "),
        (number % 10 + 11).cast("string"),
        F.lit(" Jan 2024 10:00:00 +0100</pubDate><description>&lt;p&gt;En bref "),
        "s_name",
        F.lit("&lt;/p&gt;</description></item>"),
    )
    packed = suppliers.filter(number % 3 == 0).select(F.floor(number / 60).alias("page"), number, item.alias("item"))
    packed = packed.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "item"))).alias("_list"))
    text = F.concat(F.lit("<rss><channel><title>x</title>"), F.array_join("_list.item", "\n"), F.lit("</channel></rss>"))
    feed = rss_items(packed.select(F.format_string("feed-%012d.xml", "page").alias("path"), text.alias("text")))
    empty = {c: F.lit(None).cast("string") for c in ("departement", "taux", "remuneration", "description", "summary", "date_limite")}
    current = suppliers.filter(number % 5 == 0).select(
        F.when(number % 10 == 0, number + 1).alias("id"),
        number.alias("pos"),
        url.alias("url"),
        F.lit("old").alias("title"),
        F.concat(F.lit("2024-01-"), (number % 15 + 10).cast("string")).alias("posting_date"),
        F.lit("ge").alias("source"),
        *[column.alias(name) for name, column in empty.items()],
    )
    seen = spark.createDataFrame([], "key string")
    return collect_pages(
        listing, details, current, seen, _GE, POLICIES["ge"], AS_OF, days=20, feed=feed, detail="page"
    )


@query("run_card_source", f"WITH {_GE_SQL} SELECT * FROM written")
def run_card_source(spark, sf):
    return _card_run(spark, sf).written.select(*_GE_COLUMNS)


@query("run_card_source_seen", f"WITH {_GE_SQL} SELECT url AS key FROM written")
def run_card_source_seen(spark, sf):
    return _card_run(spark, sf).seen
