"""Listing queries: key sets, ordered cuts, limits. The listing is built from ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobsluice.operators import keys, ordered
from jobsluice.queries.registry import query, table
from jobsluice.schema import listing_order
from jobsluice.session import materialize

# The listing: every event is one row, each event type a source, 25 events a page.
# Known: users with a purchase in the first two days.
URL = "https://jobs.example.com/u/"
KNOWN_UNTIL = "2024-01-03"

E_SQL = f"""
    e AS (SELECT event_type AS source, 'r1' AS run_id, event_id // 25 + 1 AS page_no, event_id % 25 AS pos,
                 event_id, '{URL}' || user_id AS url, ts FROM events),
    known AS (SELECT DISTINCT url FROM e WHERE source = 'purchase' AND ts < TIMESTAMP '{KNOWN_UNTIL}')
"""


def listing(spark, sf):
    page_no = (F.floor(F.col("event_id") / 25) + 1).cast("bigint")
    rows = table(spark, sf, "events").select(
        F.col("event_type").alias("source"),
        F.lit("r1").alias("run_id"),
        page_no.alias("page_no"),
        (F.col("event_id") % 25).alias("pos"),
        "event_id",
        F.concat(F.lit(URL), F.col("user_id").cast("string")).alias("url"),
        "ts",
    )
    return rows.withColumn("ord", listing_order(F.col("page_no"), F.col("pos")))


def early_purchases(spark, sf):
    rows = listing(spark, sf)
    return rows.filter((F.col("source") == "purchase") & (F.col("ts") < F.lit(KNOWN_UNTIL).cast("timestamp_ntz")))


def known_set(spark, sf):
    return keys.key_set(early_purchases(spark, sf))


def flagged(spark, sf):
    rows = listing(spark, sf).select("source", "run_id", "page_no", "event_id", "url", "ord")
    return keys.known_flag(rows, known_set(spark, sf), spread_by=["source", "run_id", "ord"])


@query(
    "known_keys",
    f"""
    WITH {E_SQL}
    SELECT url AS key FROM known
    UNION SELECT '{URL}' || c_custkey FROM customer
    UNION SELECT url FROM e WHERE source = 'signup'
    """,
)
def known_keys(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.concat(F.lit(f" {URL}"), F.col("c_custkey").cast("string"), F.lit("\n")).alias("key")
    )
    signups = listing(spark, sf).filter("source = 'signup'").select("url")
    return keys.known_keys(known_set(spark, sf), customers, signups)


@query(
    "new_records",
    f"WITH {E_SQL} SELECT event_id, source, url FROM e WHERE url NOT IN (SELECT url FROM known)",
)
def new_records(spark, sf):
    rows = listing(spark, sf).select("event_id", "source", "url")
    return keys.new_records(rows, known_set(spark, sf), spread_by=["event_id"])


@query(
    "known_flag",
    f"WITH {E_SQL} SELECT event_id, url, url IN (SELECT url FROM known) AS known FROM e",
)
def known_flag(spark, sf):
    return flagged(spark, sf).select("event_id", "url", "known")


@query(
    "added_keys",
    f"""
    WITH {E_SQL}
    SELECT DISTINCT url AS key FROM e WHERE url NOT IN (SELECT url FROM known)
    """,
)
def added_keys(spark, sf):
    return keys.added_keys(early_purchases(spark, sf), listing(spark, sf).select("url"))


@query("sorted_seen", f"WITH {E_SQL} SELECT DISTINCT url AS key FROM e ORDER BY key")
def sorted_seen(spark, sf):
    return keys.sorted_seen(keys.key_set(listing(spark, sf)))


# Seen policies: known, all purchases; listing, all events but the signups; fresh, the signups
# that are not known; merged, both; written, merged keys that occur on the last day. Addresses
# hold the kind of event, so that the sets differ.
_SEEN_SQL = f"""
    e AS (SELECT event_type AS source, event_id, ts,
                 '{URL}' || user_id || CASE WHEN event_id % 2 = 0 THEN '' ELSE '/' || event_type END AS url FROM events),
    known AS (SELECT DISTINCT url FROM e WHERE source = 'purchase'),
    listed AS (SELECT url FROM e WHERE source <> 'signup'),
    fresh AS (SELECT url FROM e WHERE source = 'signup' AND url NOT IN (SELECT url FROM known)),
    merged AS (SELECT url FROM known UNION SELECT url FROM fresh),
    written AS (SELECT m.url FROM merged m JOIN e USING (url) GROUP BY m.url
                HAVING max(ts) >= TIMESTAMP '2024-01-30')
"""


def _seen_tables(spark, sf):
    rows = listing(spark, sf)
    kind = F.when(F.col("event_id") % 2 == 0, "").otherwise(F.concat(F.lit("/"), "source"))
    rows = rows.withColumn("url", F.concat("url", kind))
    known = keys.key_set(rows.filter("source = 'purchase'"))
    signups = rows.filter("source = 'signup'").select("url", "event_id")
    fresh = keys.new_records(signups, known, spread_by=["event_id"]).select("url")
    merged = known.select(F.col("key").alias("url")).union(fresh).distinct()
    last = rows.groupBy("url").agg(F.max("ts").alias("last"))
    recent = last.filter(F.col("last") >= F.lit("2024-01-30").cast("timestamp_ntz")).select("url")
    return {
        "known": known,
        "listing": rows.filter("source <> 'signup'").select("url"),
        "merged": merged,
        "written": merged.join(recent, "url", "left_semi"),
        "fresh": fresh,
    }


def _seen(policy):
    return lambda spark, sf: keys.next_seen(policy, **_seen_tables(spark, sf))


for _policy, _sets in {
    "all": ("known", "listed", "merged"),
    "merged": ("merged",),
    "persisted": ("written",),
    "fresh": ("known", "fresh"),
}.items():
    _union = " UNION ".join(f"SELECT url AS key FROM {name}" for name in _sets)
    query(f"seen_{_policy}", f"WITH {_SEEN_SQL} {_union}")(_seen(_policy))


@query(
    "first_seen",
    f"""
    WITH {E_SQL}
    SELECT source, url, event_id, page_no, pos FROM (
      SELECT *, row_number() OVER (PARTITION BY source, url ORDER BY event_id) AS r FROM e) WHERE r = 1
    """,
)
def first_seen(spark, sf):
    rows = ordered.first_seen(listing(spark, sf), ("source", "url"))
    return rows.select("source", "url", "event_id", "page_no", "pos")


def _dedup_sql(order):
    return f"""
    WITH {E_SQL}
    SELECT url, event_id, source FROM (
      SELECT *, row_number() OVER (PARTITION BY url ORDER BY event_id {order}) AS r FROM e) WHERE r = 1
    """


@query("batch_dedup_first", _dedup_sql("ASC"))
def batch_dedup_first(spark, sf):
    return ordered.batch_dedup(listing(spark, sf).select("url", "event_id", "source", "ord"), "url", "first").drop("ord")


@query("batch_dedup_last", _dedup_sql("DESC"))
def batch_dedup_last(spark, sf):
    return ordered.batch_dedup(listing(spark, sf).select("url", "event_id", "source", "ord"), "url", "last").drop("ord")


@query("distinct_urls", f"WITH {E_SQL} SELECT source, count(DISTINCT url) AS n_urls FROM e GROUP BY source")
def distinct_urls(spark, sf):
    return ordered.distinct_urls(listing(spark, sf), ["source"])


def _streak_sql(counted, n):
    return f"""
    WITH {E_SQL},
    counted AS ({counted}),
    scan AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY event_id) AS rn FROM counted),
    streaks AS (SELECT *, rn - coalesce(max(CASE WHEN NOT known THEN rn END)
                                        OVER (PARTITION BY source ORDER BY event_id), 0) AS streak FROM scan),
    cut AS (SELECT source, min(event_id) AS cut_id FROM streaks WHERE streak >= {n} GROUP BY source)
    SELECT e.source, e.event_id, e.page_no, e.url FROM e LEFT JOIN cut USING (source)
    WHERE cut_id IS NULL OR event_id <= cut_id
    """


@query(
    "streak_cut_a",
    _streak_sql(
        """SELECT source, event_id, url IN (SELECT url FROM known) AS known
           FROM (SELECT *, row_number() OVER (PARTITION BY source, url ORDER BY event_id) AS r FROM e)
           WHERE r = 1 AND page_no > 1""",
        5,
    ),
)
def streak_cut_a(spark, sf):
    cut = ordered.streak_cut(flagged(spark, sf), 5, "a", ["source", "run_id"])
    return ordered.apply_cut(listing(spark, sf), cut).select("source", "event_id", "page_no", "url")


@query("streak_cut_b", _streak_sql("SELECT source, event_id, url IN (SELECT url FROM known) AS known FROM e", 10))
def streak_cut_b(spark, sf):
    return ordered.cut_after_streak(flagged(spark, sf), 10, "b").select("source", "event_id", "page_no", "url")


@query(
    "limit_new",
    f"""
    WITH {E_SQL}
    SELECT source, event_id, url FROM (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY event_id) AS r
      FROM e WHERE url NOT IN (SELECT url FROM known)) WHERE r <= 30
    """,
)
def limit_new(spark, sf):
    new = flagged(spark, sf).filter("NOT known")
    return ordered.limit_new(new, 30).select("source", "event_id", "url")


@query(
    "limit_prefix",
    f"""
    WITH {E_SQL},
    a AS (SELECT source, event_id, row_number() OVER (PARTITION BY source ORDER BY event_id) AS r
          FROM e WHERE url NOT IN (SELECT url FROM known)),
    cut AS (SELECT source, event_id AS cut_id FROM a WHERE r = 40)
    SELECT e.source, e.event_id, e.url FROM e LEFT JOIN cut USING (source) WHERE cut_id IS NULL OR event_id <= cut_id
    """,
)
def limit_prefix(spark, sf):
    return ordered.limit_prefix(flagged(spark, sf), ~F.col("known"), 40).select("source", "event_id", "url")


# Page rules run over one walk per rule: all events, 25 a page. Page 1 reports the
# totals: pages up to the middle of the walk, users of the known set.
_PAGE_SQL = f"""
    {E_SQL},
    p AS (SELECT page_no, count(*) AS n_rows,
                 CASE WHEN page_no = (SELECT count(DISTINCT url) FROM e WHERE source = 'view') THEN 500 ELSE 200 END
                   AS status
          FROM e GROUP BY page_no),
    firsts AS (SELECT url, min(page_no) AS page_no FROM e GROUP BY url),
    n AS (SELECT p.*, coalesce(f.n_new, 0) AS n_new, sum(coalesce(f.n_new, 0)) OVER (ORDER BY p.page_no) AS n_cum,
                 (SELECT max(page_no) // 2 FROM p) AS half, (SELECT count(*) FROM known) AS n_known
          FROM p LEFT JOIN (SELECT page_no, count(*) AS n_new FROM firsts GROUP BY page_no) f USING (page_no))
"""


@query(
    "page_prefix",
    f"""
    WITH {_PAGE_SQL},
    stops AS (
      SELECT 'total' AS rule, least(half, max(page_no), coalesce(min(page_no) FILTER (status >= 400) - 1, half))
               AS last_page FROM n GROUP BY half
      UNION ALL
      SELECT 'empty', least(max(page_no), min(page_no) FILTER (status >= 400) - 1) FROM n
      UNION ALL
      SELECT 'no_new', least(max(page_no), min(page_no) FILTER (status >= 400) - 1,
               min(page_no) FILTER (page_no > 1 AND n_new = 0)) FROM n
      UNION ALL
      SELECT 'short', least(max(page_no), min(page_no) FILTER (status >= 400) - 1,
               min(page_no) FILTER (n_rows < 25 OR page_no * 25 >= half * 25)) FROM n
      UNION ALL
      SELECT 'distinct', least(max(page_no), min(page_no) FILTER (status >= 400) - 1,
               min(page_no) FILTER (n_cum >= n_known)) FROM n)
    SELECT rule, CAST(last_page AS BIGINT) AS last_page, count(*) AS n_rows
    FROM stops JOIN e ON e.page_no <= last_page GROUP BY ALL
    """,
)
def page_prefix(spark, sf):
    rows = listing(spark, sf).withColumn("source", F.lit("walk"))
    pages = ordered.page_summary(rows)
    half = F.floor(F.max("page_no") / 2).cast("bigint")
    facts = pages.groupBy("source", "run_id").agg(half.alias("half"))
    n_known = known_set(spark, sf).groupBy(F.lit("walk").alias("source")).agg(F.count("*").alias("n_known"))
    views = listing(spark, sf).filter("source = 'view'").groupBy(F.lit("walk").alias("source"))
    bad = views.agg(F.count_distinct("url").alias("bad_page"))
    pages = pages.join(facts, ["source", "run_id"]).join(n_known, "source").join(bad, "source")
    pages = pages.withColumn("status", F.when(F.col("page_no") == F.col("bad_page"), 500).otherwise(200))
    pages = materialize(pages, "pages")
    totals = {
        "total": F.col("half"),
        "empty": F.lit(None).cast("bigint"),
        "no_new": F.lit(None).cast("bigint"),
        "short": F.col("half") * 25,
        "distinct": F.col("n_known"),
    }
    out = None
    for rule, total in totals.items():
        first = F.when(F.col("page_no") == 1, total)
        ends = ordered.last_page(pages.withColumn("total", first), rule)
        kept = ordered.page_prefix(rows.withColumn("rule", F.lit(rule)), ends)
        kept = kept.join(ends, ["source", "run_id"]).groupBy("rule", "last_page").agg(F.count("*").alias("n_rows"))
        out = kept if out is None else out.unionByName(kept)
    return out
