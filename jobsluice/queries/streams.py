"""Streaming queries: the events land in three parts, the stream runs after each."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from jobsluice.queries.listings import known_set, listing
from jobsluice.queries.registry import query, table
from jobsluice.schema import Policy
from jobsluice.session import scratch_path
from jobsluice.sources.sinks import SnapshotStore
from jobsluice.streaming import jobs as J

PARTS = ("2024-01-11", "2024-01-21")
SCHEMA = "id bigint, url string, title string, posting_date string"

_ROWS_SQL = f"""
    e AS (SELECT 'https://jobs.example.com/u/' || user_id || '/' || event_type || '/' || CAST(floor(value) AS BIGINT) % 4
                   AS url, props AS title, strftime(ts, '%Y-%m-%d') AS posting_date, CAST(ts AS DATE) AS day,
                 event_id AS pos, event_type AS source, user_id, event_id // 25 + 1 AS page_no,
                 CASE WHEN ts < TIMESTAMP '{PARTS[0]}' THEN 1 WHEN ts < TIMESTAMP '{PARTS[1]}' THEN 2 ELSE 3 END AS part
          FROM events),
    b AS (SELECT part, max(day) AS as_of FROM e GROUP BY part)
"""


def _rows(spark, sf):
    ts = F.col("ts")
    part = F.when(ts < F.lit(PARTS[0]).cast("timestamp_ntz"), 1).when(ts < F.lit(PARTS[1]).cast("timestamp_ntz"), 2)
    url = F.concat_ws(
        "/",
        F.lit("https://jobs.example.com/u"),
        F.col("user_id").cast("string"),
        "event_type",
        (F.floor("value") % 4).cast("string"),
    )
    return table(spark, sf, "events").select(
        part.otherwise(3).alias("part"),
        url.alias("url"),
        F.col("props").alias("title"),
        F.date_format("ts", "yyyy-MM-dd").alias("posting_date"),
        F.col("event_id").alias("pos"),
        F.col("event_type").alias("source"),
        F.lit("r1").alias("run_id"),
        (F.floor(F.col("event_id") / 25) + 1).cast("bigint").alias("page_no"),
        (F.col("event_id") % 25).alias("pos_on_page"),
    )


def _feed_parts(rows, label, run):
    """Land the parts one after another and run the stream after each; ``run(stream, folder)``."""
    spark = rows.sparkSession
    base = scratch_path(spark, label)
    for n in (1, 2, 3):
        rows.filter(F.col("part") == n).drop("part").write.parquet(f"{base}/landing/part-{n}")
        run(J.file_stream(spark, f"{base}/landing", rows.drop("part").schema), base)
    return base


def _last_day(rows) -> date | None:
    last = rows.agg(F.max("posting_date").alias("d")).first()["d"]
    return date.fromisoformat(last) if last else None


def _ingest_sql(days, keep_seen):
    """Three runs: new keys of a part within the window, next ids, output window."""
    steps = ["s0 AS (SELECT NULL::BIGINT AS id, '' AS url, '' AS title, DATE '2000-01-01' AS day WHERE false)",
             "k0 AS (SELECT '' AS url WHERE false)"]
    for n in (1, 2, 3):
        old = n - 1
        pick = "pos DESC" if keep_seen else "pos"
        fresh_first = "" if keep_seen else "WHERE n = 1"
        steps.append(f"""
        f{n} AS (SELECT x.*, as_of FROM (
                   SELECT *, row_number() OVER (PARTITION BY url ORDER BY pos) AS n FROM e WHERE part = {n}) x
                 JOIN b USING (part) {fresh_first}),
        a{n} AS (SELECT * FROM f{n} WHERE url NOT IN (SELECT url FROM k{old})
                   AND date_diff('day', day, as_of) BETWEEN 0 AND {days}),
        n{n} AS (SELECT url, arg_max(title, -r) AS title, arg_max(day, -r) AS day, min(pos) AS pos FROM (
                   SELECT *, row_number() OVER (PARTITION BY url ORDER BY {pick}) AS r FROM a{n}) GROUP BY url),
        m{n} AS (SELECT id, url, title, day FROM s{old} UNION ALL
                 SELECT (SELECT coalesce(max(id), 0) FROM s{old}) + row_number() OVER (ORDER BY pos), url, title, day
                 FROM n{n}),
        s{n} AS (SELECT m{n}.* FROM m{n}, b WHERE part = {n} AND date_diff('day', day, as_of) BETWEEN 0 AND {days})
        """)
        seen = f"SELECT url FROM k{old} UNION SELECT url FROM e WHERE part = {n}" if keep_seen else ""
        steps.append(f"k{n} AS ({seen or f'SELECT url FROM s{n}'})")
    return f"WITH {_ROWS_SQL}, " + ", ".join(steps)


@query(
    "stream_ingest",
    f"{_ingest_sql(15, True)} SELECT id, url, title, strftime(day, '%Y-%m-%d') AS posting_date FROM s3",
)
def stream_ingest(spark, sf):
    policy = Policy("demo", streak="b", days=15)
    rows = _rows(spark, sf).withColumn("source", F.lit("demo")).drop("pos")

    def run(stream, base):
        store = SnapshotStore(spark, f"{base}/store", SCHEMA, "demo")
        J.run_available(stream, J.ingest(store, policy, _last_day, stop_after_known=0), f"{base}/checkpoint")

    base = _feed_parts(rows, "ingest", run)
    return SnapshotStore(spark, f"{base}/store", SCHEMA, "demo").jobs()


@query(
    "stream_retention",
    f"{_ingest_sql(8, False)} SELECT id, url, strftime(day, '%Y-%m-%d') AS posting_date FROM s3",
)
def stream_retention(spark, sf):
    rows = _rows(spark, sf).select("part", "url", "posting_date", "pos")
    schema = "id bigint, url string, posting_date string"

    def run(stream, base):
        store = SnapshotStore(spark, f"{base}/store", schema, "demo")
        J.run_available(stream, J.retain(store, _last_day, 8), f"{base}/checkpoint")

    base = _feed_parts(rows, "retention", run)
    return SnapshotStore(spark, f"{base}/store", schema, "demo").jobs()


@query("stream_first_seen", f"WITH {_ROWS_SQL} SELECT DISTINCT url AS key FROM e")
def stream_first_seen(spark, sf):
    rows = _rows(spark, sf).select("part", F.col("url").alias("key"))

    def run(stream, base):
        J.run_available(stream, J.first_seen(f"{base}/out"), f"{base}/checkpoint")

    base = _feed_parts(rows, "first-seen", run)
    return spark.read.schema("key string").parquet(f"{base}/out/keys/batch=*")


@query(
    "stream_first_seen_window",
    f"""
    WITH {_ROWS_SQL},
    d AS (SELECT part, url AS key, max(day) AS day FROM e JOIN b USING (part)
          WHERE date_diff('day', day, as_of) <= 6 GROUP BY ALL),
    o1 AS (SELECT key, day FROM d WHERE part = 1),
    o2 AS (SELECT key, day FROM d WHERE part = 2 AND key NOT IN (
             SELECT key FROM o1, b WHERE b.part = 2 AND date_diff('day', day, as_of) <= 6)),
    o3 AS (SELECT key, day FROM d WHERE part = 3 AND key NOT IN (
             SELECT key FROM (SELECT * FROM o1 UNION ALL SELECT * FROM o2), b
             WHERE b.part = 3 AND date_diff('day', day, as_of) <= 6))
    SELECT key, day FROM o1 UNION ALL SELECT key, day FROM o2 UNION ALL SELECT key, day FROM o3
    """,
)
def stream_first_seen_window(spark, sf):
    rows = _rows(spark, sf).select("part", F.col("url").alias("key"), F.col("posting_date").cast("date").alias("day"))

    def run(stream, base):
        J.run_available(stream, J.first_seen(f"{base}/out", keep_days=6), f"{base}/checkpoint")

    base = _feed_parts(rows, "first-seen-window", run)
    return spark.read.schema("key string, day date").parquet(f"{base}/out/keys/batch=*")


@query(
    "stream_late_drop",
    f"""
    WITH {_ROWS_SQL}
    SELECT pos, url, posting_date FROM e JOIN b USING (part) WHERE date_diff('day', day, as_of) BETWEEN 0 AND 4
    """,
)
def stream_late_drop(spark, sf):
    rows = _rows(spark, sf).select("part", "pos", "url", "posting_date")

    def run(stream, base):
        J.run_available(stream, J.drop_late(f"{base}/out", _last_day, 4), f"{base}/checkpoint")

    base = _feed_parts(rows, "late", run)
    return spark.read.schema("pos bigint, url string, posting_date string").parquet(f"{base}/out/batch=*")


@query(
    "stream_streak",
    f"""
    WITH {_ROWS_SQL},
    k AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND ts < TIMESTAMP '2024-01-03'),
    scan AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY pos) AS rn,
                    user_id IN (SELECT user_id FROM k) AS known FROM e),
    streaks AS (SELECT *, rn - coalesce(max(CASE WHEN NOT known THEN rn END)
                                        OVER (PARTITION BY source ORDER BY pos), 0) AS streak FROM scan),
    cut AS (SELECT source, min(pos) AS cut_pos FROM streaks WHERE streak >= 8 GROUP BY ALL)
    SELECT pos AS event_id, e.source FROM e LEFT JOIN cut USING (source) WHERE cut_pos IS NULL OR pos <= cut_pos
    """,
)
def stream_streak(spark, sf):
    # Every listing lands in three pieces, one after the other.
    part = F.least(F.floor(F.col("event_id") / 60), F.lit(2)).cast("int") + 1
    rows = listing(spark, sf).select(part.alias("part"), "source", "run_id", "event_id", "page_no", "url", "ord")
    known = known_set(spark, sf)

    def run(stream, base):
        J.run_available(stream, J.cut_streaks(f"{base}/out", known, 8, "b"), f"{base}/checkpoint")

    base = _feed_parts(rows, "streak", run)
    return spark.read.schema("event_id bigint, source string").parquet(f"{base}/out/batch=*")
