"""Upsert queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobsluice.operators import filters, merge, ordered
from jobsluice.operators.keys import record_key
from jobsluice.operators.normalize import with_default_source
from jobsluice.queries.registry import query, table
from jobsluice.queries.texts import _hits_sql

# Events of the first three days are the current table, later ones the fresh batch.
# The key is user and event type; a small value has a blank URL, an error no id.
SPLIT = "2024-01-04"
URL = "https://jobs.example.com/u/"

_ROWS_SQL = f"""
    r AS (SELECT CASE WHEN value < 2 THEN '  ' ELSE ' {URL}' || user_id || '/' || event_type || ' ' END AS url,
                 CASE WHEN ts < TIMESTAMP '{SPLIT}' THEN 0 ELSE 1 END AS batch, event_id AS pos,
                 CASE WHEN ts < TIMESTAMP '{SPLIT}' AND event_type <> 'error' THEN event_id + 1 END AS id,
                 props AS title, value AS salary_min, CAST(user_id % 3 AS VARCHAR) AS company, event_type AS location
          FROM events)
"""


def batches(spark, sf):
    early = F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz")
    user = F.col("user_id").cast("string")
    url = F.concat(F.lit(f" {URL}"), user, F.lit("/"), "event_type", F.lit(" "))
    rows = table(spark, sf, "events").select(
        early.alias("early"),
        F.when(F.col("value") < 2, F.lit("  ")).otherwise(url).alias("url"),
        F.col("event_id").alias("pos"),
        F.when(early & (F.col("event_type") != "error"), F.col("event_id") + 1).alias("id"),
        F.col("props").alias("title"),
        F.col("value").alias("salary_min"),
        (F.col("user_id") % 3).cast("string").alias("company"),
        F.col("event_type").alias("location"),
    )
    return rows.filter("early").drop("early"), rows.filter("NOT early").drop("early")


def merge_sql(rows="r", key="trim(url)", backfill=True, max_from="r", columns="url, title, salary_min"):
    late = "" if backfill else "WHERE old IS NOT NULL OR fpos IS NOT NULL"
    return f"""
    k AS (SELECT *, {key} AS key FROM {rows} WHERE {key} <> ''),
    win AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY batch DESC, pos DESC) AS n FROM k)
            WHERE n = 1),
    old AS (SELECT key, id AS old FROM (
              SELECT key, id, row_number() OVER (PARTITION BY key ORDER BY pos DESC) AS n FROM k WHERE batch = 0)
            WHERE n = 1),
    firsts AS (SELECT key, min(pos) FILTER (batch = 1) AS fpos, min(pos) AS opos FROM k GROUP BY key),
    top AS (SELECT greatest(coalesce(max(id), 0), 0) AS top FROM {max_from} WHERE batch = 0),
    nums AS (SELECT f.key, o.old,
                    row_number() OVER (PARTITION BY o.old IS NULL ORDER BY fpos IS NULL, coalesce(fpos, opos)) AS n
             FROM firsts f LEFT JOIN old o USING (key) {late}),
    merged AS (SELECT CAST(coalesce(old, CASE WHEN nums.n IS NOT NULL THEN top + nums.n END) AS BIGINT) AS id,
                      win.key, {columns}
               FROM win LEFT JOIN nums USING (key), top)
    """


@query("merge_by_url", f"WITH {_ROWS_SQL}, {merge_sql()} SELECT id, url, title, salary_min FROM merged")
def merge_by_url(spark, sf):
    return merge.merge_by_url(*batches(spark, sf)).select("id", "url", "title", "salary_min")


@query(
    "merge_by_key",
    f"""
    WITH {_ROWS_SQL},
    {merge_sql(key="coalesce(nullif(trim(url), ''), lower(trim(title) || '|' || company || '|' || location))",
               backfill=False)}
    SELECT id, url, title, salary_min FROM merged
    """,
)
def merge_by_key(spark, sf):
    return merge.merge_by_key(*batches(spark, sf)).select("id", "url", "title", "salary_min")


@query(
    "record_key",
    f"""
    WITH {_ROWS_SQL}
    SELECT pos, coalesce(nullif(trim(url), ''), lower(trim(title) || '|' || company || '|' || location)) AS key FROM r
    """,
)
def record_keys(spark, sf):
    current, fresh = batches(spark, sf)
    return current.unionByName(fresh).select("pos", record_key().alias("key"))


@query("drop_blank_key", f"WITH {_ROWS_SQL} SELECT pos, trim(url) AS url FROM r WHERE trim(url) <> ''")
def drop_blank_key(spark, sf):
    current, fresh = batches(spark, sf)
    return filters.drop_blank_key(current.unionByName(fresh)).select("pos", "url")


@query("max_id", f"WITH {_ROWS_SQL} SELECT greatest(coalesce(max(id), 0), 0) AS max_id FROM r")
def max_id(spark, sf):
    current, fresh = batches(spark, sf)
    return merge.max_id(current.unionByName(fresh))


@query(
    "assign_ids",
    """
    SELECT event_id, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY event_id) AS id
    FROM events
    """,
)
def assign_ids(spark, sf):
    rows = table(spark, sf, "events").select("event_id")
    start = table(spark, sf, "orders").agg(F.max("o_orderkey").alias("m")).first()["m"]
    return merge.assign_ids(rows, start, "event_id")


@query("order_by_id", f"WITH {_ROWS_SQL} SELECT id, pos FROM r ORDER BY coalesce(id, 0) DESC, pos")
def order_by_id(spark, sf):
    current, fresh = batches(spark, sf)
    return ordered.newest_first(current.unionByName(fresh).select("id", "pos"), "pos")


@query(
    "default_source",
    "SELECT event_id, CASE WHEN event_type = 'view' THEN 'ge' ELSE event_type END AS source FROM events",
)
def default_source(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("source")
    )
    return with_default_source(rows, "ge")


# Documents with a label are the current table, the others the fresh batch; the key
# is source, language and size class.
_DOCS_SQL = f"""
    d AS (SELECT 'https://d.example.com/' || source || '/' || lang || '/' || (n_chars // 200) AS url,
                 CASE WHEN l.doc_id IS NULL THEN 1 ELSE 0 END AS batch, d.doc_id AS pos,
                 CASE WHEN l.quality = 1 THEN d.doc_id + 1 END AS id, text,
                 CASE lang WHEN 'fr' THEN 'Poste' WHEN 'en' THEN 'Job' ELSE lang END AS title
          FROM documents d LEFT JOIN labels l USING (doc_id)),
    {_hits_sql(filters.lang.ACCENTED_TOKEN, filters.lang.ACCENTED_HINTS)},
    kept AS (SELECT * FROM h WHERE (n_fr >= 2 OR n_en >= 2) AND greatest(n_fr, n_en) >= greatest(n_de, n_it))
"""


@query(
    "merge_lang",
    f"""
    WITH {_DOCS_SQL}, {merge_sql(rows="kept", max_from="d", columns="url, title, pos")}
    SELECT id, url, title, pos FROM merged
    """,
)
def merge_lang(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    size = F.floor(F.col("n_chars") / 200).cast("string")
    lang = F.col("lang")
    rows = docs.select(
        F.concat(F.lit("https://d.example.com/"), "source", F.lit("/"), lang, F.lit("/"), size).alias("url"),
        F.col("toxic").isNull().alias("late"),
        F.col("doc_id").alias("pos"),
        F.when(F.col("quality") == 1, F.col("doc_id") + 1).alias("id"),
        F.when(lang == "fr", "Poste").when(lang == "en", "Job").otherwise(lang).alias("title"),
        F.col("text").alias("description"),
        F.col("doc_id").alias("from_doc"),
    )
    current, fresh = rows.filter("NOT late").drop("late"), rows.filter("late").drop("late")
    merged = merge.merge_by_url(current, fresh, language=True)
    return merged.select("id", "url", "title", F.col("from_doc").alias("pos"))


# Two levels: the first week is the output, views of the second the master, all
# events after that the fresh batch.
_TWO_SQL = f"""
    x AS (SELECT '{URL}' || user_id || '/' || event_type AS url, event_id AS pos, props AS title, value AS salary_min,
                 CASE WHEN ts < TIMESTAMP '2024-01-03' THEN 'o' WHEN ts < TIMESTAMP '2024-01-05' THEN 'm' ELSE 'f' END
                   AS part FROM events),
    r AS (SELECT url, pos, title, salary_min, CASE WHEN part = 'm' THEN 0 ELSE 1 END AS batch,
                 CASE WHEN part = 'm' THEN pos * 2 + 1 END AS id FROM x WHERE part <> 'o')
"""


@query(
    "merge_two_level",
    f"""
    WITH {_TWO_SQL}, {merge_sql()},
    second AS (
      WITH r AS (SELECT url, pos, title, salary_min, 0 AS batch, pos + 1 AS id FROM x WHERE part = 'o'
                 UNION ALL SELECT url, -id, title, salary_min, 1, NULL FROM merged),
      {merge_sql()}
      SELECT * FROM merged)
    SELECT 'master' AS level, id, url, title, salary_min FROM merged
    UNION ALL SELECT 'output', id, url, title, salary_min FROM second
    """,
)
def merge_two_level(spark, sf):
    part = (
        F.when(F.col("ts") < F.lit("2024-01-03").cast("timestamp_ntz"), "o")
        .when(F.col("ts") < F.lit("2024-01-05").cast("timestamp_ntz"), "m")
        .otherwise("f")
    )
    user = F.col("user_id").cast("string")
    rows = table(spark, sf, "events").select(
        part.alias("part"),
        F.concat(F.lit(URL), user, F.lit("/"), "event_type").alias("url"),
        F.when(part == "o", F.col("event_id") + 1).when(part == "m", F.col("event_id") * 2 + 1).alias("id"),
        F.col("event_id").alias("pos"),
        F.col("props").alias("title"),
        F.col("value").alias("salary_min"),
    )
    output, master, fresh = (rows.filter(F.col("part") == p).drop("part") for p in "omf")
    new_master, new_output = merge.merge_two_level(output, master, fresh)
    columns = ["id", "url", "title", "salary_min"]
    levels = [("master", new_master), ("output", new_output)]
    first, second = (df.select(F.lit(name).alias("level"), *columns) for name, df in levels)
    return first.unionByName(second)
