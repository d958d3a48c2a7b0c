"""Payload and file queries. Payload texts are built from the tables with ``to_json``."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from jobsluice.functions import variant as V
from jobsluice.operators import normalize as N
from jobsluice.operators.report import snapshot_header
from jobsluice.queries.registry import json_pages, query, spread, table
from jobsluice.session import scratch_path
from jobsluice.sources.files import read_documents, read_job_array, read_seen_state, snapshot_read
from jobsluice.sources.payloads import ENVELOPES, payload_pages, unpack_envelope

AS_OF = date(2024, 3, 31)


def write_files(docs, path):
    """Write ``(name, text)`` rows as one file each and read the folder back."""
    spark = docs.sparkSession
    docs.write.partitionBy("name").text(path)
    return read_documents(spark, f"{path}/name=*")


# Files of 500 customers; each list also holds an element that is no object, every
# fourth file is cut off in the middle, every fourth plus one is an object.
_BATCHES_SQL = "c AS (SELECT *, (c_custkey // 500 + 1) % 4 AS form FROM customer)"


def _customer_files(spark, sf, label):
    rows = table(spark, sf, "customer")
    item = F.struct(
        F.when(F.col("c_acctbal") > 0, F.col("c_custkey")).alias("id"),
        F.concat(F.lit("https://jobs.example.com/c/"), F.col("c_custkey").cast("string")).alias("url"),
        F.col("c_name").alias("title"),
        F.when(F.col("c_nationkey") > 5, F.col("c_mktsegment")).alias("company"),
        F.col("c_acctbal").alias("salary_min"),
        (F.col("c_nationkey") > 12).alias("rav_exclusive"),
        F.array("c_mktsegment", F.lit("fr")).alias("language_codes"),
    )
    pages = json_pages(rows, item, "c_custkey", 500)
    form = F.col("page_no") % 4
    text = (
        F.when(form == 0, F.regexp_replace("items", r"\]$", ""))
        .when(form == 1, F.concat(F.lit("\n"), F.regexp_replace("items", r"\]$", ', "stray", 7, null]'), F.lit(" \n")))
        .when(form == 2, F.col("items"))
        .otherwise(F.concat(F.lit('{"jobs":'), "items", F.lit("}")))
    )
    docs = pages.select(F.format_string("f%09d", "page_no").alias("name"), text.alias("text"))
    return write_files(docs, scratch_path(spark, label))


@query(
    "read_job_array",
    f"""
    WITH {_BATCHES_SQL}
    SELECT CASE WHEN c_acctbal > 0 THEN c_custkey END AS id, 'https://jobs.example.com/c/' || c_custkey AS url,
           c_name AS title, CASE WHEN c_nationkey > 5 THEN c_mktsegment END AS company, c_acctbal AS salary_min,
           c_nationkey > 12 AS rav_exclusive, c_mktsegment || ',fr' AS codes, c_custkey % 500 AS pos
    FROM c WHERE form IN (1, 2)
    """,
)
def job_arrays(spark, sf):
    jobs = read_job_array(_customer_files(spark, sf, "arrays"))
    codes = F.array_join("language_codes", ",").alias("codes")
    return jobs.select("id", "url", "title", "company", "salary_min", "rav_exclusive", codes, "pos")


@query(
    "read_seen_state",
    """
    SELECT 'https://jobs.example.com/c/' || c_custkey AS key FROM customer
    WHERE c_acctbal > 0 AND (c_custkey // 500) % 3 < 2
    """,
)
def seen_states(spark, sf):
    rows = table(spark, sf, "customer").select(
        (F.floor(F.col("c_custkey") / 500)).cast("bigint").alias("n"),
        "c_custkey",
        F.when(
            F.col("c_acctbal") > 0, F.concat(F.lit(" https://jobs.example.com/c/"), F.col("c_custkey").cast("string"))
        )
        .otherwise(F.lit("  "))
        .alias("key"),
    )
    files = rows.groupBy("n").agg(F.to_json(F.array_sort(F.collect_list("key"))).alias("keys"))
    body = F.when(F.col("n") % 3 == 2, F.lit('"none"')).otherwise(F.col("keys"))
    text = F.concat(F.lit('{"last_run_at": "2024-01-01T00:00:00", "seen_urls": '), body, F.lit(', "days": 30}\n'))
    docs = files.select(F.format_string("s%09d", "n").alias("name"), text.alias("text"))
    return read_seen_state(write_files(docs, scratch_path(spark, "states"))).select("key")


_SNAP_SQL = """
    s AS (SELECT c_custkey // 500 AS n, 'C' || (c_custkey // 500) % 5 AS canton, * FROM customer),
    w AS (SELECT *, count(*) OVER (PARTITION BY n) AS total,
                 count(*) FILTER (c_nationkey > 12) OVER (PARTITION BY n) AS flagged FROM s)
"""


def _snapshots(spark, sf):
    rows = table(spark, sf, "customer")
    canton = F.concat(F.lit("C"), (F.floor(F.col("c_custkey") / 500) % 5).cast("string"))
    item = F.struct(
        F.concat(F.lit("id-"), F.col("c_custkey").cast("string")).alias("id"),
        F.col("c_name").alias("title"),
        canton.alias("canton"),
        F.concat(F.lit("2024-02-"), F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0")).alias("date_published"),
        F.lit("2024-03-31").alias("date_expiry"),
        F.col("c_nationkey").alias("days_ago"),
        (F.col("c_nationkey") > 12).alias("rav_exclusive"),
        F.lit("job-room.ch").alias("source"),
    )
    pages = json_pages(rows, item, "c_custkey", 500)
    keyed = rows.groupBy((F.floor(F.col("c_custkey") / 500) + 1).cast("bigint").alias("page_no")).agg(
        F.count("*").alias("total"), F.count_if(F.col("c_nationkey") > 12).alias("flagged")
    )
    text = F.concat(
        F.lit('{"source": "job-room.ch", "canton": "C'),
        ((F.col("page_no") - 1) % 5).cast("string"),
        F.lit('", "scraped_at": "2024-03-01T12:00:00", "total": '),
        F.col("total").cast("string"),
        F.lit(', "rav_exclusive_count": '),
        F.col("flagged").cast("string"),
        F.lit(', "jobs": '),
        "items",
        F.lit("}"),
    )
    docs = pages.join(keyed, "page_no").select(F.format_string("f%09d", "page_no").alias("path"), text.alias("text"))
    return snapshot_read(docs)


@query(
    "snapshot_read",
    f"""
    WITH {_SNAP_SQL}
    SELECT 'id-' || c_custkey AS external_id, CAST(NULL AS BIGINT) AS id, c_name AS title, canton AS file_canton,
           '2024-02-' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') AS posting_date, '2024-03-31' AS expiry_date,
           c_nationkey AS days_ago, total AS file_total, flagged AS file_rav_exclusive_count, c_custkey % 500 AS pos
    FROM w
    """,
)
def snapshots(spark, sf):
    return _snapshots(spark, sf).select(
        "external_id", "id", "title", "file_canton", "posting_date", "expiry_date", "days_ago", "file_total",
        "file_rav_exclusive_count", "pos",
    )


@query(
    "snapshot_header",
    f"""
    WITH {_SNAP_SQL}
    SELECT 'job-room.ch' AS source, canton, count(*) AS total, count(*) FILTER (c_nationkey > 12) AS rav_exclusive_count
    FROM w GROUP BY canton
    """,
)
def headers(spark, sf):
    return snapshot_header(_snapshots(spark, sf))


# Payload pages of 25 events in the envelopes of the three interfaces.
@query(
    "unpack_envelope",
    """
    WITH e AS (SELECT event_id, user_id, event_id // 25 + 1 AS page_no, event_id % 25 AS pos FROM events),
    r AS (SELECT 'jobroom' AS api, page_no % 4 AS form, * FROM e UNION ALL SELECT 'adzuna', page_no % 4, * FROM e
          UNION ALL SELECT 'rapidapi', page_no % 4, * FROM e)
    SELECT api, page_no, pos, event_id, user_id,
           CASE WHEN api = 'jobroom' AND form IN (0, 1) THEN page_no * 10
                WHEN api = 'adzuna' AND form = 3 THEN page_no END AS total
    FROM r WHERE api <> 'adzuna' OR form IN (1, 3)
    """,
)
def envelopes(spark, sf):
    events = table(spark, sf, "events")
    pages = json_pages(events, F.struct("event_id", "user_id"), "event_id", 25)
    items = F.regexp_replace("items", r"\]$", ', 5, "x", []]')
    n = F.col("page_no").cast("string")
    form = F.col("page_no") % 4
    payload = (
        F.when(form == 0, F.concat(F.lit('{"totalElements": "many", "total": '), n, F.lit('0, "jobs": '), items, F.lit("}")))
        .when(form == 1, F.concat(F.lit('{"content": {}, "totalElements": '), n, F.lit('0, "jobs": null, "results": '), items, F.lit("}")))
        .when(form == 2, items)
        .otherwise(F.concat(F.lit('{"count": '), n, F.lit(', "data": 1, "results": '), items, F.lit("}")))
    )
    payloads = pages.select("page_no", payload.alias("payload"))
    out = None
    for api, envelope in ENVELOPES.items():
        rows = unpack_envelope(payloads, envelope)
        rows = rows.select(
            F.lit(api).alias("api"),
            "page_no",
            "pos",
            V.integer_at(F.col("item"), "$.event_id").alias("event_id"),
            V.integer_at(F.col("item"), "$.user_id").alias("user_id"),
            "total",
        )
        out = rows if out is None else out.unionByName(rows)
    return out


# Every fifth page is empty, every seventh has text after its value.
@query(
    "payload_pages",
    """
    WITH p AS (SELECT event_id // 25 + 1 AS page_no, count(*) AS n FROM events GROUP BY 1)
    SELECT page_no, CASE WHEN page_no % 7 <> 0 THEN page_no * 10 END AS total,
           CASE WHEN page_no % 7 = 0 OR page_no % 5 = 0 THEN 0 ELSE n END AS n_rows
    FROM p
    """,
)
def api_pages(spark, sf):
    pages = json_pages(table(spark, sf, "events"), F.struct("event_id", "user_id"), "event_id", 25)
    items = F.when(F.col("page_no") % 5 == 0, F.lit("[]")).otherwise(F.col("items"))
    tail = F.when(F.col("page_no") % 7 == 0, F.lit("} {}")).otherwise(F.lit("}"))
    total = (F.col("page_no") * 10).cast("string")
    payload = F.concat(F.lit('{"count": '), total, F.lit(', "results": '), items, tail)
    return payload_pages(pages.select("page_no", payload.alias("payload")), ENVELOPES["adzuna"])


# Job-room items built around parts. The size of the part decides which fields are
# missing, blank or of the wrong type.
_JOBROOM_SQL = """
    p AS (SELECT *, 'https://ext.example.com/' || p_partkey AS ext, 'id-' || p_partkey AS pid FROM part),
    r AS (SELECT p_partkey,
      CASE WHEN p_size % 2 = 0 THEN p_name ELSE p_brand END AS title,
      CASE WHEN p_size % 5 = 0 THEN 'N/A' ELSE p_brand END AS company,
      CASE p_size % 3 WHEN 0 THEN p_type WHEN 1 THEN 'N/A' ELSE 'Genève' END AS location,
      CASE WHEN p_size % 2 = 0 THEN '12' || p_size ELSE '' END AS postal_code,
      'GE' AS canton,
      '2024-03-' || lpad(CAST(p_size % 28 + 1 AS VARCHAR), 2, '0') AS posting_date,
      CASE WHEN p_size % 4 = 0 THEN '2024-04-30' END AS expiry_date,
      CAST(date_diff('day', DATE '2024-03-01' + CAST(p_size % 28 AS INTEGER), DATE '2024-03-31') AS INTEGER) AS days_ago,
      CASE p_size % 4 WHEN 0 THEN p_size || '-' || (p_size + 10) || '%' WHEN 1 THEN (p_size + 10) || '%' ELSE '' END
        AS workload,
      CASE p_size % 3 WHEN 0 THEN 'permanent' WHEN 1 THEN 'temporary' ELSE '' END AS contract_type,
      p_size % 7 = 0 AS rav_exclusive,
      CASE p_size % 3 WHEN 0 THEN ext WHEN 1 THEN 'https://www.job-room.ch/job-search/detail/' || pid ELSE '' END AS url,
      CASE WHEN p_size % 3 = 2 THEN '' ELSE pid END AS external_id,
      CASE WHEN p_size % 2 = 0 THEN 'de,fr' ELSE ',en' END AS codes,
      CASE WHEN p_size % 2 = 0 THEN p_type ELSE rtrim(repeat(p_type || ' ', 400)) END AS description
      FROM p)
"""


def _jobroom_items(spark, sf):
    part = spread(table(spark, sf, "part"), "p_partkey", 5_000)
    size, key = F.col("p_size"), F.col("p_partkey").cast("string")
    none = F.lit(None).cast("string")
    version = lambda lang, title, text: F.struct(
        F.lit(lang).alias("languageIsoCode"), title.alias("title"), text.alias("description")
    )
    long_text = F.concat(F.lit(" "), F.repeat(F.concat("p_type", F.lit(" ")), 400))
    even = F.array(
        version("DE", F.col("p_brand"), F.col("p_brand")),
        version("fr", F.concat(F.lit(" "), "p_name"), F.col("p_type")),
        version("FR", F.lit("late"), F.lit("late")),
    )
    odd = F.array(
        version("", F.col("p_brand"), F.lit("first")),
        version("en", F.lit("  "), long_text),
    )
    content = F.struct(
        F.when(size % 3 == 0, F.concat(F.lit(" https://ext.example.com/"), key)).alias("externalUrl"),
        F.struct(F.when(size % 5 != 0, F.concat("p_brand", F.lit("\n"))).alias("name")).alias("employer"),
        F.struct(
            F.when(size % 3 == 0, F.col("p_type")).when(size % 3 == 1, F.lit(" ")).otherwise("").alias("city"),
            F.lit("Genève").alias("communalName"),
            F.when(size % 2 == 0, F.concat(F.lit("12"), size.cast("string"))).alias("zipCode"),
            F.lit("GE").alias("cantonCode"),
        ).alias("location"),
        F.struct(
            F.when(size % 4 == 0, size + F.lit(0.9)).alias("workloadPercentageMin"),
            F.when(size % 4 < 2, size + 10).alias("workloadPercentageMax"),
            F.when(size % 3 == 0, F.lit(True)).when(size % 3 == 1, F.lit(False)).alias("permanent"),
        ).alias("employment"),
        F.when(size % 2 == 0, even).otherwise(odd).alias("jobDescriptions"),
    )
    day = F.concat(F.lit("2024-03-"), F.lpad((size % 28 + 1).cast("string"), 2, "0"))
    ad = F.struct(
        F.when(size % 3 == 0, F.concat(F.lit("id-"), key)).alias("id"),
        F.when(size % 3 == 1, F.concat(F.lit("id-"), key)).alias("stellennummerEgov"),
        F.concat(day, F.lit("T10:00:00")).alias("createdTime"),
        F.when(size % 7 == 0, F.lit("yes")).otherwise("").alias("reportingObligation"),
        F.struct(
            F.when(size % 2 == 0, day).otherwise(none).alias("startDate"),
            F.when(size % 4 == 0, F.lit(" 2024-04-30T00:00")).alias("endDate"),
        ).alias("publication"),
        content.alias("jobContent"),
    )
    wrapped = F.concat(F.lit('{"jobAdvertisement": '), F.to_json(ad), F.lit("}"))
    text = F.when(size % 2 == 0, wrapped).otherwise(F.to_json(ad))
    return part.select("p_partkey", F.try_parse_json(text).alias("item"))


def _jobroom(spark, sf):
    rows = N.normalize_jobroom(_jobroom_items(spark, sf), AS_OF)
    return rows.withColumn("codes", F.array_join("language_codes", ",")).drop("language_codes")


# An odd part has no version of the preferred language: its description comes from the
# English one, its title from the first. The English text starts with a blank.
@query(
    "normalize_jobroom",
    f"""
    WITH {_JOBROOM_SQL}
    SELECT * REPLACE (trim(description) AS description), 'jobroom' AS source FROM r
    """,
)
def normalize_jobroom(spark, sf):
    return _jobroom(spark, sf)


for _key, _columns in {
    "workload_label": "workload",
    "contract_label": "contract_type, rav_exclusive",
    "url_fallback": "url, external_id",
}.items():

    def _run(spark, sf, columns=tuple(_columns.split(", "))):
        return _jobroom(spark, sf).select("p_partkey", *columns)

    query(_key, f"WITH {_JOBROOM_SQL} SELECT p_partkey, {_columns} FROM r")(_run)


# Language versions: four turns of a conversation, in the order of the turns; texts of
# the assistant are blank, roles give the titles, a user has none.
@query(
    "pick_description",
    """
    WITH v AS (
      SELECT conv_id, turn // 4 AS part, turn, ['it', 'de', 'en', 'fr'][turn % 4 + 1] AS lang,
             CASE WHEN role <> 'user' THEN role END AS title,
             CASE WHEN role <> 'assistant' THEN nullif(trim(text, E' \\n'), '') END AS body FROM conversations),
    ranked AS (
      SELECT *, CASE WHEN lang = 'de' THEN 0 ELSE list_position(['fr', 'de', 'it', 'en'], lang) END AS prio,
             row_number() OVER (PARTITION BY conv_id, part ORDER BY turn) AS n FROM v),
    best AS (SELECT conv_id, part, arg_min(struct_pack(t := title, b := body), prio) AS best FROM ranked
             WHERE title IS NOT NULL OR body IS NOT NULL GROUP BY ALL),
    firsts AS (SELECT conv_id, part, title AS t1, body AS b1 FROM ranked WHERE n = 1),
    codes AS (SELECT conv_id, part, array_to_string(list_sort(list_distinct(list(lang))), ',') AS codes
              FROM v GROUP BY ALL)
    SELECT conv_id, part, coalesce(best.t, t1) AS title, coalesce(best.b, b1) AS description, codes
    FROM firsts JOIN codes USING (conv_id, part) LEFT JOIN best USING (conv_id, part)
    """,
)
def pick_description(spark, sf):
    turns = table(spark, sf, "conversations")
    langs = F.array(*[F.lit(code) for code in ("it", "de", "en", "fr")])
    role = F.col("role")
    rows = turns.select(
        "conv_id",
        F.floor(F.col("turn") / 4).cast("bigint").alias("part"),
        F.struct(
            "turn",
            F.get(langs, (F.col("turn") % 4).cast("int")).alias("lang"),
            F.when(role != "user", role).alias("title"),
            N.stripped(F.when(role != "assistant", F.col("text"))).alias("description"),
        ).alias("version"),
    )
    # A part of a conversation is four turns at most.
    parts = rows.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list("version")).alias("versions"))
    picked = parts.withColumn("_pick", N.pick_description(F.col("versions"), "de"))
    codes = F.array_join(N.language_codes(F.col("versions")), ",")
    return picked.select("conv_id", "part", "_pick.title", "_pick.description", codes.alias("codes"))


@query(
    "normalize_adzuna",
    """
    SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'N/A' ELSE s_name END AS title,
           CASE WHEN s_nationkey % 3 = 0 THEN n_name ELSE 'N/A' END AS company,
           CASE WHEN s_nationkey % 2 = 0 THEN n_name ELSE 'N/A' END AS location,
           CASE WHEN s_nationkey % 4 > 0 THEN '2024-01-' || lpad(CAST(s_nationkey + 1 AS VARCHAR), 2, '0') END
             AS posting_date,
           CASE WHEN s_acctbal > 5000 THEN 'https://a.example.com/' || s_suppkey
                WHEN s_acctbal > 0 THEN 'ref-' || s_suppkey ELSE '' END AS url,
           rtrim(repeat(s_name || ' ', 200)) AS description,
           s_acctbal AS salary_min, CASE WHEN s_nationkey > 10 THEN s_acctbal + 1 END AS salary_max,
           CASE WHEN s_nationkey > 10 THEN 'full_time' END AS contract_time, 'permanent' AS contract_type,
           CAST(s_suppkey + 1 AS VARCHAR) AS external_id, 'adzuna' AS source
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    """,
)
def normalize_adzuna(spark, sf):
    rows = table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    nation, balance, key = F.col("s_nationkey"), F.col("s_acctbal"), F.col("s_suppkey").cast("string")
    item = F.struct(
        (F.col("s_suppkey") + 1).alias("id"),
        F.when(balance < 0, F.lit(" \n")).otherwise(F.concat(F.lit(" "), "s_name")).alias("title"),
        F.struct(F.when(nation % 3 == 0, F.col("n_name")).alias("display_name")).alias("company"),
        F.when(nation % 2 == 0, F.struct(F.col("n_name").alias("display_name"))).alias("location"),
        F.when(
            nation % 4 > 0,
            F.concat(F.lit(" 2024-01-"), F.lpad((nation + 1).cast("string"), 2, "0"), F.lit("T00:00:00Z")),
        ).alias("created"),
        F.when(balance > 5000, F.concat(F.lit("https://a.example.com/"), key)).otherwise(" ").alias("redirect_url"),
        F.when(balance > 0, F.concat(F.lit("ref-"), key, F.lit(" "))).alias("adref"),
        F.concat(F.lit("\n "), F.repeat(F.concat("s_name", F.lit(" ")), 200)).alias("description"),
        balance.alias("salary_min"),
        F.when(nation > 10, balance + 1).alias("salary_max"),
        F.when(nation > 10, F.lit("full_time")).alias("contract_time"),
        F.lit("permanent").alias("contract_type"),
    )
    text = F.to_json(item, {"ignoreNullFields": "false"})
    return N.normalize_adzuna(rows.select("s_suppkey", F.try_parse_json(text).alias("item")))


@query(
    "normalize_alias",
    """
    SELECT p_partkey,
           CASE p_size % 3 WHEN 0 THEN p_name WHEN 1 THEN ' ' ELSE 'N/A' END AS title,
           CASE p_size % 4 WHEN 0 THEN p_brand WHEN 1 THEN p_type WHEN 2 THEN p_name ELSE 'N/A' END AS company,
           CASE WHEN p_size % 2 = 0 THEN p_type ELSE 'N/A' END AS location,
           CASE WHEN p_size % 2 = 0 THEN '2024-01-01T00:00:00.000Z' END AS posting_date,
           CASE p_size % 3 WHEN 0 THEN CAST(p_size + 1 AS VARCHAR) ELSE '' END AS salary,
           CASE WHEN p_size % 5 > 0 THEN p_type END AS description,
           CASE p_size % 4 WHEN 3 THEN '' ELSE 'https://r.example.com/' || p_partkey END AS url,
           CASE p_size % 3 WHEN 0 THEN 'Board' WHEN 1 THEN 'site' ELSE 'indeed_rapidapi' END AS source
    FROM part
    """,
)
def normalize_alias(spark, sf):
    size = F.col("p_size")
    url = F.concat(F.lit("https://r.example.com/"), F.col("p_partkey").cast("string"))
    item = F.struct(
        F.when(size % 3 == 0, F.col("p_name")).otherwise("").alias("job_title"),
        F.when(size % 3 == 1, F.lit(" ")).alias("title"),
        F.when(size % 4 == 0, F.col("p_brand")).alias("employer_name"),
        F.when(size % 4 == 1, F.col("p_type")).otherwise("").alias("company"),
        F.when(size % 4 == 2, F.col("p_name")).alias("company_name"),
        F.when(size % 2 == 0, F.col("p_type")).alias("location"),
        F.when(size % 2 == 0, F.lit("2024-01-01T00:00:00.000Z")).alias("job_posted_at_datetime_utc"),
        F.when(size % 3 == 0, size + 1).otherwise(0).alias("job_salary"),
        F.array().cast("array<string>").alias("salary"),
        (size < 0).alias("job_description"),
        F.when(size % 5 > 0, F.col("p_type")).alias("description"),
        F.when(size % 4 == 0, url).alias("job_apply_link"),
        F.when(size % 4 == 1, url).alias("job_url"),
        F.when(size % 4 == 2, url).alias("url"),
        F.when(size % 3 == 0, F.lit("Board")).alias("job_publisher"),
        F.when(size % 3 == 1, F.lit("site")).alias("site"),
    )
    text = F.to_json(item, {"ignoreNullFields": "false"})
    return N.normalize_alias(table(spark, sf, "part").select("p_partkey", F.try_parse_json(text).alias("item")))
