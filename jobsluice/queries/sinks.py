"""Sink queries: written to a fresh folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobsluice.operators import keys
from jobsluice.queries.listings import E_SQL, listing
from jobsluice.queries.registry import query, table
from jobsluice.session import scratch_path
from jobsluice.schema import to_job_schema
from jobsluice.sources import sinks as S
from jobsluice.sources.files import read_job_lines


@query(
    "write_json",
    """
    SELECT '{"id":' || c_custkey || ',"title":"' || c_name || ' \\"é\\"","company":'
           || CASE WHEN c_nationkey > 5 THEN '"' || c_mktsegment || '"' ELSE 'null' END
           || ',"rav_exclusive":' || CASE WHEN c_nationkey > 12 THEN 'true' ELSE 'false' END || '}' AS line
    FROM customer
    """,
)
def write_json(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.concat("c_name", F.lit(' "é"')).alias("title"),
        F.when(F.col("c_nationkey") > 5, F.col("c_mktsegment")).alias("company"),
        (F.col("c_nationkey") > 12).alias("rav_exclusive"),
    )
    path = scratch_path(spark, "json")
    S.write_json(rows, path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query(
    "json_round_trip",
    """
    SELECT c_custkey AS id, c_name || ' "é"' || chr(10) AS title,
           CASE WHEN c_nationkey > 5 THEN c_mktsegment END AS company, c_acctbal AS salary_min, c_nationkey AS days_ago,
           c_nationkey > 12 AS rav_exclusive, c_mktsegment || ',fr' AS codes
    FROM customer
    """,
)
def json_round_trip(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.concat("c_name", F.lit(' "é"\n')).alias("title"),
        F.when(F.col("c_nationkey") > 5, F.col("c_mktsegment")).alias("company"),
        F.col("c_acctbal").alias("salary_min"),
        F.col("c_nationkey").alias("days_ago"),
        (F.col("c_nationkey") > 12).alias("rav_exclusive"),
        F.array("c_mktsegment", F.lit("fr")).alias("language_codes"),
    )
    path = scratch_path(spark, "json-lines")
    S.write_json(to_job_schema(rows), path)
    codes = F.array_join("language_codes", ",").alias("codes")
    columns = ("id", "title", "company", "salary_min", "days_ago", "rav_exclusive")
    return read_job_lines(spark, path).select(*columns, codes)


@query(
    "write_csv",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS id, 'jobroom' AS source, c_name || ' "a", b' AS title,
           CASE WHEN c_nationkey > 5 THEN c_mktsegment END AS company, NULL::VARCHAR AS location,
           CASE WHEN c_nationkey > 12 THEN 'True' ELSE 'False' END AS rav_exclusive,
           'line 1' || chr(10) || 'line 2' AS description
    FROM customer
    """,
)
def write_csv(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.lit("jobroom").alias("source"),
        F.concat("c_name", F.lit(' "a", b')).alias("title"),
        F.when(F.col("c_nationkey") > 5, F.col("c_mktsegment")).otherwise("").alias("company"),
        (F.col("c_nationkey") > 12).alias("rav_exclusive"),
        F.lit("line 1\nline 2").alias("description"),
    )
    path = scratch_path(spark, "csv")
    S.write_csv(rows, path, "jobroom")
    back = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(path)
    return back.select("id", "source", "title", "company", "location", "rav_exclusive", "description")


@query(
    "write_seen",
    f"""
    WITH {E_SQL}
    SELECT DISTINCT url AS key, 2 AS version, 'r2' AS run_id, '2024-01-04T00:00:00' AS last_run_at, 'GE' AS canton
    FROM e
    """,
)
def write_seen(spark, sf):
    known = keys.key_set(listing(spark, sf))
    jobs = known.select(F.monotonically_increasing_id().alias("id"), F.col("key").alias("url"))
    store = S.SnapshotStore(spark, scratch_path(spark, "store"), "id bigint, url string", "demo")
    store.commit(jobs.limit(0), known.limit(0), "r1", "2024-01-03T00:00:00")
    for _ in range(2):  # the second commit of a run changes nothing
        store.commit(jobs, known, "r2", "2024-01-04T00:00:00", {"canton": "GE"})
    runs = store.runs().select("version", "run_id", "last_run_at", F.col("params")["canton"].alias("canton"))
    version, _ = store.state()
    return store.seen(version).withColumn("version", F.lit(version)).join(runs, "version")
