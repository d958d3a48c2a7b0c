"""Labelling queries over ``documents`` and their labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobsluice.operators import enrich as R
from jobsluice.operators.enrich import keyword_classifier
from jobsluice.operators.filters import pending_rows
from jobsluice.operators.report import enrich_report
from jobsluice.plans.label import label_jobs
from jobsluice.queries.registry import query, table
from jobsluice.session import scratch_path

# A good label is a labelled record, a bad one a blank; a toxic one had an error. Words
# of the text give the labels; the classifier fails on one of them.
KEYWORDS = {"the ": "Anglais", "eaux": "Eaux", "tion ": "Action", "sch": "Schule", "men": "Menuisier", "re ": "Relieur"}
FAILS_ON = "heed"


class Refused(ValueError):
    """Raised by the test classifier."""


def classify(prompts):
    if any(FAILS_ON in p for p in prompts):
        raise Refused("no answer")
    return keyword_classifier(KEYWORDS)(prompts)


_DOCS_SQL = f"""
    d AS (
      SELECT doc_id, CASE WHEN lang <> 'en' THEN source ELSE '' END AS title,
             trim(regexp_replace(text, '\\s+', ' ', 'g')) AS body,
             CASE quality WHEN 1 THEN 'Label ' || lang WHEN 0 THEN '  ' END AS professions,
             CASE WHEN toxic = 1 THEN 'Old: error' END AS professions_error
      FROM documents LEFT JOIN labels USING (doc_id)),
    flags AS (
      SELECT *, trim(coalesce(professions, '')) = '' AS open, coalesce(professions_error, '') <> '' AS failed,
             'Titre: ' || title || chr(10) || 'Description: ' || body AS prompt FROM d),
    asked AS (
      SELECT *, contains(prompt, '{FAILS_ON}') AS refused, array_to_string(list_filter([
        {", ".join(f"CASE WHEN contains(lower(prompt), '{word}') THEN '{label}' END" for word, label in KEYWORDS.items())}
      ], lambda x: x IS NOT NULL)[:5], ', ') AS labels FROM flags)
"""


def documents(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    professions = F.when(F.col("quality") == 1, F.concat(F.lit("Label "), "lang")).when(F.col("quality") == 0, "  ")
    return docs.select(
        "doc_id",
        F.when(F.col("lang") != "en", F.col("source")).alias("title"),
        F.col("text").alias("description"),
        professions.alias("professions"),
        F.when(F.col("toxic") == 1, F.lit("Old: error")).alias("professions_error"),
    )


@query("pending_rows", f"WITH {_DOCS_SQL} SELECT doc_id, open AND NOT failed AS plain FROM flags WHERE open")
def pending(spark, sf):
    docs = documents(spark, sf).select("doc_id", "professions", "professions_error")
    plain = pending_rows(docs).select("doc_id", F.lit(True).alias("plain"))
    retried = pending_rows(docs, retry_errors=True).select("doc_id")
    return retried.join(plain, "doc_id", "left").fillna(False, ["plain"])


@query(
    "enrich_report",
    f"""
    WITH {_DOCS_SQL}
    SELECT count(*) AS n_total, count(*) FILTER (open AND NOT failed) AS n_processed,
           count(*) FILTER (NOT open OR failed) AS n_skipped FROM flags
    """,
)
def report(spark, sf):
    return enrich_report(documents(spark, sf))


@query(
    "parse_labels",
    """
    SELECT doc_id, CASE lang WHEN 'es' THEN '' WHEN 'de' THEN source || ' x'
                             ELSE source || ' x, ' || lang || ', A, b, c' END AS professions FROM documents
    """,
)
def parse_labels(spark, sf):
    docs = table(spark, sf, "documents")
    source = F.col("source")
    listed = F.concat(
        F.lit('{"professions": ["  '),
        source,
        F.lit(' \\u00a0x\\n", "'),
        F.upper(source),
        F.lit(' X", 5, " ", null, ["'),
        F.lit('nested"], "'),
        F.col("lang"),
        F.lit('", "A", "b", "a", "c", "d"]}'),
    )
    reply = (
        F.when(F.col("lang") == "es", F.concat(F.lit('{"professions": "'), source, F.lit('"}')))
        .when(F.col("lang") == "de", F.concat(F.lit('{"professions": ["'), source, F.lit(' x"], "more": {}}')))
        .otherwise(listed)
    )
    return docs.select("doc_id", R.parse_labels(reply).alias("professions"))


_ENRICHED_SQL = f"""
    {_DOCS_SQL}
    SELECT doc_id,
           CASE WHEN NOT open THEN professions WHEN refused THEN '' ELSE labels END AS professions,
           CASE WHEN NOT open THEN professions_error WHEN refused THEN 'Refused: no answer' END AS professions_error
    FROM asked
"""


@query("enrich", f"WITH {_ENRICHED_SQL}")
def enrich(spark, sf):
    rows = R.enrich(documents(spark, sf), classify, retry_errors=True)
    return rows.select("doc_id", "professions", "professions_error")


@query("enrich_resume", f"WITH {_ENRICHED_SQL} WHERE open")
def enrich_resume(spark, sf):
    todo = pending_rows(documents(spark, sf), retry_errors=True)
    path = scratch_path(spark, "labels")
    # A run that stops after two rounds, and the run that takes up the rest.
    R.enrich_resume(todo, classify, path, "doc_id", 4, only=range(2))
    return R.enrich_resume(todo, classify, path, "doc_id", 4)


@query(
    "attach_labels",
    """
    SELECT doc_id, coalesce('Label ' || quality, 'Old') AS professions,
           CASE WHEN quality IS NULL THEN 'Old: error' WHEN toxic = 1 THEN 'toxic' END AS professions_error
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def attach(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", F.lit("Old").alias("professions"), F.lit("Old: error").alias("professions_error")
    )
    results = table(spark, sf, "labels").select(
        "doc_id",
        F.concat(F.lit("Label "), F.col("quality").cast("string")).alias("professions"),
        F.when(F.col("toxic") == 1, F.lit("toxic")).alias("professions_error"),
    )
    return R.attach_labels(docs, results, "doc_id")


@query("run_labelling", f"WITH {_ENRICHED_SQL}")
def run_labelling(spark, sf):
    done = label_jobs(
        documents(spark, sf), classify, scratch_path(spark, "run-labels"), "doc_id", rounds=2, retry_errors=True
    )
    return done.select("doc_id", "professions", "professions_error")
