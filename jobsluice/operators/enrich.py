"""Labelling: prompts, a pluggable classifier, replies, restartable runs."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsluice.functions.html import with_text
from jobsluice.functions.text import collapse, first_chars, strip
from jobsluice.operators.filters import is_pending
from jobsluice.sources.sinks import read_table

# A classifier takes prompts and returns one JSON reply for each.
Classifier = Callable[[list[str]], list[str]]

# How much of a description a short prompt holds, how many labels count.
PROMPT_CHARS = 4000
MAX_LABELS = 5

#: Records of a round, which is what a killed run repeats at most (buckets are dealt by hash, so about).
BUCKET_ROWS = 100_000
#: Records of a task, both where a bucket is written and where it is labelled.
TASK_ROWS = 20_000
COMMIT = "folder string"


def with_prompt(df: DataFrame, name: str = "prompt", chars: int | None = None) -> DataFrame:
    """Add the classifier input; NULL if title and description are both blank.

    ``chars`` cuts the description (``PROMPT_CHARS`` is the usual size); None passes all of it.
    """
    rows = with_text(df, F.col("description"), "_plain")
    title = strip(F.coalesce(F.col("title"), F.lit("")))
    text = F.concat(F.lit("Titre: "), title, F.lit("\nDescription: "), first_chars(F.col("_plain"), chars))
    return rows.withColumn(name, F.when((title != "") | (F.col("_plain") != ""), text)).drop("_plain")


def parse_labels(reply: Column) -> Column:
    """Label text of a reply: strings only, squeezed, distinct ignoring case, the first five."""
    listed = F.try_variant_get(F.try_parse_json(reply), "$.professions", "array<variant>")
    texts = F.filter(listed, lambda v: F.schema_of_variant(v) == "STRING")
    labels = F.filter(
        F.transform(texts, lambda v: collapse(F.try_variant_get(v, "$", "string"))), lambda label: label != ""
    )

    def add(kept: Column, label: Column) -> Column:
        known = F.exists(kept, lambda k: F.lower(k) == F.lower(label))
        return F.when(known | (F.size(kept) >= MAX_LABELS), kept).otherwise(F.concat(kept, F.array(label)))

    distinct = F.aggregate(labels, F.array().cast("array<string>"), add)
    return F.coalesce(F.array_join(distinct, ", "), F.lit(""))


def keyword_classifier(labels: Mapping[str, str]) -> Classifier:
    """A deterministic classifier: every keyword found in the prompt gives its label."""

    def classify(prompts: list[str]) -> list[str]:
        found = [[label for word, label in labels.items() if word in p.lower()] for p in prompts]
        return [json.dumps({"professions": f}, ensure_ascii=False) for f in found]

    return classify


def _ask(classify: Classifier, prompts: list[str]) -> list[tuple[str | None, str | None]]:
    """(reply, error) per prompt.

    A reply that is an exception is the error of its prompt alone; a batch that fails as a whole is asked one by one.
    """
    try:
        replies = list(classify(prompts))
        if len(replies) != len(prompts):
            raise ValueError(f"{len(prompts)} prompts, {len(replies)} replies")
    except Exception as exc:
        if len(prompts) == 1:
            return [(None, f"{type(exc).__name__}: {exc}")]
        return [_ask(classify, [p])[0] for p in prompts]
    out = []
    for reply in replies:
        try:
            if isinstance(reply, Exception):
                raise reply
            json.loads(reply or "{}").get("professions")
            out.append((reply or "{}", None))
        except Exception as exc:
            out.append((None, f"{type(exc).__name__}: {exc}"))
    return out


def classified(prompt: Column, classify: Classifier, batch: int = 64) -> Column:
    """struct<reply, error> for every prompt that is not NULL.

    Marked as not deterministic, so that Spark never calls the classifier twice
    for a row that is used twice.
    """

    @F.pandas_udf("reply string, error string")
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for prompts in batches:
            answers = pd.DataFrame({"reply": None, "error": None}, index=prompts.index, dtype=object)
            asked = prompts[prompts.notna()]
            for at in range(0, len(asked), batch):
                part = asked.iloc[at : at + batch]
                answers.loc[part.index] = _ask(classify, part.tolist())
            yield answers

    return call.asNondeterministic()(prompt)


def enrich(
    df: DataFrame, classify: Classifier, batch: int = 64, prompt_chars: int | None = None, **flags: bool
) -> DataFrame:
    """Label the pending records in place; all other rows pass unchanged.

    Only prompts of pending records reach Python. Records with neither title nor
    description get empty labels and keep an old error; a success clears the
    error, a failure writes it and leaves the labels empty. ``prompt_chars`` cuts the
    description in the prompt, None reads it whole.
    """
    rows = with_prompt(df.withColumn("_pending", is_pending(**flags)), "_prompt", prompt_chars)
    asked = F.when(F.col("_pending"), F.col("_prompt"))
    rows = rows.withColumn("_answer", classified(asked, classify, batch))
    labels = F.when(F.col("_pending"), parse_labels(F.col("_answer.reply"))).otherwise(F.col("professions"))
    error = F.when(F.col("_pending") & F.col("_prompt").isNotNull(), F.col("_answer.error")).otherwise(
        F.col("professions_error")
    )
    rows = rows.withColumns({"professions": labels, "professions_error": error})
    return rows.drop("_pending", "_prompt", "_answer")


def attach_labels(records: DataFrame, results: DataFrame, key: str = "url") -> DataFrame:
    """Write results (key, ``professions``, ``professions_error``) back to their records."""
    new = results.select(
        key, F.col("professions").alias("_new"), F.col("professions_error").alias("_error"), F.lit(True).alias("_hit")
    )
    joined = records.join(new, key, "left")
    done = F.col("_hit").isNotNull()
    return joined.withColumns(
        {
            "professions": F.when(done, F.col("_new")).otherwise(F.col("professions")),
            "professions_error": F.when(done, F.col("_error")).otherwise(F.col("professions_error")),
        }
    ).drop("_new", "_error", "_hit")


def enrich_resume(
    pending: DataFrame,
    classify: Classifier,
    path: str,
    key: str = "url",
    rounds: int | None = None,
    only: range | None = None,
    prompt_chars: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Label pending records in rounds and keep every finished round on disk.

    What is left to do is written once, in hash buckets of the key: ``rounds`` of them, or as many as give about
    ``bucket_rows`` records each. A round labels one bucket, writes its results to a folder of their own and then lists
    that folder in the commit log. Only listed folders are read, so a run that is killed at any moment loses the bucket
    it was in, and no result counts twice; the next run leaves out the keys that have results. Returns all results so
    far. ``only`` limits which rounds run now.
    """
    spark = pending.sparkSession
    narrow = pending.select(key, "title", "description", "professions", "professions_error")
    results = narrow.select(key, "professions", "professions_error")
    left = narrow.join(read_results(results, path).select(key), key, "left_anti")
    n_left = left.count()
    if rounds is None:
        rounds = max(1, -(-n_left // bucket_rows))
    work = f"{path}/todo/{uuid.uuid4().hex}"
    left = left.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(rounds)).cast("int"))
    # A task writes one bucket, or a share of one that has more rows than a task should.
    shares = max(1, -(-n_left // (rounds * TASK_ROWS)))
    share = F.pmod(F.xxhash64(key, F.lit("share")), F.lit(shares))
    left.repartition(rounds * shares, "bucket", share).write.partitionBy("bucket").parquet(work)
    todo = read_table(spark, work, T.StructType([*narrow.schema, T.StructField("bucket", T.IntegerType())]))
    filled = {r["bucket"]: r["count"] for r in todo.groupBy("bucket").count().collect()}
    for part in only or range(rounds):
        if part not in filled:
            continue
        # The prompts of a bucket are dealt over all cores.
        tasks = max(spark.sparkContext.defaultParallelism, -(-filled[part] // TASK_ROWS))
        rows = todo.where(F.col("bucket") == part).drop("bucket").repartition(tasks, key)
        labelled = enrich(rows, classify, prompt_chars=prompt_chars, force_all=True).select(results.columns)
        folder = f"results/{uuid.uuid4().hex}"
        labelled.write.parquet(f"{path}/{folder}")
        spark.createDataFrame([(folder,)], COMMIT).coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return read_results(results, path)


def read_results(like: DataFrame, path: str) -> DataFrame:
    """Results of all rounds in the commit log; ``like`` has their columns."""
    spark = like.sparkSession
    folders = [r["folder"] for r in read_table(spark, f"{path}/commits", COMMIT).collect()]
    if not folders:
        return like.limit(0)
    return spark.read.schema(like.schema).parquet(*[f"{path}/{folder}" for folder in sorted(folders)])
