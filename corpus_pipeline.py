"""From raw documents to a training mix, in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``. ``docs`` has the columns of ``documents``; all
stages but the last return the same columns, and what a stage returns is written and read again
before the next one starts.

A row is known by its doc_id and a hash of its text, so that decisions also take effect on rows without an id
and on rows that share one. Rows that repeat both share their fate; where near-dedup keeps them one stays, the
same one in every run.

Defined results: the quality rules reject NULL and empty texts, and no other stage needs a text to have
words; a NULL text stays NULL. Very long texts are read whole, in slices; one text has to fit a task. Of equal texts the
row with the smallest id stays, rows without an id come last. The suffix stage removes the later copies of a passage
and keeps the first, in the order of doc_id and position, rows without an id first. Empty tables pass through. Extra
columns are carried, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobsluice.llm import mixing, neardup, perplexity, suffix, tiling
from jobsluice.llm.shared import fits, fresh, private, stored

#: A list of row keys up to this long (64 MB) is broadcast; a longer one is joined by shuffle.
BROADCAST_KEYS = 2_000_000


def _key() -> Column:
    """The key of a row: rows without an id last, then the id and a hash of the text."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))


def _keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """The key as ``doc_id``, and the named columns, for an operator that decides on rows by their id."""
    return private(docs, doc_id=_key(), **{c: F.col(c) for c in columns})


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs`` without the rows of ``keys``, whose column ``doc_id`` is a key."""
    out = fresh("out")
    keys = stored(keys.select(F.col("doc_id").alias(out)).distinct(), "dropped")
    keys = F.broadcast(keys) if fits(keys, BROADCAST_KEYS) else keys
    return docs.join(keys, _key().eqNullSafe(F.col(out)), "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return _without(docs, perplexity.quality_rules(_keyed(docs, "text", "lang")).where("not kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    groups = stored(neardup.near_duplicates(_keyed(docs, "text")), "groups")
    kept = _without(docs, groups.where("not kept"))
    repeated = groups.where("kept").groupBy("doc_id").count().where("count > 1").select("doc_id")
    repeated = stored(repeated, "repeated")
    if repeated.isEmpty():
        return kept
    # Rows that repeat id and text: the first in the order of all other columns.
    again, rank = fresh("again"), fresh("rank")
    one = F.broadcast(repeated) if fits(repeated, BROADCAST_KEYS) else repeated
    rows = kept.join(one.select(F.col("doc_id").alias(again)), _key().eqNullSafe(F.col(again)))
    rest = [F.col(c).cast("string") for c in docs.columns if c != "text"]
    order = Window.partitionBy(again).orderBy(*rest)
    once = rows.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).select(*docs.columns)
    return _without(kept, repeated).unionByName(once)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of passages of 200 bytes and more are cut out of every text, in whole characters."""
    columns, held = docs.columns, fresh("held")
    rest = [c for c in columns if c not in ("doc_id", "text")]
    carried = F.struct(F.col("text").isNull().alias("none"), *[F.col(c).alias(f"c{k}") for k, c in enumerate(rest)])
    texts = suffix.marked(docs.select("doc_id", "text", carried.alias(held)), carry=[held])
    cut = suffix.without_spans(texts, suffix.repeated_spans(docs.select("doc_id", "text"), keep="first"), whole_characters=True)
    text = F.when(~F.col(f"{held}.none"), F.decode("kept", "UTF-8"))
    back = {c: F.col(f"{held}.c{k}") for k, c in enumerate(rest)}
    if "n_chars" in back:
        back["n_chars"] = F.coalesce(F.length(text).cast(docs.schema["n_chars"].dataType), back["n_chars"])
    return private(cut, doc_id=F.col("doc_id"), text=text, **back).select(*columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, tiling.contaminated(_keyed(docs, "text"), benchmark))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes from every document that it takes from."""
    return mixing.mix(docs).where("taken > 0")


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("suffix dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("source mix", source_mix),
]

# SQL has no modified Kneser-Ney model, components or suffix arrays; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
