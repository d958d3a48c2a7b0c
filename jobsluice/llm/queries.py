"""The registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsluice.llm import (
    hardneg,
    katz,
    langid,
    licences,
    mixing,
    neardup,
    perplexity,
    quality,
    spelling,
    suffix,
    tiling,
    tokens,
    warc,
)
from jobsluice.llm.shared import training_rows

Run = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, read back as chunks."""
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN f.first_id IS NULL OR f.first_id = d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first_id <> d.page_id THEN f.first_id END AS refers_to
FROM d LEFT JOIN f ON d.payload_digest = f.payload_digest AND d.payload_bytes >= 100
"""


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the target shares of their sources."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS body,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
k AS (
  SELECT doc_id, source, size,
         -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || body), 1, 13))::BIGINT + 0.5)
             / 4503599627370496.0)
         / greatest(coalesce(size::DOUBLE
             / nullif(size + length(body) - length(translate(body, '#*$%&|<>', '')), 0), 1.0), 1e-6) AS key
  FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
r AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS weight,
         3 * source_size AS cap FROM s),
c AS (
  SELECT *, sum(cap) OVER o AS caps, sum(weight) OVER o AS used,
         sum(source_size) OVER () AS all_words, sum(weight) OVER () AS all_weight
  FROM r WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
l AS (SELECT *, (all_words - (caps - cap))::DOUBLE / (all_weight - (used - weight)) AS rate FROM c),
f AS (SELECT min_by(rate, used) AS rate FROM l WHERE rate * weight <= cap),
t AS (
  SELECT l.source, l.source_size,
         CASE WHEN f.rate * weight <= cap THEN f.rate * weight ELSE cap::DOUBLE END AS target FROM l, f),
p AS (
  SELECT k.*, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM k),
e AS (
  SELECT p.*, t.source_size, t.target, coalesce(floor(t.target / nullif(t.source_size, 0)), 0) AS epochs
  FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + CASE WHEN upto - size / 2 <= target - epochs * source_size THEN size ELSE 0 END)::BIGINT AS taken
FROM e
"""


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every byte of a 200-byte string that also starts elsewhere removed from all documents."""
    cut = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of a Jaccard similarity of 0.75 or more."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learnt from the labels outside the held-out third."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.classify(docs, labels, training_rows("doc_id", 3, 1))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base signals and the perplexity verdict of every document."""
    return perplexity.quality_rules(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document."""
    import public_tokenizers

    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def _names(confirmed: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(confirmed, lambda n: n["family"]))), ",")


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence families that every document names, and how many of its paragraphs do."""
    found = licences.scan(table(spark, sf_dir, "documents"))
    confirmed = F.filter("notices", lambda n: n["confirmed"])
    return found.select(
        "doc_id",
        "n_paragraphs",
        F.size("notices").cast("bigint").alias("n_predicted"),
        F.size(confirmed).cast("bigint").alias("n_confirmed"),
        _names(confirmed).alias("families"),
    )


def op9_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Katz and add-one scores of every document, learnt from those that are not held out."""
    return katz.katz_scores(table(spark, sf_dir, "documents"), training_rows("doc_id", 7, 2))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items that they hold."""
    return tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for every hundredth vector; the labels of every seventh one are moved on by one."""
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hardneg.hard_negatives(table(spark, sf_dir, "embeddings"), vec_id, F.col("embedding"), moved, vec_id % 100 == 0)


OP11_SQL = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor_id, b.id AS other, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.id % 100 = 0 AND a.id <> b.id),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (
  SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, one in 199 damaged, and the more frequent form and root of each."""
    counts = spelling.count_words(table(spark, sf_dir, "documents"), damage_every=199)
    return spelling.variants(counts)


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt outside the held-out third."""
    return langid.identify(table(spark, sf_dir, "documents"), training_rows("doc_id", 3, 1))


QUERIES: dict[str, Run] = {
    run.__name__: run
    for run in (
        op1_warc,
        op2_mixing,
        op3_suffix_dedup,
        op4_near_dedup,
        op5_quality,
        op6_quality_rules,
        op7_token_counts,
        op8_licences,
        op9_katz,
        op10_decontamination,
        op11_hard_negatives,
        op12_spelling_variants,
        op13_language_id,
    )
} | {"pipeline": corpus_pipeline.run}

SQL: dict[str, str] = {"op1_warc": OP1_SQL, "op2_mixing": OP2_SQL, "op11_hard_negatives": OP11_SQL}
if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
