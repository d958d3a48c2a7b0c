"""The stages one after the other, each against its operator's decisions."""

from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from jobsluice.llm import mixing, neardup, perplexity, suffix, tiling

ITEM = " ".join(f"bench{k}" for k in range(30))


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    # The clashing columns of the fixture stay, and one that the stages use themselves.
    plain = docs.withColumn("kept", F.lit("x")) if "kept" not in docs.columns else docs
    words = " ".join(f"own{k}" for k in range(80))
    extra = [(200, f"{words} {ITEM}", "en", "s0", 1)]
    extra = spark.createDataFrame(extra, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    plain.unionByName(extra, allowMissingColumns=True).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def rows(df):
    return sorted(map(repr, df.collect()))


def key_of(row):
    return row["doc_id"], row["text"]


def numbers(df):
    """A number for every (id, text) that follows the ids, rows without an id last."""
    keys = {key_of(r) for r in df.collect()}
    return {k: n for n, k in enumerate(sorted(keys, key=lambda k: (k[0] is None, k[0] or 0, k[1] or "")))}


def numbered(df):
    """The rows with these numbers as ids."""
    n = numbers(df)
    return df.sparkSession.createDataFrame([(n[key_of(r)], r["text"], r["lang"]) for r in df.collect()], "doc_id bigint, text string, lang string")


def decided(df, found, where="true"):
    """The (id, text) of the rows that an operator on ``numbered`` rows has found."""
    keys = {n: k for k, n in numbers(df).items()}
    return {keys[r["doc_id"]] for r in found.where(where).collect()}


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if k < 4:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        out.write.parquet(f"{tmp_path}/{k}")
        seen.append((docs, spark.read.parquet(f"{tmp_path}/{k}")))
        docs = seen[-1][1]

    (a, b), (c, d), (e, f), (g, h), (i, j) = seen
    kept = Counter(map(key_of, a.collect())) & Counter({k: 10**9 for k in decided(a, perplexity.quality_rules(numbered(a)), "kept")})
    assert Counter(map(key_of, b.collect())) == kept
    groups = decided(c, neardup.near_duplicates(numbered(c)), "kept")
    assert set(map(key_of, d.collect())) <= set(groups) and d.count() == len(set(d.select("text").collect()))
    cut = {(r["doc_id"], r["n_bytes"]): bytes(r["kept"]) for r in suffix.remove_repeats(e, keep="first").collect()}
    before = {r["doc_id"]: r["text"] for r in e.collect()}
    for r in f.where("doc_id is not null").collect():
        whole = cut[r["doc_id"], len(before[r["doc_id"]].encode())]
        assert r["n_chars"] == len(r["text"]) and len(whole) <= len(r["text"].encode()) <= len(whole) + 40
    bad = decided(g, tiling.contaminated(numbered(g), spark.read.parquet(f"{folder}/benchmark.parquet")))
    assert 200 in {k[0] for k in bad}
    assert Counter(map(key_of, h.collect())) == Counter({k: n for k, n in Counter(map(key_of, g.collect())).items() if k not in bad})
    assert rows(j) == rows(mixing.mix(i).where("taken > 0"))
    assert rows(corpus_pipeline.run(spark, folder)) == rows(j)


def test_null_texts_and_shared_ids(spark, folder):
    """Decisions hold for the row they were made on, not for others with its id."""
    words = [" ".join(f"v{n}w{k}" for k in range(200)) for n in range(3)]
    data = [(1, words[0], "x"), (2, words[0], "x"), (2, words[1], "x"), (None, words[0], "x"), (None, words[2], "x"), (3, None, "b"), (3, None, "a"), (4, "", "x")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, mark string")
    out = corpus_pipeline.near_dedup(spark, docs, folder)
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, [data[0], data[2], data[4], data[6], data[7]]))
    cut = corpus_pipeline.suffix_dedup(spark, docs, folder)
    assert cut.columns == docs.columns
    assert sum(r["text"] is None for r in cut.collect()) == 2 and sum(r["text"] == words[1] for r in cut.collect()) == 1


def test_first_copy_stays(spark, folder):
    passage = " ".join(f"passage{k}" for k in range(60))
    data = [(n, f"{passage} {' '.join(f'w{n}x{k}' for k in range(300))}", "x", "y") for n in (4, 2, 3)]
    cut = corpus_pipeline.suffix_dedup(spark, spark.createDataFrame(data, "doc_id bigint, text string, kept string, n_bytes string"), folder)
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert texts[2] == data[1][1] and "passage30" not in texts[3] + texts[4] and cut.columns == ["doc_id", "text", "kept", "n_bytes"]


def test_rows_without_id_are_decontaminated(spark, folder):
    data = [(None, f"a b c {ITEM} d e f"), (None, "clean text"), (5, ITEM), (5, "clean text")]
    left = corpus_pipeline.decontamination(spark, spark.createDataFrame(data, "doc_id bigint, text string"), folder)
    assert sorted(map(repr, map(tuple, left.collect()))) == sorted(map(repr, [data[1], data[3]]))


def test_empty_documents(spark, folder, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_clean_documents_stay(spark, folder):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1")
    failed = perplexity.quality_rules(docs).where("not base_failed and not kept").join(labels, "doc_id")
    clean = labels.join(docs, "doc_id").where(F.size(F.split("text", " ")) >= 50).count()
    assert failed.count() <= 0.01 * clean
