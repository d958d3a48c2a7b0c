"""Held-out accuracy of the rules, rules as columns, degenerate labels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobsluice.llm import quality
from jobsluice.llm.shared import training_rows

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.classify(docs, labels, training_rows("doc_id", 3, 1)).where("held_out").join(labels, "doc_id").collect()
    right = [r["predicted"] == r["quality"] for r in rows]
    assert len(right) > 50 and sum(right) > 0.95 * len(right)
    good = [r["score"] for r in rows if r["quality"] == 1]
    poor = [r["score"] for r in rows if r["quality"] == 0]
    assert np.mean([a > b for a in good for b in poor]) > 0.97


def test_column_is_the_model(spark):
    rng = np.random.default_rng(2)
    x = rng.random((600, len(quality.STATISTICS)))
    y = ((x[:, 3] > 0.6) & (x[:, 7] < 0.5)).astype(float)
    rules = quality.fit(x, y)
    total = rules.intercept + sum(w * quality._hits(x, c) for c, w in rules.rules)
    frame = spark.createDataFrame([tuple(map(float, r)) for r in x], list(quality.STATISTICS))
    got = np.array([r[0] for r in frame.select(rules.column()).collect()])
    assert got == pytest.approx(1 / (1 + np.exp(-total)))
    assert ((got > 0.5) == (y > 0.5)).mean() > 0.97
    assert len(rules.rules) < len(quality._paths(x, y))


def test_no_labels_or_one_class(docs, spark, corpus):
    none = spark.createDataFrame([], "doc_id bigint, quality int, text string")
    rows = quality.classify(docs, none, F.lit(False)).collect()
    assert len(rows) == len(corpus) and {(r["score"], r["predicted"]) for r in rows} == {(0.5, 1)}
    ones = spark.createDataFrame([(k, 1) for k in range(9)] + [(None, 0), (3, None)], "doc_id bigint, quality int")
    assert all(r["score"] > 0.99 for r in quality.classify(docs, ones, F.lit(False)).collect())


def test_held_out_rows_are_not_learnt(spark):
    texts = [(k, "word " * (5 if k % 2 else 90)) for k in range(300)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    held = F.col("doc_id") >= 150
    labels = [[(k, int(k % 2 == 0) if k < 150 or not flip else int(k % 2)) for k in range(300)] for flip in (0, 1)]
    a, b = (
        sorted(map(tuple, quality.classify(docs, spark.createDataFrame(x, "doc_id bigint, quality int"), held).collect()))
        for x in labels
    )
    assert a == b


def test_empty_table(empty, spark):
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, quality int")
    assert quality.classify(empty, labels, F.lit(False)).count() == 0
