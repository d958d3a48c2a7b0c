"""Small tables for the corpus operators."""

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from conftest_llm import CLASHING, DOCS, prose  # noqa: E402


@pytest.fixture(scope="session")
def corpus():
    """Rows of documents: prose, exact and near copies, shared passages, odd and empty texts."""
    rng = random.Random(7)
    passage = prose(rng, 90, 5_000)
    rows = []
    for k in range(60):
        text = prose(rng, rng.choice([3, 20, 60, 150]), 3_000)
        if k % 5 == 0:
            text = f"{text[:40]} {passage} {text[40:]}"
        rows.append((k, text, "en" if k % 3 else "fr", f"s{k % 4}", len(text)))
    base = rows[9][1] + prose(rng, 120, 3_000)
    for k in range(60, 72):
        words = base.split(" ")
        if k > 62:
            words[rng.randrange(len(words))] = f"changed{k}"
        rows.append((k, " ".join(words), "en", "s0", 1))
    rows += [
        (80, None, None, None, None),
        (81, "", "en", "", 0),
        (82, " \n\t ", "en", None, 4),
        (83, "one", None, "s1", 3),
        (84, "é" * 1_000, "fr", "s1", 1_000),
        (85, "heer " * 400, "de", "s2", 2_000),
        (86, "a b c d", "en", "s2", 7),
        (87, "A B C D", "en", "s2", 7),
        (None, rows[3][1], "en", "s3", 5),
        (5, rows[5][1], rows[5][2], rows[5][3], rows[5][4]),
        (88, prose(rng, 30_000, 20_000), "en", "s3", 1),
    ]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus, tmp_path_factory):
    """The rows as a Parquet table with clashing extra columns."""
    from pyspark.sql import functions as F

    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    frame = spark.createDataFrame(corpus, DOCS).withColumns({c: F.lit("x") for c in CLASHING})
    frame.repartition(3, "lang").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty") / "documents.parquet")
    spark.createDataFrame([], DOCS).write.parquet(path)
    return spark.read.parquet(path)
