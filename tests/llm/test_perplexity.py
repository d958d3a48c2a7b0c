"""Base signals against a row loop, the language model against its definition, bands."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import words_of

from jobsluice.llm import perplexity
from jobsluice.llm.words import texts_of


def signals(text):
    text, w = text or "", words_of(text)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    repeated = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    marks = sum(c in "#*$%&|<>" for c in text)
    return (len(w), sum(map(len, w)), marks, len(lines) - len(set(lines)), len(repeated))


ODD = ["a\na\n\na", "x x x x", "\n\n", "a|b #* \r\n a|b #*", " é　é \x0b é", "a\x00b a\x00b", "l\nm\nl\n", "n"]


def test_signals_of_odd_texts():
    found = perplexity.base_signals(texts_of(pa.array([*ODD, None, ""])))
    assert list(zip(*(v.tolist() for v in found.values()), strict=True)) == [signals(t) for t in [*ODD, None, ""]]


def test_rules_of_all_rows(docs, corpus):
    got = perplexity.quality_rules(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(((r["doc_id"], *(r[n] for n in names)) for r in got), key=repr) == sorted(
        ((r[0], *signals(r[1])) for r in corpus), key=repr
    )
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_model_sums_to_one(docs):
    model = perplexity.train(docs)
    symbols = np.array([*range(256)])
    for context in (b"w1", b"\xff\xff", b"qq", b" w", b"\xc3\xa9"):
        codes = (context[0] << 16 | context[1] << 8) + symbols
        assert (10 ** model.log_probability(codes)).sum() == pytest.approx(1, abs=1e-4)


def test_trigram_counts(spark):
    rows = [("aba",), (None,), ("",), ("ab",)]
    got = {r["code"]: r["n"] for r in perplexity.count_trigrams(spark.createDataFrame(rows, "text string")).collect()}
    want = Counter()
    for (text,) in rows:
        s = [0xFF, 0xFF, *(text or "").encode(), 0xFE]
        want.update(a << 16 | b << 8 | c for a, b, c in zip(s, s[1:], s[2:], strict=False))
    assert got == dict(want)


def test_symbols_between_words_are_rejected(spark):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abdeilnorst"), rng.integers(2, 9)))
    clean = [(k, " ".join(word() for _ in range(int(rng.integers(60, 200)))), "en") for k in range(300)]
    noisy = [(1_000 + k, " ".join(word() + "".join(rng.choice(list("#*$%&|<>"), 4)) for _ in range(120)), "en") for k in range(5)]
    rows = perplexity.quality_rules(spark.createDataFrame(clean + noisy, "doc_id bigint, text string, lang string"))
    kept = {r["doc_id"] for r in rows.where("kept").collect()}
    assert kept == {k for k, _, _ in clean}


def _word(rng):
    return "".join(rng.choice(list("abdeilnorst"), rng.integers(2, 9)))


def test_a_third_of_junk_does_not_move_the_band(spark):
    rng = np.random.default_rng(6)
    clean = [(k, " ".join(_word(rng) for _ in range(int(rng.integers(60, 200)))), "en") for k in range(200)]
    noisy = [(1_000 + k, " ".join(_word(rng) + "".join(rng.choice(list("#*$%&|<>"), 4)) for _ in range(120)), "en") for k in range(100)]
    lists = [(1_000 + k, " | ".join(_word(rng) for _ in range(120)), "en") for k in range(100)]
    for junk in (noisy, lists):
        rows = perplexity.quality_rules(spark.createDataFrame(clean + junk, "doc_id bigint, text string, lang string"))
        assert {r["doc_id"] for r in rows.where("kept").collect()} == {k for k, _, _ in clean}


def test_lists_with_bars_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 0").select("doc_id")
    passed = perplexity.quality_rules(docs).where("not base_failed").join(labels, "doc_id")
    bars = passed.join(docs.where("contains(text, ' | ')").select("doc_id"), "doc_id")
    assert bars.where("kept").count() <= 0.1 * bars.count() and bars.count() > 0


def test_word_model_sums_to_one(docs):
    model = perplexity.train(docs, of_words=True)
    for context in ((1, 2), (0xFF, 0xFF), (63, 0)):
        codes = (context[0] << 16 | context[1] << 8) + np.array([*range(256)])
        assert (10 ** model.log_probability(codes)).sum() == pytest.approx(1, abs=1e-4)


def test_empty_table(empty):
    assert perplexity.quality_rules(empty).count() == 0
