"""Language identification against a plain version and on held-out documents."""

import math
import random
from collections import Counter, defaultdict

import pytest
from conftest_llm import CLASHING
from pyspark.sql import functions as F

from jobsluice.llm import langid as L
from jobsluice.llm.shared import training_rows

SYLLABLES = {
    "en": "the ing er th and on wh ea".split(), "fr": "le ou eau qué ment tre çon ais".split(), "el": "και τον ος ειν ης".split(),
}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def rows_of(rng, n):
    rows = []
    for k in range(n):
        lang = rng.choice(list(SYLLABLES))
        text = sentence(rng, lang, rng.choice([2, 10, 60]))
        rows.append((k, rng.choice([text, text.upper(), text + "!\n7 ", text.title()]), lang if k % 11 else None))
    rows += [(900, None, "en"), (901, "", "fr"), (902, "12 -- !", "en"), (903, "日本語 漢字", None), (904, "日 the", None), (None, "the the", "en"), (5, "eau eau", "fr")]
    return rows


def words(text):
    out, now = [], ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            now += c
        elif now:
            out.append(now)
            now = ""
    return out


def n_grams(word, n):
    whole = f" {word} "
    return [g for g in (whole[i : i + n] for i in range(len(whole) - n + 1)) if g != " "]


def plain(train, texts):
    """The method on dictionaries, one word at a time."""
    rows_by_lang = Counter(lang for text, lang in train if lang is not None and text is not None)
    langs = sorted(rows_by_lang, key=lambda x: (-rows_by_lang[x], x))
    counts = defaultdict(Counter)
    for text, lang in train:
        if lang is None:
            continue
        for w in words(text):
            counts[0, lang][w] += 1
            for n in range(1, L.LONGEST + 1):
                counts[n, lang].update(n_grams(w, n))
    total = {key: sum(c.values()) for key, c in counts.items()}
    penalty = {n: -math.log10(2 * max([t for (k, _), t in total.items() if k == n], default=1)) for n in range(L.LONGEST + 1)}

    def value(n, lang, item):
        c = counts[n, lang][item]
        return math.log10(c / total[n, lang]) if c else penalty[n]

    def known(n, item):
        return any(counts[n, lang][item] for lang in langs)

    out = []
    for text in texts:
        scores, n_words = [], 0
        for w in words(text):
            n_words += 1
            if known(0, w):
                scores.append([value(0, lang, w) for lang in langs])
                continue
            for n in range(L.LONGEST, 0, -1):
                found = [g for g in n_grams(w, n) if known(n, g)]
                if found:
                    scores.append([sum(value(n, lang, g) for g in found) / len(found) for lang in langs])
                    break
        if not n_words:
            out.append(("und", 0.0))
            continue
        mean = [sum(s[k] for s in scores) / max(len(scores), 1) for k in range(len(langs))]
        best = max(range(len(langs)), key=lambda k: (round(mean[k], 9), -k))
        sure = 1 / sum(math.exp((m - mean[best]) * math.log(10) * min(len(scores), L.SURE_WORDS)) for m in mean)
        out.append((langs[best], sure))
    return out


@pytest.mark.parametrize("piece", [1 << 20, 40])
def test_against_plain_version(spark, monkeypatch, piece):
    monkeypatch.setattr(L, "PIECE", piece)
    rows = rows_of(random.Random(1), 120)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    frame = frame.withColumns({c: F.lit("x") for c in [*CLASHING, "held_out", "gram", "kind", "lang_pred", "score"]})
    model = L.train(frame)
    want = plain([(t, l) for _, t, l in rows], [t for _, t, _ in rows])
    names, scores = model.predict([t for _, t, _ in rows])
    assert names == [n for n, _ in want]
    assert scores.tolist() == pytest.approx([s for _, s in want], abs=1e-6)


def test_query_rows(spark):
    rows = rows_of(random.Random(2), 400)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    found = L.identify(frame, training_rows("doc_id", 3, 1))
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = found.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((i is None, i or 0) for i, _, _ in rows)
    lang = {i: x for i, _, x in rows}
    held = [r for r in got if r.held_out and r.doc_id < 900 and lang[r.doc_id]]
    assert len(held) > 80 and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and by_id[902].score == 0
    assert by_id[903].lang_pred in SYLLABLES and by_id[904].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got)


def test_language_names_do_not_leak(spark):
    """The language of a row that is scored has no influence on its result."""
    rows = rows_of(random.Random(3), 200)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    out = training_rows("doc_id", 3, 1)
    other = frame.withColumn("lang", F.when(out, F.lit("xx")).otherwise(F.col("lang")))
    a, b = (sorted(map(repr, L.identify(f, out).collect())) for f in (frame, other))
    assert a == b


def test_nothing_learnt_and_empty(spark, empty):
    frame = spark.createDataFrame([(1, "abc", None), (2, None, "en")], "doc_id bigint, text string, lang string")
    assert {tuple(r) for r in L.identify(frame, F.lit(False)).collect()} == {(1, False, "und", 0.0), (2, False, "und", 0.0)}
    assert L.identify(empty, F.lit(False)).collect() == []


def test_sample_is_bounded_and_long_texts_are_whole(spark, monkeypatch):
    monkeypatch.setattr(L, "LEAST_ROWS", 10)
    rng = random.Random(4)
    rows = [(k, sentence(rng, "en", 20), "en") for k in range(2_000)] + [(k, sentence(rng, "fr", 20), "fr") for k in range(2_000, 2_020)]
    # The words at the end outweigh those at the beginning.
    rows.append((9_000, sentence(rng, "en", 20_000) + " " + sentence(rng, "fr", 200_000), None))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = L.train(frame, train_rows=200)
    assert model.langs == ["en", "fr"] and model.predict([rows[-1][1]])[0] == ["fr"]
    seen = L.count_grams(frame.where("lang is not null").select("lang", "text")).where("kind = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    assert {r.lang: r.n for r in seen.collect()} == {"en": 40_000, "fr": 400}
