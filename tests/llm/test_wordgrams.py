"""The word model of the quality rules against Kneser-Ney on dictionaries."""

from collections import Counter, defaultdict
from math import log2

import numpy as np
import pytest
from conftest_llm import words_of

from jobsluice.llm import perplexity, wordgrams
from jobsluice.llm.shared import stored


def _discounts(counts):
    few = Counter(counts.values())
    return (0, *perplexity.discounts_of(*(few[k] for k in (1, 2, 3, 4))))


def _probability(gram, counts, d, below):
    """Interpolated with ``below``; the counts may be those without one text, the discounts are of all."""
    same = [n for g, n in counts.items() if g[:-1] == gram[:-1] and n]
    n = counts.get(gram, 0)
    return (n - d[min(n, 3)] + sum(d[min(k, 3)] for k in same) * below) / sum(same) if same else below


def plain_bits(texts):
    sequences = [[1, 1, *words_of(t or ""), 2] for t in texts]
    events = [Counter(zip(s, s[1:], s[2:], strict=False)) for s in sequences]
    third = sum(events, Counter())
    second = Counter(g[1:] for g in third)
    first = Counter(g[1:] for g in second)
    d1, d2, d3 = map(_discounts, (first, second, third))
    p1 = {g: _probability(g, first, d1, 1 / len(first)) for g in first}
    out = []
    for own in events:
        rest = third - own
        pairs = Counter(g[1:] for g in rest)
        bits = 0.0
        for g, times in own.items():
            if first[g[2:]] == 1 and not pairs[g[1:]]:
                continue
            p2 = _probability(g[1:], pairs, d2, p1[g[2:]])
            bits -= times * log2(_probability(g, rest, d3, p2))
        out.append(bits / max(own.total() - 1, 1))
    return out


def _texts():
    rng = np.random.default_rng(11)
    words = [f"w{k}" for k in range(60)] + ["é", "longer-word", "W1"]
    draw = lambda n: " ".join(words[int(k) % len(words)] for k in rng.zipf(1.4, n))
    texts = [draw(int(n)) for n in rng.integers(1, 60, 150)]
    return [*texts, texts[0], None, "", " \n", "w1 " * 40, "only-here twice only-here"]


@pytest.mark.parametrize("split", [False, True])
def test_word_surprise_is_that_of_whole_words_in_other_texts(spark, monkeypatch, split):
    if split:  # several blocks, buckets and ranges, and frequent words in several buckets
        for name, value in {"BLOCK_EVENTS": 300, "BUCKET_EVENTS": 400, "FREQUENT": 150, "SHARE": 0}.items():
            monkeypatch.setattr(wordgrams, name, value)
    texts = _texts()
    rows = [(k // 2 if k else None, t, "en") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    total, often = wordgrams.frequent_words(docs)
    assert total == sum(len(words_of(t or "")) + 1 for t in texts) and bool(often) == split
    got = perplexity.score(docs, perplexity.train(docs), perplexity.train(docs, of_words=True)).collect()
    found = sorted((r["doc_id"] or -1, r["n_words"], r["word_surprise"]) for r in got)
    want = sorted((i or -1, len(words_of(t or "")), b) for (i, t, _), b in zip(rows, plain_bits(texts), strict=True))
    assert [f[:2] for f in found] == [w[:2] for w in want]
    # Split, what a text has after a frequent word in other buckets is not taken out.
    assert [f[2] for f in found] == pytest.approx([w[2] for w in want], rel=0.05 if split else 1e-6)


def test_trigrams_are_sent_once_and_in_no_table(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(wordgrams, "BLOCK_EVENTS", 300)
    monkeypatch.setattr(wordgrams, "BUCKET_EVENTS", 400)
    tables = []
    monkeypatch.setattr(wordgrams, "stored", lambda df, label: tables.append(label) or stored(df, label))
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(_texts())], "doc_id bigint, text string")
    log = tmp_path / "measured"

    def measure(rows, texts):
        with log.open("a") as out:
            out.write("x" * len(texts))
        return rows.select(["doc_id"])

    bits = wordgrams.with_word_bits(docs, measure, "doc_id bigint", perplexity.discounts_of, "bits").collect()
    assert sorted(r["doc_id"] for r in bits) == list(range(len(_texts())))
    assert len(log.read_text()) == len(_texts())  # two steps read the trigrams, texts are read once for them
    assert tables == ["middle-words"]
