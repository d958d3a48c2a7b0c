"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from conftest_llm import CLASHING, lower
from pyspark.sql import functions as F

from jobsluice.llm import spelling as S


def counted(rows, every):
    """The rule of the words, one run at a time."""
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if every and h % every == 0:
                gone = h % len(word)
                word = word[:gone] + word[gone + 1 :]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= 6}


def shortened(word):
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and b in shortened(a) or len(b) == len(a) + 1 and a in shortened(b)


def grouped(counts, min_count=5, factor=5):
    counts = {w: n for w, n in counts.items() if n >= min_count}
    near = {w: [v for v in counts if is_near(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return out


def words_with_variants(rng):
    """Words over few letters, many of them near each other, with runs of equal letters."""
    words = Counter()
    for _ in range(60):
        base = "".join(rng.choice("abé") for _ in range(rng.randrange(6, 9)))
        words[base] += rng.choice([5, 30, 200, 1_000])
        for _ in range(rng.randrange(6)):
            i = rng.randrange(len(base))
            base = rng.choice([base[:i] + base[i + 1 :], base[:i] + rng.choice("abé") + base[i:], base[:i] + "a" + base[i + 1 :]])
            words[base] += rng.choice([1, 4, 5, 6, 25, 26])
    words |= {"a" * 40: 9, "a" * 41: 50, "ab" * 300: 7, "ab" * 300 + "a": 35}
    return {w: n for w, n in words.items() if len(w) >= 6}


@pytest.fixture(params=[1, 7])
def partitions(spark, request):
    """One range partition, and several whose borders cut through the tries."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", old)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("seed", [1, 2])
def test_variants(spark, partitions, seed):
    counts = words_with_variants(random.Random(seed))
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    got = [tuple(r) for r in S.variants(frame).collect()]
    assert len(got) == len(set(got))
    assert set(got) == grouped(counts)


def test_numbers_of_prefixes(spark, partitions):
    counts = words_with_variants(random.Random(3))
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    rows, rename = S.number_prefixes(frame)
    prefix_of, number_of, whole = {}, {}, []
    for row in rows.collect():
        whole.append((row.nodes[-1], row.word))
        for k, node in enumerate(row.nodes, 1):
            node = rename.get(node, node)
            assert prefix_of.setdefault(node, row.word[:k]) == row.word[:k]
            assert number_of.setdefault(row.word[:k], node) == node
    assert [w for _, w in sorted(whole)] == sorted(counts)
    assert not {n for n, _ in whole} & set(rename) and S.ROOT not in prefix_of
    assert bool(rename) == (partitions > 1)


def test_counts(spark, docs, corpus):
    rows = [(r[0], r[1]) for r in corpus] + [(900, "ÀÉÿ×÷ABCdef"), (901, "abcdef-ABCDEF\nabcdeF7abcdefĀabcdefgh"), (None, "nobodys")] * 3
    extra = spark.createDataFrame(rows[len(corpus) :], "doc_id bigint, text string").withColumns({c: F.lit("x") for c in CLASHING})
    frame = docs.unionByName(extra, allowMissingColumns=True)
    for every in (None, 3, 199):
        got = {r.word: r.n for r in S.count_words(frame, damage_every=every).collect()}
        assert got == counted(rows, every), every


def test_query_rule(spark, docs, corpus):
    letters = str.maketrans("0123456789", "abcdefghij")
    rows = [(r[0], "word" + r[1].translate(letters).replace(" ", " word") if r[1] else r[1]) for r in corpus]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [tuple(r) for r in S.variants(S.count_words(frame, damage_every=7)).collect()]
    want = grouped(counted(rows, 7))
    assert set(got) == want and len(got) == len(want) > 100


def test_empty(spark, empty):
    assert S.variants(S.count_words(empty, damage_every=199)).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, ""), (3, "a bc 12")], "doc_id bigint, text string")
    assert S.variants(S.count_words(nothing)).collect() == []


def test_very_long_text_and_word(spark):
    rows = [(1, "letter " * 200_000 + "x" * 30_000), (2, " ".join(["x" * 30_000] * 4 + ["lettre"] * 5))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.word[:8], len(r.word), r.n, r.n_near) for r in S.variants(S.count_words(frame)).collect()}
    assert got == {("letter", 6, 200_000, 0), ("lettre", 6, 5, 0), ("x" * 8, 30_000, 5, 0)}
