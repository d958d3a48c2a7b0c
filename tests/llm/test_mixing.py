"""Targets by water filling, prefix selection, reruns."""

import random
from collections import defaultdict

import pytest
from conftest_llm import words_of

from jobsluice.llm import mixing


def wanted(sizes):
    """Targets by raising what is shared again until nothing is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    out, left, open_ = {}, float(sum(sizes.values())), set(order)
    while open_:
        rate = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if rate * weight[s] > 3 * sizes[s]}
        if not over:
            return out | {s: rate * weight[s] for s in open_}
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def check(rows, source_of):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[source_of(r)] += r["size"]
    targets = wanted(dict(sizes))
    for r in rows:
        s = source_of(r)
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(targets[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    for s, target in targets.items():
        largest = max(r["size"] for r in rows if source_of(r) == s)
        assert abs(taken[s] - target) <= largest / 2 + 1


def test_all_rows(docs, corpus):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(corpus)
    assert sorted((r["doc_id"] or -1, r["size"]) for r in rows) == sorted((r[0] or -1, len(words_of(r[1]))) for r in corpus)
    check(rows, lambda r: r["source"])
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix(docs.repartition(5)).collect()))


def test_skewed_sources(spark):
    rng = random.Random(4)
    rows = [(k, "w " * rng.randrange(1, 30), "hot" if k % 3 else f"s{k % 17}") for k in range(1_500)]
    rows += [(5_000 + k, "w", f"tiny{k}") for k in range(9)]
    check(mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect(), lambda r: r["source"])


def test_better_texts_come_first(spark):
    rows = [(k, "word " * 20 if k % 2 else "w#$% " * 20, "a" if k < 600 else "b") for k in range(1_200)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    some = [r for r in got if r["source"] == "b"]
    good, poor = (sum(r["taken"] for r in some if r["doc_id"] % 2 == k) for k in (1, 0))
    assert good > 1.5 * poor


def test_no_words_and_no_rows(spark, empty):
    assert mixing.mix(empty).count() == 0
    rows = mixing.mix(spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id bigint, text string, source string")).collect()
    assert [(r["size"], r["taken"], r["target"]) for r in rows] == [(0, 0, 0.0)] * 2
