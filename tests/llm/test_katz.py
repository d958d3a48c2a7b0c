"""Katz scores against the definition, and that probabilities add up."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import lower, words_of

from jobsluice.llm import katz
from jobsluice.llm.shared import training_rows


class Definition:
    """The model by its formulas, on dictionaries."""

    def __init__(self, texts):
        tokens = [[*words_of(lower(t)), None] for t in texts]
        self.c = Counter(w for t in tokens for w in t)
        self.b = Counter(p for t in tokens for p in zip(["<"], t, strict=False)) + Counter(
            p for t in tokens for p in zip(t, t[1:], strict=False)
        )
        self.n = sum(self.c.values())
        few = lambda counts: np.array([sum(v == r for v in counts.values()) for r in range(1, 7)], float)
        self.d1, self.d2 = katz.discounts(few(self.c)), katz.discounts(few(self.b))
        self.left = self.n - sum(self.cut(v, self.d1) for v in self.c.values())
        self.after = defaultdict(dict)
        for (h, w), v in self.b.items():
            self.after[h][w] = v

    @staticmethod
    def cut(v, d):
        return v * (d[v - 1] if v <= 5 else 1)

    def single(self, w):
        if self.left <= 0:
            return (self.c[w] or 1) / (self.n + 1)
        return (self.cut(self.c[w], self.d1) if self.c[w] else self.left) / self.n

    def p(self, h, w):
        seen = self.after.get(h)
        if not seen:
            return self.single(w)
        total = sum(seen.values())
        bare = all(v > 5 for v in seen.values())
        mass = {x: (v / (total + 1) if bare else self.cut(v, self.d2) / total) for x, v in seen.items()}
        if w in mass:
            return mass[w]
        return (1 - sum(mass.values())) / (1 - sum(map(self.single, seen))) * self.single(w)


def check(got, rows):
    held = lambda r: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2
    model = Definition([r[1] for r in rows if not held(r)])
    want = []
    for r in rows:
        t = [*words_of(lower(r[1])), None]
        base = sum(math.log10((model.c[w] + 1) / (model.n + 1 * (len(model.c) + 1))) for w in t)
        score = sum(math.log10(model.p(h, w)) for h, w in zip(["<", *t], t, strict=False))
        want.append((r[0], held(r), len(t), sum(model.c[w] > 0 for w in t), model.n, base, score))
    order = lambda rows: sorted(rows, key=lambda x: repr(x[:5]))
    for a, b in zip(order(map(tuple, got)), order(want), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)
    return model


def test_all_rows(docs, corpus):
    model = check(katz.katz_scores(docs, training_rows("doc_id", 7, 2)).collect(), corpus)
    for h in ("<", "w1", "heer", None, "nowhere"):
        assert sum(model.p(h, w) for w in model.c) + model.p(h, "unknown word") == pytest.approx(1)


def test_small_blocks_and_split_histories(docs, corpus, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK_WORDS", 500)
    monkeypatch.setattr(katz, "BUCKET_ENTRIES", 300)
    monkeypatch.setattr(katz, "FREQUENT", 20)
    check(katz.katz_scores(docs, training_rows("doc_id", 7, 2)).collect(), corpus)


def test_nothing_to_learn_from(spark, empty):
    assert katz.katz_scores(empty, training_rows("doc_id", 7, 2)).count() == 0
    held = [k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2][:3]
    rows = [(k, "a b") for k in held]
    got = katz.katz_scores(spark.createDataFrame(rows, "doc_id bigint, text string"), training_rows("doc_id", 7, 2))
    assert {tuple(r)[1:] for r in got.collect()} == {(True, 3, 0, 0, 0.0, 0.0)}


def test_only_frequent_tokens(spark):
    rows = [(k, "a a a a a a a") for k in range(40)]
    got = katz.katz_scores(spark.createDataFrame(rows, "doc_id bigint, text string"), training_rows("doc_id", 7, 2))
    check(got.collect(), rows)


def test_packing():
    for values in ([], [0], [0, 0, 5], [2**40, 1, 2**63], list(range(3_000))):
        array = np.array(values, np.uint64)
        assert katz.unpack(katz.pack(array)).tolist() == values
        assert katz.unpack_sorted(katz.pack_sorted(np.sort(array))).tolist() == sorted(values)
