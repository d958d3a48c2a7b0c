"""Repeated byte strings against all strings of a length."""

from collections import Counter

import numpy as np
import pytest

from jobsluice.llm import suffix


def brute(rows, length, keep):
    texts = sorted(((r[0] is not None, r[0] or 0, (r[1] or "").encode()) for r in rows), key=lambda t: t[:2])
    count, first = Counter(), {}
    for has, doc, data in texts:
        for s in range(len(data) - length + 1):
            w = data[s : s + length]
            count[w] += 1
            first.setdefault(w, (has, doc, s))
    out = []
    for has, doc, data in texts:
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            w = data[s : s + length]
            if count[w] > 1 if keep == "none" else first[w] != (has, doc, s):
                gone[s : s + length] = b"\1" * length
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((doc if has else None, len(data), len(data) - len(kept), runs, kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("group", [2_000, 1])
def test_against_all_strings(docs, corpus, monkeypatch, keep, group):
    monkeypatch.setattr(suffix, "GROUP_STRETCHES", group)
    rows = [r for r in corpus if r[0] != 88]
    got = suffix.remove_repeats(docs.where("doc_id is null or doc_id <> 88"), keep=keep).collect()
    found = sorted(
        ((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got), key=repr
    )
    want = brute(rows, 200, keep)
    assert [(a[:4], b[:4]) for a, b in zip(found, want, strict=True) if a != b] == []


def test_long_text_in_segments(docs, monkeypatch):
    one = docs.where("doc_id in (5, 88)").select("doc_id", "text")
    whole = sorted(map(repr, suffix.remove_repeats(one).collect()))
    monkeypatch.setattr(suffix, "SEGMENT", 5_000)
    assert sorted(map(repr, suffix.remove_repeats(one).collect())) == whole


def test_empty_table(empty):
    assert suffix.remove_repeats(empty).count() == 0


def test_whole_characters_stay_text():
    data = "aéü".encode()
    assert suffix._whole_characters(data, 2, 4) == (3, 3)
    assert suffix._whole_characters(data, 1, 4) == (1, 3)


def test_suffix_array_groups():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 600).astype(np.uint8)
    starts = np.arange(600 - 12 + 1)
    order, group = suffix.suffix_groups(data, starts, 12)
    text = data.tobytes()
    assert [text[k : k + 12] for k in order] == sorted(text[k : k + 12] for k in starts)
    count = Counter(text[k : k + 12] for k in starts)
    assert [count[text[k : k + 12]] > 1 for k in order] == suffix.repeated(group, order, 12, "none").tolist()
    assert [text.find(text[k : k + 12]) < k for k in order] == suffix.repeated(group, order, 12, "first").tolist()
    lpf, before, after = suffix.longest_previous(group, order, 12)
    for i, place in enumerate(order):
        near = [j for j in range(len(order)) if group[j] == group[i] and order[j] < place]
        assert before[i] == max((j for j in near if j < i), default=-1)
        assert after[i] == min((j for j in near if j > i), default=-1)
        # The longest earlier match by definition, as far as the depth reaches.
        earlier = max((k for k in range(13) if text.find(text[place : place + k]) < place), default=0)
        assert lpf[i] == (12 if earlier == 12 else 0)


def test_sliding_min():
    values = np.array([5, 3, 4, 1, 2, 6, 7], np.uint64)
    assert suffix.sliding_min(values, 3).tolist() == [3, 1, 1, 1, 2]
    assert suffix.sliding_min(values, 9).tolist() == []
