"""Near-dedup against all pairs, sketches, components, blocks."""

import numpy as np
from conftest_llm import lower, words_of
from pyspark.sql import functions as F

from jobsluice.llm import neardup
from jobsluice.llm.graph import components


def shingles(text):
    w = words_of(lower(text))
    return frozenset(zip(*[w[k:] for k in range(5)], strict=False)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [(r[0], shingles(r[1])) for r in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[root(i)] = root(j)
    groups = {}
    for i, (doc, _) in enumerate(sets):
        groups.setdefault(root(i), []).append(doc)
    smallest = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return sorted(
        ((doc, len(s), smallest[root(i)] if s else doc) for i, (doc, s) in enumerate(sets)), key=repr
    )


def test_components_of_all_pairs(docs, corpus):
    got = neardup.near_duplicates(docs).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == brute(corpus)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_empty_table(empty):
    assert neardup.near_duplicates(empty).count() == 0


def test_members_that_only_others_link(spark):
    """The smallest class of a bucket is like no other, so that blocks have to find the links."""
    base = [f"t{k}" for k in range(400)]
    rows = [(k, " ".join([*base[: 400 - 9 * k], *(f"n{k}_{j}" for j in range(9 * k))])) for k in range(14)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = neardup.near_duplicates(docs).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == brute(rows)


def test_blocks_of_one_bucket():
    import pyarrow as pa

    sets = [np.arange(k, 40 + k, dtype=np.int64) for k in range(6)]
    values = np.concatenate(sets).view(np.uint64)
    first = np.arange(0, 241, 40)
    sketch = neardup.odd_sketches(neardup._min_hashes(values, first)).view(np.int64)
    key = tuple(pa.scalar(k) for k in (1, 0, 0))
    whole = {"cid": range(6), "label": range(6), "block": [0] * 6, "n": [40] * 6, "sketch": list(sketch), "items": sets}
    rows = pa.table({name: pa.array(list(column)) for name, column in whole.items()})
    # In one piece, in several, and as a part of a longer table.
    for table in (rows, pa.concat_tables([rows.slice(0, 2), rows.slice(2)]), pa.concat_tables([rows, rows]).combine_chunks().slice(6)):
        got = neardup._block_links(75)(key, table)
        assert got.num_rows == 5 and set(got["a"].to_pylist()) | set(got["b"].to_pylist()) == set(range(6))
    joined = rows.set_column(1, "label", pa.array([3] * 6))
    assert neardup._block_links(75)(key, joined).num_rows == 0


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 2_000, dtype=np.uint64)
    a, b = pool[:1_000], pool[100:1_100]
    values = np.concatenate([np.sort(a), np.sort(b)])
    sketch = neardup.odd_sketches(neardup._min_hashes(values, np.array([0, 1_000, 2_000])))
    apart = int(np.bitwise_count(sketch[0] ^ sketch[1]).sum())
    bits, samples = neardup.SKETCH_BITS, neardup.BANDS * neardup.ROWS
    estimate = 1 + bits / (4 * samples) * np.log(1 - 2 * apart / bits)
    assert abs(estimate - 900 / 1_100) < 0.12
    assert apart <= neardup.sketch_limit()


def test_chains_and_repeats(spark):
    links = [(k, k + 1) for k in range(30)] + [(5, 4), (7, 7), (100, 101), (None, 3)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {(r["node"], r["label"]) for r in found} == {(k, 0) for k in range(31)} | {(100, 100), (101, 100)}


def test_one_set_for_a_class_of_copies(spark):
    """Copies of two linked texts meet once, not once for each pair of copies."""
    words = [f"w{k}" for k in range(100)]
    texts = [" ".join(words), " ".join([*words[:-1], "other"])]
    for ids in (lambda k: k, lambda k: k % 2, lambda k: None):
        copies = spark.createDataFrame([(ids(k), texts[k % 2]) for k in range(200)], "doc_id bigint, text string")
        signed = neardup.signatures(copies)
        classes = signed.groupBy("cid").agg(F.min("doc_id").alias("first_id"), F.min("mark").alias("mark"))
        assert neardup._sets(copies, "text", "doc_id", classes).count() == 2
        assert {r["component_id"] for r in neardup.near_duplicates(copies).collect()} == {ids(0)}
