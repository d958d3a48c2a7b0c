"""Hard negatives against brute force."""

import math
import random
from itertools import pairwise

import numpy as np
import pytest
from conftest_llm import CLASHING
from pyspark.sql import functions as F

from jobsluice.llm import hardneg as H

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, modulus):
    best = {}
    for vec_id, vec, label in rows:
        if None in (vec_id, vec, label) or any(x is None or not math.isfinite(x) for x in vec):
            continue
        row = (label, [math.floor(256 * float(np.float32(x))) for x in vec])
        best[vec_id] = min(best.get(vec_id, row), row)
    out = set()
    score = lambda a, b: sum(x * y for x, y in zip(best[a][1], best[b][1]))
    for a in best:
        if a % modulus:
            continue
        ordered = sorted((b for b in best if b != a), key=lambda b: (-score(a, b), b))
        for p in [b for b in ordered if best[b][0] == best[a][0]][:5]:
            ps = score(a, p)
            window = [b for b in ordered if best[b][0] != best[a][0] and 30 * ps <= 100 * score(a, b) <= 90 * ps]
            out |= {(a, p, k, b, ps, score(a, b)) for k, b in enumerate(window[:10], 1)}
    return out


def mined(frame, modulus):
    found = H.hard_negatives(frame, F.col("vec_id"), F.col("embedding"), F.col("label"), F.col("vec_id") % modulus == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.fixture
def small_blocks(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_ROWS", 16)
    monkeypatch.setattr(H, "ANCHOR_ROWS", 4)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def clustered(rng, n, dims=6, clusters=8):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(clusters)]
    rows = []
    for k in range(n):
        centre = rng.choice(centres)
        rows.append((k, [x + rng.gauss(0, 0.1) for x in centre], rng.randrange(4)))
    return rows


def odd_rows(rng):
    """Ties, repeated rows, repeated ids, missing values, other lengths, no length."""
    rows = clustered(rng, 200)
    rows += [(300 + k, rows[10][1], rows[10][2]) for k in range(30)] + [rows[5], rows[5], (7, rows[8][1], 3), (14, [1.0] * 6, 0)]
    rows += [(400, None, 1), (407, [1.0, None], 1), (414, [float("nan")] * 6, 1), (421, [float("inf")] * 6, 1)]
    rows += [(428, rows[3][1], None), (None, rows[4][1], 1), (435, [], 2), (442, [0.5, -1.0], 2), (449, [0.0] * 6, 2), (456, [2.0] * 9, 2)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, small_blocks, seed):
    rows = odd_rows(random.Random(seed))
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in [*CLASHING, "id", "q", "vec", "shelf", "slot", "asked"] if c != "label"})
    want = brute(rows, 7)
    assert mined(frame, 7) == want and len(want) > 500


def test_large_components(spark, small_blocks):
    rng = random.Random(3)
    rows = [(k, [rng.uniform(-1e6, 1e6) for _ in range(4)], k % 3) for k in range(80)]
    assert mined(spark.createDataFrame(rows, SCHEMA), 5) == brute(rows, 5)


def test_no_rows(spark):
    assert mined(spark.createDataFrame([], SCHEMA), 2) == set()
    assert mined(spark.createDataFrame([(2, None, 1), (4, [], 1), (6, [1.0], 1)], SCHEMA), 2) == brute([(4, [], 1), (6, [1.0], 1)], 2)


def test_bounds_hold_and_skip(spark, small_blocks):
    rows = clustered(random.Random(4), 600)
    table = spark.createDataFrame(rows, SCHEMA).select(F.col("vec_id").alias("id"), "label", (F.col("vec_id") % 50 == 0).alias("asked"), F.col("embedding").alias("vec"))
    vectors = H.whole_vectors(table)
    space = H.space_of(vectors)
    blocks = H.build_blocks(vectors, space)
    zones = H.zone_maps(blocks, space)
    assert len(zones["shelf"]) == 6
    q = np.array([r.q for r in vectors.collect()])
    for block in blocks.collect():
        inside = np.frombuffer(block.vectors, space.kind).reshape(-1, space.dim)
        score = space.products(q, inside)
        least, most = space.bounds(q, np.array([block.low]), np.array([block.high]))
        assert (least <= score).all() and (score <= most).all()
    anchors = H.anchors_of(blocks)
    assert anchors.count() == 12
    # A window that only close neighbours reach leaves most shelves unread.
    tight = anchors.join(vectors.select("id", "q"), "id").select(
        "id", "label", "place", "home", "vector",
        F.array(F.struct(F.lit(0).alias("slot"), F.aggregate("q", F.lit(0).cast("bigint"), lambda s, x: s + x * x).alias("low"), F.lit(H.MOST).alias("high"))).alias("windows"),
    )
    asked = H.requests(tight, space, zones, 1, True, False).collect()
    assert sum(len(r.ids) // 8 for r in asked) < 0.6 * 12 * 5


def test_curve_has_neighbours_next_to_each_other():
    for dims, bits in ((2, 3), (3, 2), (5, 1)):
        cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims)).reshape(dims, -1).T
        key = H.hilbert(cells, bits)
        assert sorted(key.tolist()) == list(range(len(cells)))
        path = cells[np.argsort(key)]
        assert all(np.abs(a - b).sum() == 1 for a, b in pairwise(path))
