"""Tiling of benchmark items, in order and reordered."""

from jobsluice.llm import tiling

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def pairs(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id bigint, text string, item_id string")
    items = spark.createDataFrame(items, "item_id bigint, text string, doc_id string")
    return sorted((r["doc_id"], r["item_id"], r["covered_words"], r["n_tiles"]) for r in tiling.contaminated(docs, items).collect())


def test_whole_part_and_reordered(spark):
    w = ITEM.split()
    docs = [
        (1, f"before {ITEM.upper()} after", "x"),
        (2, " ".join(["x", *w[10:], "y", *w[:10], "z"]), "x"),
        (3, " ".join(w[:9]), "x"),
        (4, " ".join(w[:10]), "x"),
        (5, " ".join(w[::-1]), "x"),
        (6, None, None),
        (7, "", None),
        (8, " ".join(x for k in range(0, 20, 4) for x in [*w[k : k + 4], "gap"]), "x"),
        (1, f"before {ITEM.upper()} after", "x"),
    ]
    items = [(70, ITEM, "y"), (71, None, None), (72, "too short", None), (73, "", None)]
    assert pairs(spark, docs, items) == [(1, 70, 20, 1), (1, 70, 20, 1), (2, 70, 20, 2), (4, 70, 10, 1)]


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    items = [(k, " ".join(f"i{k}w{j}" for j in range(12)), None) for k in range(20)]
    docs = [(k, f"{items[k][1]} and {items[(k + 1) % 20][1]}", None) for k in range(20)]
    whole = pairs(spark, docs, items)
    monkeypatch.setattr(tiling, "BLOCK_BYTES", 300)
    assert pairs(spark, docs, items) == whole and len(whole) == 40


def test_longest_first_and_no_overlap():
    # A match of 8 lies across the ends of two matches of 6.
    assert tiling.tiles([(6, 0, 0), (8, 4, 20), (6, 10, 40)], 5) == [(8, 4, 20)]
    assert tiling.tiles([(6, 0, 0), (8, 4, 20), (9, 10, 40)], 5) == [(9, 10, 40), (6, 0, 0)]
    assert tiling.tiles([(10, 0, 0), (10, 0, 30)], 5) == [(10, 0, 0)]


def test_repeated_words(spark):
    assert pairs(spark, [(1, "the " * 40, None)], [(9, "the " * 12, None)]) == [(1, 9, 12, 1)]


def test_empty_tables(spark, empty):
    items = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    assert tiling.contaminated(empty, items).count() == 0
    assert tiling.contaminated(items.selectExpr("item_id as doc_id", "text"), items.limit(0)).count() == 0
