import random

import pytest

from jobsluice import session
from jobsluice.operators import merge
from jobsluice.operators.keys import record_key

SCHEMA = "url string, title string, company string, location string, id bigint, pos bigint, note string"


def _batch(rnd, n, ids, keys=9, tag=""):
    free = rnd.sample(range(1, 200), n)
    rows = []
    for pos in range(n):
        url = rnd.choice([f"u{rnd.randint(0, keys)}", f" u{rnd.randint(0, keys)} ", "  ", None])
        rows.append((url, rnd.choice(["T", " t ", None]), "C", None, free[pos] if ids and rnd.random() < 0.6 else None,
                     pos, f"{tag}{pos}"))
    return rows


def _key(row, by_key):
    url = (row[0] or "").strip()
    if url or not by_key:
        return url
    return "|".join((v or "").strip().lower() for v in row[1:4])


def _merge(current, fresh, by_key=False, backfill=True):
    """Row by row: {key: (id, note)}."""
    top = max([r[4] for r in current if r[4] is not None] + [0])
    table = {}
    for row in current:
        if _key(row, by_key):
            table[_key(row, by_key)] = [row[4], row[6]]
    for row in fresh:
        key = _key(row, by_key)
        if not key:
            continue
        number = table[key][0] if key in table else None
        if number is None:
            top += 1
            number = top
        table[key] = [number, row[6]]
    for entry in table.values():
        if entry[0] is None and backfill:
            top += 1
            entry[0] = top
    return sorted(((k, *v) for k, v in table.items()), key=repr)


def _got(df, by_key=False):
    rows = df.select("url", "title", "company", "location", "id", "note").collect()
    return sorted(((_key(r, by_key), r.id, r.note) for r in rows), key=repr)


@pytest.mark.parametrize("rows", [1_000_000, 0])
def test_merge_by_url(spark, monkeypatch, rows):
    # At 0 every size check fails, so the way for large tables runs.
    monkeypatch.setattr(session, "BROADCAST_ROWS", rows)
    for seed in range(4):
        rnd = random.Random(seed)
        current, fresh = _batch(rnd, 20, True, tag="c"), _batch(rnd, 25, False, 14, tag="f")
        out = merge.merge_by_url(spark.createDataFrame(current, SCHEMA), spark.createDataFrame(fresh, SCHEMA))
        assert _got(out) == _merge(current, fresh), seed


def test_merge_by_key(spark):
    for seed in range(3):
        rnd = random.Random(seed)
        current, fresh = _batch(rnd, 15, True, tag="c"), _batch(rnd, 15, False, tag="f")
        out = merge.merge_by_key(spark.createDataFrame(current, SCHEMA), spark.createDataFrame(fresh, SCHEMA))
        assert _got(out, True) == _merge(current, fresh, True, False), seed


def test_edges(spark):
    current = [("a", "old", "", "", 5, 0, "c0"), ("a", "old", "", "", None, 1, "c1"), (" ", "", "", "", 90, 2, "c2"),
               ("b", "", "", "", -3, 3, "c3"), ("c", "", "", "", None, 4, "c4")]
    fresh = [("c", "", "", "", None, 0, "f0"), ("d", "", "", "", None, 1, "f1"), ("d ", "", "", "", None, 2, "f2")]
    out = merge.merge_by_url(spark.createDataFrame(current, SCHEMA), spark.createDataFrame(fresh, SCHEMA))
    # A blank key holds the largest id; the last current row decides whether a key has one.
    assert _got(out) == _merge(current, fresh) == [("a", 93, "c1"), ("b", -3, "c3"), ("c", 91, "f0"), ("d", 92, "f2")]
    none = spark.createDataFrame([], SCHEMA)
    assert merge.merge_by_url(none, none).count() == 0
    assert _got(merge.merge_by_url(none, spark.createDataFrame(fresh, SCHEMA))) == [("c", 1, "f0"), ("d", 2, "f2")]


def test_preserve(spark):
    current = spark.createDataFrame([("a", 1, 0, "x", "Label")], "url string, id bigint, pos bigint, t string, professions string")
    fresh = spark.createDataFrame([("a", None, 0, "y", None), ("b", None, 1, "z", None)], current.schema)
    lost = {r.url: (r.id, r.t, r.professions) for r in merge.merge_by_url(current, fresh).collect()}
    assert lost == {"a": (1, "y", None), "b": (2, "z", None)}
    kept = merge.merge_by_url(current, fresh, preserve=["professions"])
    assert {r.url: r.professions for r in kept.collect()} == {"a": "Label", "b": None}


def test_two_level(spark):
    schema = "url string, id bigint, pos bigint, t string"
    output = spark.createDataFrame([("a", 4, 0, "o"), ("x", 9, 1, "o")], schema)
    master = spark.createDataFrame([("a", 7, 0, "m"), ("b", 8, 1, "m")], schema)
    fresh = spark.createDataFrame([("b", None, 0, "f"), ("c", None, 1, "f")], schema)
    new_master, new_output = merge.merge_two_level(output, master, fresh)
    assert {(r.url, r.id, r.t) for r in new_master.collect()} == {("a", 7, "m"), ("b", 8, "f"), ("c", 9, "f")}
    # The master is read newest first: c, b, a.
    assert {(r.url, r.id, r.t) for r in new_output.collect()} == {("a", 4, "m"), ("x", 9, "o"), ("c", 10, "f"), ("b", 11, "f")}


def test_assign_ids_in_blocks(spark):
    rows = random.Random(1).sample(range(1 << 40), 300)
    df = spark.createDataFrame([(o,) for o in rows], "ord bigint")
    got = {r.ord: r.id for r in merge.assign_ids(df, 10).collect()}
    assert got == {o: 11 + n for n, o in enumerate(sorted(rows))}


def test_record_key(spark):
    rows = [(" u ", "t", "c", "l"), ("", " T ", None, "L"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "url string, title string, company string, location string")
    assert [r[0] for r in df.select(record_key()).collect()] == ["u", "t||l", "||"]


def test_language_on_both_sides(spark):
    schema = "url string, title string, description string, id bigint, pos bigint"
    good, bad = "mission pour vous", "aufgaben mit sie"
    current = [("a", "x", good, 1, 0), ("b", "x", bad, 8, 1), ("c", "x", bad, 3, 2), ("d", "x", good, None, 3)]
    fresh = [("b", "y", good, None, 0), ("a", "y", bad, None, 1), ("e", "y", good, None, 2), ("f", "y", bad, None, 3)]
    out = merge.merge_by_url(spark.createDataFrame(current, schema), spark.createDataFrame(fresh, schema), language=True)
    # The dropped row of b holds the largest id, and b starts anew after it.
    assert sorted((r.url, r.id, r.title) for r in out.collect()) == [("a", 1, "x"), ("b", 9, "y"), ("d", 11, "x"), ("e", 10, "y")]
