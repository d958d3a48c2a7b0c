from helpers import values
from pyspark.sql import functions as F

from jobsluice.operators import keys


def _tables(spark):
    rows = [("hot", n) for n in range(300)] + [(f"u{n % 40}", n) for n in range(80)] + [("cold hot", n) for n in range(100)]
    known = ["hot", *(f"u{n}" for n in range(0, 40, 2)), "unused"]
    return (
        spark.createDataFrame(rows, "url string, n int"),
        spark.createDataFrame([(k,) for k in known], "key string"),
        rows,
        set(known),
    )


def test_membership_with_and_without_hot_keys(spark):
    df, known, rows, known_set = _tables(spark)
    for hot_rows in (10**6, 50, 1, 0):
        flagged = values(keys.known_flag(df, known, hot_rows=hot_rows), "url", "n", "known")
        assert sorted(flagged) == sorted((u, n, u in known_set) for u, n in rows)
        new = values(keys.new_records(df, known, hot_rows=hot_rows, spread_by=["n"]), "url", "n")
        assert sorted(new) == sorted(r for r in rows if r[0] not in known_set)


def test_a_hot_key_gets_salts_by_its_count(spark):
    df, known, rows, _ = _tables(spark)
    left, right = keys._salted(df, known, "url", 40, ["n"])
    salts = {u: n for u, n in values(left.groupBy("url").agg(F.count_distinct("_salt")))}
    assert salts["hot"] == 8 and salts["cold hot"] == 3 and salts["u0"] == 1
    copies = {k: n for k, n in values(right.groupBy("_known").count())}
    assert copies["hot"] == 8 and copies["unused"] == copies["u0"] == 1
    largest = left.filter("url = 'hot'").groupBy("_salt").count().agg(F.max("count")).first()[0]
    assert largest < 2 * 300 / 8


def test_key_sets(spark):
    df = spark.createDataFrame([(" a ",), ("b",), ("  ",), (None,), ("a",)], "url string")
    state = spark.createDataFrame([("c",), ("b ",), ("",)], "key string")
    assert sorted(values(keys.key_set(df))) == [("a",), ("b",)]
    assert sorted(values(keys.known_keys(df, state))) == [("a",), ("b",), ("c",)]
    after = spark.createDataFrame([("a",), ("d",), ("d ",)], "url string")
    assert values(keys.added_keys(df, after)) == [("d",)]
    assert values(keys.sorted_seen(keys.known_keys(df, state))) == [("a",), ("b",), ("c",)]


def test_seen_policies(spark):
    def table(*urls):
        return spark.createDataFrame([(u,) for u in urls], "url string")

    tables = {
        "known": spark.createDataFrame([("k",)], "key string"),
        "listing": table("l"),
        "merged": table("m", "w"),
        "written": table("w"),
        "fresh": table("f"),
    }
    expected = {"all": "klmw", "merged": "mw", "persisted": "w", "fresh": "fk"}
    for policy, want in expected.items():
        assert "".join(sorted(r.key for r in keys.next_seen(policy, **tables).collect())) == want


def test_likely_keeps_every_wanted_row(spark):
    rows = spark.range(20_000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"), F.col("id").alias("n"))
    wanted = rows.filter("n % 50 = 0").select("url")
    got = [r.n for r in keys.likely(rows, wanted).collect()]
    assert {n for n in range(0, 20_000, 50)} <= set(got) and len(got) < 420
    assert keys.likely(rows, wanted.limit(0)).count() == 0
    assert "_bits" not in keys.likely(rows, wanted).columns
