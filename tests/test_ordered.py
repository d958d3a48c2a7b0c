import random

import pytest
from pyspark.sql import functions as F

from jobsluice.operators import ordered
from jobsluice.schema import listing_order


def _listing(seed, runs=3, pages=9, urls=12):
    rnd = random.Random(seed)
    rows = []
    for run in range(runs):
        for page in range(1, rnd.randint(2, pages)):
            for pos in range(rnd.randint(0, 6)):
                rows.append(("s", f"r{run}", page, pos, f"u{rnd.randint(0, urls)}"))
    known = {f"u{n}" for n in range(urls + 1) if rnd.random() < 0.7}
    return rows, known


def _frame(spark, rows, known):
    df = spark.createDataFrame(rows, "source string, run_id string, page_no bigint, pos bigint, url string")
    df = df.withColumn("ord", listing_order(F.col("page_no"), F.col("pos")))
    return df.withColumn("known", F.col("url").isin(*known) if known else F.lit(False))


def _walk(rows, known, n, variant):
    """The listing row by row."""
    out, streak, seen, done = [], {}, {}, set()
    for row in rows:
        run, page, url = row[1], row[2], row[4]
        if run in done:
            continue
        out.append(row)
        repeat = url in seen.setdefault(run, set())
        seen[run].add(url)
        if n <= 0 or (variant == "a" and (page == 1 or repeat)):
            continue
        streak[run] = streak.get(run, 0) + 1 if url in known else 0
        if streak[run] >= n:
            done.add(run)
    return out


@pytest.mark.parametrize("variant", ["a", "b"])
def test_streak(spark, variant):
    for seed in range(3):
        rows, known = _listing(seed)
        df = _frame(spark, rows, known)
        for n in (0, 1, 3):
            cut = ordered.cut_after_streak(df, n, variant)
            got = sorted(tuple(r) for r in cut.select("source", "run_id", "page_no", "pos", "url").collect())
            assert got == sorted(_walk(rows, known, n, variant)), (seed, n)


def test_blocks_equal_plain_windows(spark):
    rnd = random.Random(5)
    rows = [(g, o, rnd.random() < 0.2) for g in "ab" for o in sorted(rnd.sample(range(3000), 400))]
    df = spark.createDataFrame(rows, "g string, ord bigint, m boolean")
    plain, rn, mark = [], {}, {}
    for g, o, m in rows:
        rn[g] = rn.get(g, 0) + 1
        mark[g] = rn[g] if m else mark.get(g, 0)
        plain.append((g, o, m, rn[g], mark[g]))
    # Small shifts give all three levels many blocks.
    for shifts in ((3, 2), (6, 3), (20, 14)):
        blocks = ordered.running_count(df, F.col("m"), ["g"], shifts=shifts)
        assert sorted(map(tuple, blocks.collect())) == sorted(plain)
        weighted = ordered.running_count(df, groups=["g"], shifts=shifts, weight=F.col("ord") % 3)
        total = {}
        for row in weighted.orderBy("g", "ord").collect():
            total[row.g] = total.get(row.g, 0) + row.ord % 3
            assert row.rn == total[row.g]


def test_first_seen_and_dedup(spark):
    rows, _ = _listing(7)
    df = _frame(spark, rows, set())
    first = {}
    for row in rows:
        first.setdefault((row[1], row[4]), row)
    got = ordered.first_seen(df, ("run_id", "url")).select("source", "run_id", "page_no", "pos", "url")
    assert sorted(map(tuple, got.collect())) == sorted(first.values())
    last = {r.url: r.ord for r in ordered.batch_dedup(df.filter("run_id = 'r0'"), "url", "last").collect()}
    assert last == {r[4]: (r[2] << 20) + r[3] for r in rows if r[1] == "r0"}


def test_limits(spark):
    rows, known = _listing(9)
    df = _frame(spark, rows, known)
    for n in (0, 1, 4, 1000):
        new, prefix, taken = [], [], {}
        for row in rows:
            full = n > 0 and taken.get(row[1], 0) >= n
            if not full:
                prefix.append(row)
            if row[4] not in known:
                if not full:
                    new.append(row)
                taken[row[1]] = taken.get(row[1], 0) + 1
        columns = ["source", "run_id", "page_no", "pos", "url"]
        got = ordered.limit_new(df.filter("NOT known"), n).select(columns)
        assert sorted(map(tuple, got.collect())) == sorted(new)
        got = ordered.limit_prefix(df, ~F.col("known"), n).select(columns)
        assert sorted(map(tuple, got.collect())) == sorted(prefix)


def _last_page(pages, rule, max_pages, size):
    """Walk the pages of one listing; returns the last page that was kept."""
    total, seen, last = None, 0, 0
    for page_no, status, n_rows, n_new, reported in pages:
        if rule == "total" and page_no == 1:
            total = reported
        cap = max_pages or 10**9
        if rule == "total" and total is not None:
            cap = min(total, max_pages) if max_pages else total
        if page_no > max(cap, 1):
            break
        if page_no > 1 and status >= 400:
            break
        if page_no > 1 and n_rows == 0 and not (rule == "total" and total is not None):
            break
        last, seen = page_no, seen + n_new
        if rule != "total" and total is None:
            total = reported
        if rule == "no_new" and page_no > 1 and n_new == 0:
            break
        if rule == "short" and (n_rows < size or (total is not None and page_no * size >= total)):
            break
        if rule == "distinct" and total is not None and seen >= total:
            break
    return last


def test_page_rules(spark):
    rnd = random.Random(3)
    schema = "source string, run_id string, page_no bigint, status int, n_rows bigint, n_new bigint, total bigint"
    cases, rows = {}, []
    for run in range(40):
        pages = []
        for page in range(1, rnd.randint(2, 70)):
            n = rnd.choice([10] * 30 + [4, 0]) if page > 1 else 10
            new = rnd.randint(0 if rnd.random() < 0.05 else 1, n) if n else 0
            reported = rnd.choice([None, 3, 12, 90, 400])
            pages.append((page, rnd.choice([200] * 60 + [429]) if page > 1 else 200, n, new, reported))
        cases[f"r{run}"] = pages
        rows += [("s", f"r{run}", *p) for p in pages]
    df = spark.createDataFrame(rows, schema)
    for rule in ("total", "empty", "no_new", "short", "distinct"):
        for max_pages in (0, 5):
            got = {r.run_id: r.last_page for r in ordered.last_page(df, rule, max_pages, 10).collect()}
            for run, pages in cases.items():
                assert got[run] == _last_page(pages, rule, max_pages, 10), (rule, max_pages, run, pages)


def test_newest_first(spark):
    df = spark.createDataFrame([(None, 0), (3, 1), (None, 2), (7, 3), (0, 4), (-1, 5)], "id bigint, pos bigint")
    assert [r.pos for r in ordered.newest_first(df, "pos").collect()] == [3, 1, 0, 2, 4, 5]
