import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from jobsluice.plans.collect import collect_listing
from jobsluice.schema import Policy
from jobsluice.sources.sinks import SnapshotStore
from jobsluice.streaming import jobs as J

LISTING = "source string, run_id string, page_no bigint, pos_on_page bigint, url string, title string, posting_date string"
JOBS = "id bigint, url string, title string, posting_date string"


def _parts(seed):
    rnd = random.Random(seed)
    parts, day = [], date(2026, 1, 1)
    for n in range(3):
        rows = []
        for page in range(1, 5):
            for pos in range(rnd.randint(1, 6)):
                posted = (day - timedelta(days=rnd.randint(-1, 12))).isoformat()
                rows.append(("s", f"r{n}", page, pos, f"u{rnd.randint(0, 25)}", f"t{n}-{page}-{pos}", posted))
        parts.append(rows)
        day += timedelta(days=5)
    return parts


def _last_day(df):
    last = df.agg(F.max("posting_date")).first()[0]
    return date.fromisoformat(last) if last else None


def _runs(parts, days, streak):
    """The runs one after another, row by row; returns {url: (id, title)} and the seen keys."""
    jobs, seen = {}, set()
    for rows in parts:
        as_of = max(date.fromisoformat(r[6]) for r in rows)
        recent = lambda text: 0 <= (as_of - date.fromisoformat(text)).days <= days
        known, run, listed, fresh = set(jobs) | seen, 0, set(), []
        for row in rows:
            listed.add(row[4])
            run = run + 1 if row[4] in known else 0
            if streak and run >= streak:
                break
            if row[4] not in known and recent(row[6]):
                fresh.append(row)
        top = max([j[0] for j in jobs.values()] + [0])
        for row in fresh:
            if row[4] not in jobs:
                top += 1
                jobs[row[4]] = (top, row[5], row[6])
            jobs[row[4]] = (jobs[row[4]][0], row[5], row[6])
        seen = known | listed | set(jobs)
        jobs = {u: j for u, j in jobs.items() if recent(j[2])}
    return {u: j[:2] for u, j in jobs.items()}, seen


def test_stream_equals_runs(spark, tmp_path):
    for seed, streak in ((1, 0), (2, 3)):
        parts, base = _parts(seed), tmp_path / str(seed)
        policy = Policy("s", streak="b", days=8)
        store = SnapshotStore(spark, str(base / "store"), JOBS, "s")
        schema = spark.createDataFrame([], LISTING).schema
        for n, rows in enumerate(parts):
            spark.createDataFrame(rows, LISTING).write.parquet(str(base / "in" / f"part-{n}"))
            stream = J.file_stream(spark, str(base / "in"), schema)
            J.run_available(stream, J.ingest(store, policy, _last_day, stop_after_known=streak), str(base / "cp"))
        jobs, seen = _runs(parts, 8, streak)
        assert {r.url: (r.id, r.title) for r in store.jobs().collect()} == jobs
        assert {r.key for r in store.seen().collect()} == seen


def test_replayed_batch_changes_nothing(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"), JOBS, "s")
    on_batch = J.ingest(store, Policy("s", streak="b", days=8), _last_day)
    rows = spark.createDataFrame(_parts(4)[0], LISTING)
    on_batch(rows, 0)
    before = sorted(map(tuple, store.jobs().collect()))
    on_batch(rows, 0)
    on_batch(rows.limit(0), 1)
    assert store.state()[0] == 1 and sorted(map(tuple, store.jobs().collect())) == before and before


def test_late_rows(spark, tmp_path):
    rows = spark.createDataFrame(_parts(5)[0], LISTING)
    J.drop_late(str(tmp_path / "o"), _last_day, 4)(rows, 3)
    got = spark.read.parquet(str(tmp_path / "o" / "batch=3"))
    last = _last_day(rows)
    assert got.count() == sum(0 <= (last - date.fromisoformat(r[6])).days <= 4 for r in _parts(5)[0])


def test_limit_ends_the_listing(spark):
    rows = _parts(6)[0]
    none = spark.createDataFrame([], "id bigint, url string, title string, posting_date string, pos bigint")
    seen = spark.createDataFrame([("u1",), ("u2",)], "key string")
    policy = Policy("s", streak="b", fresh_days=False, output_days=False)
    run = collect_listing(
        spark.createDataFrame(rows, LISTING), none, seen, policy, date(2026, 1, 1), stop_after_known=0, max_jobs=3
    )
    taken, listed = [], set()
    for row in rows:
        listed.add(row[4])
        if row[4] not in ("u1", "u2"):
            taken.append(row)
        if len(taken) == 3:
            break
    assert {r.url for r in run.written.collect()} == {r[4] for r in taken}
    assert {r.key for r in run.seen.collect()} == listed | {"u1", "u2"}


def test_first_seen_forgets(spark, tmp_path):
    landing = str(tmp_path / "in")
    schema = "key string, at timestamp"
    for n, rows in enumerate(
        [[("a", "2026-01-01"), ("a", "2026-01-02"), ("b", "2026-01-01")], [("a", "2026-01-03"), ("c", "2026-03-10")],
         [("d", "2026-03-11"), ("b", "2026-03-12")]]
    ):
        df = spark.createDataFrame(rows, "key string, day string").selectExpr("key", "cast(day as timestamp) as at")
        df.write.parquet(f"{landing}/part-{n}")
        for name, event_time in (("ever", None), ("month", "at")):
            stream = J.file_stream(spark, landing, spark.createDataFrame([], schema).schema)
            out, checkpoint = str(tmp_path / name), str(tmp_path / f"{name}-cp")
            J.first_seen_stream(stream, out, checkpoint, event_time).awaitTermination()

    def keys(name):
        return sorted(r.key for r in spark.read.schema("key string").parquet(str(tmp_path / name)).collect())

    assert keys("ever") == ["a", "b", "c", "d"]
    assert keys("month") == ["a", "b", "b", "c", "d"]


def _streak(rows, known, n, variant):
    """A listing up to its streak, row by row: the kept positions."""
    kept, run, seen = [], 0, set()
    for page, ord_, url in rows:
        kept.append(ord_)
        if variant == "a":
            if url in seen:
                continue
            seen.add(url)
            if page == 1:
                continue
        run = run + 1 if url in known else 0
        if run >= n:
            break
    return kept


def test_streak_over_pieces(spark, tmp_path):
    """A listing that lands in pieces is cut where the whole one is; a replayed piece changes nothing."""
    schema = "source string, run_id string, page_no bigint, ord bigint, url string"
    known = {f"u{k}" for k in range(0, 30, 2)} | {f"u{k}" for k in range(12, 20)}
    keys = spark.createDataFrame([(k,) for k in sorted(known)], "key string")
    for seed, variant, n in ((1, "a", 3), (2, "b", 4), (3, "a", 5), (4, "b", 0)):
        rnd, path = random.Random(seed), str(tmp_path / str(seed))
        lists = {s: [(1 + k // 4, k, f"u{rnd.randrange(30)}") for k in range(40)] for s in ("p", "q", "r")}
        # A streak that starts in one piece and ends in the next.
        lists["r"] = [(2 + k // 4, k, f"u{k + 2}" if k < 8 else f"u{k % 8 + 12}" if k < 16 else "u1") for k in range(40)]
        on_batch = J.cut_streaks(path, keys, n, variant)
        for piece, (a, b) in enumerate(((0, 10), (10, 13), (13, 40))):
            rows = [(s, "r1", *row) for s, listing in lists.items() for row in listing[a:b]]
            for _ in range(2 if piece == 1 else 1):
                on_batch(spark.createDataFrame(rows, schema), piece)
        got = spark.read.schema("source string, ord bigint").parquet(f"{path}/batch=*").collect()
        for source, listing in lists.items():
            want = _streak(listing, known, n, variant) if n else [k for _, k, _ in listing]
            assert sorted(r.ord for r in got if r.source == source) == want, (seed, source)


def test_first_seen_without_stream_state(spark, tmp_path):
    path = str(tmp_path / "keys")
    on_batch = J.first_seen(path, keep_days=10)
    batches = [
        [("a", "2026-01-01"), ("a", "2026-01-02"), ("b", "2026-01-03"), (None, "2026-01-03")],
        [("a", "2026-01-04"), ("c", "2026-01-05"), ("old", "2025-12-01")],
        [("d", "2026-02-01"), ("a", "2026-02-02"), ("c", "2026-01-20")],
        [("a", "2026-02-03"), ("e", None)],
    ]
    for n, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, "key string, day string")
        for _ in range(2 if n == 1 else 1):
            on_batch(frame, n)
    got = spark.read.schema("key string, batch int").parquet(f"{path}/keys")
    assert sorted(map(tuple, got.collect())) == [("a", 0), ("a", 2), ("b", 0), ("c", 1), ("d", 2)]
    runs = J.read_table(spark, f"{path}/runs", J.FIRST_SEEN_RUNS).orderBy("batch")
    assert [(r.n_rows, r.n_late, r.n_new) for r in runs.collect()] == [(4, 0, 2), (3, 1, 1), (3, 1, 2), (2, 1, 0)]
    # What a batch looks at is the window, not all that was ever written.
    assert J.live_batches(spark, path, 3, None) == [0, 1, 2] and J.live_batches(spark, path, 3, date(2026, 1, 23)) == [2]
    plain = J.first_seen(str(tmp_path / "ever"))
    for n, rows in enumerate(batches):
        plain(spark.createDataFrame(rows, "key string, day string"), n)
    ever = spark.read.schema("key string").parquet(str(tmp_path / "ever" / "keys"))
    assert sorted(r.key for r in ever.collect()) == ["a", "b", "c", "d", "e", "old"]
