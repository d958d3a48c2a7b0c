import csv
import io
import json
from pathlib import Path

from jobsluice.schema import CSV_LAYOUTS, to_job_schema
from jobsluice.sources import sinks as S

ROWS = [(1, 'say "hi", é', None, True, "a\nb", ["fr"]), (2, "", "x;y", False, None, None)]
SCHEMA = "id bigint, title string, company string, rav_exclusive boolean, description string, language_codes array<string>"


def _text(path, pattern):
    return [p.read_text(encoding="utf-8") for p in sorted(Path(path).glob(pattern))]


def test_json(spark, tmp_path):
    path = str(tmp_path / "j")
    S.write_json(spark.createDataFrame(ROWS, SCHEMA), path)
    lines = [json.loads(line) for text in _text(path, "*.json") for line in text.splitlines()]
    names = ["id", "title", "company", "rav_exclusive", "description", "language_codes"]
    assert sorted(lines, key=lambda r: r["id"]) == [dict(zip(names, r)) for r in ROWS]
    assert any("é" in text for text in _text(path, "*.json"))


def test_csv(spark, tmp_path):
    path = str(tmp_path / "c")
    S.write_csv(spark.createDataFrame(ROWS, SCHEMA).coalesce(1), path, "jobroom")
    records = list(csv.DictReader(io.StringIO("".join(_text(path, "*.txt")))))
    assert list(records[0]) == CSV_LAYOUTS["jobroom"]
    got = [(r["id"], r["title"], r["company"], r["rav_exclusive"], r["description"], r["canton"]) for r in records]
    assert got == [("1", 'say "hi", é', "", "True", "a\nb", ""), ("2", "", "x;y", "False", "", "")]
    assert 'say ""hi""' in "".join(_text(path, "*.txt"))


def test_csv_line_ends(spark, tmp_path):
    rows = spark.createDataFrame([("a\nb", "c,d"), (None, 'x"y')], "title string, company string")
    S.write_csv(rows.coalesce(1), str(tmp_path / "c"), ["title", "company"])
    assert [p.read_bytes() for p in (tmp_path / "c").glob("*.txt")] == [
        b'title,company\r\n"a\nb","c,d"\r\n,"x""y"\r\n'
    ]
    S.write_csv(rows.limit(0), str(tmp_path / "e"), ["title", "company"])
    assert b"".join(p.read_bytes() for p in (tmp_path / "e").glob("*.txt")) == b"title,company\r\n"


def test_unified_schema(spark):
    df = spark.createDataFrame([("u", 5, "more")], "url string, id int, other string")
    unified = to_job_schema(df)
    assert len(unified.columns) == 28 and dict(unified.dtypes)["id"] == "bigint"
    assert unified.first()["url"] == "u"


def test_store(spark, tmp_path):
    store = S.SnapshotStore(spark, str(tmp_path / "s"), "id bigint, url string", "ge")
    assert store.state("r1") == (0, False) and store.jobs().count() == 0 and store.seen().count() == 0

    def frame(*urls):
        return spark.createDataFrame([(n, u) for n, u in enumerate(urls)], "id bigint, url string")

    seen = spark.createDataFrame([("b",), ("a",), ("b",)], "key string")
    store.commit(frame("a"), seen, "r1", "2026-01-01T00:00:00", {"days": "30"})
    store.commit(frame("x", "y"), seen, "r1", "2026-01-01T00:00:00")
    assert store.state("r1") == (1, True) and store.jobs().count() == 1
    assert sorted(r.key for r in store.seen().collect()) == ["a", "b"]
    # The next version is built from the table it replaces.
    store.commit(store.jobs().union(frame("z")), store.seen(), "r2", "2026-01-02T00:00:00")
    assert store.state("r2") == (2, True) and store.jobs().count() == 2
    assert [r.params["days"] for r in store.runs().filter("run_id = 'r1'").collect()] == ["30"]
    assert {r.source for r in store.runs().collect()} == {"ge"}


def test_store_writes_what_changes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "COMPACT_AFTER", 3)
    path = tmp_path / "s"
    store = S.SnapshotStore(spark, str(path), "id bigint, url string", "ge", buckets=8)

    def folders(table, version):
        return len(list(path.glob(f"{table}/v={version}/bucket=*")))

    def frame(rows):
        return spark.createDataFrame(sorted(rows.items()), "url string, id bigint").select("id", "url")

    def key_frame(keys):
        return spark.createDataFrame([(k,) for k in sorted(keys)], "key string")

    jobs, keys = {f"u{k}": k for k in range(200)}, {f"k{k}" for k in range(200)}
    steps = [
        lambda: None,
        lambda: (jobs.update(u5=500), keys.add("new")),
        lambda: keys.add("another"),
        lambda: (jobs.pop("u9"), keys.discard("k7")),
        lambda: (jobs.clear(), keys.clear()),
        lambda: (jobs.update(z=1), keys.add("k7")),
    ]
    written = []
    for n, step in enumerate(steps, 1):
        step()
        store.commit(frame(jobs) if jobs else store.jobs().limit(0), key_frame(keys) if keys else store.seen().limit(0), f"r{n}", "2026-01-01T00:00:00")
        assert {r.url: r.id for r in store.jobs().collect()} == jobs
        got = [r.key for r in store.seen().collect()]
        assert sorted(got) == sorted(keys)
        written.append((folders("jobs", n), folders("seen", n)))
    assert written == [(8, 8), (1, 1), (0, 1), (1, 1), (0, 0), (1, 1)]
    # Older versions stay readable until they are cleared away.
    assert {r.id for r in store.jobs(2).where("url = 'u5'").collect()} == {500} and store.jobs(3).count() == 200
    assert store.vacuum(keep=1) > 0 and store.jobs().count() == 1 and folders("jobs", 1) == 0
    assert store.vacuum(keep=1) == 0


def test_parts_of_a_bucket_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "COMPACT_AFTER", 2)
    store = S.SnapshotStore(spark, str(tmp_path), "id bigint, url string", "ge", buckets=1)
    none = spark.createDataFrame([], "id bigint, url string")
    for n in range(4):
        store.commit(none, spark.createDataFrame([(f"k{k}",) for k in range(n + 1)], "key string"), f"r{n}", "d")
    assert [store.parts(v)["seen/0"][0] for v in (1, 2, 3, 4)] == [[1], [1, 2], [3], [3, 4]]
    assert sorted(r.key for r in store.seen().collect()) == ["k0", "k1", "k2", "k3"]
