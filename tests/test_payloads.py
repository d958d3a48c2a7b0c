import json
from datetime import date

from helpers import values
from pyspark.sql import functions as F

from jobsluice.functions import variant as V
from jobsluice.operators import normalize as N
from jobsluice.operators.report import snapshot_header
from jobsluice.queries.registry import spread
from jobsluice.sources.feed import FEED_LIMITS, rss_items
from jobsluice.sources.files import read_documents, read_job_array, read_job_lines, read_seen_state, snapshot_read
from jobsluice.sources.payloads import ENVELOPES, payload_pages, unpack_envelope


def _files(tmp_path, files):
    for name, text in files.items():
        (tmp_path / name).write_text(text if isinstance(text, str) else json.dumps(text), encoding="utf-8")
    return str(tmp_path)


def _items(spark, items):
    rows = [(n, json.dumps(item)) for n, item in enumerate(items)]
    return spark.createDataFrame(rows, "n int, t string").select("n", F.try_parse_json("t").alias("item"))


def test_truthy_text(spark):
    samples = ["x", " ", "", "0", "false", 0, 0.0, 5, 5.5, True, False, None, [], {}, [1], {"a": 1}]
    rows = _items(spark, [{"v": s} for s in samples] + [{}])
    got = [r[0] for r in rows.orderBy("n").select(V.truthy_text(F.col("item"), "$.v")).collect()]
    want = ["x", " ", None, "0", "false", None, None, "5", "5.5", "True", None, None, None, None, "[1]", '{"a":1}', None]
    assert got == want
    staged = V.with_truthy_texts(rows, "item", {"a": ("$.v",), "b": ("$.none", "$.v")}).orderBy("n")
    assert values(staged, "a", "b") == [(w, w) for w in want]


def test_job_arrays(spark, tmp_path):
    path = _files(tmp_path, {
        "good.json": [{"id": 1, "url": "a", "rav_exclusive": True, "language_codes": ["fr"]}, "x", None, 5, [1]],
        "types.json": [{"id": "5", "salary_min": "9"}, {"id": 5.0, "salary_min": 9.5}, {"id": None}],
        "object.json": {"jobs": [{"id": 9}]},
        "broken.json": '[{"id": 9}',
        "trailing.json": '[{"id": 9}] x',
        "bracket.json": '[{"id": 9}] x]',
        "two.json": '[{"id": 9}] [2]',
        "pair.json": '[{"id": 9}], [2]',
        "empty.json": "",
        "repeat.json": '[{"id": 1, "id": 2}]\n\n',
    })
    docs = read_documents(spark, path)
    rows = read_job_array(docs).collect()
    by_file = {}
    for r in sorted(rows, key=lambda r: (r.path, r.pos)):
        by_file.setdefault(r.path.rsplit("/", 1)[1], []).append((r.id, r.url, r.salary_min, r.rav_exclusive))
    assert by_file == {
        "good.json": [(1, "a", None, True)],
        "types.json": [(None, None, None, None), (None, None, 9.5, None), (None, None, None, None)],
        "repeat.json": [(2, None, None, None)],
    }
    assert read_job_array(docs, objects_only=False).count() == 9
    assert read_job_array(read_documents(spark, str(tmp_path / "missing"))).count() == 0


def test_seen_states(spark, tmp_path):
    path = _files(tmp_path, {
        "a.json": {"seen_urls": [" u1 ", "", "  ", "u2", None, 5], "days": 30},
        "b.json": {"seen_urls": "u3"},
        "c.json": ["u4"],
        "d.json": '{"seen_urls": ["u5"]',
        "f.json": '{"seen_urls": ["u6"]} y}',
        "g.json": '{"seen_urls": ["u7"]} {"seen_urls": ["u8"]}',
        "e.json": {"seen_keys": [" k1 ", ""]},
    })
    docs = read_documents(spark, path)
    assert sorted(r.key for r in read_seen_state(docs).collect()) == ["5", "u1", "u2"]
    assert sorted(r.key for r in read_seen_state(docs, "seen_keys", trim=False).collect()) == ["", " k1 "]


def test_snapshot(spark):
    body = {"source": "s", "canton": "GE", "scraped_at": "t", "total": 2, "rav_exclusive_count": 1, "jobs": [
        {"id": "x-1", "title": "A", "canton": "GE", "source": "s", "date_published": "2026-01-01", "rav_exclusive": True},
        {"id": "x-2", "title": "B", "canton": "GE", "source": "s", "posting_date": "2026-01-02", "rav_exclusive": False}, 7]}
    docs = spark.createDataFrame([("p", json.dumps(body)), ("q", "[]")], "path string, text string")
    rows = snapshot_read(docs)
    got = sorted(values(rows, "external_id", "id", "posting_date", "file_total", "pos"))
    assert got == [("x-1", None, "2026-01-01", 2, 0), ("x-2", None, "2026-01-02", 2, 1)]
    assert values(snapshot_header(rows)) == [("s", "GE", 2, 1)]


def test_envelopes(spark):
    item = {"a": 1}
    payloads = [
        {"content": [item], "jobs": [item, item], "totalElements": 7},
        {"content": 5, "results": [item, "x", None, [item]], "totalElements": "7", "total": 8},
        {"jobs": None, "data": {}, "result": [item], "count": 3.0},
        [item, item, 4],
        {"results": [item], "count": 3},
        "text",
        {"content": [], "jobs": [item]},
    ]
    df = spark.createDataFrame([(n, json.dumps(p)) for n, p in enumerate(payloads)], "n int, payload string")
    want = {
        "jobroom": [(0, 7, 0), (1, 8, 0), (3, None, 0), (3, None, 1), (4, None, 0)],
        "adzuna": [(1, None, 0), (4, 3, 0)],
        "rapidapi": [(0, None, 0), (0, None, 1), (1, None, 0), (2, None, 0), (3, None, 0), (3, None, 1), (4, None, 0), (6, None, 0)],
    }
    for api, rows in want.items():
        assert sorted(values(unpack_envelope(df, ENVELOPES[api]), "n", "total", "pos"), key=repr) == sorted(rows, key=repr)


def _ad(**content):
    return {"id": "7", "jobContent": content}


def test_jobroom(spark):
    versions = [{"languageIsoCode": "de", "title": "D", "description": "dd"}, "x",
                {"languageIsoCode": "FR", "title": " ", "description": None}, {"languageIsoCode": "fr", "title": "late"},
                {"title": "none"}]
    items = [
        {"jobAdvertisement": _ad(jobDescriptions=versions, location={"city": " ", "communalName": "X"},
                                 employment={"workloadPercentageMin": 49.9, "workloadPercentageMax": 80, "permanent": True})},
        _ad(employment={"workloadPercentageMin": "50", "workloadPercentageMax": 80, "permanent": "true"}, externalUrl=" e "),
        {"jobAdvertisement": 5},
        {"jobAdvertisement": {"stellennummerEgov": " 8 ", "publication": {"startDate": "", "endDate": "2026-02-01T00"},
                              "createdTime": " 2026-01-05T10:00", "reportingObligation": 1, "jobContent": "x"}},
        {"publication": {"startDate": "junk"}, "jobContent": {"jobDescriptions": [{"description": "x" * 2499 + " y"}]}},
    ]
    rows = {r.n: r for r in N.normalize_jobroom(_items(spark, items), date(2026, 1, 31)).collect()}
    a, b, c, d, e = (rows[n] for n in range(5))
    # The first French version is blank, so the fallback finds the German one.
    assert (a.title, a.description, a.language_codes) == ("D", "dd", ["", "de", "fr"])
    assert (a.location, a.workload, a.contract_type, a.url) == ("N/A", "49-80%", "permanent", N.DETAIL_URL + "7")
    assert (b.workload, b.contract_type, b.url, b.external_id) == ("80%", "", "e", "7")
    assert (c.title, c.company, c.url, c.external_id, c.posting_date, c.rav_exclusive) == ("N/A", "N/A", "", "", None, False)
    assert (d.external_id, d.posting_date, d.expiry_date, d.days_ago, d.rav_exclusive) == ("8", "2026-01-05", "2026-02-01", 26, True)
    assert (e.posting_date, e.days_ago) == ("junk", None)
    assert e.description == "x" * 2499 + " y"
    cut = N.normalize_jobroom(_items(spark, items), date(2026, 1, 31), description_chars=N.DESCRIPTION_LIMIT)
    assert {r.n: r.description for r in cut.collect()}[e.n] == "x" * 2499


def test_preferred_language_stops_at_its_first_version(spark):
    versions = [{"languageIsoCode": "it", "title": "I", "description": "ii"},
                {"languageIsoCode": "en", "title": "E", "description": ""}, {"languageIsoCode": "en", "description": "late"}]
    rows = N.normalize_jobroom(_items(spark, [_ad(jobDescriptions=versions)]), date(2026, 1, 1), "en").first()
    assert (rows.title, rows.description) == ("E", "ii")


def test_adzuna(spark):
    items = [
        {"id": 9, "title": " A ", "company": {"display_name": "C"}, "location": "L", "created": "2026-01-01T00:00:00Z",
         "redirect_url": " ", "adref": " r ", "description": " " + "d" * 2600, "salary_min": 10, "salary_max": 10.5},
        {"title": "", "company": [], "created": None, "redirect_url": "u", "salary_min": "10"},
    ]
    a, b = sorted(N.normalize_adzuna(_items(spark, items)).collect(), key=lambda r: r.n)
    assert (a.title, a.company, a.location, a.posting_date, a.url, a.external_id) == ("A", "C", "N/A", "2026-01-01", "r", "9")
    assert (a.description, a.salary_min, a.salary_max) == ("d" * 2600, 10.0, 10.5)
    cut = N.normalize_adzuna(_items(spark, items), N.DESCRIPTION_LIMIT)
    assert {r.description for r in cut.collect()} == {"d" * 2500, None}
    assert (b.title, b.company, b.posting_date, b.url, b.description, b.salary_min) == ("N/A", "N/A", None, "u", None, None)


def test_aliases(spark):
    items = [{"job_title": "", "title": " t", "company": [], "company_name": "C", "job_salary": 0, "salary": False},
             {"job_apply_link": "a", "job_url": "b", "site": "s", "salary": 50}]
    a, b = sorted(N.normalize_alias(_items(spark, items)).collect(), key=lambda r: r.n)
    assert (a.title, a.company, a.location, a.salary, a.url, a.source) == (" t", "C", "N/A", "", "", "indeed_rapidapi")
    assert (b.title, b.salary, b.url, b.source, b.posting_date, b.description) == ("N/A", "50", "a", "s", None, None)


def test_feed(spark):
    feed = """<?xml version="1.0"?><rss><channel><title>c</title>
      <item><title>A &amp;amp; B</title><link> l1 </link><pubDate>Mon, 02 Mar 2026 23:30:00 -0500</pubDate>
        <description><![CDATA[<p>x <b>y</b></p>]]></description></item>
      <item><link>l2</link><pubDate>junk</pubDate></item><item><title>no link</title><link> </link></item>
      <item><title>late</title><link>l1</link><description>&lt;i&gt;z&lt;/i&gt;</description></item></channel></rss>"""
    docs = spark.createDataFrame([("f", feed)], "path string, text string")
    assert sorted(values(rss_items(docs))) == [("l1", "late", None, "z"), ("l2", None, None, None)]
    one = spark.createDataFrame([("f", feed.replace("<link>l1<", "<link>l3<"))], "path string, text string")
    assert ("l1", "A & B", "2026-03-02", "x y") in values(rss_items(one))
    long = spark.createDataFrame([("f", feed.replace("<b>y</b>", "y" * 2_000).replace("<link>l1<", "<link>l3<"))], "path string, text string")
    for limits, size in ((None, 2_002), (FEED_LIMITS, 1_200)):
        assert max(len(r.summary or "") for r in rss_items(long, limits).collect()) == size


def test_strict_json(spark):
    texts = ['{"a": 1}', ' {"a": 1}\n', '{"a": 1} x', '{"a": 1}, 2', '{"a": 1}]', '{"a": 1', "", None, "5"]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, t string").orderBy("n")
    got = [r[0] for r in rows.select(F.to_json(V.strict_json(F.col("t")))).collect()]
    assert got == ['{"a":1}', '{"a":1}', None, None, None, None, None, None, "5"]


def test_payload_pages(spark):
    texts = ['{"results": [{"a": 1}, 5, {}], "count": 70}', '{"results": []}', "[{}]", '{"results": [{}]} x', None]
    rows = spark.createDataFrame(list(enumerate(texts, 1)), "page_no int, payload string")
    pages = payload_pages(rows, ENVELOPES["adzuna"]).orderBy("page_no")
    assert values(pages, "page_no", "n_rows", "total") == [(1, 2, 70), (2, 0, None), (3, 0, None), (4, 0, None), (5, 0, None)]
    assert unpack_envelope(rows, ENVELOPES["adzuna"]).count() == 2


def test_json_lines(spark, tmp_path):
    (tmp_path / "part-0.json").write_text('{"id":1,"title":"é"}\n{"id":2} x\n[]\n\n{"id":"3"}\n', encoding="utf-8")
    rows = read_job_lines(spark, str(tmp_path))
    assert sorted(values(rows, "id", "title"), key=repr) == [(1, "é"), (None, None)]
    assert read_job_lines(spark, str(tmp_path / "missing")).count() == 0


def test_rows_of_one_row_group_are_dealt_to_several_tasks(spark):
    rows = spark.range(0, 95, 1, 1)
    dealt = spread(rows, "id", 10)
    assert dealt.rdd.getNumPartitions() == 10
    assert sorted(r["id"] for r in dealt.collect()) == list(range(95))
    assert spread(rows, "id", 95).rdd.getNumPartitions() == 1
