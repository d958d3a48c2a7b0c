import json

import pytest
from helpers import values
from pyspark.sql import functions as F

from jobsluice.operators import enrich as R
from jobsluice.operators.report import enrich_report, run_report
from jobsluice.plans.label import label_jobs

SCHEMA = "url string, title string, description string, professions string, professions_error string"


def _parse(reply):
    listed = json.loads(reply).get("professions", [])
    out = []
    for value in listed if isinstance(listed, list) else []:
        text = " ".join(value.split()) if isinstance(value, str) else ""
        if text and text.lower() not in [o.lower() for o in out]:
            out.append(text)
    return ", ".join(out[:5])


def test_parse_labels(spark):
    replies = [{"professions": p} for p in (
        ["A", " a ", "B\xa0 c", "", 5, None, ["x"], "D", "É", "é", "E", "F"], "A", [], None, [" "], {"a": 1}, ["x, y"])]
    replies = [json.dumps(r, ensure_ascii=False) for r in [*replies, {}]]
    df = spark.createDataFrame([(r,) for r in replies], "r string")
    for reply, labels in values(df, "r", R.parse_labels(F.col("r"))):
        assert labels == _parse(reply), reply


def test_prompt(spark):
    rows = [("u", " T\n", "<p>a&amp;b</p> c", None, None), ("v", None, "x" * 5000, None, None), ("w", " ", "<p> </p>", None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for chars, length in ((None, 5000), (R.PROMPT_CHARS, 4000)):
        got = [r.prompt for r in R.with_prompt(frame, chars=chars).orderBy("url").collect()]
        assert got == ["Titre: T\nDescription: a&b c", "Titre: \nDescription: " + "x" * length, None]


def test_whole_descriptions_are_read(spark, tmp_path):
    late = "word " * 2_000 + "alpha"
    frame = spark.createDataFrame([("a", "t", late, None, None)], SCHEMA)
    classify = R.keyword_classifier({"alpha": "Late"})
    for chars, labels in ((None, "Late"), (R.PROMPT_CHARS, "")):
        assert values(R.enrich(frame, classify, prompt_chars=chars), "professions") == [(labels,)]
        done = label_jobs(frame, classify, str(tmp_path / str(chars)), rounds=1, prompt_chars=chars)
        assert values(done, "professions") == [(labels,)]


def test_one_bad_prompt_keeps_the_other_replies():
    calls = []

    def classify(prompts):
        calls.append(len(prompts))
        return [TimeoutError("late") if "bad" in p else json.dumps({"professions": [p]}) for p in prompts]

    got = R._ask(classify, ["a", "bad", "c"])
    assert calls == [3]
    assert got == [('{"professions": ["a"]}', None), (None, "TimeoutError: late"), ('{"professions": ["c"]}', None)]


def _classify(prompts):
    """One reply per prompt; some prompts break the whole batch, some replies are bad."""
    if any("boom" in p for p in prompts):
        raise RuntimeError("refused")
    out = []
    for p in prompts:
        word = p.split("\n")[0].removeprefix("Titre: ")
        out.append({"bad": "{", "list": "[1]", "none": None}.get(word, json.dumps({"professions": [word]})))
    return out


ROWS = [
    ("a", "alpha", "", None, None),
    ("b", "boom", "", None, None),
    ("c", "bad", "", "  ", None),
    ("d", "list", "", None, None),
    ("e", "none", "", None, None),
    ("f", "done", "", "Done", "kept"),
    ("g", "retry", "", "", "Old: x"),
    ("h", " ", "<br>", "", None),
    ("i", None, None, None, "Old: y"),
]


def test_enrich(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {r.url: (r.professions, r.professions_error) for r in R.enrich(df, _classify, batch=3, retry_errors=True).collect()}
    assert got["a"] == ("alpha", None)
    assert got["b"] == ("", "RuntimeError: refused")
    assert got["c"][0] == "" and got["c"][1].startswith("JSONDecodeError: ")
    assert got["d"][0] == "" and got["d"][1].startswith("AttributeError: ")
    assert got["e"] == ("", None)
    assert got["f"] == ("Done", "kept")
    assert got["g"] == ("retry", None)
    assert got["h"] == ("", None)
    assert got["i"] == ("", "Old: y")
    plain = {r.url: r.professions for r in R.enrich(df, _classify).collect()}
    assert plain["g"] == "" and plain["i"] is None
    assert values(enrich_report(df, retry_errors=True)) == [(9, 8, 1)]
    assert values(enrich_report(df)) == [(9, 6, 3)]


def test_resume_asks_for_every_key_once(spark, tmp_path):
    # The classifier leaves a line per prompt, so calls can be counted over processes.
    log = tmp_path / "calls"

    def counting(prompts, log=str(log)):
        with open(log, "a") as f:
            f.writelines(p.split("\n")[0] + "\n" for p in prompts)
        return _plain(prompts)

    def _plain(prompts):
        return [json.dumps({"professions": ["x"]}) for _ in prompts]

    df = spark.createDataFrame([(f"u{n}", f"t{n}", None, None, None) for n in range(40)], SCHEMA)
    path = str(tmp_path / "out")
    part = R.enrich_resume(df, counting, path, rounds=4, only=range(2))
    n_part = part.count()
    assert 0 < n_part < 40
    done = R.enrich_resume(df, counting, path, rounds=4)
    assert done.count() == done.select("url").distinct().count() == 40
    assert R.enrich_resume(df, counting, path, rounds=4).count() == 40
    assert len(log.read_text().splitlines()) == 40


class Killed(BaseException):
    """Ends a task; the operator takes no exception of this kind for a refusal."""


def test_killed_run_repeats_one_bucket(spark, tmp_path):
    log, path = tmp_path / "calls", str(tmp_path / "out")

    def asking(bad, log=str(log)):
        def classify(prompts):
            with open(log, "a") as f:
                f.writelines(p.split("\n")[0] + "\n" for p in prompts)
            if any(bad in p for p in prompts):
                raise Killed
            return [json.dumps({"professions": ["x"]}) for _ in prompts]

        return classify

    df = spark.createDataFrame([(f"u{n}", f"t{n}.", None, None, None) for n in range(60)], SCHEMA).repartition(4)
    sizes = [r["count"] for r in df.groupBy(F.pmod(F.xxhash64("url"), F.lit(6)).alias("b")).count().collect()]
    last = df.where(F.pmod(F.xxhash64("url"), F.lit(6)) == 3).first()["title"]
    with pytest.raises(Exception):  # noqa: B017
        R.enrich_resume(df, asking(last), path, bucket_rows=10)
    results = df.select("url", "professions", "professions_error")
    before = R.read_results(results, path).count()
    assert 0 < before < 60
    # What a killed writer leaves behind is in no commit.
    results.limit(5).write.parquet(f"{path}/results/left-over")
    done = R.enrich_resume(df, asking("nothing"), path, bucket_rows=10)
    assert sorted(values(done)) == sorted((f"u{n}", "x", None) for n in range(60))
    assert len(log.read_text().splitlines()) <= 60 + max(sizes)
    assert R.enrich_resume(df, asking(""), path, bucket_rows=10).count() == 60


def test_resume_without_rows(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    assert R.enrich_resume(none, _classify, str(tmp_path / "out")).count() == 0


def test_label_jobs(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    done = label_jobs(df, _classify, str(tmp_path / "w"), rounds=2)
    whole = R.enrich(df, _classify)
    columns = ["url", "professions", "professions_error"]
    assert sorted(values(done, *columns)) == sorted(values(whole, *columns))


def test_run_report(spark):
    from datetime import date

    details = [(True, "2026-01-30"), (True, "2026-01-31"), (True, "2025-01-01"), (True, None), (False, None)]
    details = spark.createDataFrame(details, "ok boolean, posting_date string")
    before = spark.createDataFrame([("a",)], "url string")
    after = spark.createDataFrame([("a",), ("b",)], "url string")
    as_of = date(2026, 1, 31)
    assert values(run_report(details, before, after, as_of, 30)) == [(2, 1, 2, 1)]
    assert values(run_report(details, before, after, as_of, 30, language=False)) == [(2, 1, 2, 0)]
    assert values(run_report(details, before, before, as_of, 0)) == [(4, 1, 0, 4)]


def test_large_bucket_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "TASK_ROWS", 20)
    rows = spark.range(200).selectExpr(
        "cast(id as string) url", "'cook' title", "null description", "cast(null as string) professions",
        "cast(null as string) professions_error",
    )
    results = R.enrich_resume(rows, _classify, str(tmp_path), rounds=2)
    assert results.count() == results.select("url").distinct().count() == 200
    for bucket in (0, 1):
        assert len(list(tmp_path.glob(f"todo/*/bucket={bucket}/*.parquet"))) > 1
    assert all(len(list(folder.glob("*.parquet"))) > 1 for folder in tmp_path.glob("results/*"))
