import itertools
from datetime import date, datetime, timedelta
from email.utils import parsedate_to_datetime

from helpers import values
from pyspark.sql import functions as F

from jobsluice.functions import dates as D
from jobsluice.operators import filters


def _iso(text):
    try:
        return datetime.fromisoformat(text).date()
    except ValueError:
        return None


def test_iso_day(spark):
    days = ["2026-02-18", "20260218", "2026-2-8", "2026-02-30", "2026", "", "0000-01-01", "2026-13-01", "9999-12-31"]
    times = ["", "T23:30:00-05:00", " 10:00", "T24:00", "T10:61", "T10:00:00.123Z", " junk", "T", "T10", "T1000+0100"]
    texts = [d + t for d, t in itertools.product(days, times)] + [" 2026-02-18", "2026-02-18 "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, day in values(df, "t", D.iso_day(F.col("t"))):
        assert day == _iso(t), (t, day, _iso(t))


def test_window(spark):
    as_of = date(2026, 3, 1)
    texts = [(as_of - timedelta(days=n)).isoformat() for n in (-1, 0, 1, 30, 31)] + [None, "junk"]
    df = spark.createDataFrame([(t,) for t in texts], "posting_date string")
    assert [r[0] for r in filters.within_days(df, as_of, 30).collect()] == texts[1:4]
    assert filters.within_days(df, as_of, 0).count() == len(texts)
    assert filters.within_days(df, as_of, None).count() == len(texts)
    assert [r.days_ago for r in filters.with_age(df, as_of).collect()] == [-1, 0, 1, 30, 31, None, None]


def test_french_day(spark):
    days = {
        "12.03.2026": "2026-03-12", "1.2.2026": "2026-02-01", "1/2/2026": "2026-02-01", "2026-2-1": "2026-02-01",
        " 01.01.2026\xa0": "2026-01-01", "29.02.2024": "2024-02-29", "1.2.26": None, "12.03/2026": None,
        "31.02.2026": None, "": None, "x": None, "1.2.2026 x": None, "00.01.2024": None, "01.01.0000": None,
    }
    df = spark.createDataFrame([(t,) for t in days], "t string")
    assert dict(values(df, "t", D.french_day(F.col("t")))) == days


def test_rfc2822_day(spark):
    texts = ["Mon, 02 Mar 2026 23:59:59 -0900", "2 mar 2026 10:00:00 GMT", "Mon, 31 Feb 2026 10:00:00 +0000",
             "Mon, 02 Foo 2026 10:00:00 +0000", "junk", "", "Wed, 1 Apr 2026 10:00 +0100"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, day in values(df, "t", D.rfc2822_day(F.col("t"))):
        try:
            expected = parsedate_to_datetime(t).date().isoformat()
        except Exception:
            expected = None
        assert day == expected, (t, day)


def test_labelled_days(spark):
    cases = [
        ("Publié le 12.03.2026", "2026-03-12", None),
        ("PUBLIÉ LE: mardi 1/2/2026", "2026-02-01", None),
        ("publie le 12.03/2026 puis mise en ligne 13.03.2026", "2026-03-13", None),
        ("date limite 1.2.26, délai de candidature 5.2.2026, avant le 6.2.2026", None, "2026-02-05"),
        ("avant le (texte) 06.02.2026", None, "2026-02-06"),
        ("rien", None, None),
    ]
    df = spark.createDataFrame([(c[0],) for c in cases], "t string")
    got = values(df, "t", D.labelled_day(F.col("t"), D.POSTING_LABELS), D.labelled_day(F.col("t"), D.DEADLINE_LABELS))
    assert got == cases
