import re

import pyarrow as pa
from helpers import values
from pyspark.sql import functions as F

from jobsluice.functions import text as T
from jobsluice.operators import filters

BLANKS = ["", " ", "\xa0", "\x1c\x1f", "\x85 　", "\t\n\x0b\x0c\r"]
TEXTS = [
    *BLANKS, None, "a", "\xa0a ", "a\x1cb", "a \x85 b", "caf&eacute; &amp;amp; th&#233;", "&nbsp;x&nbsp;", "&copy 2024",
    "&amp;lt;b&gt;", "a & b &c; &am", "&#x1F600;" * 3, "&laquo;x&raquo;", "😀😀😀😀😀", "x" * 30, "12345 789 x", "&", "&;", "&#;",
]


def test_strip_and_collapse(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = values(df, "t", T.strip(F.col("t")), T.collapse(F.col("t")))
    for t, stripped, collapsed in got:
        if t is None:
            assert stripped is None and collapsed is None
        else:
            assert stripped == t.strip()
            assert collapsed == re.sub(r"\s+", " ", t).strip()


def test_trim_set_is_what_counts_as_whitespace():
    assert set(T.WS_CHARS) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_clean_text(spark):
    cut = {
        "": None, " ": None, "\t\n": None, None: None, "a": "a", "\xa0a ": "a", "a\x1cb": "a b", "a \x85 b": "a b",
        "caf&eacute; &amp;amp; th&#233;": "café &", "&nbsp;x&nbsp;": "x", "&copy 2024": "© 2024", "&amp;lt;b&gt;": "&lt;b>",
        "a & b &c; &am": "a & b ", "&#x1F600;&#x1F600;": "😀😀", "&laquo;x&raquo;": "«x»", "😀😀😀😀😀": "😀😀😀😀😀",
        "x" * 30: "xxxxxx", "12345 789 x": "12345 ", "&": "&", "&;": "&;", "&#;": "&#;",
    }
    df = spark.createDataFrame([(t, t) for t in cut], "t string, c string")
    assert dict(values(T.with_clean_text(df, {"c": 6}), "t", "c")) == cut


def test_language_filters(spark):
    rows = [
        (1, "Responsable équipe", "mission pour vous"),
        (2, "Team job", "you work here"),
        (3, "Stelle für Arbeit", "mit sie erfahrung team job"),
        (4, None, None),
        (5, "expérience", "équipe compétences"),
        (6, "experience", "team experience profil"),
        (7, "lavoro per", "squadra con esperienza avec pour poste vous nous"),
    ]
    df = spark.createDataFrame(rows, "n int, title string, description string")

    assert {r.n for r in filters.french_or_english(df).collect()} == {1, 2, 5, 6, 7}
    tagged = df.withColumn("language_codes", F.when(F.col("n") == 4, F.array(F.lit("de"), F.lit("FR"))))
    assert {r.n for r in filters.french(tagged).collect()} == {1, 4, 6, 7}


def test_pending(spark):
    rows = [(1, None, None), (2, " ", None), (3, "a", None), (4, "", "E: x"), (5, "a", "E: x"), (6, "[]", None)]
    df = spark.createDataFrame(rows, "n int, professions string, professions_error string")

    def pick(**flags):
        return {r.n for r in filters.pending_rows(df, **flags).collect()}

    assert pick() == {1, 2}
    assert pick(retry_errors=True) == {1, 2, 4}
    assert pick(strip_blanks=False) == {1}
    assert pick(force_all=True) == {1, 2, 3, 4, 5, 6}


def test_texts_of_a_row_share_a_python_worker(spark):
    df = spark.createDataFrame([("a &Aacute;", "&Ouml; b", None)], "a string, b string, c string")
    cleaned = T.with_clean_text(df, {"a": None, "b": None, "c": None})
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert tuple(cleaned.first()) == ("a Á", "Ö b", None)


def test_python_steps_hold_pieces_of_bounded_size(monkeypatch):
    monkeypatch.setattr(T, "PIECE_BYTES", 100)
    sizes, whole = [], pa.Array.to_pylist
    values = pa.array([None, *["x" * 40] * 30, "y" * 500])

    class Pieces:
        def __init__(self, part):
            self.part, self.null_count, self.nbytes = part, part.null_count, part.nbytes

        def __len__(self):
            return len(self.part)

        def slice(self, at, n):
            piece = self.part.slice(at, n)
            sizes.append(len(piece))
            return piece

    assert whole(T.mapped(Pieces(values), lambda v: v and v.upper(), pa.string())) == [v and v.upper() for v in whole(values)]
    assert max(sizes) <= 3 and sum(sizes) == len(values)
    assert T.mapped(pa.nulls(3, pa.string()), len, pa.int32()).null_count == 3
    assert len(T.mapped(pa.array([], pa.string()), len, pa.int32())) == 0
