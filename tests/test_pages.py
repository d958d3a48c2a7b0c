import json
from html.parser import HTMLParser

from helpers import values
from pyspark.sql import functions as F

from jobsluice.functions import html as H
from jobsluice.functions.urls import SITE_RULES, SiteRule
from jobsluice.operators import extract
from jobsluice.operators.assemble import assemble_ge

PAGES = [
    "<p>plain</p>", "a<b>b</b>c", "x < y & z &amp;lt;", "<!-- c --><p>a<!-- b -->b</p>", "<script>var a='</p>';</script>t",
    "<style>p{}</style><p title='a>b'>q</p>", "<p>one<p>two</p>three</div>four", "<ul><li>a<ul><li>b</li></ul><li>c</ul>d",
    "<main><p>m</main>after", "<P CLASS=x>upper</P><br/>end", "", "<p>unclosed <b>bold", "</p>stray<p>a</p></p>", "a&nbsp;b\n c\t",
    "<p title=it's>hello it's</p>x", '<p data-x="a>b" y>q</p>', "<li 'odd>t</li>", "<p a = 'x>y' b=c>r</p>", "a<!doctype x>b",
    "<p/>x<p>y", "<SCRIPT>x</SCRIPT >y", "<a href=x>l</a><img src='a'>i",
]


class Tree(HTMLParser):
    """Text and elements the slow way: an end tag closes up to its start tag."""

    VOID = H.VOID_TAGS

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.nodes, self.open, self.found = [], [], []
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        entry = (tag, [])
        self.found.append(entry)
        if tag not in self.VOID:
            self.open.append(entry)

    def handle_startendtag(self, tag, attrs):
        self.found.append((tag, []))

    def handle_endtag(self, tag):
        if any(t == tag for t, _ in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if any(t in ("script", "style") for t, _ in self.open) or not data.strip():
            return
        for _, texts in self.open:
            texts.append(data.strip())
        self.nodes.append(data.strip())

    def text(self):
        return " ".join(" ".join(self.nodes).split())

    def texts(self, tag):
        return [" ".join(" ".join(t).split()) for name, t in self.found if name == tag]


def test_text(spark):
    df = spark.createDataFrame([(p,) for p in [*PAGES, None]], "html string")
    for page, text in values(H.with_text(df, F.col("html"), "t"), "html", "t"):
        assert text == Tree(page or "").text(), (page, text)


def test_elements(spark):
    df = spark.createDataFrame([(p,) for p in PAGES], "html string")
    df = df.withColumn("found", H.elements(F.col("html"), "p", "li"))
    for tag in ("p", "li"):
        rows = H.with_texts(df, F.col("found")[tag], "texts")
        for page, n, texts in values(rows, "html", F.size(F.col("found")[tag]), "texts"):
            expected = Tree(page).texts(tag)
            assert n == len(expected), (page, n)
            assert [" ".join(t.split()) for t in texts][: len(expected)] == expected or not expected, (page, texts)


def test_outermost(spark):
    df = spark.createDataFrame([("<p>a<p>b</p>c</div><div><p>d</p>",)], "html string")
    got = df.select(H.elements(F.col("html"), "p", outermost=True)["p"].alias("p")).first()["p"]
    assert len(got) == 1 and got[0].startswith("<p>a<p>b")


def test_links(spark):
    page = """<!-- <a href="/hidden">x</a> --><script>'<a href="/js">'</script><a name=x>no</a><a data-href="/no">x</a>
      <A class="c" HREF = '/one?a=1&amp;b=2#f'>1</A><a href=" /two ">2</a><a href="">3</a><a href=/three>4</a>
      <a title="x href='/fake'" href="/four">5</a><area href="/area"><a href="&#47;five">6</a>"""
    df = spark.createDataFrame([(1, page)], "page_id int, html string")
    links = extract.page_links(df, "https://e.example.com")
    urls = [r.url for r in links.orderBy("pos").collect()]
    assert urls == [f"https://e.example.com{p}" for p in ("/one?a=1&b=2", "/two", "/three", "/four", "/five")]


def test_links_first_occurrence(spark):
    pages = [(2, '<a href="/b">x</a><a href="/a">x</a>'), (1, '<a href="/a#1">x</a><a href="/a#2">x</a><a href="/X">x</a>')]
    df = spark.createDataFrame(pages, "page_id int, html string")
    rule = SiteRule("t", "https://e.example.com", "example.com", "/[a-z]")
    got = sorted(values(extract.extract_links(df, rule), "url", "page_id", "pos"))
    assert got == [("https://e.example.com/a", 1, 0), ("https://e.example.com/b", 2, 0)]


def test_cards(spark):
    at = "/offres-emploi-etat-geneve/liste-offres/"
    page = f"""<ul><li>Menu <a href="/x">x</a></li>
      <li><a href="/organisation/a">Dép. A &amp; B</a> <a href="{at}1">Titre  1</a> Taux d'activité: 80%
        <ul><li><a href="{at}1">again</a></li><li><a href="{at}2">Titre 2</a> Rémunération à convenir | x</li></ul></li>
      <li><a href="{at}3">T3</a> Taux d’activite 50 - 100% Classe 12 <li><a href="{at}4?x=1">bad</a></ul>"""
    df = spark.createDataFrame([(1, page)], "page_id int, html string")
    rows = extract.listing_cards(df, SITE_RULES["ge"]).orderBy("pos").collect()
    got = [(r.url.rsplit("/", 1)[1], r.title, r.departement, r.taux, r.remuneration) for r in rows]
    # The outer item is the card of its first matching link; its text holds the inner items.
    assert got == [
        ("1", "Dép. A & B", "Dép. A & B", None, "à convenir"),
        ("2", "Titre 2", None, None, "à convenir"),
        ("3", "T3", None, "50 - 100%", "classe 12"),
    ]


POSTING = {"@type": "JobPosting", "title": "T", "datePosted": "2026-01-02T03:04", "description": "<p>D</p>",
           "hiringOrganization": {"name": "C"}, "jobLocation": {"address": {"addressRegion": "GE"}}}


def _page(*scripts, kind="application/ld+json"):
    tags = "".join(f"<script type='{kind}'>{s if isinstance(s, str) else json.dumps(s)}</script>" for s in scripts)
    return f"<html><!-- <script type='application/ld+json'>{{}}</script> -->{tags}</html>"


def test_postings(spark):
    other = POSTING | {"title": "Other"}
    pages = {
        "plain": (_page(POSTING), "T", "T"),
        "graph": (_page({"@graph": [{"@type": "x"}, POSTING, other]}), "T", "T"),
        "nested graph": (_page({"graph": {"itemListElement": [other]}}), "Other", "Other"),
        "any key": (_page({"z": {"y": POSTING}}), None, "T"),
        "source order": (_page({"z": other, "a": POSTING}), None, "Other"),
        "second script": (_page("", "{broken", POSTING), "T", "T"),
        "trailing text": (_page(json.dumps(POSTING) + " x"), None, None),
        "repeated key": (_page('{"@type":"JobPosting","title":"A","title":"B"}'), "B", "B"),
        "type list": (_page(POSTING | {"@type": ["JobPosting"]}), None, None),
        "case": (_page(POSTING | {"@type": "jobPOSTING"}), "T", "T"),
        "other type": (_page(POSTING, kind="text/json"), None, None),
        "parent first": (_page(other | {"@graph": [POSTING]}), "Other", "Other"),
        "none": ("<p>x</p>", None, None),
    }
    df = spark.createDataFrame([(k, v[0]) for k, v in pages.items()], "name string, html string")
    for n, keys in ((1, extract.GRAPH_KEYS), (2, None)):
        rows = extract.ldjson_jobposting(df, keys, extract.POSTING_LIMITS["jobup"])
        for name, title, ok in values(rows, "name", "title", "ok"):
            assert title == pages[name][n], (name, keys, title)
            assert ok


def test_posting_types(spark):
    bad = [{"title": 5}, {"title": ["x"]}, {"datePosted": 20260101}, {"hiringOrganization": {"name": {"a": 1}}}]
    good = [{"title": None}, {"title": 0}, {"title": []}, {"hiringOrganization": "C"}, {"jobLocation": [1]}]
    pages = [(i, _page(POSTING | change)) for i, change in enumerate(bad + good)]
    df = spark.createDataFrame(pages, "n int, html string")
    graph = extract.ldjson_jobposting(df, None, extract.POSTING_LIMITS["jobup"])
    assert {r.n for r in graph.filter("NOT ok").collect()} == set(range(len(bad)))
    # The date needs no cleaning at the other site, so a number is a date text there.
    nested = extract.detail_record_nested(df.withColumn("url", F.lit("u")))
    dates = {r.n: (r.ok, r.posting_date) for r in nested.collect()}
    assert dates[2] == (True, "20260101") and dates[4] == (True, "2026-01-02")


def test_detail_record(spark):
    meta = """<meta property="og:title" content=" OG "><meta content="x" property="og:description">"""
    pages = [(1, meta + _page(POSTING)), (2, meta), (3, "<p>none</p>")]
    df = spark.createDataFrame(pages, "n int, html string").withColumn("url", F.lit("u"))
    got = {r.n: r for r in extract.detail_record_graph(df).collect()}
    assert (got[1].title, got[1].company, got[1].location, got[1].posting_date) == ("T", "C", "GE", "2026-01-02")
    assert got[1].description == "<p>D</p>"
    assert (got[2].title, got[2].description, got[2].posting_date) == ("OG", None, None)
    assert got[3].title is None


def test_page_detail(spark):
    long = "mot " * 30
    pages = [
        (1, f"<h1>A &amp;amp; <b>B</b></h1><p>{long}</p><main>Publié le 1.2.2026</main><article>date limite 3.2.2026</article>"),
        (2, f"<article>mise en ligne 1.2.26 <p>short<p>{long}</article><p>publié le 5.2.2026"),
        (3, "<p>short</p>"),
    ]
    df = spark.createDataFrame(pages, "n int, html string")
    got = {r.n: r for r in extract.page_detail(df).collect()}
    assert (got[1].title, got[1].description, got[1].posting_date, got[1].date_limite) == ("A & B", long.strip(), "2026-02-01", None)
    assert (got[2].title, got[2].description, got[2].posting_date) == (None, "short " + long.strip(), None)
    assert (got[3].title, got[3].description) == (None, None)


def test_texts_are_whole_unless_limits_are_passed(spark):
    title, text = "t" * 500, "d" * 5_000
    page = spark.createDataFrame([(1, f"<h1>{title}</h1><p>{text}</p>")], "n int, html string")
    posting = spark.createDataFrame([(1, _page(POSTING | {"title": title, "description": text}))], "n int, html string")
    posting = posting.withColumn("url", F.lit("u"))
    for limits, sizes in ((None, (500, 5_000)), (extract.PAGE_LIMITS, (240, 2_200))):
        row = extract.page_detail(page, limits).first()
        assert (len(row.title), len(row.description)) == sizes
    for record, site in ((extract.detail_record_graph, "jobup"), (extract.detail_record_nested, "talent")):
        usual = extract.POSTING_LIMITS[site]
        for limits, sizes in ((None, (500, 5_000)), (usual, (usual["title"], usual["description"]))):
            row = record(posting, limits=limits).first()
            assert (len(row.title), len(row.description)) == sizes
    card = f"<ul><li><a href='/offres-emploi-etat-geneve/liste-offres/1'>{title}</a></li></ul>"
    for limits, size in ((None, 500), (extract.CARD_LIMITS, 240)):
        rows = extract.listing_cards(spark.createDataFrame([(1, card)], "page_id int, html string"), SITE_RULES["ge"], limits=limits)
        assert [len(r.title) for r in rows.collect()] == [size]


def test_assemble(spark):
    cards = spark.createDataFrame(
        [("u1", "card", "d", "80%", "classe 1"), ("u2", None, None, None, None), ("u3", "card", None, None, None)],
        "url string, title string, departement string, taux string, remuneration string",
    )
    details = spark.createDataFrame(
        [("u1", "", "text", None, None), ("u2", None, None, "2026-01-01", "2026-02-01")],
        "url string, title string, description string, posting_date string, date_limite string",
    )
    feed = spark.createDataFrame(
        [("u1", "feed 1", "2026-03-01", "s1"), ("u2", "feed 2", "2026-03-02", "s2")],
        "url string, title string, posting_date string, summary string",
    )
    got = {r.url: r for r in assemble_ge(cards, details, feed).collect()}
    assert set(got) == {"u1", "u2"}
    assert (got["u1"].title, got["u1"].posting_date, got["u1"].summary) == ("card", "2026-03-01", "s1")
    assert (got["u2"].title, got["u2"].posting_date, got["u2"].date_limite) == ("feed 2", "2026-01-01", "2026-02-01")
