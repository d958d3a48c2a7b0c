from urllib.parse import urlencode, urljoin

from helpers import values
from pyspark.sql import functions as F

from jobsluice.functions import urls as U
from jobsluice.operators import expand, extract

ORIGIN = "https://www.example.com"


def test_absolute_url(spark):
    links = ["/a/b?x=1#f", "a/b", "./a", "../a/../b", "/a/./b/", "/a/b/..", "/a/b/.", "?q=1", "#top", "//cdn.example.com/x",
             "http://other.example.com/a/../b", "mailto:x@example.com", "/é à", "a", "/a;p?q", "..", "/"]
    df = spark.createDataFrame([(x,) for x in links], "href string")
    got = values(df, "href", U.drop_fragment(U.absolute_url(F.col("href"), ORIGIN)))
    for href, url in got:
        assert url == urljoin(ORIGIN, href).split("#")[0], (href, url)


def test_detail_rules(spark):
    urls = [
        "https://www.jobup.ch/fr/emplois/detail/1", "https://WWW.JOBUP.CH/fr/emplois/detail/1?x=1", "//jobup.ch/emplois/detail/",
        "https://jobup.ch.evil.example/emplois/detail/1", "https://www.jobup.ch/fr?x=/emplois/detail/1", "https://www.jobup.ch",
        "https://ch.talent.com/view?id=1", "https://ch.talent.com/view?x=1&jobid=2", "https://ch.talent.com/view",
        "https://ch.talent.com/views?id=1", "https://ch.talent.com/view/?id=1", "https://ch.talent.com/a/view?b#id=1",
        "https://www.ge.ch/offres-emploi-etat-geneve/liste-offres/12", "https://www.ge.ch/offres-emploi-etat-geneve/liste-offres/12?a=b",
        "https://www.ge.ch/offres-emploi-etat-geneve/liste-offres/12/", "https://www.ge.ch/offres-emploi-etat-geneve/liste-offres/x",
        "/offres-emploi-etat-geneve/liste-offres/12",
    ]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    hits = {"jobup": urls[0:3], "talent": urls[6:8], "ge": urls[12:14]}
    for site, rule in U.SITE_RULES.items():
        assert [url for url, hit in values(df, "url", U.is_detail_url(F.col("url"), rule)) if hit] == hits[site]


def test_listing_urls(spark):
    # Search URL, and its first and second further page with the parameter counting from 0.
    site = "https://e.example.com/"
    pages = [
        ("s", "s", "s?page=1", "s?page=2"),
        ("s?a=1&page=9&b=2", "s?a=1&b=2", "s?a=1&page=1&b=2", "s?a=1&page=2&b=2"),
        ("s?a=1&a=2&b=", "s?a=2&b=", "s?a=2&b=&page=1", "s?a=2&b=&page=2"),
        ("s?page=1#top", "s#top", "s?page=1#top", "s?page=2#top"),
        ("s?q=a+b%20c*~&&x", "s?q=a+b+c%2A~&x=", "s?q=a+b+c%2A~&x=&page=1", "s?q=a+b+c%2A~&x=&page=2"),
        ("?l=Gen%C3%A8ve", "?l=Gen%C3%A8ve", "?l=Gen%C3%A8ve&page=1", "?l=Gen%C3%A8ve&page=2"),
    ]
    df = spark.createDataFrame([(site + p[0], 3) for p in pages], "url string, total_pages int")
    got = values(expand.listing_urls(df, "page", 0), "url", "page_no", "page_url")
    assert sorted(got) == sorted((site + p[0], k, site + p[k]) for p in pages for k in (1, 2, 3))
    from_one = values(expand.listing_urls(df.limit(1), "page", 1), "page_no", "page_url")
    assert sorted(from_one) == [(1, f"{site}s"), (2, f"{site}s?page=2"), (3, f"{site}s?page=3")]


def test_search_url(spark):
    df = spark.createDataFrame([("Genève", " dév & ops* "), ("a~b", "  ")], "l string, t string")
    url = expand.search_url("https://e.example.com/", {"location": F.col("l"), "term": expand.search_term(F.col("t"))})
    assert [r[0] for r in df.select(url).collect()] == [
        "https://e.example.com/?" + urlencode({"location": "Genève", "term": "dév & ops*"}),
        "https://e.example.com/?" + urlencode({"location": "a~b"}),
    ]


def test_total_pages(spark):
    rows = [('{"totalPages" : 7}', 7, None), ('"total_pages":0 "totalPages":"x"', 1, None), ("?p=2&p=11 p=99", None, 11),
            ("?p=1", None, None), ("", None, None)]
    df = spark.createDataFrame([(r[0],) for r in rows], "html string")
    html = F.col("html")
    assert values(df, "html", extract.total_pages_reported(html), extract.total_pages_linked(html)) == rows
