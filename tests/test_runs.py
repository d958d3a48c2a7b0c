import json
import random
from datetime import date

from pyspark.sql import functions as F

from jobsluice.functions.urls import SiteRule
from jobsluice.operators.normalize import normalize_adzuna
from jobsluice.plans.collect import collect_feed_items, collect_listing, collect_pages
from jobsluice.schema import POLICIES, Policy
from jobsluice.sources.payloads import ENVELOPES, payload_pages, unpack_envelope

RULE = SiteRule("t", "https://e.example.com", "example.com", "/d/")
JOBS = "id bigint, url string, title string, description string, posting_date string, pos bigint"


def _site(seed):
    rnd = random.Random(seed)
    listing = [(page, [f"https://e.example.com/d/{rnd.randint(0, 30)}" for _ in range(rnd.randint(1, 5))]) for page in range(1, 9)]
    urls = sorted({u for _, links in listing for u in links})
    known = {u for u in urls if rnd.random() < 0.5}
    broken = {u for u in urls if rnd.random() < 0.2}
    return listing, urls, known, broken


def _frames(spark, site):
    listing, urls, known, broken = site
    pages = [("t", "r", page, 200, "".join(f'<a href="{u[21:]}">x</a><a href="/other">o</a>' for u in links)) for page, links in listing]
    posting = '<script type="application/ld+json">{"@type":"JobPosting","title":%s,"datePosted":"2026-01-%02d"}</script>'
    details = [(u, posting % ("5" if u in broken else f'"avec vous {u[24:]}"', 1 + n % 28)) for n, u in enumerate(urls)]
    return (
        spark.createDataFrame(pages, "source string, run_id string, page_no bigint, status int, html string"),
        spark.createDataFrame(details, "url string, html string"),
        spark.createDataFrame([(n + 1, u, "old pour vous", None, "2026-01-20", n) for n, u in enumerate(sorted(known))], JOBS),
        spark.createDataFrame([], "key string"),
    )


def _walk(site, streak):
    listing, _, known, _ = site
    links, run = [], 0
    for page, urls in listing:
        for u in urls:
            if u in links:
                continue
            links.append(u)
            if page > 1:
                run = run + 1 if u in known else 0
                if run >= streak:
                    return links
    return links


def test_html_runs(spark):
    as_of = date(2026, 1, 28)
    for seed, seen_policy, language in ((1, "all", None), (2, "persisted", None), (3, "merged", "fr_en")):
        site = _site(seed)
        _, urls, known, broken = site
        policy = Policy("t", fresh_days=seen_policy == "persisted", seen=seen_policy, language=language)
        run = collect_pages(
            *_frames(spark, site), RULE, policy, as_of, days=14, stop_after_known=3, max_jobs=6, page_rule="empty"
        )
        links = _walk(site, 3)
        new = [u for u in links if u not in known][:6]
        day = {u: 1 + n % 28 for n, u in enumerate(urls)}
        fresh = [u for u in new if u not in broken and (seen_policy != "persisted" or day[u] >= 14)]
        table = {u: (n + 1, 20) for n, u in enumerate(sorted(known))}
        table |= {u: (len(known) + 1 + n, day[u]) for n, u in enumerate(fresh)}
        written = {u: i for u, (i, d) in table.items() if d >= 14}
        assert {r.url: r.id for r in run.written.collect()} == written, seed
        recent = [u for u in new if u not in broken and (seen_policy != "persisted" or day[u] >= 14)]
        counts = (len(links), len(new), len(recent), sum(u in broken for u in new))
        assert tuple(run.report.first()) == (*counts, len(new) - counts[2] - counts[3], 0), seed
        seen = {"all": known | set(links) | set(table), "persisted": set(written), "merged": set(table)}[seen_policy]
        assert {r.key for r in run.seen.collect()} == seen, seed


def test_report_counts_languages_and_nothing(spark):
    pages, details, current, seen = _frames(spark, _site(4))
    german = details.withColumn("html", F.regexp_replace("html", "avec vous", "mit sie Stelle"))
    half = details.filter("substring(url, -1) % 2 = 0").unionByName(german.filter("substring(url, -1) % 2 = 1"))
    policy = Policy("t", fresh_days=False, seen="merged", language="fr_en")
    run = collect_pages(pages, half, current, seen, RULE, policy, date(2026, 1, 28), stop_after_known=0, page_rule="empty")
    fresh = [r.title for r in run.fresh.collect()]
    report = run.report.first()
    assert report.n_ok == len(fresh) and report.n_language == sum("mit" in t for t in fresh) > 0
    none = collect_pages(pages.limit(0), half, current, seen, RULE, policy, date(2026, 1, 28), page_rule="empty")
    assert tuple(none.report.first()) == (0, 0, 0, 0, 0, 0)
    assert none.written.count() == current.count()


def test_feed_run(spark):
    items = [("", "A", "c", "l", 0), ("u1", "B", "", "", 1), (" ", "a ", "C", "L", 2), ("u1", "late", "", "", 3), ("u2", "D", "", "", 4)]
    schema = "url string, title string, company string, location string, pos bigint"
    current = [("u2", "old", "", "", 0, 4), ("u9", "old", "", "", 1, None)]
    run = collect_feed_items(
        spark.createDataFrame(items, schema),
        spark.createDataFrame(current, schema + ", id bigint"),
        spark.createDataFrame([("u8",)], "key string"),
        POLICIES["indeed"],
        date(2026, 1, 1),
    )
    got = {(r.id, r.url, r.title) for r in run.written.collect()}
    assert got == {(4, "u2", "old"), (None, "u9", "old"), (5, "", "A"), (6, "u1", "B")}
    assert {r.key for r in run.seen.collect()} == {"u1", "u2", "u8", "u9", "a|c|l"}


def test_two_level_run(spark):
    site = _site(11)
    _, urls, known, broken = site
    pages, details, current, seen = _frames(spark, site)
    in_master = [u for u in urls if u not in known][:5]
    master = spark.createDataFrame([(100 + n, u, "m", None, "2026-01-21", n) for n, u in enumerate(in_master)], JOBS)
    policy = Policy("t", fresh_days=False)
    run = collect_pages(
        pages, details, current, seen, RULE, policy, date(2026, 1, 28), days=0, stop_after_known=4, page_rule="empty",
        master=master,
    )
    combined = (site[0], urls, known | set(in_master), broken)
    links = _walk(combined, 4)
    fresh = [u for u in links if u not in known and u not in broken]
    master_ids = {u: 100 + n for n, u in enumerate(in_master)}
    top = max(master_ids.values())
    for u in fresh:
        if u not in master_ids:
            top += 1
            master_ids[u] = top
    assert {r.url: r.id for r in run.master.collect()} == master_ids
    ids = {u: n + 1 for n, u in enumerate(sorted(known))}
    for u in sorted(master_ids, key=master_ids.get, reverse=True):
        ids.setdefault(u, len(ids) + 1)
    assert {r.url: r.id for r in run.written.collect()} == ids
    assert {r.key for r in run.seen.collect()} == known | set(links) | set(master_ids)
    assert {r.url for r in run.details.filter("NOT ok").collect()} == {u for u in links if u in broken and u not in known}


def test_card_and_feed_run(spark):
    at = "/offres-emploi-etat-geneve/liste-offres/"
    card = '<li><a href="%s%d">Poste %d</a><a href="/organisation/d">Dép %d</a> Classe %d</li>'
    html = {p: "".join(card % (at, n, n, n, n) for n in numbers) for p, numbers in {1: (1, 2), 2: (2, 3, 4), 3: (1, 4), 4: (5,)}.items()}
    pages = spark.createDataFrame(
        [("ge", "r", p, 200, h) for p, h in html.items()],
        "source string, run_id string, page_no bigint, status int, html string",
    )
    url = "https://www.ge.ch" + at
    body = "<h1>%s</h1><article>Publié le %s <p>x</p> date limite 1.3.2026</article>"
    details = spark.createDataFrame(
        [(f"{url}1", body % ("", "20.01.2026")), (f"{url}3", body % ("Titre", "01.01.2025")), (f"{url}4", "<p>none</p>"),
         (f"{url}5", body % ("never listed", "20.01.2026"))],
        "url string, html string",
    )
    feed = spark.createDataFrame(
        [(f"{url}4", "feed", "2026-01-15", "résumé")], "url string, title string, posting_date string, summary string"
    )
    schema = ("id bigint, url string, title string, departement string, taux string, remuneration string, description string, "
              "summary string, posting_date string, date_limite string, source string, pos bigint")
    current = spark.createDataFrame([(3, f"{url}2", "old", None, None, None, None, None, "2026-01-10", None, "ge", 0)], schema)
    seen = spark.createDataFrame([], "key string")
    from jobsluice.functions.urls import SITE_RULES

    run = collect_pages(
        pages, details, current, seen, SITE_RULES["ge"], POLICIES["ge"], date(2026, 1, 28), feed=feed, detail="page"
    )
    got = {r.url[len(url):]: r for r in run.written.collect()}
    # Page 3 adds nothing, so page 4 is not walked; number 3 is too old.
    assert {n: r.id for n, r in got.items()} == {"2": 3, "1": 4, "4": 5}
    assert (got["1"].title, got["1"].departement, got["1"].remuneration) == ("Poste 1", "Dép 1", "classe 1")
    assert (got["1"].posting_date, got["1"].date_limite, got["1"].source) == ("2026-01-20", "2026-03-01", "ge")
    assert (got["4"].title, got["4"].posting_date, got["4"].summary) == ("Poste 4", "2026-01-15", "résumé")
    assert {r.key for r in run.seen.collect()} == {f"{url}{n}" for n in "124"}
    # Number 3 is too old; every other new link has a page.
    assert run.report.first().asDict() == {
        "n_links": 4, "n_new": 3, "n_ok": 2, "n_errors": 0, "n_out_of_window": 1, "n_language": 0
    }


def test_an_empty_page_ends_a_walk(spark):
    body = lambda *ids: json.dumps({"results": [{"id": i, "redirect_url": f"https://x/{i}"} for i in ids]})
    payloads = spark.createDataFrame([(1, body(1, 2)), (2, body()), (3, body(3))], "page_no int, payload string")
    frame = payload_pages(payloads, ENVELOPES["adzuna"]).withColumns({"source": F.lit("adzuna"), "run_id": F.lit("r")})
    listing = normalize_adzuna(unpack_envelope(payloads, ENVELOPES["adzuna"]).drop("total"))
    listing = listing.withColumnRenamed("pos", "pos_on_page").withColumn("run_id", F.lit("r"))
    current = spark.createDataFrame([], "id bigint, pos bigint, url string, title string")
    seen = spark.createDataFrame([], "key string")
    policy = Policy("adzuna", fresh_days=False, output_days=False, streak=None)
    for pages, n in ((frame, 2), (None, 3)):
        run = collect_listing(listing, current, seen, policy, date(2026, 1, 28), pages=pages, page_rule="distinct")
        assert run.written.count() == n
