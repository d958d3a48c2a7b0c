"""Extraction queries over captured pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobsluice.functions import html as H
from jobsluice.functions.urls import SITE_RULES, SiteRule, is_detail_url
from jobsluice.operators import expand, extract
from jobsluice.operators.assemble import assemble_ge, feed_left_join
from jobsluice.queries.registry import fmt, query, table
from jobsluice.sources.feed import rss_items

# Detail pages of the test site: paths starting with a lower-case ASCII letter.
SITE = SiteRule("demo", "https://jobs.example.com", "example.com", "/[a-z]")

# Visible text the SQL way: hidden parts out, tags out, the references that occur in
# the data decoded.
_VISIBLE = "regexp_replace(html, '(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>', ' ', 'g')"


def _decoded(sql):
    for entity, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"')):
        sql = f"replace({sql}, '{entity}', '{char}')"
    return f"regexp_replace({sql}, '&amp;?', '&', 'g')"


_LINKS_SQL = f"""
    tags AS (SELECT page_id, regexp_extract_all({_VISIBLE}, '<a[^>]*href="([^"]*)"', 1) AS hrefs FROM pages),
    l AS (SELECT page_id, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) - 1 AS pos FROM tags),
    links AS (SELECT page_id, pos, split_part('https://jobs.example.com' || trim({_decoded('href')}), '#', 1) AS url
              FROM l WHERE href <> '')
"""


@query(
    "extract_links",
    f"""
    WITH {_LINKS_SQL}
    SELECT url, page_id, pos FROM (
      SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id, pos) AS n FROM links
      WHERE regexp_matches(url, '^https://jobs.example.com/[a-z]')) WHERE n = 1
    """,
)
def extract_links(spark, sf):
    return extract.extract_links(table(spark, sf, "pages").select("page_id", "html"), SITE)


# Links in the shape of each site's detail pages, and near misses.
_SHAPES = {
    "jobup": ("https://www.JobUp.ch/fr/emplois/detail/", "https://www.jobup.ch/fr/emplois/"),
    "talent": ("https://ch.talent.com/view?id=", "https://ch.talent.com/views?id="),
    "ge": (
        "https://www.ge.ch/offres-emploi-etat-geneve/liste-offres/",
        "https://www.ge.ch/offres-emploi-etat-geneve/liste-offres/x",
    ),
}


@query(
    "detail_url_filter",
    f"""
    WITH {_LINKS_SQL},
    n AS (SELECT page_id, pos, ascii(substr(url, 26)) % 7 AS form, url FROM links),
    u AS (SELECT page_id, pos, form, CASE form
            WHEN 0 THEN 'https://www.JobUp.ch/fr/emplois/detail/' || page_id
            WHEN 1 THEN 'https://www.jobup.ch/fr/emplois/' || page_id
            WHEN 2 THEN 'https://ch.talent.com/view?id=' || page_id
            WHEN 3 THEN 'https://ch.talent.com/views?id=' || page_id
            WHEN 4 THEN 'https://www.ge.ch/offres-emploi-etat-geneve/liste-offres/' || page_id
            WHEN 5 THEN 'https://www.ge.ch/offres-emploi-etat-geneve/liste-offres/x' || page_id
            ELSE url END AS url FROM n)
    SELECT page_id, pos, url, CASE form WHEN 0 THEN 'jobup' WHEN 2 THEN 'talent' ELSE 'ge' END AS site
    FROM u WHERE form IN (0, 2, 4)
    """,
)
def detail_url_filter(spark, sf):
    links = extract.page_links(table(spark, sf, "pages").select("page_id", "html"), SITE.origin)
    form = F.ascii(F.substring("url", 26, 1)) % 7
    page = F.col("page_id").cast("string")
    shaped = F.col("url")
    for n, prefix in enumerate(p for pair in _SHAPES.values() for p in pair):
        shaped = F.when(form == n, F.concat(F.lit(prefix), page)).otherwise(shaped)
    rows = links.select("page_id", F.col("pos").cast("bigint").alias("pos"), shaped.alias("url"))
    site = F.coalesce(*[F.when(is_detail_url(F.col("url"), rule), F.lit(name)) for name, rule in SITE_RULES.items()])
    return rows.withColumn("site", site).filter("site IS NOT NULL")


@query(
    "html_to_text",
    f"""
    SELECT page_id, trim(regexp_replace({_decoded(f"regexp_replace({_VISIBLE}, '<[^>]*>', ' ', 'g')")},
                                        '\\s+', ' ', 'g')) AS body FROM pages
    """,
)
def html_to_text(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "html")
    return H.with_text(pages, F.col("html"), "body").select("page_id", "body")


# The article as chunks after each <p>; a chunk without </p> leaves its paragraph
# open to the end of the article.
@query(
    "page_detail",
    f"""
    WITH a AS (
      SELECT page_id, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS h1,
             string_split(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<p>')[2:] AS chunks,
             strftime(DATE '2024-01-01' + CAST(page_id % 300 AS INTEGER), '%Y-%m-%d') AS day FROM pages),
    c AS (SELECT page_id, chunks, unnest(chunks) AS chunk, generate_subscripts(chunks, 1) AS i FROM a),
    o AS (SELECT *, min(i) FILTER (NOT contains(chunk, '</p>')) OVER (PARTITION BY page_id) AS first_open FROM c),
    p AS (SELECT page_id, i, CASE WHEN i = first_open THEN array_to_string(chunks[i:], '<p>')
                                  ELSE split_part(chunk, '</p>', 1) END AS para
          FROM o WHERE first_open IS NULL OR i <= first_open),
    t AS (SELECT page_id, i, array_to_string(list_filter(list_transform(
                   string_split_regex({_decoded('para')}, '<[^>]*>'), lambda x: trim(x, E' \\n')),
                   lambda x: x <> ''), ' ') AS body FROM p),
    f AS (SELECT page_id, arg_min(body, i) AS body FROM t WHERE length(body) > 80 GROUP BY page_id)
    SELECT a.page_id,
           nullif(trim(regexp_replace({_decoded(f"regexp_replace({_decoded('h1')}, '<[^>]*>', ' ', 'g')")},
                                      '\\s+', ' ', 'g')), '') AS title,
           trim(regexp_replace({_decoded('f.body')}, '\\s+', ' ', 'g')) AS description,
           day AS posting_date, NULL::VARCHAR AS date_limite
    FROM a LEFT JOIN f USING (page_id)
    """,
)
def page_detail(spark, sf):
    day = fmt(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 300).cast("int")), "dd.MM.yyyy")
    pages = table(spark, sf, "pages").select("page_id", "html")
    # The note stands in front of the article, so that it leaves the paragraphs alone.
    html = F.replace("html", F.lit("<article>"), F.concat(F.lit("<article><i>Publi&eacute; le "), day, F.lit("</i>")))
    return extract.page_detail(pages.withColumn("html", html))


@query(
    "total_pages",
    """
    SELECT page_id, CASE WHEN page_id % 3 > 0 THEN greatest(1, page_id % 7) END AS reported,
           CASE WHEN page_id % 5 > 1 THEN page_id % 5 END AS linked FROM pages
    """,
)
def total_pages(spark, sf):
    n = (F.col("page_id") % 7).cast("string")
    marker = (
        F.when(F.col("page_id") % 3 == 1, F.concat(F.lit('<i data-x=\'{"totalPages" : '), n, F.lit("}'></i>")))
        .when(F.col("page_id") % 3 == 2, F.concat(F.lit('{"total_pages":'), n, F.lit("}")))
        .otherwise(F.lit('{"totalPages":"many"}'))
    )
    last = (F.col("page_id") % 5).cast("string")
    links = F.concat(F.lit('<a href="/s?k=x&p=1">1</a><a href="/s?p='), last, F.lit('">2</a>'))
    pages = table(spark, sf, "pages").select("page_id", F.concat("html", marker, links).alias("html"))
    return pages.select(
        "page_id",
        extract.total_pages_reported(F.col("html")).alias("reported"),
        extract.total_pages_linked(F.col("html")).alias("linked"),
    )


# The addresses of the data hold no query, ``?utm_source=feed`` or ``?page=2&ref=x``.
@query(
    "listing_urls",
    """
    WITH u AS (SELECT page_id, url, split_part(url, '#', 1) AS plain,
                      CASE WHEN contains(url, '#') THEN '#' || split_part(url, '#', 2) ELSE '' END AS tail,
                      unnest(generate_series(1, length(url) % 4 + 1)) AS page_no FROM pages)
    SELECT page_id, page_no, CASE
        WHEN contains(plain, '?page=') AND page_no = 1 THEN replace(plain, 'page=2&', '')
        WHEN contains(plain, '?page=') THEN replace(plain, 'page=2', 'page=' || page_no)
        WHEN page_no = 1 THEN plain
        WHEN contains(plain, '?') THEN plain || '&page=' || page_no
        ELSE plain || '?page=' || page_no END || tail AS page_url
    FROM u
    """,
)
def listing_urls(spark, sf):
    searches = table(spark, sf, "pages").select("page_id", "url", (F.length("url") % 4 + 1).alias("total_pages"))
    return expand.listing_urls(searches).select("page_id", "page_no", "page_url")


@query(
    "search_urls",
    """
    SELECT s_suppkey, 'https://jobs.example.com/?location=' || replace(replace(n_name, '_', ' '), ' ', '+')
           || CASE WHEN s_acctbal > 0 THEN '&term=' || replace(s_name, '#', '%23') || '+%26+%C3%A9*~'[:-3] || '%2A~'
              ELSE '' END AS url
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    """,
)
def search_urls(spark, sf):
    rows = table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    term = F.when(F.col("s_acctbal") > 0, F.concat(F.lit(" "), "s_name", F.lit(" & é*~ "))).otherwise(F.lit(" "))
    params = {"location": F.replace("n_name", F.lit("_"), F.lit(" ")), "term": expand.search_term(term)}
    return rows.select("s_suppkey", expand.search_url("https://jobs.example.com/", params).alias("url"))


# Detail pages built around parts: structured data in four arrangements, meta data.
def _part_pages(spark, sf):
    part = table(spark, sf, "part")
    node = F.to_json(
        F.struct(
            F.lit("JobPosting").alias("@type"),
            F.concat("p_name", F.lit(" &amp; co")).alias("title"),
            F.struct(F.col("p_brand").alias("name")).alias("hiringOrganization"),
            F.struct(
                F.struct(
                    F.when(F.col("p_size") > 25, F.col("p_type")).otherwise(F.lit("")).alias("addressLocality"),
                    F.lit("GE").alias("addressRegion"),
                ).alias("address")
            ).alias("jobLocation"),
            F.concat(F.lit("2024-03-0"), (F.col("p_size") % 9 + 1).cast("string"), F.lit("T08:00:00Z")).alias("datePosted"),
        )
    )
    form = F.col("p_size") % 4
    script = (
        F.when(form == 0, F.concat(F.lit('{"@graph":[{"@type":"WebPage"},'), node, F.lit("]}")))
        .when(form == 1, F.concat(F.lit("["), node, F.lit("]")))
        .when(form == 2, F.concat(F.lit('{"mainEntity":{"offer":'), node, F.lit('},"@type":"Page"}')))
        .otherwise(F.concat(F.lit("{broken "), node))
    )
    html = F.concat(
        F.lit('<html><head><meta property="og:title" content=" '),
        "p_name",
        F.lit(' (og) "><meta name="x" property=\'og:description\' content=\'About '),
        "p_brand",
        F.lit("'><!-- <script type=\"application/ld+json\">{}</script> -->"),
        F.lit("<script>var a = 1;</script><script type=\"application/ld+json\"> </script>"),
        F.lit('<script type="application/ld+json">'),
        script,
        F.lit("</script></head><body><p>x</p></body></html>"),
    )
    url = F.concat(F.lit("https://jobs.example.com/p/"), F.col("p_partkey").cast("string"))
    return part.select("p_partkey", url.alias("url"), html.alias("html"))


_FOUND = {"graph": "p_size % 4 < 2", "nested": "p_size % 4 < 3"}


def _posting_sql(found, date):
    return f"""
      CASE WHEN {found} THEN p_name || ' & co' END AS title,
      CASE WHEN {found} THEN p_brand END AS company,
      CASE WHEN {found} THEN CASE WHEN p_size > 25 THEN p_type ELSE 'GE' END END AS location,
      CASE WHEN {found} THEN '2024-03-0' || (p_size % 9 + 1) || '{date}' END AS posting_date
    """


@query(
    "ldjson_jobposting",
    f"SELECT p_partkey, {_posting_sql(_FOUND['nested'], 'T08:00:00Z')}, true AS ok FROM part",
)
def ldjson_jobposting(spark, sf):
    rows = extract.ldjson_jobposting(_part_pages(spark, sf), None, dict.fromkeys(extract.POSTING_LIMITS["jobup"]))
    return rows.select("p_partkey", "title", "company", "location", "posting_date", "ok")


@query(
    "meta_property",
    "SELECT p_partkey, p_name || ' (og)' AS og_title, 'About ' || p_brand AS og_description, NULL::VARCHAR AS og_url FROM part",
)
def meta_property(spark, sf):
    pages = _part_pages(spark, sf).select("p_partkey", "html")
    for prop in ("title", "description", "url"):
        pages = extract.meta_property(pages, f"og:{prop}", f"og_{prop}")
    return pages.drop("html")


_RECORD_SQL = f"""
    SELECT p_partkey, 'jobup' AS site, 'https://jobs.example.com/p/' || p_partkey AS url,
           coalesce(title, p_name || ' (og)') AS title, company, location, 'About ' || p_brand AS description, posting_date
    FROM (SELECT *, {_posting_sql(_FOUND['graph'], '')} FROM part)
    UNION ALL
    SELECT p_partkey, 'talent', 'https://jobs.example.com/p/' || p_partkey, title, company, location, NULL, posting_date
    FROM (SELECT *, {_posting_sql(_FOUND['nested'], '')} FROM part)
"""


@query("detail_record", _RECORD_SQL)
def detail_record(spark, sf):
    pages = _part_pages(spark, sf)
    columns = ["p_partkey", "site", "url", "title", "company", "location", "description", "posting_date"]
    graph = extract.detail_record_graph(pages).withColumn("site", F.lit("jobup"))
    nested = extract.detail_record_nested(pages).withColumn("site", F.col("source"))
    return graph.select(columns).unionByName(nested.select(columns))


# Listing cards built around suppliers, eight per page after a menu; every card stands
# on its page twice.
_CARD_URL = "/offres-emploi-etat-geneve/liste-offres/"


def _card_pages(spark, sf):
    rows = table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    key = F.col("s_suppkey").cast("string")
    pay = F.when(F.col("s_nationkey") % 2 == 0, F.concat(F.lit("Classe "), F.col("s_nationkey").cast("string"))).otherwise(
        F.concat(F.lit("Rémunération "), F.col("n_name"), F.lit(" | autre"))
    )
    card = F.concat(
        F.lit(f'<li class="c"><h3><a href="{_CARD_URL}'),
        key,
        F.lit('"> Poste <b>'),
        "s_name",
        F.lit('</b></a></h3><a href="/organisation/x">D&eacute;partement '),
        "n_name",
        F.lit("</a><p>Taux d'activité 80 - "),
        (F.col("s_nationkey") + 50).cast("string"),
        F.lit("%<br>"),
        pay,
        F.lit("</p></li>"),
    )
    packed = rows.select(F.floor(F.col("s_suppkey") / 8).cast("bigint").alias("page_id"), "s_suppkey", card.alias("card"))
    cards = F.array_join(F.col("_list.card"), "<!-- <li> -->")
    html = F.concat(F.lit('<ul><li><a href="/x">menu</a></li></ul><ul>'), cards, cards, F.lit("</ul>"))
    lists = packed.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "card"))).alias("_list"))
    return lists.select("page_id", html.alias("html"))


@query(
    "listing_cards",
    f"""
    SELECT s_suppkey // 8 AS page_id, s_suppkey % 8 + 1 AS pos, 'https://www.ge.ch{_CARD_URL}' || s_suppkey AS url,
           'Poste ' || s_name AS title, 'Département ' || n_name AS departement,
           '80 - ' || (s_nationkey + 50) || '%' AS taux,
           CASE WHEN s_nationkey % 2 = 0 THEN 'classe ' || s_nationkey ELSE n_name END AS remuneration
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    """,
)
def listing_cards(spark, sf):
    return extract.listing_cards(_card_pages(spark, sf), SITE_RULES["ge"])


# Feeds built from orders, twenty items each; an item repeats its order once with a
# later text. Orders of low priority have no link.
def _feeds(spark, sf):
    orders = table(spark, sf, "orders")
    url = F.concat(F.lit(" https://jobs.example.com/c/"), F.col("o_custkey").cast("string"), F.lit(" "))
    link = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(" ")).otherwise(url)
    item = F.concat(
        F.lit("<item><title>Order &amp;amp; "),
        F.col("o_orderkey").cast("string"),
        F.lit("</title><link>"),
        link,
        F.lit("</link><pubDate>Sun, "),
        fmt(F.col("o_orderdate"), "d MMM yyyy"),
        F.lit(" 10:00:00 +0100</pubDate><description>&lt;p&gt;Priority &lt;b&gt;"),
        "o_orderpriority",
        F.lit("&lt;/b&gt;&lt;/p&gt;</description></item>"),
    )
    packed = orders.select(F.floor(F.col("o_orderkey") / 20).cast("bigint").alias("page"), "o_orderkey", item.alias("item"))
    lists = packed.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "item"))).alias("_list"))
    text = F.concat(F.lit("<rss><channel><title>x</title>"), F.array_join("_list.item", "\n"), F.lit("</channel></rss>"))
    return lists.select(F.format_string("feed-%012d.xml", "page").alias("path"), text.alias("text"))


_FEED_SQL = """
    f AS (SELECT 'https://jobs.example.com/c/' || o_custkey AS url, 'Order & ' || o_orderkey AS title,
                 strftime(o_orderdate, '%Y-%m-%d') AS posting_date, 'Priority ' || o_orderpriority AS summary
          FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n
                FROM orders WHERE o_orderpriority <> '5-LOW') WHERE n = 1)
"""


@query("rss_items", f"WITH {_FEED_SQL} SELECT * FROM f")
def feed_items(spark, sf):
    return rss_items(_feeds(spark, sf))


def _customers(spark, sf):
    url = F.concat(F.lit("https://jobs.example.com/c/"), F.col("c_custkey").cast("string"))
    return table(spark, sf, "customer").withColumn("url", url)


@query(
    "feed_left_join",
    f"""
    WITH {_FEED_SQL}
    SELECT c_custkey, f.title AS feed_title, posting_date AS feed_posting_date
    FROM customer LEFT JOIN f ON f.url = 'https://jobs.example.com/c/' || c_custkey
    """,
)
def left_join(spark, sf):
    joined = feed_left_join(_customers(spark, sf).select("c_custkey", "url"), rss_items(_feeds(spark, sf)))
    return joined.select("c_custkey", "feed_title", "feed_posting_date")


@query(
    "assemble_ge",
    f"""
    WITH {_FEED_SQL}
    SELECT 'https://jobs.example.com/c/' || c_custkey AS url, 'ge' AS source,
           CASE WHEN c_acctbal > 5000 THEN c_name WHEN c_acctbal > 0 THEN 'card ' || c_custkey ELSE f.title END AS title,
           c_mktsegment AS departement, CASE WHEN c_acctbal <= 5000 THEN f.posting_date ELSE '2024-01-31' END AS posting_date,
           f.summary
    FROM customer LEFT JOIN f ON f.url = 'https://jobs.example.com/c/' || c_custkey
    WHERE c_mktsegment <> 'MACHINERY'
    """,
)
def assemble(spark, sf):
    rows = _customers(spark, sf)
    balance = F.col("c_acctbal")
    none = F.lit(None).cast("string")
    cards = rows.select(
        "url",
        F.when(balance > 0, F.concat(F.lit("card "), F.col("c_custkey").cast("string"))).alias("title"),
        F.col("c_mktsegment").alias("departement"),
        none.alias("taux"),
        none.alias("remuneration"),
    )
    details = rows.filter("c_mktsegment <> 'MACHINERY'").select(
        "url",
        F.when(balance > 5000, F.col("c_name")).otherwise("").alias("title"),
        none.alias("description"),
        F.when(balance > 5000, F.lit("2024-01-31")).alias("posting_date"),
        none.alias("date_limite"),
    )
    out = assemble_ge(cards, details, rss_items(_feeds(spark, sf)))
    return out.select("url", "source", "title", "departement", "posting_date", "summary")
