"""One collection run: listing in, new job table and seen state out."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobsluice.functions.urls import SiteRule
from jobsluice.operators import extract, filters, keys, merge, ordered
from jobsluice.operators.assemble import assemble_ge
from jobsluice.schema import Policy, listing_order
from jobsluice.session import materialize, materialize_counted


@dataclass(frozen=True)
class RunResult:
    """Tables of a run. ``written`` is the output, ``merged`` the table before the output filter."""

    walked: DataFrame
    fresh: DataFrame
    merged: DataFrame
    written: DataFrame
    seen: DataFrame
    details: DataFrame | None = None  # parsed detail pages with ``ok``
    master: DataFrame | None = None  # the new master table of the two-level mode
    report: DataFrame | None = None  # one row of counts, of runs over pages


def _finish(
    policy: Policy,
    current: DataFrame,
    known: DataFrame,
    walked: DataFrame,
    fresh: DataFrame,
    as_of: date,
    days: int,
    details: DataFrame | None = None,
    captured: DataFrame | None = None,
    added: Observation | None = None,
) -> RunResult:
    columns = _shared(current, fresh)
    batch = fresh.select(columns)
    stored = None if captured is None else captured.select(columns)
    if policy.record_key:
        merged = merge.merge_by_key(current, batch, captured=stored)
    else:
        merged = merge.merge_by_url(
            current, batch, language=policy.language == "fr_en", backfill=policy.backfill_ids, captured=stored,
            added=added,
        )
    if policy.seen in ("merged", "persisted"):
        # The state is read from the merged rows, which then serve two outputs.
        merged = materialize(merged, "merged")
    written = filters.within_days(merged, as_of, days) if policy.output_days else merged
    key = "record_key" if policy.record_key else "url"
    # Current keys are known and fresh ones listed, so "all" needs no look at the merged rows.
    seen = keys.next_seen(
        policy.seen,
        known=known,
        listing=walked,
        merged=None if policy.seen == "all" else merged,
        written=written,
        fresh=fresh,
        key=key,
    )
    return RunResult(walked, fresh, merged, written, seen, details)


def _shared(table: DataFrame, batch: DataFrame) -> list[str]:
    """Columns a batch brings to a table; ids come from the merge."""
    return [c for c in batch.columns if c in table.columns and c != "id"]


def collect_listing(
    listing: DataFrame,
    current: DataFrame,
    seen: DataFrame,
    policy: Policy,
    as_of: date,
    *,
    days: int | None = None,
    stop_after_known: int | None = None,
    max_jobs: int = 0,
    pages: DataFrame | None = None,
    page_rule: str | None = None,
    max_pages: int = 0,
) -> RunResult:
    """Run of a source whose listing already holds full records (API payloads).

    ``listing`` is the listing of one run and has ``source, run_id, page_no, pos_on_page`` and record columns;
    ``current`` the record columns with ``id`` and ``pos``; ``seen`` the column
    ``key``. ``page_rule`` ends the walk at a page edge; ``pages`` has a row for every
    captured page, with ``source, run_id, page_no, n_rows`` and maybe ``total`` and
    ``status`` (see ``payload_pages``), so that a page without items counts. If not
    given, only pages with items are known. The walk ends at the earliest of streak,
    page rule and job limit.
    """
    days = policy.days if days is None else days
    stop = policy.stop_after_known if stop_after_known is None else stop_after_known
    known = keys.known_keys(current, seen)
    if page_rule:
        listing = materialize(listing, "captured")
    recent = filters.is_recent(F.col("posting_date"), as_of, days) if policy.fresh_days else F.lit(True)
    rows = listing.withColumn("ord", listing_order(F.col("page_no"), F.col("pos_on_page")))
    rows = rows.withColumn("pos", F.col("ord"))
    rows = filters.with_language_flag(filters.drop_blank_key(rows), "fr" if policy.language == "fr" else None)
    rows = materialize(rows.withColumn("passes", F.col("lang_ok") & recent).drop("lang_ok"), "listing")

    # The ordered logic sees narrow rows only and gives one cut per listing.
    narrow = rows.select("source", "run_id", "page_no", "ord", "url", "passes")
    cuts = []
    if (policy.streak and stop > 0) or max_jobs > 0:
        flagged = keys.known_flag(narrow, known, spread_by=["source", "run_id", "ord"])
        if policy.streak and stop > 0:
            cuts.append(ordered.streak_cut(flagged, stop, policy.streak))
        if max_jobs > 0:
            cuts.append(ordered.limit_cut(flagged, F.col("passes") & ~F.col("known"), max_jobs))
    if page_rule:
        ends = ordered.last_page(_pages_of(listing, pages), page_rule, max_pages, policy.page_size or 25)
        cuts.append(ordered.page_cut(ends))
    walked = rows
    if cuts:
        walked = ordered.apply_cut(rows, materialize(ordered.earliest_cut(cuts), "cut"))
    fresh = keys.new_records(walked.filter("passes"), known, spread_by=["source", "run_id", "ord"])
    return _finish(policy, current, known, walked, fresh, as_of, days, captured=rows)


# What ends a listing of the API sources.
API_PAGE_RULES = {"jobroom": "short", "adzuna": "distinct"}


def _pages_of(listing: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Page table for ``last_page``: the captured pages, or those with rows in the listing.

    Rows without a URL count as rows.
    """
    page = ["source", "run_id", "page_no"]
    if pages is None:
        total = F.max("total") if "total" in listing.columns else F.lit(None).cast("bigint")
        counts = listing.groupBy(*page).agg(F.count("*").alias("n_rows"), total.alias("total"))
    else:
        extra = {"total": F.lit(None).cast("bigint"), "status": F.lit(200)}
        counts = pages.withColumns({name: value for name, value in extra.items() if name not in pages.columns})
        counts = counts.select(*page, "n_rows", "total", "status")
    first = filters.drop_blank_key(listing).groupBy("source", "run_id", "url").agg(F.min("page_no").alias("page_no"))
    new = first.groupBy(*page).agg(F.count("*").alias("n_new"))
    counts = counts.join(new, page, "left").fillna(0, ["n_new"])
    return counts if pages is not None else counts.withColumn("status", F.lit(200))


def collect_feed_items(
    items: DataFrame, current: DataFrame, seen: DataFrame, policy: Policy, as_of: date
) -> RunResult:
    """Run of a source without ordered logic: record keys, the first item of a key wins.

    ``items`` has the record columns and ``pos``.
    """
    keyed = items.withColumn("record_key", keys.record_key())
    old = current.withColumn("record_key", keys.record_key())
    known = keys.known_keys(old, seen, key="record_key")
    keyed = materialize(keyed, "captured")
    first = keyed.groupBy("record_key").agg(F.min("pos").alias("pos"))
    new = materialize(keys.new_records(first, known, "record_key", spread_by=["pos"]), "new-keys")
    fresh = keyed.join(new, ["record_key", "pos"], "left_semi")
    return _finish(policy, current, known, keyed, fresh, as_of, policy.days, captured=keyed)


def walk_listing_pages(
    pages: DataFrame,
    rule: SiteRule,
    known: DataFrame,
    *,
    streak: int,
    page_rule: str,
    max_pages: int = 0,
    cards: bool = False,
) -> DataFrame:
    """Distinct detail links of a captured listing, in walk order, with ``known``.

    ``pages`` has ``source, run_id, page_no, status, html`` and may have ``total``.
    With ``cards`` the listing cards give the links and their columns.
    """
    carry = ("source", "run_id", "page_no")
    links = extract.listing_cards(pages, rule, carry) if cards else extract.detail_links(pages, rule, carry)
    links = materialize(links.withColumn("ord", listing_order(F.col("page_no"), F.col("pos"))).drop("pos"), "links")
    first = ordered.first_seen(links, ("source", "run_id", "url"))
    first = materialize(keys.known_flag(first, known, spread_by=["source", "run_id"]), "first-links")
    counts = links.groupBy(*carry).agg(F.count("*").alias("n_rows"))
    new = first.groupBy(*carry).agg(F.count("*").alias("n_new"))
    total = F.col("total") if "total" in pages.columns else F.lit(None).cast("bigint")
    frame = pages.select(*carry, "status", total.alias("total"))
    frame = frame.join(counts, list(carry), "left").join(new, list(carry), "left").fillna(0, ["n_rows", "n_new"])
    cuts = [ordered.page_cut(ordered.last_page(frame, page_rule, max_pages))]
    if streak > 0:
        cuts.append(ordered.streak_cut(first, streak, "a"))
    return ordered.apply_cut(first, ordered.earliest_cut(cuts))


# Counts of a run over pages: links walked and new, records kept, failed fetches, records out of the window, dropped by
# language (kept, but without a new key after the language filter).
REPORT = ("n_links", "n_new", "n_ok", "n_errors", "n_out_of_window", "n_language")

# What ends a listing of the HTML sources.
PAGE_RULES = {"jobup": "total", "talent": "empty", "ge": "no_new"}


def collect_pages(
    list_pages: DataFrame,
    detail_pages: DataFrame,
    current: DataFrame,
    seen: DataFrame,
    rule: SiteRule,
    policy: Policy,
    as_of: date,
    *,
    days: int | None = None,
    stop_after_known: int | None = None,
    max_jobs: int = 0,
    max_pages: int = 0,
    page_rule: str | None = None,
    feed: DataFrame | None = None,
    detail: str = "graph",
    master: DataFrame | None = None,
) -> RunResult:
    """Run of a source with listing pages and detail pages.

    ``detail_pages`` has ``url, html``. Only pages of new links give records; a new
    link without a page, or with one that cannot be read, is a failed fetch.
    ``detail`` names the record form: ``graph``, ``nested`` or ``page``. ``master``
    turns on the two-level mode: its keys count for the streak but not as known,
    fresh records go into it, and it goes into the output. ``report`` of the result is counted
    while the tables of the run are written, without another pass.
    """
    days = policy.days if days is None else days
    stop = policy.stop_after_known if stop_after_known is None else stop_after_known
    known = keys.known_keys(current, seen)
    walked = walk_listing_pages(
        list_pages,
        rule,
        known if master is None else keys.known_keys(current, seen, master),
        streak=stop,
        page_rule=page_rule or PAGE_RULES[rule.name],
        max_pages=max_pages,
        cards=detail == "page",
    )
    walked, counts = materialize_counted(walked, "walked", n_links=F.count("*"))
    if master is None:
        new = walked.filter(~F.col("known"))
    else:
        new = keys.new_records(walked, known, spread_by=["source", "run_id"])
    new = ordered.limit_new(new.drop("known"), max_jobs)
    new, found = materialize_counted(new, "new", n_new=F.count("*"))
    # Markup is not shuffled: a filter of the new links selects the pages to parse, and the parsed
    # records join the links.
    wanted = keys.likely(detail_pages, new)
    if detail == "page":
        empty = list_pages.sparkSession.createDataFrame(
            [], "url string, title string, posting_date string, summary string"
        )
        details = assemble_ge(new, extract.page_detail(wanted), feed if feed is not None else empty)
        details = details.withColumn("ok", F.lit(True))
    else:
        parse = {"graph": extract.detail_record_graph, "nested": extract.detail_record_nested}[detail]
        details = new.select("url", "ord").join(parse(wanted), "url", "left")
        details = details.withColumn("ok", F.coalesce("ok", F.lit(False)))
    recent = filters.is_recent(F.col("posting_date"), as_of, days) if policy.fresh_days else F.lit(True)
    details, read = materialize_counted(
        details.withColumn("pos", F.col("ord")),
        "details",
        n_ok=F.count_if(F.col("ok") & recent),
        n_errors=F.count_if(~F.col("ok")),
        n_out_of_window=F.count_if(F.col("ok") & ~recent),
    )
    if detail == "page":
        # Here a link without a page has no row at all.
        read |= {"n_errors": max(found["n_new"] - read["n_ok"] - read["n_out_of_window"], 0)}
    counts = counts | found | read | {"n_language": 0}
    fresh = details.filter("ok")
    if policy.fresh_days:
        fresh = filters.within_days(fresh, as_of, days)
    spark = list_pages.sparkSession
    if master is None:
        added = Observation("added") if policy.language == "fr_en" and not policy.record_key else None
        run = _finish(policy, current, known, walked, fresh, as_of, days, details, added=added)
        if added is not None:
            counts["n_language"] = max(counts["n_ok"] - added.get["n_added"], 0)
        return replace(run, report=_report(spark, counts))
    new_master, merged = merge.merge_two_level(current, master, fresh.select(_shared(master, fresh)))
    written = filters.within_days(merged, as_of, days) if policy.output_days else merged
    seen = keys.known_keys(known, walked.select("url"), new_master.select("url"))
    return RunResult(walked, fresh, merged, written, seen, details, new_master, _report(spark, counts))


def _report(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """One row: links walked, new ones, and of these what became of their pages."""
    return spark.createDataFrame([tuple(counts[name] for name in REPORT)], ", ".join(f"{name} bigint" for name in REPORT))
