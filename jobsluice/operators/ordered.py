"""Ordered logic over listings: streak cut, page prefix, limits, numbering.

A listing is a table with group columns (``source``, ``run_id``) and a sortable
``ord``. One group may hold a large share of all rows. ``running_count`` therefore
splits the order into blocks of bounded width, counts inside a block, and adds the
totals of the blocks before it, which are summed in blocks again, so that no window
ever spans a large group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsluice.schema import listing_order
from jobsluice.session import materialize

GROUP = ("source", "run_id")
SHIFTS = (20, 14)


def running_count(
    df: DataFrame,
    marked: Column | None = None,
    groups: Sequence[str] = GROUP,
    ord_col: str = "ord",
    shifts: tuple[int, int] = SHIFTS,
    weight: Column | None = None,
) -> DataFrame:
    """Add ``rn`` and ``last_mark`` in the order of ``ord_col`` within a group.

    ``rn`` numbers the rows of a group 1, 2, 3 …, or with ``weight`` sums it up to
    and including the row. ``last_mark`` is ``rn`` of the latest marked row up to
    and including the row, 0 if there is none. ``ord_col``
    must be unique within a group and not negative. The rows are read twice, so pass
    a stored table.
    """
    groups, keep = list(groups), df.columns
    mark = F.lit(False) if marked is None else marked
    low, high = shifts
    rows = df.withColumn("_b0", F.shiftright(F.col(ord_col), low))
    rows = _count_in(rows, [*groups, "_b0"], ord_col, mark, weight)
    blocks = rows.groupBy(*groups, "_b0").agg(F.max("_n").alias("_total"), F.max("_m").alias("_mark"))
    blocks = materialize(blocks.withColumn("_b1", F.shiftright("_b0", high)), "blocks")

    # Offsets of the blocks within their block of blocks.
    before = Window.partitionBy(*groups, "_b1").orderBy("_b0").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_off", F.coalesce(F.sum("_total").over(before), F.lit(0)))
    blocks = blocks.withColumn("_mark", F.col("_off") + F.col("_mark"))
    blocks = blocks.withColumn("_carry", F.max("_mark").over(before))
    # Offsets of the blocks of blocks.
    tops = blocks.groupBy(*groups, "_b1").agg(
        F.max(F.col("_off") + F.col("_total")).alias("_top_total"), F.max("_mark").alias("_top_mark")
    )
    ahead = Window.partitionBy(*groups).orderBy("_b1").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.withColumn("_top_off", F.coalesce(F.sum("_top_total").over(ahead), F.lit(0)))
    tops = tops.withColumn("_top_mark", F.col("_top_off") + F.col("_top_mark"))
    tops = tops.withColumn("_top_carry", F.max("_top_mark").over(ahead))

    offsets = blocks.join(tops.select(*groups, "_b1", "_top_off", "_top_carry"), [*groups, "_b1"]).select(
        *groups,
        "_b0",
        (F.col("_top_off") + F.col("_off")).alias("_off"),
        F.greatest(F.lit(0), F.col("_top_carry"), F.col("_top_off") + F.col("_carry")).alias("_carry"),
    )
    numbered = rows.join(offsets, [*groups, "_b0"])
    return numbered.select(
        *keep,
        (F.col("_off") + F.col("_n")).alias("rn"),
        F.greatest(F.col("_carry"), F.col("_off") + F.col("_m")).alias("last_mark"),
    )


def _count_in(
    rows: DataFrame, parts: list[str], ord_col: str, marked: Column, weight: Column | None
) -> DataFrame:
    """Add ``_n``, the running number within a part, and ``_m``, that of the latest marked row."""
    upto = Window.partitionBy(*parts).orderBy(ord_col).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_n", F.sum(F.lit(1) if weight is None else weight).over(upto).cast("bigint"))
    return rows.withColumn("_m", F.max(F.when(marked, F.col("_n"))).over(upto))


def dense_numbers(df: DataFrame, groups: Sequence[str], ord_col: str = "ord") -> DataFrame:
    """Add ``rn`` = 1, 2, 3 … in the order of ``ord_col`` within a group."""
    return running_count(df, groups=groups, ord_col=ord_col).drop("last_mark")


def streak_cut(listing: DataFrame, n: int, variant: str = "a", groups: Sequence[str] = GROUP) -> DataFrame:
    """Where ``n`` known rows in a row end a listing: group columns and ``cut`` (an ``ord``).

    ``listing`` has ``url``, ``ord``, ``page_no`` and ``known``. Variant ``a``
    counts the first occurrence of a URL on pages after the first; variant ``b``
    counts every row. Groups without such a streak have no row.
    """
    groups = list(groups)
    counted = materialize(streak_rows(listing, variant, groups), "streak")
    scan = running_count(counted, ~F.col("known"), groups)
    return scan.filter(F.col("rn") - F.col("last_mark") >= n).groupBy(*groups).agg(F.min("ord").alias("cut"))


def streak_rows(listing: DataFrame, variant: str, groups: Sequence[str] = GROUP) -> DataFrame:
    """The rows of a listing that count for a streak: group columns, ``ord`` and ``known``."""
    groups = list(groups)
    if variant != "a":
        return listing.select(*groups, "ord", "known")
    return (
        listing.groupBy(*groups, "url")
        .agg(
            F.min("ord").alias("_first"),
            F.min_by("page_no", "ord").alias("page_no"),
            F.min_by("known", "ord").alias("known"),
        )
        .withColumnRenamed("_first", "ord")
        .filter("page_no > 1")
        .select(*groups, "ord", "known")
    )


def streak_on(counted: DataFrame, state: DataFrame, n: int, groups: Sequence[str] = GROUP) -> DataFrame:
    """Listings that go on: ``cut`` (NULL for none) and the ``streak`` at their end, per group.

    ``counted`` is a stored table of ``streak_rows``; ``state`` has the ``streak`` that each group had before.
    The known rows before the first unknown one lengthen that streak.
    """
    groups = list(groups)
    carried = state.select(*groups, F.col("streak").alias("_carried"))
    scan = running_count(counted, ~F.col("known"), groups).join(carried, groups, "left")
    before = F.when(F.col("last_mark") == 0, F.coalesce("_carried", F.lit(0))).otherwise(0)
    scan = scan.withColumn("_streak", F.col("rn") - F.col("last_mark") + before)
    return scan.groupBy(*groups).agg(
        F.min(F.when(F.col("_streak") >= n, F.col("ord"))).alias("cut"),
        F.max_by("_streak", "ord").cast("bigint").alias("streak"),
    )


def apply_cut(listing: DataFrame, cut: DataFrame, groups: Sequence[str] = GROUP) -> DataFrame:
    """Keep the rows up to and including the cut of their group."""
    kept = listing.join(cut, list(groups), "left")
    return kept.filter(F.col("cut").isNull() | (F.col("ord") <= F.col("cut"))).drop("cut")


def cut_after_streak(listing: DataFrame, n: int, variant: str = "a", groups: Sequence[str] = GROUP) -> DataFrame:
    """The listing up to the row that completes ``n`` known ones; ``n <= 0`` keeps all."""
    if n <= 0:
        return listing
    return apply_cut(listing, materialize(streak_cut(listing, n, variant, groups), "cut"), groups)


def first_seen(listing: DataFrame, keys: Sequence[str] = ("url",)) -> DataFrame:
    """The first row of every key. ``ord`` is unique within a key."""
    return _at_place(listing, keys, "ord", F.min)


def batch_dedup(rows: DataFrame, key: str = "url", keep: str = "first", ord_col: str = "ord") -> DataFrame:
    """One row per key: the first or the last of the batch. ``ord_col`` is unique within a key."""
    return _at_place(rows, [key], ord_col, F.min if keep == "first" else F.max)


def _at_place(rows: DataFrame, keys: Sequence[str], ord_col: str, pick: Callable[[str], Column]) -> DataFrame:
    """The row at the first or last place of every key.

    The places come from a hash aggregate over key and place, which collapses before the shuffle.
    The rows then meet them by key and place, which spreads a hot key; they are hashed, not sorted.
    """
    best = rows.groupBy(*keys).agg(pick(ord_col).alias("_ord"))
    best = best.select(*[F.col(k).alias(f"_key{n}") for n, k in enumerate(keys)], "_ord").hint("shuffle_hash")
    match = F.col(ord_col) == F.col("_ord")
    for n, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_key{n}"))
    return rows.join(best, match, "left_semi")


def limit_new(rows: DataFrame, n: int, groups: Sequence[str] = GROUP) -> DataFrame:
    """The first ``n`` rows of every group in listing order."""
    return limit_prefix(rows, F.lit(True), n, groups)


def limit_prefix(listing: DataFrame, accepted: Column, n: int, groups: Sequence[str] = GROUP) -> DataFrame:
    """Cut every group at its ``n``-th accepted row; later rows are not seen at all."""
    return apply_cut(listing, limit_cut(listing, accepted, n, groups), groups) if n > 0 else listing


def limit_cut(listing: DataFrame, accepted: Column, n: int, groups: Sequence[str] = GROUP) -> DataFrame:
    """Where the ``n``-th accepted row ends a listing; no row if there are fewer. ``n`` is positive."""
    narrow = materialize(listing.filter(accepted).select(*groups, "ord"), "accepted")
    return running_count(narrow, groups=groups).filter(F.col("rn") == n).select(*groups, F.col("ord").alias("cut"))


def page_cut(ends: DataFrame, groups: Sequence[str] = GROUP) -> DataFrame:
    """Last pages as cuts: the place just before the page after them."""
    return ends.select(*groups, (listing_order(F.col("last_page") + 1, F.lit(0)) - 1).alias("cut"))


def earliest_cut(cuts: Sequence[DataFrame], groups: Sequence[str] = GROUP) -> DataFrame:
    """Of several cuts the first one per listing; listings without any have no row."""
    every = reduce(DataFrame.unionByName, cuts)
    return every.groupBy(*groups).agg(F.min("cut").alias("cut"))


def page_summary(listing: DataFrame, groups: Sequence[str] = GROUP) -> DataFrame:
    """Per page: rows ``n_rows`` and URLs first seen there ``n_new``."""
    groups = list(groups)
    new = listing.groupBy(*groups, "url").agg(F.min("page_no").alias("page_no"))
    new = new.groupBy(*groups, "page_no").agg(F.count("*").alias("n_new"))
    rows = listing.groupBy(*groups, "page_no").agg(F.count("*").alias("n_rows"))
    return rows.join(new, [*groups, "page_no"], "left").fillna(0, ["n_new"])


def last_page(
    pages: DataFrame,
    rule: str,
    max_pages: int = 0,
    page_size: int = 25,
    groups: Sequence[str] = GROUP,
) -> DataFrame:
    """The last page a listing walk keeps, per group.

    ``pages`` has ``page_no`` from 1, ``status``, ``n_rows``, ``n_new`` and
    ``total`` (total pages or total rows as the source reports it, may be NULL).
    Rules, named by what ends the walk:

    * ``total``: the page count if page 1 reports one, else an empty page
    * ``empty``: an empty page
    * ``no_new``: an empty page, or a page without a new URL (kept)
    * ``short``: an empty page, a short page (kept), the row total reached (kept)
    * ``distinct``: an empty page, the distinct total reached (kept)

    A bad status ends every walk before its page. Page 1 is always kept. Pages
    after ``max_pages`` are left out if that is positive; by default all count.
    """
    groups = list(groups)
    reported = F.when(F.col("total").isNotNull(), F.col("page_no"))
    if rule == "total":
        reported = F.when(F.col("page_no") == 1, reported)
    totals = pages.groupBy(*groups).agg(
        F.min_by(F.col("total"), reported).alias("_total"), F.min(reported).alias("_total_page")
    )
    walked = pages.join(totals, groups)
    if max_pages > 0:
        walked = walked.filter(F.col("page_no") <= max_pages)
    if rule == "distinct":
        walked = _running_new(walked, groups)

    page = F.col("page_no")
    later = page > 1
    empty = F.col("n_rows") == 0
    stop_before = later & (F.col("status") >= 400)
    stop_at = F.lit(False)
    told = F.coalesce(page >= F.col("_total_page"), F.lit(False))
    if rule == "total":
        stop_before = stop_before | F.when(F.col("_total").isNull(), later & empty).otherwise(page > F.col("_total"))
    else:
        stop_before = stop_before | (later & empty)
    if rule == "no_new":
        stop_at = later & (F.col("n_new") == 0)
    elif rule == "short":
        stop_at = (F.col("n_rows") < page_size) | (told & (page * page_size >= F.col("_total")))
    elif rule == "distinct":
        stop_at = told & (F.col("_distinct") >= F.col("_total"))
    end = F.when(stop_before, page - 1).when(stop_at, page)
    return walked.groupBy(*groups).agg(F.coalesce(F.min(end), F.max("page_no")).cast("bigint").alias("last_page"))


def _running_new(pages: DataFrame, groups: list[str]) -> DataFrame:
    """Add ``_distinct``: URLs seen up to and including the page."""
    pages = materialize(pages, "pages")
    scan = running_count(pages, groups=groups, ord_col="page_no", weight=F.col("n_new"))
    return scan.withColumnRenamed("rn", "_distinct").drop("last_mark")


def page_prefix(listing: DataFrame, ends: DataFrame, groups: Sequence[str] = GROUP) -> DataFrame:
    """The rows on pages up to the last kept one."""
    kept = listing.join(ends, list(groups))
    return kept.filter(F.col("page_no") <= F.col("last_page")).drop("last_page")


def newest_first(df: DataFrame, ord_col: str | None = None) -> DataFrame:
    """Order by id descending, missing ids as 0, ties by first position."""
    ties = [F.col(ord_col)] if ord_col else []
    return df.orderBy(F.coalesce(F.col("id"), F.lit(0)).desc(), *ties)


def distinct_urls(listing: DataFrame, groups: Sequence[str] = GROUP) -> DataFrame:
    """Exact number of distinct URLs per listing."""
    unique = listing.select(*groups, "url").distinct()
    return unique.groupBy(*groups).agg(F.count("*").alias("n_urls"))
