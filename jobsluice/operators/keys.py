"""Key sets: known keys, new records, membership flags, next seen state.

One key may hold a large share of the rows. Sets are built with distinct, which
collapses repeats before the shuffle. A membership join cannot do that, so it
spreads the hot keys: ``HOT_ROWS`` rows of one key are more than one task should
take, and such keys get a salt on the row side and copies on the key side, one for
every ``HOT_ROWS`` of their measured count. The salt hashes ``spread_by`` (all columns
if not given), which should tell rows of one key apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsluice.functions.text import filled, strip
from jobsluice.session import materialize

HOT_ROWS = 1_000_000


def record_key() -> Column:
    """Trimmed URL, else ``title|company|location`` in lower case; never empty."""
    parts = [F.lower(strip(F.coalesce(F.col(c), F.lit("")))) for c in ("title", "company", "location")]
    return F.coalesce(filled(strip(F.col("url"))), F.concat_ws("|", *parts))


def key_set(df: DataFrame, key: str = "url") -> DataFrame:
    """Distinct trimmed keys of a table, blanks dropped, as column ``key``."""
    return df.select(strip(F.col(key)).alias("key")).filter(F.col("key") != "").distinct()


def known_keys(*tables: DataFrame, key: str = "url") -> DataFrame:
    """Union of the keys of all tables (records, seen state, older masters)."""
    trimmed = [t.select(strip(F.col("key" if "key" in t.columns else key)).alias("key")) for t in tables]
    return reduce(DataFrame.unionByName, trimmed).filter(F.col("key") != "").distinct()


def _salted(
    rows: DataFrame, keys: DataFrame, key: str, hot_rows: int, spread_by: Sequence[str] | None
) -> tuple[DataFrame, DataFrame]:
    # A hot key is dealt over as many salts as its count has portions of ``hot_rows``.
    counts = rows.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows)
    salts = F.ceil(F.col("_n") / F.lit(max(hot_rows, 1))).cast("int")
    # A stored table, so that its measured size decides whether Spark broadcasts it.
    hot = materialize(counts.select(F.col(key).alias("_hot"), salts.alias("_salts")), "hot-keys")
    # The salt is a hash of the row, so a task that runs twice sends its rows the same way.
    bucket = F.pmod(F.xxhash64(*(spread_by or rows.columns)), F.col("_salts")).cast("int")
    left = rows.join(hot, F.col(key) == F.col("_hot"), "left")
    left = left.withColumn("_salt", F.coalesce(bucket, F.lit(0))).drop("_hot", "_salts")
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    right = keys.join(hot, F.col("key") == F.col("_hot"), "left").select(
        F.col("key").alias("_known"), F.explode(copies).alias("_copy")
    )
    return left, right


def new_records(
    rows: DataFrame,
    known: DataFrame,
    key: str = "url",
    hot_rows: int = HOT_ROWS,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Rows whose key is not known. ``known`` has one column ``key``."""
    left, right = _salted(rows, known, key, hot_rows, spread_by)
    match = (F.col(key) == F.col("_known")) & (F.col("_salt") == F.col("_copy"))
    return left.join(right, match, "left_anti").drop("_salt")


def known_flag(
    rows: DataFrame,
    known: DataFrame,
    key: str = "url",
    hot_rows: int = HOT_ROWS,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Rows with ``known``: whether the key is in the set. ``known`` holds distinct keys."""
    left, right = _salted(rows, known, key, hot_rows, spread_by)
    match = (F.col(key) == F.col("_known")) & (F.col("_salt") == F.col("_copy"))
    joined = left.join(right, match, "left")
    return joined.withColumn("known", F.col("_known").isNotNull()).drop("_salt", "_known", "_copy")


# Bits of the filter of ``likely``: at most 32 MB, whatever the number of keys.
FILTER_BITS = 1 << 28


def likely(rows: DataFrame, wanted: DataFrame, key: str = "url") -> DataFrame:
    """``rows`` without most of those whose key is not among ``wanted`` (one column ``key``).

    Every row of a wanted key stays, a few others do too; an exact join has to follow. Keys set one
    bit each in bitmaps of 4 KB, which are broadcast, so that wide rows are not shuffled.
    """
    place = lambda column: F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))
    bits = wanted.select(place(key).alias("_h"))
    bits = bits.groupBy(F.bitmap_bucket_number("_h").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_h")).alias("_bits")
    )
    at = F.bitmap_bit_position(place(key))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1
    met = rows.join(F.broadcast(bits), F.bitmap_bucket_number(place(key)) == F.col("_bucket"))
    return met.filter(is_set).select(*rows.columns)


def added_keys(before: DataFrame, after: DataFrame, key: str = "url") -> DataFrame:
    """Keys of ``after`` that ``before`` lacks."""
    return key_set(after, key).join(key_set(before, key), "key", "left_anti")


def next_seen(
    policy: str,
    *,
    known: DataFrame | None = None,
    listing: DataFrame | None = None,
    merged: DataFrame | None = None,
    written: DataFrame | None = None,
    fresh: DataFrame | None = None,
    key: str = "url",
) -> DataFrame:
    """The keys the next run knows.

    ``all``: known, every listing row and every merged record. ``merged``: merged
    records alone. ``persisted``: records left after the output filter. ``fresh``:
    known and the new records.
    """
    tables = {
        "all": (known, listing, merged),
        "merged": (merged,),
        "persisted": (written,),
        "fresh": (known, fresh),
    }[policy]
    return known_keys(*[t for t in tables if t is not None], key=key)


def sorted_seen(seen: DataFrame) -> DataFrame:
    """Distinct keys in code-point order."""
    return seen.select("key").distinct().orderBy("key")
