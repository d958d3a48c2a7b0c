"""Keyed upsert with stable ids.

``current`` and ``fresh`` have the same columns: the key, ``id`` (may be NULL), a
bigint ``pos`` (place in the batch, unique) and the payload. Per key the last
fresh row replaces the whole current row but keeps the id of the last current
row. Other keys of ``fresh`` get the next ids in the order they first appear;
then, with ``backfill``, current rows without an id do.

The winner of every key is found on narrow rows, which collapse before the
shuffle, so a hot key costs no more than a cold one. Only keys that need an id are
numbered. The payload of the fresh batch moves once, that of the current table
only if more rows change than a broadcast may hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from jobsluice.functions.text import strip
from jobsluice.operators.filters import french_or_english
from jobsluice.operators.keys import record_key
from jobsluice.operators.ordered import dense_numbers
from jobsluice.session import broadcast_if_small, materialize


def max_id(df: DataFrame) -> DataFrame:
    """One row with the largest id, at least 0."""
    return df.agg(F.greatest(F.coalesce(F.max("id"), F.lit(0)), F.lit(0)).cast("bigint").alias("max_id"))


def assign_ids(rows: DataFrame, start: int, ord_col: str = "ord") -> DataFrame:
    """Give every row the next free id after ``start``, in the order of ``ord_col``."""
    rows = materialize(rows.withColumn("_all", F.lit(0)), "number")
    numbered = dense_numbers(rows, ["_all"], ord_col).drop("_all")
    return numbered.withColumn("id", F.col("rn") + F.lit(start)).drop("rn")


def _merge(
    current: DataFrame,
    fresh: DataFrame,
    key: Column,
    start: int,
    backfill: bool,
    preserve: Sequence[str],
    captured: DataFrame | None = None,
    table: DataFrame | None = None,
    added: Observation | None = None,
) -> DataFrame:
    """``fresh`` into ``current``; payloads are read from ``captured`` and ``table`` if given."""
    payload = [c for c in current.columns if c not in ("id", "pos")]

    def keyed(batch: DataFrame) -> DataFrame:
        return batch.withColumn("_key", key).filter(F.col("_key") != "")

    # First pass over key, id and pos alone: plain numbers, so Spark hashes them.
    both = keyed(current).withColumn("_batch", F.lit(0)).unionByName(
        keyed(fresh).withColumn("_batch", F.lit(1)), allowMissingColumns=True
    )
    old_pos = F.when(F.col("_batch") == 0, F.col("pos"))
    new_pos = F.when(F.col("_batch") == 1, F.col("pos"))
    narrow = both.groupBy("_key").agg(
        F.max_by("id", old_pos).alias("_id"),
        F.min(new_pos).alias("_first_new"),
        F.min(old_pos).alias("_first_old"),
        F.max(new_pos).alias("_last_new"),
        F.max(old_pos).alias("_last_old"),
        *[F.max_by(c, old_pos).alias(f"_old_{c}") for c in preserve],
    )
    if added is not None:
        only_new = F.col("_first_new").isNotNull() & F.col("_first_old").isNull()
        narrow = narrow.observe(added, F.count_if(only_new).alias("n_added"))
    narrow = narrow.select(
        "_key",
        "_id",
        F.col("_first_new").isNull().alias("_late"),
        F.coalesce("_first_new", "_first_old").alias("_ord"),
        F.coalesce("_last_new", "_last_old").alias("pos"),
        *[f"_old_{c}" for c in preserve],
    )
    narrow = materialize(narrow, "merge-keys")
    winners = narrow.drop("_ord").join(_new_ids(narrow, start, backfill), "_key", "left")

    # Fresh rows that won get their id; their payload is found by place in the batch.
    fresh_rows = keyed(fresh if captured is None else captured)
    if "id" in fresh_rows.columns:
        fresh_rows = fresh_rows.drop("id")
    won = fresh_rows.join(winners.filter(~F.col("_late")).drop("_late"), ["_key", "pos"])
    absent = [c for c in payload if c not in fresh_rows.columns]
    won = won.withColumns({c: F.lit(None).cast(current.schema[c].dataType) for c in absent})
    columns = [F.coalesce(f"_old_{c}", c).alias(c) if c in preserve else F.col(c) for c in payload]
    won = won.select(F.coalesce("_id", "_new_id").alias("id"), *columns)

    # Current rows pass as they are, but for those that lost and those that get an id.
    # These are few in a usual run, so the payload of the table does not move.
    old = keyed(current if table is None else table)
    stays = winners.filter("_late").select("_key", "pos", "_new_id", F.lit(True).alias("_stays"))
    changes = old.select("_key", "pos").join(stays, ["_key", "pos"], "left")
    changes = changes.filter(F.col("_stays").isNull() | F.col("_new_id").isNotNull())
    changes = changes.select("_key", "pos", "_new_id", F.coalesce("_stays", F.lit(False)).alias("_stays"))
    changes = broadcast_if_small(materialize(changes, "merge-changes"))
    kept = old.join(changes, ["_key", "pos"], "left").filter(F.coalesce("_stays", F.lit(True)))
    return kept.select(F.coalesce("id", "_new_id").alias("id"), *payload).unionByName(won)


def _new_ids(narrow: DataFrame, start: int, backfill: bool) -> DataFrame:
    """``_key`` and ``_new_id`` of the keys without an id: fresh ones first, then current ones."""
    todo = narrow.filter(F.col("_id").isNull()).select("_key", "_late", "_ord")
    if not backfill:
        todo = todo.filter(~F.col("_late"))
    counts = {row["_late"]: row["n"] for row in todo.groupBy("_late").agg(F.count("*").alias("n")).collect()}
    numbers = dense_numbers(todo, ["_late"], "_ord")
    offset = F.when(F.col("_late"), start + counts.get(False, 0)).otherwise(start)
    return materialize(numbers.select("_key", (F.col("rn") + offset).alias("_new_id")), "new-ids")


def merge_by_url(
    current: DataFrame,
    fresh: DataFrame,
    *,
    language: bool = False,
    backfill: bool = True,
    preserve: Sequence[str] = (),
    captured: DataFrame | None = None,
    added: Observation | None = None,
) -> DataFrame:
    """Upsert on the trimmed URL; rows without one are dropped.

    ``language`` drops rows that are neither French nor English on both sides
    first; the largest id still covers them. ``preserve`` names columns whose
    current value survives the replacement (labels, for instance). If ``fresh`` is
    the outcome of joins over a stored table, ``captured`` names that table: the
    payload is then read from there by position and takes no part in those joins. ``added``
    observes ``n_added``, the keys that only ``fresh`` has, as the narrow rows are written.
    """
    start = max_id(current).first()["max_id"]
    key = strip(F.coalesce(F.col("url"), F.lit("")))
    if not language:
        return _merge(current, fresh, key, start, backfill, preserve, captured, added=added)
    # The test runs in the first pass; rows it drops are no winners in the second.
    captured = fresh if captured is None else captured
    kept, new = french_or_english(current), french_or_english(fresh)
    return _merge(kept, new, key, start, backfill, preserve, captured, table=current, added=added)


def merge_by_key(
    current: DataFrame, fresh: DataFrame, preserve: Sequence[str] = (), captured: DataFrame | None = None
) -> DataFrame:
    """Upsert on the record key; current rows without an id stay without one."""
    start = max_id(current).first()["max_id"]
    return _merge(current, fresh, record_key(), start, False, preserve, captured)


def merge_two_level(output: DataFrame, master: DataFrame, fresh: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fresh into master, then master into output; ids of the output win.

    Returns the new master and the new output.
    """
    new_master = materialize(merge_by_url(master, fresh), "master")
    # The master is listed newest first, that order decides new ids in the output.
    top = F.lit(2**62)
    as_batch = new_master.withColumn("pos", top - F.col("id"))
    return new_master, merge_by_url(output, as_batch)
