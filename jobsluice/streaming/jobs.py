"""Structured Streaming jobs. Every micro-batch is one incremental run."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from jobsluice.operators import filters, keys, merge, ordered
from jobsluice.plans.collect import collect_listing
from jobsluice.schema import Policy
from jobsluice.sources.sinks import SnapshotStore, read_table
from jobsluice.session import materialize


def file_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """Captured rows landing as Parquet files below ``path``."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def run_available(rows: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process everything that has landed, then stop; the next call goes on from there."""
    query = (
        rows.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest(store: SnapshotStore, policy: Policy, as_of: Callable[[DataFrame], date | None], **options):
    """Batch function: run the listing of a micro-batch against the stored tables.

    The run id comes from the batch id, so a batch that is replayed after a
    failure changes nothing.
    """

    def on_batch(listing: DataFrame, batch_id: int) -> None:
        run_id = f"batch-{batch_id}"
        version, done = store.state(run_id)
        day = as_of(listing)
        if done or day is None:
            return
        current = store.jobs(version)
        rows = current.withColumn("pos", F.lit(2**62) - F.coalesce(F.col("id"), F.lit(0)))
        run = collect_listing(listing, rows, store.seen(version), policy, day, **options)
        store.commit(run.written.select(current.columns), run.seen, run_id, day.isoformat())

    return on_batch


def first_seen_stream(
    rows: DataFrame, path: str, checkpoint: str, event_time: str | None = None, keep: str = "30 days"
) -> StreamingQuery:
    """Distinct keys of a stream, each written once.

    With ``event_time`` a key is held for at least ``keep`` and forgotten once the
    watermark, which trails the stream by ``keep``, is as far past it. That bounds the
    state; a forgotten key is written again when it comes back.
    """
    if event_time is None:
        unique = rows.select("key").dropDuplicates(["key"])
    else:
        timed = rows.select("key", F.col(event_time).cast("timestamp").alias("seen_at"))
        unique = timed.withWatermark("seen_at", keep).dropDuplicatesWithinWatermark(["key"]).select("key")
    return (
        unique.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def retain(store: SnapshotStore, as_of: Callable[[DataFrame], date | None], days: int):
    """Batch function with bounded state: a key leaves the table when its day leaves the window.

    Rows have ``url, posting_date, pos``. A key that is in the table is not looked
    at again; one that has left is taken up as new.
    """

    def on_batch(rows: DataFrame, batch_id: int) -> None:
        run_id = f"batch-{batch_id}"
        version, done = store.state(run_id)
        day = as_of(rows)
        if done or day is None:
            return
        current = store.jobs(version)
        first = ordered.batch_dedup(rows, "url", "first", "pos")
        fresh = keys.new_records(first, keys.known_keys(current), spread_by=["pos"])
        fresh = materialize(filters.within_days(fresh, day, days), "fresh")
        kept = current.withColumn("pos", F.lit(2**62) - F.coalesce(F.col("id"), F.lit(0)))
        merged = merge.merge_by_url(kept, fresh.select("url", "posting_date", "pos"))
        written = materialize(filters.within_days(merged, day, days), "written")
        store.commit(written.select(current.columns), keys.next_seen("persisted", written=written), run_id, str(day))

    return on_batch


def drop_late(path: str, as_of: Callable[[DataFrame], date | None], days: int):
    """Batch function: append the rows inside the window as of the batch to a table."""

    def on_batch(rows: DataFrame, batch_id: int) -> None:
        day = as_of(rows)
        if day is None:
            return
        kept = filters.within_days(rows, day, days)
        kept.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return on_batch


STREAKS = "source string, run_id string, streak bigint, done boolean, batch int"
LISTED = "source string, run_id string, url string, batch int"


def cut_streaks(path: str, known: DataFrame, n: int, variant: str):
    """Batch function: listings up to their known streak, wherever their pieces end.

    Rows go to ``path/batch=<id>``. ``path/state`` holds for every listing the streak that its last piece ended with
    and whether it was cut; a piece goes on from there, and nothing is taken from a listing after its cut. Variant
    ``a`` also keeps the URLs of open listings, since a URL counts once. The state of a batch is read from the
    batches before it, so a batch that is replayed writes the same again. ``n <= 0`` keeps all.
    """

    def on_batch(listing: DataFrame, batch_id: int) -> None:
        spark = listing.sparkSession
        rows = materialize(keys.known_flag(listing, known, spread_by=["source", "run_id", "ord"]), "micro-batch")
        if n <= 0:
            rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
            return
        states = read_table(spark, f"{path}/state", STREAKS).where(F.col("batch") < batch_id)
        last = states.agg(F.max("batch").alias("batch")).first()["batch"]
        state = states.where(F.col("batch") == (-1 if last is None else last)).drop("batch")
        listings = list(ordered.GROUP)
        rows = rows.join(state.where("done").select(listings), listings, "left_anti")
        counted = rows
        if variant == "a":
            urls = read_table(spark, f"{path}/urls", LISTED).where(F.col("batch") < batch_id)
            counted = rows.join(urls.select(*listings, "url"), [*listings, "url"], "left_anti")
        counted = materialize(ordered.streak_rows(counted, variant), "streak")
        ends = materialize(ordered.streak_on(counted, state, n), "streak-ends")
        ordered.apply_cut(rows, ends.select(*listings, "cut")).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if variant == "a":
            open_ = rows.join(ends.where("cut is not null").select(listings), listings, "left_anti")
            open_.select(*listings, "url").distinct().write.mode("overwrite").parquet(f"{path}/urls/batch={batch_id}")
        now = ends.select(*listings, "streak", F.col("cut").isNotNull().alias("done"))
        kept = state.join(now.select(listings), listings, "left_anti")
        now.unionByName(kept).write.mode("overwrite").parquet(f"{path}/state/batch={batch_id}")

    return on_batch


FIRST_SEEN_RUNS = "n_rows bigint, n_late bigint, n_new bigint, last_day date, batch int"


def live_batches(spark: SparkSession, path: str, before: int, oldest: date | None) -> list[int]:
    """The batches of ``first_seen`` before ``before`` that hold keys of ``oldest`` or later days."""
    runs = read_table(spark, f"{path}/runs", FIRST_SEEN_RUNS).where(F.col("batch") < before)
    if oldest is not None:
        runs = runs.where(F.col("last_day") >= F.lit(oldest))
    return sorted(r["batch"] for r in runs.where("n_new > 0").select("batch").collect())


def first_seen(path: str, keep_days: int | None = None):
    """Batch function: keys that no batch before has written, to ``path/keys/batch=<id>``; no stream state.

    The written keys are the state: a batch joins them away by their key, which Spark shuffles and spills as any table.
    With ``keep_days`` rows have a ``day``; a key is looked for in the batches of the last ``keep_days`` days of the
    stream only, so the table that is read stays as large as that window, and a key that comes back later is
    written again. Rows older than the window, or without a day, are dropped as late. ``path/runs`` counts rows,
    late rows and new keys of every batch. A batch that is replayed writes the same again.
    """

    def on_batch(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        rows = rows.select("key", (F.col("day") if keep_days is not None else F.lit(None)).cast("date").alias("day"))
        # A row for each day of the batch.
        days = {r["day"]: r["n"] for r in rows.groupBy("day").agg(F.count("*").alias("n")).collect()}
        last = oldest = None
        if keep_days is not None:
            before = read_table(spark, f"{path}/runs", FIRST_SEEN_RUNS).where(F.col("batch") < batch_id)
            known_days = [before.agg(F.max("last_day").alias("d")).first()["d"], *days]
            last = max((d for d in known_days if d is not None), default=None)
            if last is None:
                return
            oldest = last - timedelta(days=keep_days)
            rows = rows.where(F.col("day") >= F.lit(oldest))
        fresh = rows.where("key is not null").groupBy("key").agg(F.max("day").alias("day"))
        paths = [f"{path}/keys/batch={b}" for b in live_batches(spark, path, batch_id, oldest)]
        if paths:
            known = spark.read.schema("key string, day date").parquet(*paths)
            if oldest is not None:
                known = known.where(F.col("day") >= F.lit(oldest))
            fresh = fresh.join(known.select("key"), "key", "left_anti")
        out = f"{path}/keys/batch={batch_id}"
        fresh.write.mode("overwrite").parquet(out)
        n_new = spark.read.schema("key string").parquet(out).count()
        n_late = 0 if oldest is None else sum(n for d, n in days.items() if d is None or d < oldest)
        row = [(sum(days.values()), n_late, n_new, last)]
        runs = spark.createDataFrame(row, FIRST_SEEN_RUNS.rpartition(",")[0])
        runs.coalesce(1).write.mode("overwrite").parquet(f"{path}/runs/batch={batch_id}")

    return on_batch
