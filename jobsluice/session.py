"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Up to this many narrow rows (a key and a few numbers) a table may be broadcast.
BROADCAST_ROWS = 500_000


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect."""
    builder = SparkSession.builder.appName("jobsluice")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings needed on a session somebody else built.

    Repeated JSON keys must keep the last value instead of turning the whole
    document into NULL.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="jobsluice-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/jobsluice/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where one expensive result feeds several branches: the lineage ends at
    a written table, so a lost executor costs a file read and not a recompute.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, label: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """``materialize``, and aggregates over the rows that are taken while they are written.

    They sit right below the write, in the stage of which Spark counts every partition once, so a task that
    runs twice does not change them.
    """
    seen = Observation(label)
    stored = materialize(df.observe(seen, *[c.alias(name) for name, c in counts.items()]), label)
    return stored, seen.get


def broadcast_if_small(stored: DataFrame) -> DataFrame:
    """Mark a stored table of narrow rows for broadcast if its row count allows."""
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored
