"""Helpers of the corpus operators on the Spark side."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsluice.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back: lineage ends at files."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def private(df: DataFrame, **columns) -> DataFrame:
    """Only the named expressions, so that extra or clashing columns of the input cannot interfere."""
    return df.select(*[c.alias(name) for name, c in columns.items()])


def fits(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows, without counting further."""
    return df.limit(rows + 1).count() <= rows


def fresh(prefix: str) -> str:
    """A column name that no input has."""
    return f"_{prefix}_{uuid.uuid4().hex[:8]}"


def schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def training_rows(doc_id, modulus: int, left_out: int):
    """(held out?) by the checksum of the id's decimal text; a NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus == left_out, F.lit(False))
