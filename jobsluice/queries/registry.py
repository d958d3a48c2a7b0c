"""Registry of queries and small helpers they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsluice.session import configure

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under ``name`` with the SQL that gives the same rows."""

    def add(run: Run) -> Run:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir)

        REGISTRY[name] = Query(configured, sql)
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str, size: int) -> DataFrame:
    """``rows`` in partitions of about ``size``, where a table of few row groups would be the work of few tasks."""
    parts = -(-rows.count() // size)
    return rows.repartition(parts, key) if parts > 1 else rows


def fmt(day: Column, pattern: str) -> Column:
    return F.date_format(day, pattern)


def json_pages(rows: DataFrame, item: Column, key: str, size: int) -> DataFrame:
    """Rows packed into JSON lists of at most ``size`` items: ``page_no`` from 1 and ``items``.

    ``key`` is unique and counts from 0, so a list never holds more than ``size``.
    """
    packed = rows.select(
        (F.floor(F.col(key) / size) + 1).cast("bigint").alias("page_no"),
        F.col(key).alias("_key"),
        F.to_json(item, {"ignoreNullFields": "false"}).alias("_item"),
    )
    lists = packed.groupBy("page_no").agg(F.array_sort(F.collect_list(F.struct("_key", "_item"))).alias("_list"))
    return lists.select("page_no", F.concat(F.lit("["), F.array_join("_list._item", ","), F.lit("]")).alias("items"))
