"""Mixing sources to target shares by weighted sampling without replacement.

Every source gets a target number of words: a share of all words by its weight, at most ``REPEATS``
times its own words, the excess shared again by weight. A source takes complete epochs first. For
the rest every document draws an exponential key divided by its quality weight (the smaller, the
earlier), and documents are taken in key order until their words reach the rest; the last one counts
if at least half of it fits. Keys are hashes of the document, so that reruns agree.

Prefix sums run over one global order of (source, key): the rows are range-partitioned, summed inside
a range and shifted by the totals of the ranges before it. A source of any size is spread over as
many ranges as its rows need; no source, and no list of sources, has to fit one task.

Defined results: NULL and empty texts have size 0 and nothing is taken from them; a NULL source is a
source, sorted last; repeated rows are rows of their own and share a key, their order is of no
consequence; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsluice.llm.shared import stored

WEIGHTS = (5, 2, 1)
REPEATS = 3
SYMBOLS = "#*$%&|<>"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint"), F.lit(0).cast("bigint"))


def quality_weight(text: Column, size: Column) -> Column:
    """Between 0 and 1: the share of words among words and symbols."""
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return F.coalesce(F.try_divide(size.cast("double"), size + symbols), F.lit(1.0))


def uniform(doc_id: Column, text: Column) -> Column:
    """A number in (0, 1) from 52 bits of a hash of the document."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def running_totals(rows: DataFrame, order: list[Column], **values: Column) -> DataFrame:
    """``rows`` with, for each name, the sum of its value over all rows up to and including the row.

    The order is global. Each task sums one range of it; the totals of the ranges, one row a range,
    are summed in a window of their own.
    """
    ranged = rows.withColumns(values).repartitionByRange(*order)
    ranged = stored(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy("_range").agg(*[F.sum(n).alias(f"_all_{n}") for n in values])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("_range", *[F.coalesce(F.sum(f"_all_{n}").over(before), F.lit(0)).alias(f"_shift_{n}") for n in values])
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumns({n: F.sum(n).over(inside) for n in values})
    summed = summed.join(F.broadcast(shifts), "_range")
    return summed.withColumns({n: F.col(n) + F.col(f"_shift_{n}") for n in values}).select(*rows.columns, *values)


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``source``, ``source_size`` with ``target`` and ``before`` (words of the sources ahead in order).

    A source stops at ``cap`` if its share at the final rate exceeds it. In the order of cap by
    weight the sources that stop come first: the rate is (all - their caps) / (weights of the
    others), at the first place where it does not lift the next source above its cap.
    """
    ranked = running_totals(
        sources, [F.col("source").asc_nulls_last()], rank=F.lit(1).cast("bigint"), upto=F.col("source_size")
    )
    at = (F.col("rank") - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (at + 1).cast("int")).cast("bigint")
    ranked = ranked.select(
        "source",
        "source_size",
        (F.col("upto") - F.col("source_size")).alias("before"),
        weight.alias("weight"),
        (repeats * F.col("source_size")).alias("cap"),
    )
    order = [F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()]
    ranked = stored(running_totals(ranked, order, caps=F.col("cap"), used=F.col("weight")), "sources")
    if ranked.isEmpty():
        return ranked.select("source", "source_size", "before", F.lit(0.0).alias("target"))
    whole = ranked.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    # The rate if all sources ahead of this one in the order of cap by weight stop.
    rate = (whole["words"] - (F.col("caps") - F.col("cap"))) / (whole["weight"] - (F.col("used") - F.col("weight")))
    open_ = rate * F.col("weight") <= F.col("cap")
    final = ranked.agg(F.min_by(F.when(open_, rate), F.when(open_, F.col("used"))).alias("rate")).first()["rate"]
    share = F.lit(final) * F.col("weight")
    target = F.when(share <= F.col("cap"), share).otherwise(F.col("cap").cast("double"))
    return ranked.select("source", "source_size", "before", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
    quality: Column | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``taken``.

    ``quality`` is a positive column of ``docs``, by default ``quality_weight`` of the text.
    """
    text, size = F.col("text"), word_count(F.col("text"))
    weight = quality_weight(text, size) if quality is None else quality
    key = -F.log(uniform(F.col("doc_id"), text)) / F.greatest(weight, F.lit(1e-6))
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"), key.alias("key"))
    rows = stored(rows, "sizes")
    sources = targets(stored(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sources"), weights, repeats)
    sources = stored(sources, "targets")
    order = [F.col("source").asc_nulls_last(), F.col("key"), F.col("doc_id")]
    summed = running_totals(rows, order, upto=F.col("size"))
    joined = summed.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    epochs = F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0))
    rest = F.col("target") - epochs * F.col("source_size")
    within = F.col("upto") - F.col("before") - F.col("size") / 2 <= rest
    taken = epochs * F.col("size") + F.when(within, F.col("size")).otherwise(0)
    return joined.select("doc_id", "source", "size", "source_size", "target", taken.cast("bigint").alias("taken"))
