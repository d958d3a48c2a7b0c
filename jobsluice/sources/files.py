"""Reading captured files: job arrays, JSON Lines, seen state, snapshots.

One capture is one file and is read whole by one task; files spread over tasks. JSON Lines are split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsluice.functions import variant as V
from jobsluice.functions.binding import bind
from jobsluice.functions.text import strip
from jobsluice.schema import JOB_SCHEMA


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Files as rows ``(path, text)``; no rows if the path does not exist."""
    try:
        files = spark.read.text(path, wholetext=True)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, text string")
    return files.select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def _strict(text: Column, kind: str, mark: str, read_mark: Callable[[Column], Column]) -> Column:
    """A JSON text read as ``kind``, NULL unless the text is one such value as a whole.

    The parser stops after the first value. The text is therefore the first element of a list,
    and ``mark``, a value of the same kind around the text's own digest, has to be its second.
    """
    before, after = mark.split("?")
    listed = F.concat(F.lit("["), text, F.lit(f',{before}"'), F.md5(text), F.lit(f'"{after}]'))
    ends_well = lambda v: read_mark(F.get(v, F.lit(1))) == F.md5(text)
    return bind(F.from_json(listed, f"array<{kind}>"), lambda v: F.when(ends_well(v), F.get(v, F.lit(0))))


def _json_list(text: Column) -> Column:
    """array<variant> of a JSON text that is one list, else NULL."""
    return _strict(text, "array<variant>", "[?]", lambda v: F.try_variant_get(F.get(v, F.lit(0)), "$", "string"))


def job_fields(item: Column, schema: T.StructType) -> list[Column]:
    """Typed columns out of an item; a value of another type is NULL."""
    readers = {
        T.LongType: V.integer_at,
        T.IntegerType: V.integer_at,
        T.DoubleType: V.number_at,
        T.BooleanType: V.boolean_at,
        T.ArrayType: lambda v, path: F.try_variant_get(v, path, "array<string>"),
    }
    out = []
    for field in schema.fields:
        read = readers.get(type(field.dataType), lambda v, path: F.try_variant_get(v, path, "string"))
        out.append(read(item, f"$.{field.name}").cast(field.dataType).alias(field.name))
    return out


def job_schema(spark: SparkSession) -> T.StructType:
    return spark.createDataFrame([], JOB_SCHEMA).schema


def read_items(docs: DataFrame, objects_only: bool = True) -> DataFrame:
    """Elements of files that hold one JSON array, as VARIANT ``item`` with ``path`` and ``pos``."""
    items = docs.select("path", F.posexplode(_json_list(F.col("text"))).alias("pos", "item"))
    items = items.withColumn("pos", F.col("pos").cast("bigint"))
    return items.filter(V.is_object(F.col("item"))) if objects_only else items


def read_job_array(docs: DataFrame, objects_only: bool = True) -> DataFrame:
    """Records of files that hold one JSON array, with ``path`` and ``pos``.

    Broken text or another top level gives no rows; elements that are no objects
    are dropped, or with ``objects_only=False`` kept as empty records.
    """
    items = read_items(docs, objects_only)
    return items.select("path", "pos", *job_fields(F.col("item"), job_schema(docs.sparkSession)))


def read_job_lines(spark: SparkSession, path: str) -> DataFrame:
    """Records of JSON Lines, as ``write_json`` writes them, with ``path``; no rows if nothing is there.

    Large files are split over tasks. A line that is not one JSON object as a whole gives no row.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], "value string")
    items = lines.select(F.input_file_name().alias("path"), V.strict_json(F.col("value")).alias("item"))
    return items.filter(V.is_object(F.col("item"))).select("path", *job_fields(F.col("item"), job_schema(spark)))


def read_seen_state(docs: DataFrame, field: str = "seen_urls", trim: bool = True) -> DataFrame:
    """Keys of state files, with ``path``. Only a list counts; blank keys are dropped.

    ``trim=False`` takes the keys as they are.
    """
    kind = f"struct<{field}: array<string>>"
    whole = _strict(F.col("text"), kind, f'{{"{field}":[?]}}', lambda v: F.get(v[field], F.lit(0)))
    keys = docs.select("path", F.explode(whole[field]).alias("key")).filter(F.col("key").isNotNull())
    if not trim:
        return keys
    return keys.withColumn("key", strip(F.col("key"))).filter(F.col("key") != "")


def snapshot_read(docs: DataFrame) -> DataFrame:
    """Records of snapshot files, older field names aligned, file metadata on every row.

    Ids of a snapshot are texts: they become ``external_id`` and are no ids for a
    later merge.
    """
    parsed = docs.withColumn("_file", V.strict_json(F.col("text")))
    file, item = F.col("_file"), F.col("item")
    items = parsed.select(
        "path", "_file", F.posexplode(V.list_items(file, "$.jobs")).alias("pos", "item")
    ).filter(V.is_object(item))
    old_names = {"posting_date": "date_published", "expiry_date": "date_expiry"}
    fields = []
    for field, column in zip(job_schema(docs.sparkSession).fields, job_fields(item, job_schema(docs.sparkSession))):
        if field.name in old_names:
            older = F.try_variant_get(item, f"$.{old_names[field.name]}", "string")
            column = F.coalesce(older, column).alias(field.name)
        elif field.name == "external_id":
            column = F.coalesce(column, V.string_at(item, "$.id")).alias("external_id")
        fields.append(column)
    return items.select(
        "path",
        F.col("pos").cast("bigint").alias("pos"),
        F.try_variant_get(file, "$.source", "string").alias("file_source"),
        F.try_variant_get(file, "$.canton", "string").alias("file_canton"),
        F.try_variant_get(file, "$.scraped_at", "string").alias("scraped_at"),
        V.integer_at(file, "$.total").alias("file_total"),
        V.integer_at(file, "$.rav_exclusive_count").alias("file_rav_exclusive_count"),
        *fields,
    )
