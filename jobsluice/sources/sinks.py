"""Outputs: JSON, CSV, seen state, versioned snapshots."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsluice.schema import CSV_LAYOUTS
from jobsluice.session import materialize

RUNS_SCHEMA = (
    "source string, run_id string, version int, last_run_at string, params map<string,string>,"
    " buckets map<string, struct<versions: array<int>, digest: string>>"
)
#: Hash buckets of a table of a store, and parts of a bucket of the seen state before it is written anew.
BUCKETS = 8
COMPACT_AFTER = 8


def write_json(df: DataFrame, path: str) -> None:
    """JSON Lines with NULL fields written."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def csv_projection(df: DataFrame, layout: list[str]) -> DataFrame:
    """The columns of a layout as text: missing ones empty, booleans capitalised."""
    types = dict(df.dtypes)
    columns = []
    for name in layout:
        if name not in types:
            column = F.lit(None).cast("string")
        elif types[name] == "boolean":
            column = F.initcap(F.col(name).cast("string"))
        else:
            column = F.col(name).cast("string")
        columns.append(column.alias(name))
    return df.select(columns)


def write_csv(df: DataFrame, path: str, layout: str | list[str]) -> None:
    """CSV with a header in every file, doubled quotes, empty NULLs and CRLF after every record.

    Line feeds inside a field stay as they are, which Spark's own CSV writer does not grant with
    such line ends; the records are therefore written as text. An empty table gives one header.
    """
    names = CSV_LAYOUTS[layout] if isinstance(layout, str) else layout
    header = ",".join(names)
    rows = csv_projection(df, names)
    fields = [F.coalesce(_csv_field(F.col(name)), F.lit("")) for name in names]
    # The low 33 bits of the id count the rows of a task, and a task writes one file.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    line = F.concat_ws(",", *fields)
    lines = rows.select(F.when(first, F.concat(F.lit(header + "\r\n"), line)).otherwise(line).alias("value"))
    lines.write.mode("overwrite").option("lineSep", "\r\n").option("maxRecordsPerFile", 0).text(path)
    if df.sparkSession.read.text(path).isEmpty():
        empty = df.sparkSession.createDataFrame([(header,)], "value string")
        empty.write.mode("overwrite").option("lineSep", "\r\n").text(path)


def _csv_field(value: Column) -> Column:
    """A text as a CSV field, in quotes if it holds a comma, a quote or a line end."""
    quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(value.rlike('[,"\r\n]'), quoted).otherwise(value)


def read_table(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A Parquet table, empty if it does not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class SnapshotStore:
    """Versioned job table and seen state of one source, in hash buckets of the key.

    A run reads version n and writes what version n + 1 changes: job buckets whose rows differ are written anew, keys
    that are new to the seen state are added as one more part of their bucket. The row of the run in ``runs`` lists
    which folders make up each bucket; it is written last, so a run that failed before it left no trace and can be
    repeated, and a run that is already listed is not written again. A bucket of the seen state is written anew if it
    loses keys or has ``COMPACT_AFTER`` parts; ``vacuum`` deletes folders that no recent version reads.

    The digest of a bucket is its number of rows and the sum of their hashes; it needs one pass over the table and
    moves no payload. ``buckets`` is fixed when a store is created, so that a bucket fits a few tasks.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: str | T.StructType, source: str, key: str = "url", buckets: int = BUCKETS
    ):
        self.spark, self.path, self.schema, self.source = spark, path.rstrip("/"), schema, source
        self.key, self.buckets = key, buckets
        self._parts: dict[int, dict[str, tuple[list[int], str]]] = {0: {}}

    def runs(self) -> DataFrame:
        return read_table(self.spark, f"{self.path}/runs", RUNS_SCHEMA)

    def state(self, run_id: str = "") -> tuple[int, bool]:
        """(latest version, whether the run is already recorded)."""
        done = F.coalesce(F.bool_or(F.col("run_id") == run_id), F.lit(False))
        row = self.runs().agg(F.coalesce(F.max("version"), F.lit(0)).alias("v"), done.alias("done")).first()
        return row["v"], row["done"]

    def parts(self, version: int) -> dict[str, tuple[list[int], str]]:
        """For every bucket, as ``table/number``, the versions whose folders hold it, and its digest."""
        if version not in self._parts:  # what a version consists of never changes
            row = self.runs().where(F.col("version") == version).select("buckets").first()
            found = {name: (part["versions"], part["digest"]) for name, part in ((row and row["buckets"]) or {}).items()}
            if row is None:
                return found
            self._parts[version] = found
        return self._parts[version]

    def _read(self, table: str, schema: str | T.StructType, parts: Mapping[str, tuple[list[int], str]]) -> DataFrame:
        names = [(name.partition("/"), versions) for name, (versions, _) in parts.items()]
        paths = [f"{self.path}/{table}/v={v}/bucket={n}" for (of, _, n), versions in names if of == table for v in versions]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*sorted(paths))

    def jobs(self, version: int | None = None) -> DataFrame:
        return self._read("jobs", self.schema, self.parts(self.state()[0] if version is None else version))

    def seen(self, version: int | None = None) -> DataFrame:
        return self._read("seen", "key string", self.parts(self.state()[0] if version is None else version))

    def _bucketed(self, rows: DataFrame, key: str) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int"))

    def _write(self, rows: DataFrame, table: str, version: int) -> None:
        rows = rows.repartition("bucket")
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{table}/v={version}")

    def commit(
        self, jobs: DataFrame, seen: DataFrame, run_id: str, last_run_at: str, params: Mapping[str, str] | None = None
    ) -> None:
        """Write what changes in the next version of both tables and record the run."""
        version, done = self.state(run_id)
        if done:
            return
        before = self.parts(version)
        after = self._commit_jobs(jobs, before, version + 1) | self._commit_seen(seen, before, version + 1)
        row = [(self.source, run_id, version + 1, last_run_at, dict(params or {}), after)]
        self.spark.createDataFrame(row, RUNS_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.path}/runs")
        self._parts[version + 1] = after

    def _commit_jobs(self, jobs: DataFrame, before, version: int) -> dict[str, tuple[list[int], str]]:
        rows = self._bucketed(jobs, self.key)
        content = F.sum(F.xxhash64(*jobs.columns).cast("decimal(38,0)"))
        found = rows.groupBy("bucket").agg(F.count("*").alias("n"), content.alias("content")).collect()
        digests = {f"jobs/{r['bucket']}": f"{r['n']}:{r['content']}" for r in found}
        changed = {name for name, digest in digests.items() if name not in before or before[name][1] != digest}
        if changed:
            touched = [int(name.partition("/")[2]) for name in changed]
            self._write(rows.where(F.col("bucket").isin(touched)), "jobs", version)
        return {name: ([version] if name in changed else before[name][0], digest) for name, digest in digests.items()}

    def _commit_seen(self, seen: DataFrame, before, version: int) -> dict[str, tuple[list[int], str]]:
        old = self._read("seen", "key string", before)
        both = old.withColumn("side", F.lit(1)).unionByName(seen.select("key", F.lit(2).alias("side")))
        moved = both.groupBy("key").agg(F.bit_or("side").alias("side")).where("side <> 3")
        moved = materialize(self._bucketed(moved, "key"), "seen-changes")
        counts = moved.groupBy("bucket").agg(F.count_if(F.col("side") == 2).alias("new"), F.count_if(F.col("side") == 1).alias("gone"))
        after = {name: part for name, part in before.items() if name.startswith("seen/")}
        anew, touched = [], []
        for row in counts.collect():
            name = f"seen/{row['bucket']}"
            versions, n = after.pop(name, ([], "0"))
            left = int(n) + row["new"] - row["gone"]
            rewrite = row["gone"] > 0 or len(versions) >= COMPACT_AFTER
            if left:
                after[name] = ([version] if rewrite else [*versions, version], str(left))
                touched.append(row["bucket"])
                if rewrite:
                    anew.append(row["bucket"])
        if touched:
            rows = moved.where((F.col("side") == 2) & F.col("bucket").isin(touched)).select("key", "bucket")
            if anew:
                stay = self._bucketed(old, "key").where(F.col("bucket").isin(anew))
                rows = rows.unionByName(stay.join(moved.where("side = 1").select("key"), "key", "left_anti"))
            self._write(rows, "seen", version)
        return after

    def vacuum(self, keep: int = 2) -> int:
        """Delete the folders that none of the last ``keep`` versions reads; returns how many there were."""
        recent = self.runs().orderBy(F.desc("version")).limit(keep).select("version", "buckets").collect()
        if not recent:
            return 0
        used = set()
        for row in recent:
            for name, part in row["buckets"].items():
                table, _, bucket = name.partition("/")
                used |= {f"{table}/v={v}/bucket={bucket}" for v in part["versions"]}
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        files = hadoop.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = files.globStatus(hadoop.Path(f"{self.path}/*/v=*/bucket=*")) or []
        names = [(str(f.getPath()), "/".join(str(f.getPath()).split("/")[-3:])) for f in found]
        latest = max(row["version"] for row in recent)
        old = [path for path, name in names if name not in used and int(name.split("/")[1][2:]) <= latest]
        for path in old:
            files.delete(hadoop.Path(path), True)
        return len(old)


def write_seen(seen: DataFrame, path: str) -> None:
    """Distinct keys, sorted over the files."""
    seen.select("key").distinct().orderBy("key").write.mode("overwrite").parquet(path)
