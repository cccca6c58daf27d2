"""File sources and sinks (S1-S8): raw JSON, CSV round trip, newest snapshot, snapshot/JSON sinks."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from situate.sources.csv_ranges import scan_csv_ranges
from situate.sources.json_arrays import scan_json_arrays


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _files(spark: SparkSession, path: str) -> list:
    """Status of the files of a path, a pattern or a directory (names with ``_`` or ``.`` first aside)."""
    fs, p = _fs(spark, path)
    found = []
    for status in fs.globStatus(p) or []:
        found += list(fs.listStatus(status.getPath())) if status.isDirectory() else [status]
    return [s for s in found if s.isFile() and not s.getPath().getName().startswith(("_", "."))]


def _records(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """:func:`situate.sources.json_arrays.scan_json_arrays` with each row's ``ordinal`` (file rank · 2^32 + place) where it has none."""
    records, broken, unread = scan_json_arrays(spark, path, schema)
    if unread:  # names only: Spark has no range of files without a byte; a file at a time in the driver, so only if there are any
        empty = [(s.getPath().toString(),) for s in _files(spark, path) if s.getLen() == 0]
        broken = broken.union(spark.createDataFrame(empty, "file string"))
    if "ordinal" in schema.fieldNames():
        place = F.shiftleft(F.col("rank").cast("long"), 32) + F.col("record")
        records = records.withColumn("row", F.col("row").withField("ordinal", F.coalesce("row.ordinal", place)))
    return records, broken


def scan_raw_json(spark: SparkSession, path: str, schema: T.StructType, layout: str = "array", errors: str = "raise") -> DataFrame:
    """S1 ``load_raw_json``: landed JSON with a fixed schema.

    ``layout='array'``: each file holds one top-level JSON array (the reference's landing), read in byte ranges.
    A row without an ``ordinal`` gets its place by file name and position. ``errors='raise'``: a file that isn't one closed
    array is a ValueError here, a record that doesn't fit the schema fails the query that reads it; ``'quarantine'``: sound
    records of sound files only, the rest is what :func:`quarantined_records` returns. ``layout='lines'``: JSON lines as written by :func:`sink_json`.
    """
    if layout == "lines":
        return spark.read.schema(schema).json(path)
    if layout != "array" or errors not in ("raise", "quarantine"):
        raise ValueError(f"unknown layout {layout!r} or errors {errors!r}")
    records, broken = _records(spark, path, schema)
    if errors == "quarantine":
        return records.where("problem is null").select("row.*")
    bad = [r["file"] for r in broken.limit(5).collect()]
    if bad:
        raise ValueError(f"raw JSON must be one closed list at the top level: {', '.join(sorted(bad))}")
    told = F.concat(F.col("file"), F.lit(", record "), F.col("record").cast("string"), F.lit(": "), F.col("problem"))
    return records.where(F.when(F.col("problem").isNull(), F.lit(True)).otherwise(F.raise_error(told).cast("boolean"))).select("row.*")


def quarantined_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(file, record, problem, text) of the landed records that don't fit; a file that isn't one closed array has
    a row of its own too (record -1)."""
    records, broken = _records(spark, path, schema)
    files = broken.select("file", F.lit(-1).cast("long").alias("record"), F.lit("not one closed JSON array").alias("problem"), F.lit(None).cast("string").alias("text"))
    return records.where("problem is not null").select("file", "record", "problem", "text").unionByName(files)


CSV_OPTIONS = {"header": "true", "escape": '"', "multiLine": "true", "encoding": "UTF-8"}


def write_csv(df: DataFrame, path: str) -> str:
    """CSV snapshot with RFC-4180 quoting (quotes doubled), so JSON text columns survive."""
    df.write.mode("errorifexists").options(**CSV_OPTIONS, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)
    return path


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S2 ``load_processed_csv``: a processed CSV read back with a fixed schema.

    ``escape='"'`` is required: with Spark's default escape a JSON column is cut at its first comma.
    """
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def scan_csv_parallel(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S2 for large files: the rows of :func:`scan_csv`, each file read by as many tasks as it has byte ranges."""
    return scan_csv_ranges(spark, path, schema, CSV_OPTIONS)


def latest_snapshot(spark: SparkSession, directory: str, prefix: str | None = None, suffix: str = "") -> str:
    """S3/S4 ``find_latest_csv`` / ``find_latest_prefixed_csv``: newest ``{prefix}_*`` entry by the time in
    its name and its ``_n`` suffix; names without a time come first, by modification time. A directory
    counts once its job has committed (``_SUCCESS``). Only metadata is read. FileNotFoundError if none."""
    pattern = f"{directory.rstrip('/')}/{prefix + '_' if prefix else ''}*{suffix}"
    fs, p = _fs(spark, pattern)
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    statuses = [s for s in fs.globStatus(p) or [] if s.isFile() or fs.exists(done(s.getPath(), "_SUCCESS"))]
    if not statuses:
        raise FileNotFoundError(f"no finished snapshot matches {pattern}")

    def age(status):
        name = status.getPath().getName()
        m = re.search(r"(\d{8}_\d{6})(?:_(\d+))?", name)
        return (m.group(1) if m else "", int(m.group(2) or 0) if m else 0, status.getModificationTime(), name)

    best = max(statuses, key=age)
    return best.getPath().toString()


def snapshot_path(directory: str, name: str, when: _dt.datetime | None = None) -> str:
    when = when or _dt.datetime.now(_dt.UTC)
    return f"{directory.rstrip('/')}/{name}_{when.strftime('%Y%m%d_%H%M%S')}"


def sink_snapshot(df: DataFrame, directory: str, name: str, fmt: str = "parquet",
                  when: _dt.datetime | None = None) -> str:
    """Write a timestamped snapshot ``{name}_%Y%m%d_%H%M%S`` (UTC), one directory per snapshot.

    Never overwrites: an existing snapshot of the same second gets a ``_n`` suffix.
    """
    base = snapshot_path(directory, name, when)
    spark = df.sparkSession
    fs, _ = _fs(spark, directory)
    path, n = base, 0
    while fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)):
        n += 1
        path = f"{base}_{n}"
    if fmt == "csv":
        return write_csv(df, path)
    df.write.mode("errorifexists").format(fmt).save(path)
    return path


def sink_json(df: DataFrame, path: str) -> str:
    """JSON lines (nested structs and arrays kept), one directory per write."""
    df.write.mode("errorifexists").json(path)
    return path


def scan_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Nested JSON back to typed records."""
    return spark.read.schema(schema).json(path)
