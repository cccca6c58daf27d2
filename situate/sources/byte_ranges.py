"""Text files in byte ranges, for formats whose records can't be found from inside a range.

Spark's text reader cuts files into ranges of whole chunks (text up to a separator) and keeps their order within
a range; which chunk ends a record depends on everything before it. The formats scan their ranges twice: once for what a
range does to any state at its start, then, with the state known from running sums over a file's ranges, for its records.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIECES = "file string, start long, record long, whole boolean, text string"
KINDS = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "map<long,long>": pa.map_(pa.int64(), pa.int64())}


def chunk_rows(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """value (without the separator), file, start (of the byte range), size (of the file)."""
    text = spark.read.option("lineSep", separator).text(path)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("size"))


def ranges(batch):
    """(file, start, file size, first row, end row) of the runs of one byte range in a batch."""
    files, starts, sizes = (batch.column(c).to_pylist() for c in ("file", "start", "size"))
    i = 0
    for j in range(1, len(files) + 1):
        if j == len(files) or files[j] != files[i] or starts[j] != starts[i]:
            yield files[i], starts[i], sizes[i], i, j
            i = j


def record_batch(rows, spec: str) -> pa.RecordBatch:
    fields = [f.split(" ") for f in spec.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[k]) for c, (_, k) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def whole_texts(pieces: DataFrame, spanning: DataFrame | None = None) -> DataFrame:
    """(file, record, text): records within a range as they are, the pieces of a record over several ranges put together.
    ``spanning``: a frame that has all the pieces which aren't whole, if it is less work than ``pieces``."""
    whole = pieces.where("whole").select("file", "record", "text")
    parts = (pieces if spanning is None else spanning).where("not whole").groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("start", "text"))).alias("p"))
    return whole.unionByName(parts.select("file", "record", F.array_join("p.text", "").alias("text")))
