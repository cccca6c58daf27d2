"""Quoted CSV read in byte ranges: a file with line breaks inside quotes doesn't need one task.

A line break ends a record where the number of quotes before it is even (a quote inside a quoted field is doubled, so
it counts twice). A range's profile is its parity and, for either parity before it, the number of records it ends; running
sums over a file's ranges give its start. Lines of one record are joined, records over several ranges are
put together by number (only those are shuffled), and ``from_csv`` parses the record texts with the reader's options.

Lines end with \\n or \\r\\n; line breaks inside quotes stay as they are (the reader makes them \\n). The first record of a file is its header. Blank lines are no records. An unclosed quote is a
ValueError that names the file.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from situate.session import materialize
from situate.sources.byte_ranges import PIECES, chunk_rows, ranges, record_batch, whole_texts

PROFILE = "file string, start long, parity int, even long, odd long"


def _quotes(column) -> np.ndarray:
    return np.cumsum(np.asarray(pc.count_substring(column, '"')).astype(np.int64))


def _profile(batches):
    held: dict = {}  # a partition's ranges: three numbers each
    for batch in batches:
        for file, start, _, i, j in ranges(batch):
            seen = held.setdefault((file, start), [0, 0, 0])
            upto = _quotes(batch.column("value").slice(i, j - i)) + seen[0]
            even = int((upto % 2 == 0).sum())
            held[file, start] = [int(upto[-1]) % 2, seen[1] + even, seen[2] + (j - i) - even]
    if held:
        yield record_batch([(*k, *v) for k, v in held.items()], PROFILE)


def _records(batches):
    """Rows of PIECES from line rows with the range's ``parity`` and ``before`` (records ended before it)."""
    now, parity, record, held, whole = None, 0, 0, [], True
    names = [f.split(" ")[0] for f in PIECES.split(", ")]
    for batch in batches:
        first, before = batch.column("parity").to_pylist(), batch.column("before").to_pylist()
        for file, start, _, i, j in ranges(batch):
            if (file, start) != now:
                if held:
                    yield record_batch([(*now, record, False, "".join(held))], PIECES)
                if first[i] is None:
                    raise RuntimeError(f"{file}: its byte ranges changed between two scans; run again")
                now, parity, record, held, whole = (file, start), first[i], before[i], [], not first[i]
            values = batch.column("value").slice(i, j - i)
            upto = (_quotes(values) + parity) % 2
            ends = upto == 0
            # a line that begins and ends outside quotes is a record: passed on as it is
            alone = ends & np.append(parity == 0 and not held, ends[:-1])
            number = record + np.cumsum(ends) - 1
            if alone.any():
                n = int(alone.sum())
                yield pa.RecordBatch.from_arrays([pa.array([file] * n), pa.array([start] * n, pa.int64()), pa.array(number[alone], pa.int64()), pa.array([True] * n), values.filter(pa.array(alone))], names=names)
            rest, joined = np.flatnonzero(~alone), []
            for at, text in zip(rest.tolist(), values.take(pa.array(rest)).to_pylist()):
                held.append(text + "\n" * (not ends[at]))
                if ends[at]:
                    joined.append((file, start, int(number[at]), whole, "".join(held)))
                    held = []
                whole = whole or bool(ends[at])
            if joined:
                yield record_batch(joined, PIECES)
            parity, record, whole = int(upto[-1]), record + int(ends.sum()), whole or bool(ends.any())
    if held:
        yield record_batch([(*now, record, False, "".join(held))], PIECES)


def scan_csv_ranges(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str], header: bool = True) -> DataFrame:
    """The rows of the CSV files under ``path``; ``options`` as for the reader."""
    lines = chunk_rows(spark, path, "\n")
    file = Window.partitionBy("file").orderBy("start")
    earlier = file.rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    states = lines.mapInArrow(_profile, PROFILE).withColumn("begin", (zero(F.sum("parity").over(earlier)) % 2).cast("int"))
    states = states.withColumn("before", zero(F.sum(F.when(F.col("begin") == 0, F.col("even")).otherwise(F.col("odd"))).over(earlier)).cast("long"))
    states = materialize(states.select("file", "start", F.col("begin").alias("parity"), "before", F.col("parity").alias("own")))
    open_ = [r["file"] for r in states.groupBy("file").agg((F.sum("own") % 2).alias("open")).where("open = 1").limit(5).collect()]
    if open_:
        raise ValueError(f"a quote is never closed in {', '.join(sorted(open_))}")
    # one small row a range: broadcast, as a shuffle would lose the order of lines
    known = lines.join(F.broadcast(states.drop("own")), ["file", "start"], "left").select("file", "start", "size", "value", "parity", "before")
    texts = whole_texts(known.mapInArrow(_records, PIECES))
    if header:
        texts = texts.where("record > 0")
    text = F.regexp_replace("text", r"\r$", "")
    parse = {k: v for k, v in options.items() if k not in ("header", "encoding")}
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return texts.select(text.alias("text")).where("text != ''").select(F.from_csv("text", fields, parse).alias("row")).select("row.*")
