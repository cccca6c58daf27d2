"""Landed files of one JSON array each, read in parallel byte ranges.

Spark's text reader cuts the files into byte ranges with ``}`` as line separator, whatever the layout of the
text, so each range is a run of chunks that end at a closing brace. Where a record ends depends on what
stands before the range: whether a string is open and how deep the brackets are. Two passes:

1. ``_profile``: each range is scanned for both possible string states: its quote parity, change of
   depth and, by relative depth, the number of closing braces. One small row a range; running sums
   over a file's ranges give every range's state at its start, the number of records before it, and for the file
   whether its brackets and quotes close.
2. ``_records``: ranges are scanned again with their state and cut at the braces that end a record. Records
   within a range are passed on; the pieces of a record that spans ranges are put together by (file, record
   number), so only these few are shuffled.

Record texts are parsed by ``from_json``; a record that isn't an object, doesn't parse or has a mistyped
field is corrupt on its own, with its text. The scan of structure is numpy over Arrow batches: built-in expressions
cannot carry a state through a text range without shuffling all of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from situate.session import materialize
from situate.sources.byte_ranges import PIECES, chunk_rows, ranges, record_batch, whole_texts

CORRUPT = "_corrupt"
QUOTE, ESCAPE, OPEN_ARRAY, CLOSE_ARRAY, OPEN_OBJECT, CLOSE_OBJECT = (ord(c) for c in '"\\[]{}')
BLANK = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0D])
STEP = np.zeros(256, np.int64)
STEP[[OPEN_ARRAY, OPEN_OBJECT]], STEP[[CLOSE_ARRAY, CLOSE_OBJECT]] = 1, -1
MARK = (STEP != 0) | (np.arange(256) == QUOTE)
PROFILE = "file string, start long, file_size long, bytes long, first int, state int, parity int, delta long, ends map<long,long>"


def _chunk_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all chunks, each with its closing brace again; offsets)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[off[0]:off[-1]]
    off = off - off[0]
    return np.insert(data, off[1:], CLOSE_OBJECT), off + np.arange(len(off))


def _marks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, bytes, is it a quote) of the brackets and of the quotes that aren't behind an odd run of backslashes."""
    at = np.flatnonzero(MARK[data])
    kind = data[at]
    quote = kind == QUOTE
    escapes = np.flatnonzero(data == ESCAPE)
    if len(escapes):
        # places in their run of backslashes, from 1: a quote behind an odd one is escaped
        first = np.append(True, np.diff(escapes) != 1)
        nth = np.arange(len(escapes)) - np.flatnonzero(first)[np.cumsum(first) - 1] + 1
        escaped = quote & np.isin(at, escapes[nth % 2 == 1] + 1, assume_unique=True)
        at, kind, quote = at[~escaped], kind[~escaped], quote[~escaped]
    return at, kind, quote


def _steps(kind: np.ndarray, quote: np.ndarray, state: int) -> tuple[np.ndarray, np.ndarray]:
    """(depth after each mark, relative; marks outside strings) if a string is open (``state`` 1) or not before."""
    outside = (np.cumsum(quote) - quote + state) % 2 == 0
    step = STEP[kind]
    step[~outside] = 0
    return np.cumsum(step), outside


def _profile(batches):
    """Rows of PROFILE: one for each range of the partition and each state that may hold before it (at a file's start only 0)."""
    held: dict = {}  # a partition's ranges: a few numbers each
    for batch in batches:
        for file, start, size, i, j in ranges(batch):
            data, _ = _chunk_bytes(batch.column("value").slice(i, j - i))
            _, kind, quote = _marks(data)
            seen = held.setdefault((file, start), {"size": size, "bytes": 0, "first": None, "parity": 0, "delta": [0, 0], "ends": [{}, {}]})
            for state in (0, 1) if start else (0,):  # no string is open before a file
                depth, outside = _steps(kind, quote, state ^ seen["parity"])
                for d, n in zip(*(x.tolist() for x in np.unique(depth[outside & (kind == CLOSE_OBJECT)], return_counts=True))):
                    to = seen["delta"][state] + d
                    seen["ends"][state][to] = seen["ends"][state].get(to, 0) + n
                seen["delta"][state] += int(depth[-1])
            if seen["first"] is None and not BLANK[data].all():
                seen["first"] = int(data[np.argmin(BLANK[data])])
            seen["bytes"] += len(data)
            seen["parity"] ^= int(quote.sum()) % 2
    rows = [(f, s, v["size"], v["bytes"], v["first"], state, v["parity"], v["delta"][state], list(v["ends"][state].items())) for (f, s), v in held.items() for state in ((0, 1) if s else (0,))]
    if rows:
        yield record_batch(rows, PROFILE)


def _records(batches):
    """Rows of PIECES from chunk rows with the range's ``state``, ``depth``, ``before`` (records ended before it) and ``only`` (the file
    has no other range, so all its texts are whole)."""
    now, carry = None, None  # range in hand; [state, depth, record, bytes of the record in hand, is it open from an earlier range, is its range the only one]

    def row(out, whole, text):
        out.append((now[0], now[1], carry[2], whole, bytes(text).decode("utf-8", "replace")))

    for batch in batches:
        out: list[tuple] = []
        states, depths, before, only = (batch.column(c) for c in ("state", "depth", "before", "only"))
        for file, start, _, i, j in ranges(batch):
            if (file, start) != now:
                if now and carry[3]:
                    row(out, carry[5], carry[3])
                now = (file, start)
                state, depth, record = (c[i].as_py() for c in (states, depths, before))
                if state is None:
                    raise RuntimeError(f"{file}: its byte ranges changed between two scans; run again")
                carry = [state, depth, record, b"", start > 0 and (state, depth) != (0, 1), only[i].as_py()]
            data, _ = _chunk_bytes(batch.column("value").slice(i, j - i))
            at, kind, quote = _marks(data)
            depth, outside = _steps(kind, quote, carry[0])
            ends = at[outside & (kind == CLOSE_OBJECT) & (depth + carry[1] == 1)] + 1
            raw, at = data.tobytes(), 0
            for e in ends.tolist():
                row(out, not carry[4], carry[3] + raw[at:e])
                carry[2], carry[3], carry[4], at = carry[2] + 1, b"", False, e
            carry[3] += raw[at:]
            carry[0], carry[1] = (carry[0] + int(quote.sum())) % 2, carry[1] + int(depth[-1])
        if out:
            yield record_batch(out, PIECES)
    if now and carry[3]:
        out = []
        row(out, carry[5], carry[3])
        yield record_batch(out, PIECES)


def range_states(chunks: DataFrame) -> DataFrame:
    """One row a byte range: file, start, state, depth and ``before`` at its start; for the file ``sound`` (one array
    whose brackets and quotes close) and ``braced`` (its last byte is a closing brace)."""
    both = materialize(chunks.mapInArrow(_profile, PROFILE))
    file = Window.partitionBy("file").orderBy("start")
    earlier, whole = file.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("file")
    zero = lambda c: F.coalesce(c, F.lit(0))
    one = both.where("state = 0").withColumn("begin", (zero(F.sum("parity").over(earlier)) % 2).cast("int"))
    fits = both.select("file", "start", F.col("state").alias("begin"), F.col("delta").alias("own"), F.col("ends").alias("own_ends"))
    known = one.select("file", "start", "file_size", "bytes", "first", "parity", "begin").join(fits, ["file", "start", "begin"])
    known = known.withColumn("depth", zero(F.sum("own").over(earlier)).cast("long"))
    # a closing brace ends a record where it leads back to depth 1
    known = known.withColumn("ended", zero(F.element_at("own_ends", 1 - F.col("depth"))))
    known = known.withColumn("before", zero(F.sum("ended").over(earlier)).cast("long"))
    # the scan puts a brace behind the last chunk too: it is the file's own if the bytes add up with it (a byte order mark is skipped)
    known = known.withColumn("braced", (F.sum("bytes").over(whole) - F.col("file_size")).isin(0, -3))
    quoted = F.sum("parity").over(whole) % 2 == 1
    depth = F.sum("own").over(whole) + F.when(F.col("braced") | quoted, 0).otherwise(1)
    array = F.max(F.when(F.col("start") == 0, F.col("first"))).over(whole) == OPEN_ARRAY
    return known.select("file", "start", F.col("begin").alias("state"), "depth", "before", (array & ~F.col("braced") & ~quoted & (depth == 0)).alias("sound"), "braced")


def scan_json_arrays(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame, int]:
    """(records, broken files, number of files without a byte) of the arrays under ``path``.

    records: file, rank (the file's place by name), record (the place in its array), problem, text, row. ``problem`` is null for
    a sound record, else it says what is wrong with ``text``; all records of a broken file have one. An empty array has no records,
    a file without a byte is not among the broken ones (Spark doesn't open it).
    The table of ranges (one small row for each split of the input) is broadcast."""
    chunks = chunk_rows(spark, path, "}")
    states = materialize(range_states(chunks))
    unread = len(chunks._jdf.inputFiles()) - states.select("file").distinct().count()  # the array stays in the JVM
    alone = (F.count("*").over(Window.partitionBy("file")) == 1).alias("only")
    known = chunks.join(F.broadcast(states.select("file", "start", "state", "depth", "before", alone)), ["file", "start"], "left")
    known = known.select("file", "start", "size", "value", "state", "depth", "before", "only")
    # the second scan for pieces leaves out the files of one range: their texts are whole
    texts = whole_texts(known.mapInArrow(_records, PIECES), known.where(~F.coalesce("only", F.lit(False))).mapInArrow(_records, PIECES))
    files = states.groupBy("file").agg(F.bool_and(F.coalesce("sound", F.lit(False))).alias("sound"), F.bool_and("braced").alias("braced"))
    # one small row a file, broadcast: no text is shuffled for it
    texts = texts.join(F.broadcast(files.withColumn("rank", F.row_number().over(Window.orderBy("file")) - 1)), "file")
    blank, mark, first = r"[\x20\x09\x0A\x0D]*", r"^\x{FEFF}?", F.col("record") == 0
    # behind the last record stands the closing bracket, with the scan's brace
    tail = F.when(first, F.rlike("text", F.lit(rf"{mark}{blank}\[{blank}\]{blank}\}}$"))).otherwise(F.rlike("text", F.lit(rf"^{blank}\]{blank}\}}$")))
    led = F.when(first, F.rlike("text", F.lit(rf"{mark}{blank}\[{blank}\{{"))).otherwise(F.rlike("text", F.lit(rf"^{blank},{blank}\{{")))
    flat = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    body = F.regexp_replace("text", rf"{mark}{blank}[\[,]{blank}", "")
    rows = texts.where(F.col("braced") | ~tail).select("file", "rank", "record", "sound", "text", led.alias("led"),
                                                    # a generator's output is not put into the expressions on it: each text is parsed once
                                                    F.explode_outer(F.array(F.from_json(body, flat, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))).alias("row"))
    problem = (F.when(~F.col("sound"), "in a file that is not one closed JSON array").when(~F.col("led"), "not an object of the array")
               .when(F.col("row").isNull() | F.col(f"row.{CORRUPT}").isNotNull(), "not a record of the schema"))
    return rows.select("file", "rank", "record", problem.alias("problem"), "text", F.col("row").dropFields(CORRUPT).alias("row")), states.where(~F.coalesce("sound", F.lit(False))).select("file").distinct(), unread
