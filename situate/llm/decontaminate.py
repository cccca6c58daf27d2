"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over all texts.

Words are runs of digits, letters and characters beyond ASCII, after lower-casing A-Z. A window is
``n`` consecutive words of a benchmark item; an item of fewer words (but not none) is one window. Every
document window is looked up by its 64-bit hash; a hit is verified word by word.

The benchmark is broadcast only up to ``block_bytes`` of text; a larger one is cut into blocks of whole
items, and the documents pass through one narrow scan per block, so nothing grows with the benchmark
but the number of scans. No shuffle at all; hot documents, sources or passages change nothing.

Null or empty text: no words, no hits. Null or empty items have no windows. Repeated rows are scanned
each by itself. Extra columns of either table are ignored by ``find_hits`` and kept by ``remove``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from situate.llm import textnum as X

BLOCK_BYTES = 32 << 20


def _item_windows(rows: list[tuple[str, str]], n: int) -> dict:
    """length -> (sorted hashes, where each hash's entries begin, item index, words) of a block."""
    column = pa.array([t for _, t in rows], pa.string())
    data, off = X.utf8(column)
    low, starts, ends, first, hashes = X.words(data, off, X.ALNUM)
    count = np.diff(first)
    found: dict[int, list] = {}
    for item in np.flatnonzero(count):
        length = int(min(n, count[item]))
        own = hashes[first[item]:first[item + 1]]
        at, h = X.windows(own, np.array([0, len(own)]), length)
        for a, v in zip(at + first[item], h):
            text = b" ".join(low[starts[k]:ends[k]].tobytes() for k in range(a, a + length))
            found.setdefault(length, []).append((int(v), int(item), text))
    out = {}
    for length, entries in found.items():
        keys = np.array(sorted({e[0] for e in entries}), np.uint64)
        by: dict[int, list] = {}
        for v, item, text in entries:
            by.setdefault(v, []).append((item, text))
        out[length] = (keys, [by[int(k)] for k in keys])
    return out


def _scanner(shared, id_col: str, schema: pa.Schema):
    def scan(batches):
        block = shared.value
        table = np.array([i for i, _ in block["rows"]], object)
        plain = np.full(256, 32, np.uint8)
        plain[X.ALNUM] = np.arange(256, dtype=np.uint8)[X.ALNUM]
        gates = {}
        for length, (keys, _) in block["windows"].items():
            gate = np.zeros(1 << 20, bool)
            gate[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            gates[length] = gate
        for batch, data, off in X.chunks(batches, "text"):
            low, starts, ends, first, hashes = X.words(data, off, X.ALNUM)
            ranges = [list(r) for r in batch.column("ranges").to_pylist()]
            items = [set(i) for i in batch.column("items").to_pylist()]
            norm = None
            for length, (keys, entries) in block["windows"].items():
                at, h = X.windows(hashes, first, length)
                some = np.flatnonzero(gates[length][(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
                if not len(some):
                    continue
                pos = np.minimum(np.searchsorted(keys, h[some]), len(keys) - 1)
                match = keys[pos] == h[some]
                some, pos = some[match], pos[match]
                doc = np.searchsorted(first, at[some], side="right") - 1
                for a, p, d in zip(at[some].tolist(), pos.tolist(), doc.tolist()):
                    if norm is None:
                        norm = plain[low]
                    said = b" ".join(norm[starts[a]:ends[a + length - 1]].tobytes().split())
                    own = [item for item, text in entries[p] if text == said]
                    if own:
                        w = a - int(first[d])
                        ranges[d].append([w, w + length])
                        items[d].update(table[own].tolist())
            count = np.diff(first)
            for d, r in enumerate(ranges):
                if len(r) > 1:
                    r.sort()
                    merged = [r[0]]
                    for s, e in r[1:]:
                        if s <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], e)
                        else:
                            merged.append([s, e])
                    ranges[d] = merged
            points = X.code_points(data)
            spans = []
            for d, r in enumerate(ranges):
                base, zero = int(first[d]), int(points[off[d]])
                spans.append([[int(points[starts[base + s]]) - zero, int(points[ends[base + e - 1]]) - zero] for s, e in r])
            new = {"n_words": pa.array(count, pa.int64()), "ranges": pa.array(ranges, schema.field("ranges").type),
                   "items": pa.array([sorted(i, key=lambda x: (x is None, x or "")) for i in items], schema.field("items").type),
                   "spans": pa.array(spans, schema.field("spans").type)}
            yield pa.RecordBatch.from_arrays([new.get(f.name, None) if f.name in new else batch.column(f.name) for f in schema], schema=schema)

    return scan


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
              item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES,
              keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document row: the id, ``keep`` columns, text, n_words, ranges (merged hit word
    ranges), items (ids of items with a window in the text, as sorted strings, null last and once
    for all items without an id) and spans (the ranges as
    code points of the text). ``keep`` must not name text, n_words, ranges, items or spans."""
    spark = docs.sparkSession
    bench = benchmark.where(F.col(item_text_col).isNotNull()).select(
        F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
    total = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    state = docs.select(F.col(id_col), *[F.col(k) for k in keep if k != id_col], F.col(text_col).alias("text"),
                        F.lit(0).cast("long").alias("n_words"), F.array().cast("array<array<int>>").alias("ranges"),
                        F.array().cast("array<string>").alias("items"),
                        F.array().cast("array<array<int>>").alias("spans"))
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(state.schema)
    for b in range(blocks):
        part = bench if blocks == 1 else bench.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        rows = sorted(((r["item"], r["text"]) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or "", r[1]))
        shared = spark.sparkContext.broadcast({"rows": rows, "windows": _item_windows(rows, n)})
        state = state.mapInArrow(_scanner(shared, id_col, schema), state.schema)
    return state


def hit_report(hits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digest per document from ``find_hits``."""
    return hits.select(
        F.col(id_col).alias("doc_id"), "n_words",
        F.aggregate("ranges", F.lit(0).cast("long"), lambda a, r: a + r[1] - r[0]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("ranges") > 0).alias("contaminated"))


def remove(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", **options) -> DataFrame:
    """``documents``: drops every document with a hit. ``spans``: cuts each hit span out of its text
    (a single blank stays) and keeps the document. Columns of ``docs`` are kept as they are."""
    text = options.get("text_col", "text")
    ident = options.get("id_col", "doc_id")
    inner = "__t"
    taken = {"text", "n_words", "ranges", "items", "spans"}
    alias = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    df = docs.select([F.col(f"`{c}`").alias(a) for c, a in alias.items()] + [F.col(f"`{text}`").alias(inner)])
    options = {k: v for k, v in options.items() if k not in ("text_col", "id_col")}
    assert not taken & set(alias.values())
    hits = find_hits(df, benchmark, id_col=alias[ident], text_col=inner, keep=tuple(alias.values()), **options)
    if mode == "documents":
        return hits.where(F.size("ranges") == 0).select([F.col(a).alias(c) for c, a in alias.items()])
    if mode != "spans":
        raise ValueError(f"mode {mode!r}")
    acc = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    cut = F.aggregate("spans", acc, lambda a, s: F.struct(
        F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, s[0] - a["at"]), F.lit(" ")).alias("out"), s[1].alias("at")))
    left = F.concat(cut["out"], F.substring(F.col("text"), cut["at"] + 1, F.length("text")))
    clean = F.when(F.size("spans") == 0, F.col("text")).otherwise(left)
    return hits.select([(clean if c == text else F.col(a)).alias(c) for c, a in alias.items()])
