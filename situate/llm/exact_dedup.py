"""Exact deduplication with a Cuckoo-filter index.

Texts are equal when identical after deleting [\\x20\\x09-\\x0D]; the key is the SHA-256 of what is left.
``CuckooIndex`` holds fingerprints of live keys in a Cuckoo filter (two candidate buckets, four slots);
a lookup that the filter denies is new without touching the store, a hit is verified against the
content stored for its bucket pair, and an insertion that overflows doubles the filter and refills it
from the stored keys. Keys can be deleted while live.

Spark deals rows to shards by key. Each input partition first merges its own copies through an index,
so a text with a third of all rows sends one row per partition to its shard; the shard's index merges
those. Null text counts as empty; an empty table gives no rows; repeated rows (equal id and text) each
get a result row and count in the size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from situate.llm import textnum as X

SLOTS = 4
MAX_KICKS = 200
SHARD_ROWS_BYTES = 64 << 20


class CuckooIndex:
    """Cuckoo filter over 32-byte keys with a bucketed store of the keys' values.

    The store maps a bucket pair's lower number to its live keys, so a verification reads one bucket's
    content only. ``put`` returns the value already stored or None."""

    def __init__(self, buckets: int = 1024):
        self.kept: dict[bytes, list] = {}
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.n = buckets
        self.table = [[] for _ in range(buckets)]
        self.content: dict[int, dict[bytes, object]] = {}
        self.size = 0

    def _place(self, key: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(key[:2], "little") or 1
        one = int.from_bytes(key[2:10], "little") & (self.n - 1)
        return mark, one, self._other(one, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & (self.n - 1)

    def maybe(self, key: bytes) -> bool:
        mark, one, two = self._place(key)
        return mark in self.table[one] or mark in self.table[two]

    def get(self, key: bytes):
        """The value of a live key, or None; a filter hit is verified against the bucket's content."""
        mark, one, two = self._place(key)
        if mark not in self.table[one] and mark not in self.table[two]:
            return None
        return self.content.get(min(one, two), {}).get(key)

    def put(self, key: bytes, value) -> None:
        """Adds a new key (``get`` said None) or replaces a live key's value."""
        mark, one, two = self._place(key)
        bucket = self.content.setdefault(min(one, two), {})
        if key in bucket:
            bucket[key] = value
            return
        bucket[key] = value
        self.size += 1
        if not self._seat(mark, one, two):
            self._grow()

    def _seat(self, mark: int, one: int, two: int) -> bool:
        for b in (one, two):
            if len(self.table[b]) < SLOTS:
                self.table[b].append(mark)
                return True
        at = one
        for kick in range(MAX_KICKS):
            row = self.table[at]
            slot = kick % SLOTS
            mark, row[slot] = row[slot], mark
            at = self._other(at, mark)
            if len(self.table[at]) < SLOTS:
                self.table[at].append(mark)
                return True
        return False

    def _grow(self) -> None:
        """Twice the buckets, refilled from the stored keys (again if that overflows too)."""
        pairs = list(self.items())
        buckets = self.n * 2
        while True:
            self._clear(buckets)
            for key, value in pairs:
                mark, one, two = self._place(key)
                self.content.setdefault(min(one, two), {})[key] = value
                self.size += 1
                if not self._seat(mark, one, two):
                    break
            else:
                return
            buckets *= 2

    def delete(self, key: bytes) -> bool:
        """Removes a live key; False (and nothing removed) if the key isn't live."""
        mark, one, two = self._place(key)
        bucket = self.content.get(min(one, two), {})
        if key not in bucket:
            return False
        del bucket[key]
        for b in (one, two):
            if mark in self.table[b]:
                self.table[b].remove(mark)
                break
        self.size -= 1
        return True

    def items(self):
        for bucket in self.content.values():
            yield from bucket.items()


_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest binary, n_points) of every row."""
    def run(batches):
        for batch, data, off in X.chunks(batches, "text"):
            points = X.code_points(data)
            raw = data.tobytes()
            keys = [hashlib.sha256(raw[a:b].translate(None, _SPACE)).digest() for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(points[off[1:]] - points[off[:-1]], pa.int64())],
                                             names=["doc_id", "digest", "n_points"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, digest binary, n_points long")


_GROUP = "digest binary, keep_points long, keep_id long, group_size long"


def _merge(batches):
    """Rows of one partition through one index: one row per live key (longest, then smallest id)."""
    index = CuckooIndex()
    for batch in batches:
        for key, points, ident, size in zip(*(batch.column(c).to_pylist() for c in ("digest", "keep_points", "keep_id", "group_size"))):
            held = index.get(key)
            order = (-points, ident is None, ident or 0)
            if held is None:
                index.put(key, (order, points, ident, size))
            else:
                best = held if held[0] <= order else (order, points, ident, size)
                index.put(key, (*best[:3], held[3] + size))
    rows = list(index.items())
    for i in range(0, len(rows), 50_000):
        part = rows[i:i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in part], pa.binary()), pa.array([v[1] for _, v in part], pa.int64()),
                                          pa.array([v[2] for _, v in part], pa.int64()), pa.array([v[3] for _, v in part], pa.int64())],
                                         names=["digest", "keep_points", "keep_id", "group_size"])


def build_index(keys: DataFrame) -> DataFrame:
    """The live index: one row per distinct digest with its kept row and group size."""
    rows = keys.select("digest", F.col("n_points").alias("keep_points"), F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    local = rows.mapInArrow(_merge, _GROUP)
    return local.repartition("digest").mapInArrow(_merge, _GROUP)


def update_index(index: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """An index after insertions and deletions of digests, shard by shard.

    ``added`` has the columns of the index, ``removed`` a column ``digest``; a removed digest leaves
    the index whatever its group size, one that isn't live is ignored, and one both removed and added
    is live with the added rows only."""
    tagged = index.withColumn("op", F.lit(0)).unionByName(
        removed.select("digest", F.lit(0).cast("long").alias("keep_points"), F.lit(0).cast("long").alias("keep_id"), F.lit(0).cast("long").alias("group_size"), F.lit(1).alias("op"))
    ).unionByName(added.withColumn("op", F.lit(2)))

    def run(batches):
        live = CuckooIndex()
        for batch in batches:  # sorted by op: live rows, then deletions, then insertions
            gone = [k for k, op in zip(batch.column("digest").to_pylist(), batch.column("op").to_pylist()) if op == 1]
            ops = np.array(batch.column("op").to_pylist())
            base = batch.filter(pa.array(ops == 0))
            for key, p, i, s in zip(*(base.column(c).to_pylist() for c in ("digest", "keep_points", "keep_id", "group_size"))):
                live.put(key, ((-p, i is None, i or 0), p, i, s))
            for key in gone:
                live.delete(key)
            new = batch.filter(pa.array(ops == 2))
            for key, p, i, s in zip(*(new.column(c).to_pylist() for c in ("digest", "keep_points", "keep_id", "group_size"))):
                held, order = live.get(key), (-p, i is None, i or 0)
                if held is None:
                    live.put(key, (order, p, i, s))
                else:
                    best = held if held[0] <= order else (order, p, i, s)
                    live.put(key, (*best[:3], held[3] + s))
        rows = list(live.items())
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.binary()), pa.array([v[1] for _, v in rows], pa.int64()),
                                          pa.array([v[2] for _, v in rows], pa.int64()), pa.array([v[3] for _, v in rows], pa.int64())],
                                         names=["digest", "keep_points", "keep_id", "group_size"])

    return tagged.repartition("digest").sortWithinPartitions("op").mapInArrow(run, _GROUP)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    keys = digests(docs, id_col, text_col)
    index = build_index(keys)
    return keys.join(index, "digest").select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
