"""Token-id output: raw id payloads in shards, with a minimal perfect hash index for keyed access.

``write_tokens`` ranges documents by key, encodes each whole text with a ``tokenizers`` file, appends
an end id and writes, per shard, ``ids-NNNNN.bin`` (raw little-endian ids, 2 bytes each where the
vocabulary fits, else 4) and ``idx-NNNNN.npz``: rows in key order (key, first id) and a minimal perfect
hash over the distinct keys. A slot stores a 32-bit fingerprint and the key's first row, so a lookup is
one pilot, one slot, one fingerprint and one range read; a foreign key fails the fingerprint (chance
2^-32) or the stored key.

Encoding: the tokenizer never joins text across a blank that a visible character follows, nor from an
ASCII letter to another ASCII character that is none, so texts are cut there, each distinct piece of a chunk is encoded by the library once per worker, and ids are
gathered. The tokenizer is used as loaded: what a text holds of an added token's content gets that token's id;
a text with any is cut around the added tokens the library finds there, never inside one. Memory is bounded by the chunk and the worker's piece cache, which is emptied when full.

A null text is empty: the end id alone. A null key has rows (they come first) but no slot. Repeated keys
keep all their rows, ordered by text; ``get`` returns the first, ``get_all`` each. An empty table writes
no ids. Extra columns are ignored. A task that is run again writes the same bytes under another name
and renames them, so a lost executor leaves no torn file.
"""

from __future__ import annotations

import io
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from situate.llm import textnum as X
from situate.session import scratch_path

CACHED_PIECES = 1 << 21
BUCKET_KEYS = 4
#: bytes that may follow a blank at which text is cut: visible ASCII and lead bytes of blocks without white space
AFTER_BLANK = np.ones(256, bool)
AFTER_BLANK[:33] = AFTER_BLANK[127] = False
AFTER_BLANK[[0xC2, 0xE1, 0xE2, 0xE3]] = False
#: a letter of ASCII always ends its piece where any other ASCII byte follows
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
AFTER_LETTER = np.zeros(256, bool)
AFTER_LETTER[:128] = ~LETTER[:128]


# ---- minimal perfect hash -------------------------------------------------------------------------

def _mix(keys: np.ndarray, seed) -> np.ndarray:
    return X._finish(keys.astype(np.uint64) + np.asarray(seed, np.uint64) * np.uint64(X.HASH_BASE))


def build_mph(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pilots, slot of each key) over distinct int64 keys; slots are 0..n-1, each used once.

    Buckets are placed largest first, each with the first pilot that sends its keys to free slots; a
    bucket of one key stores its slot itself, as -1 - slot."""
    n = len(keys)
    pilots = np.zeros(max(1, -(-n // BUCKET_KEYS)), np.int32)
    slots = np.full(n, -1, np.int64)
    if not n:
        return pilots, slots
    u = keys.view(np.uint64)
    bucket = (_mix(u, 0) % np.uint64(len(pilots))).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    begin = np.searchsorted(bucket[order], np.arange(len(pilots) + 1))
    sizes = np.diff(begin)
    free = np.ones(n, bool)
    for b in np.argsort(-sizes, kind="stable"):
        k = int(sizes[b])
        if k <= 1:
            break
        own = order[begin[b]:begin[b + 1]]
        pilot, step = 1, 16
        while True:
            seeds = np.arange(pilot, pilot + step, dtype=np.uint64)
            at = (_mix(u[own][None, :], seeds[:, None]) % np.uint64(n)).astype(np.int64)
            good = free[at].all(axis=1)
            for r in np.flatnonzero(good):
                if len(set(at[r].tolist())) == k:
                    break
            else:
                pilot, step = pilot + step, min(step * 2, 4096)
                continue
            pilots[b] = pilot + r
            slots[own], free[at[r]] = at[r], False
            break
    left = np.flatnonzero(free)
    for b, slot in zip(np.flatnonzero(sizes == 1), left):
        pilots[b] = -1 - slot
        slots[order[begin[b]]] = slot
    return pilots, slots


def mph_slots(pilots: np.ndarray, n: int, keys: np.ndarray) -> np.ndarray:
    """The slot of each key (any slot for a key that isn't in the index)."""
    u = keys.astype(np.int64).view(np.uint64)
    p = pilots[(_mix(u, 0) % np.uint64(len(pilots))).astype(np.int64)].astype(np.int64)
    return np.where(p < 0, -1 - p, (_mix(u, np.maximum(p, 0).astype(np.uint64)) % np.uint64(max(n, 1))).astype(np.int64))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys.astype(np.int64).view(np.uint64), 1 << 32) >> np.uint64(32)).astype(np.uint32)


# ---- encoding ---------------------------------------------------------------------------------------

class PieceEncoder:
    """Encodes chunks of texts; remembers the ids of up to ``CACHED_PIECES`` distinct pieces."""

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.added = re.compile(b"|".join(re.escape(c.encode()) for c in sorted(added, key=len, reverse=True))) if added else None
        #: tokens that take blanks along, or match only normalised or whole words, leave their texts uncut
        self.plain = all(not (t.lstrip or t.rstrip or t.single_word or t.normalized) for t in self.tokenizer.get_added_tokens_decoder().values())
        self.end_id = end_id
        self._empty()

    def _empty(self):
        self.hashes = np.empty(0, np.uint64)
        self.at, self.length = np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool, self.used = np.empty(1 << 16, np.uint32), 1
        self.pool[0] = self.end_id

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        length = np.fromiter(map(len, got), np.int64, len(got))
        total = int(length.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty(len(self.pool), np.uint32)])
        self.pool[self.used:self.used + total] = np.fromiter((i for ids in got for i in ids), np.uint32, total)
        at = self.used + np.cumsum(length) - length
        self.used += total
        where = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, where, hashes)
        self.at, self.length = np.insert(self.at, where, at), np.insert(self.length, where, length)

    def _whole(self, raw: bytes, off: np.ndarray) -> list[tuple[int, int]]:
        """Spans that are never cut: each occurrence of an added token within a text, or whole texts."""
        texts = [(a, b) for a, b in zip(off[:-1].tolist(), off[1:].tolist()) if b > a]
        if self.added is None or not self.plain:
            return [] if self.added is None else texts
        return [m.span() for a, b in texts for m in self.added.finditer(raw, a, b)] if self.added.search(raw) else []

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id; ids per text)."""
        if len(self.hashes) > CACHED_PIECES:
            self._empty()
        n, full = len(data), np.flatnonzero(np.diff(off))
        mark = np.zeros(n, bool)
        mark[:-1] = (data[:-1] == 32) & AFTER_BLANK[data[1:]]
        mark[off[1:][full] - 1] = False
        raw = data.tobytes()
        whole = self._whole(raw, off)
        mark[[a - 1 for a, _ in whole if a]] = False  # a blank before one ends its stretch of text
        mark[1:] |= LETTER[data[:-1]] & AFTER_LETTER[data[1:]]
        for a, b in whole:
            mark[a:b] = False
            mark[a] = True
            mark[b:b + 1] = True
        mark[off[:-1][full]] = True
        starts = np.flatnonzero(mark)
        ends = np.append(starts[1:], n)[:len(starts)]
        first = np.searchsorted(starts, off)
        hashes, one, piece = np.unique(X.span_hash(X.byte_values(data), starts, ends), return_index=True, return_inverse=True)
        pos = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = pos < len(self.hashes)
        known[inside] = self.hashes[pos[inside]] == hashes[inside]
        if not known.all():
            new = np.flatnonzero(~known)
            self._learn(hashes[new], [raw[a:b].decode() for a, b in zip(starts[one[new]].tolist(), ends[one[new]].tolist())])
            pos = np.searchsorted(self.hashes, hashes)
        at = np.insert(self.at[pos][piece], first[1:], 0)
        length = np.insert(self.length[pos][piece], first[1:], 1)
        ids = self.pool[X.ragged(at, length)]
        upto = np.concatenate([[0], np.cumsum(length)])[first + np.arange(len(first))]
        return ids, np.diff(upto)


# ---- files ------------------------------------------------------------------------------------------

def _fs(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root)


def write_tokens(docs: DataFrame, tokenizer_path: str, root: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 0, id_bytes: int = 2, shards: int | None = None) -> dict:
    """Writes the store below ``root`` (default: the shared checkpoint folder) and returns its manifest:
    root, id_bytes and, per shard in key order, (shard, rows, ids). One small row per shard reaches the
    driver. ``id_bytes`` must be 4 for vocabularies beyond 65,536 ids."""
    spark = docs.sparkSession
    root = root or scratch_path(spark, "tokens")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = {2: "<u2", 4: "<u4"}[id_bytes]

    def write(batches):
        part = TaskContext.get().partitionId()
        files, base = _fs(root)
        files.create_dir(base, recursive=True)
        mine = f"{base}/.{part}-{TaskContext.get().taskAttemptId()}"
        encoder = X.worker_state(f"pieces {tokenizer_path} {end_id}", lambda: PieceEncoder(tokenizer_path, end_id))
        keys, nulls, counts = [], [], []
        with files.open_output_stream(mine) as out:
            for batch, data, off in X.chunks(batches, "text"):
                ids, count = encoder.encode(data, off)
                if id_bytes == 2 and len(ids) and int(ids.max()) >= 1 << 16:
                    raise ValueError("ids beyond 16 bits: use id_bytes=4")
                out.write(ids.astype(kind).tobytes())
                column = batch.column("key")
                nulls.append(np.asarray(column.is_null()))
                keys.append(np.asarray(column.fill_null(0)).astype(np.int64))
                counts.append(count)
        keys = np.concatenate(keys) if keys else np.empty(0, np.int64)
        nulls = np.concatenate(nulls) if nulls else np.empty(0, bool)
        starts = np.concatenate([[0], *[c for c in counts]]).astype(np.int64).cumsum()
        real = np.flatnonzero(~nulls)
        distinct, row = np.unique(keys[real], return_index=True)
        pilots, slots = build_mph(distinct)
        prints, rows = np.zeros(len(distinct), np.uint32), np.zeros(len(distinct), np.uint32)
        prints[slots], rows[slots] = fingerprints(distinct), real[row]
        buffer = io.BytesIO()
        np.savez(buffer, pilots=pilots, fingerprints=prints, rows=rows, keys=keys, nulls=nulls, starts=starts)
        with files.open_output_stream(mine + ".x") as out:
            out.write(buffer.getvalue())
        files.move(mine, f"{base}/ids-{part:05d}.bin")
        files.move(mine + ".x", f"{base}/idx-{part:05d}.npz")
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([len(keys)], pa.int64()), pa.array([int(starts[-1])], pa.int64())],
                                         names=["shard", "rows", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    done = rows.repartitionByRange(shards, "key").sortWithinPartitions("key", "text").mapInArrow(write, "shard long, rows long, ids long").collect()
    return {"root": root, "id_bytes": id_bytes, "shards": sorted((r["shard"], r["rows"], r["ids"]) for r in done)}


class Shard:
    """Random access to one shard by key."""

    def __init__(self, manifest: dict, shard: int):
        self.files, base = _fs(manifest["root"])
        self.kind = {2: "<u2", 4: "<u4"}[manifest["id_bytes"]]
        self.data = f"{base}/ids-{shard:05d}.bin"
        with self.files.open_input_file(f"{base}/idx-{shard:05d}.npz") as f:
            x = np.load(io.BytesIO(f.read()))
            self.pilots, self.fingerprints, self.rows, self.keys, self.nulls, self.starts = (
                x[k] for k in ("pilots", "fingerprints", "rows", "keys", "nulls", "starts"))

    def first_rows(self, keys: np.ndarray) -> np.ndarray:
        """The first row of each key, -1 where the shard hasn't the key."""
        keys = np.asarray(keys, np.int64)
        if not len(self.rows):
            return np.full(len(keys), -1, np.int64)
        slot = mph_slots(self.pilots, len(self.rows), keys)
        row = self.rows[slot].astype(np.int64)
        return np.where((self.fingerprints[slot] == fingerprints(keys)) & (self.keys[row] == keys), row, -1)

    def ids(self, row: int) -> np.ndarray:
        width = int(self.kind[-1])
        with self.files.open_input_file(self.data) as f:
            f.seek(int(self.starts[row]) * width)
            return np.frombuffer(f.read(int(self.starts[row + 1] - self.starts[row]) * width), self.kind)

    def get(self, key: int) -> np.ndarray | None:
        row = int(self.first_rows(np.array([key]))[0])
        return None if row < 0 else self.ids(row)

    def get_all(self, key: int) -> list[np.ndarray]:
        row, out = int(self.first_rows(np.array([key]))[0]), []
        while 0 <= row < len(self.keys) and self.keys[row] == key and not self.nulls[row]:
            out.append(self.ids(row))
            row += 1
        return out


def read_tokens(spark: SparkSession, manifest: dict) -> DataFrame:
    """Every row of the store, each found through its shard's index, in key order within a shard:
    doc_id, start (ids of all rows before it), n_tokens, ids_crc32 (of the ids as 32-bit integers)."""
    full = [s for s in manifest["shards"] if s[1]]
    base = dict(zip((s[0] for s in full), np.cumsum([0, *(s[2] for s in full)]).tolist()))
    names = [s[0] for s in full]

    def read(batches):
        for batch in batches:
            for i in batch.column(0).to_pylist():
                shard = Shard(manifest, names[i])
                row = np.arange(len(shard.keys))
                real = np.flatnonzero(~shard.nulls)
                found = shard.first_rows(shard.keys[real])
                first = np.concatenate([[0], np.flatnonzero(np.diff(shard.keys[real])) + 1]) if len(real) else real
                repeat = np.arange(len(real)) - np.repeat(first, np.diff(np.append(first, len(real)))) if len(real) else real
                if (found < 0).any():
                    raise ValueError(f"shard {names[i]}: keys missing from the index")
                row[real] = found + repeat
                width = int(shard.kind[-1])
                with shard.files.open_input_file(shard.data) as f:
                    crc, at = np.zeros(len(row), np.int64), 0
                    while at < len(row):
                        to = max(at + 1, int(np.searchsorted(shard.starts, shard.starts[at] + (1 << 20), side="right")) - 1)
                        to = min(to, len(row))
                        f.seek(int(shard.starts[at]) * width)
                        ids = np.frombuffer(f.read(int(shard.starts[to] - shard.starts[at]) * width), shard.kind).astype("<u4").tobytes()
                        zero = int(shard.starts[at])
                        for k in range(at, to):
                            crc[k] = zlib.crc32(ids[(int(shard.starts[k]) - zero) * 4:(int(shard.starts[k + 1]) - zero) * 4])
                        at = to
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.keys, pa.int64(), mask=shard.nulls), pa.array(shard.starts[row] + base[names[i]], pa.int64()),
                     pa.array(shard.starts[row + 1] - shard.starts[row], pa.int64()), pa.array(crc[row], pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not full:
        return spark.createDataFrame([], schema)
    return spark.range(0, len(full), 1, len(full)).mapInArrow(read, schema)
