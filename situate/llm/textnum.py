"""Vectorised text primitives for Arrow batches: chunks of UTF-8 bytes, words as byte spans, hashes.

A chunk is a run of whole texts of one Arrow batch, at most ``CHUNK`` bytes unless one text alone is
longer; memory is a small multiple of the chunk, never of the partition. A null text is empty.
"""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
#: odd multiplier of the rolling hash and the two multipliers of the 64-bit finaliser (splitmix64)
HASH_BASE = 0x9E3779B97F4A7C15
FINAL_1, FINAL_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: every byte but [\x20\x09-\x0D]
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[9, 10, 11, 12, 13, 32]] = False
#: lower-cased [^\x00-\x2F\x3A-\x60\x7B-\x7F]: digits, letters and everything beyond ASCII
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def worker_state(name: str, make):
    """An object that outlives a task in a reused Python worker (a cache, never a result)."""
    store = sys.modules.setdefault("_situate_llm_state", types.ModuleType("_situate_llm_state")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, off, data = column.buffers()
    if off is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[off[0]:off[-1]], off.astype(np.int64) - int(off[0])


def chunks(batches, text: str, limit: int = CHUNK):
    """(batch slice, bytes, offsets) for runs of whole texts of about ``limit`` bytes."""
    for batch in batches:
        data, off = utf8(batch.column(batch.schema.get_field_index(text)))
        i, n = 0, len(off) - 1
        while i < n:
            j = min(n, max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1))
            yield batch.slice(i, j - i), data[off[i]:off[j]], off[i:j + 1] - off[i]
            i = j


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(FINAL_1)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(FINAL_2)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` of each."""
    have = worker_state("powers", dict)
    if have.get("n", 0) < n:
        size = max(n, CHUNK + 1)
        for key, base in (("up", HASH_BASE), ("down", pow(HASH_BASE, -1, 1 << 64))):
            p = np.full(size, np.uint64(base))
            p[0] = 1
            have[key] = np.cumprod(p, dtype=np.uint64)
        have["n"] = size
    return have["up"], have["down"]


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``values[start:end]`` (uint64, none zero): equal runs, equal hashes."""
    n = len(values)
    up, down = _powers(n + 1)
    acc = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=acc[1:])
    return _finish((acc[ends] - acc[starts]) * down[starts])


def byte_values(data: np.ndarray) -> np.ndarray:
    """A fixed odd 64-bit value for each byte."""
    return (_finish(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1))[data]


def mask_spans(mask: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``mask`` within each text: starts, ends, and each text's first run (n + 1)."""
    n = len(mask)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(off), np.int64)
    before = np.empty(n, bool)
    before[0], before[1:] = False, mask[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, mask[1:]
    inner = off[(off > 0) & (off < n)]
    before[inner] = False
    after[inner - 1] = False
    starts = np.flatnonzero(mask & ~before)
    return starts, np.flatnonzero(mask & ~after) + 1, np.searchsorted(starts, off)


def words(data: np.ndarray, off: np.ndarray, kind: np.ndarray = NON_SPACE):
    """Lower-cases A-Z and finds words (runs of ``kind``): (lower bytes, starts, ends, first, hashes)."""
    low = LOWER[data]
    starts, ends, first = mask_spans(kind[low], off)
    return low, starts, ends, first, span_hash(byte_values(low), starts, ends)


def windows(values: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every run of ``length`` consecutive values that lies within one text."""
    n = len(values) - length + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    inside = np.ones(n, bool)
    for k in range(1, length):  # a window that starts k values before a text's first value crosses into it
        cross = first[1:-1] - k
        inside[cross[(cross >= 0) & (cross < n)]] = False
    start = np.flatnonzero(inside)
    return start, span_hash(values | np.uint64(1), start, start + length)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenation of the runs [start, start + length)."""
    total = int(lengths.sum())
    at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return at + np.arange(total)


def code_points(data: np.ndarray) -> np.ndarray:
    """Code points before each byte position (n + 1)."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out
