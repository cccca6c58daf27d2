"""Language-model scores by context-tree weighting over bytes.

A text is the sequence of its lower-cased words ([^\\x20\\x09-\\x0D]+), each followed by a blank, the last
(or an empty text) by an end byte; before it stand end bytes. Every byte is eight binary decisions. Each
(context of d bytes, bits so far) is a node with a Krichevsky-Trofimov estimator; context-tree weighting
mixes the nodes of all depths 0..``depth`` with the weights that their block probabilities give. Block
probabilities depend on counts only, so the tree is learnt from counts of byte runs over all training
texts, and a byte's code length is a function of its run of depth + 1 bytes.

One scan cuts the input into blocks of whole texts (about ``BLOCK_BYTES``, or ``BLOCK_RUNS`` distinct runs)
and writes the texts and, per block, its distinct runs and words with their counts. Spark sums the counts,
computes the subtrees below each context of two bytes in parallel, and finishes the two top levels from
sums over those subtrees' root nodes (at most 65,536 rows reach the driver). The values of runs and the
counts of words (the base model is add-one word frequencies) are joined to the blocks' rows by shuffle and
come back to each block, which then scores its own texts: nothing that grows with the corpus is collected
or broadcast, and the depth is the same at every size.

Null text is empty: one end token, the code length of the end byte. Repeated rows are scored each by
itself. With no training rows every bit costs one bit. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from situate.llm import textnum as X
from situate.session import materialize, scratch_path

DEPTH = 5
END = 10
MERGE_AT = 800_000
BLOCK_BYTES, BLOCK_RUNS = 1 << 24, 2_000_000
SUBTREE_RUNS, PACK = 1 << 16, 1 << 19


# ---- byte runs -------------------------------------------------------------------------------------

def sequence(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the normalised texts: words with a blank after each, the end byte last."""
    count = np.diff(first)
    empty = np.flatnonzero(count == 0)
    starts, ends = np.insert(starts, first[empty], 0), np.insert(ends, first[empty], 0)
    last = np.cumsum(np.maximum(count, 1)) - 1
    length = ends - starts + 1
    stop = np.cumsum(length)
    out = low[np.minimum(X.ragged(starts, length), max(len(low) - 1, 0))] if len(low) else np.zeros(int(stop[-1]) if len(stop) else 0, np.uint8)
    out[stop - 1] = 32
    out[stop[last] - 1] = END
    return out, np.append(0, stop[last])


def runs(seq: np.ndarray, off: np.ndarray, depth: int) -> np.ndarray:
    """For each byte the number made of its ``depth`` bytes before and itself (the last byte)."""
    n = len(seq)
    key = seq.astype(np.uint64)
    for d in range(1, min(depth, n - 1) + 1):
        key[d:] |= seq[:n - d].astype(np.uint64) << np.uint64(8 * d)
    length = np.diff(off)
    for d in range(depth):  # the d-th byte of a text has d bytes of its own before it
        at = off[:-1][length > d] + d
        low = np.uint64((1 << 8 * (d + 1)) - 1)
        ends = np.uint64(int.from_bytes(bytes([END]) * (depth + 1), "big") & ~int(low))
        key[at] = (key[at] & low) | ends
    return key


# ---- tree ------------------------------------------------------------------------------------------

def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after a shift by eight."""
    x = np.asarray(x, np.float64)
    small = x < 8
    y = np.where(small, x + 8, x)
    product = np.ones_like(x)
    for k in range(8):
        product *= np.where(small, x + k, 1.0)
    z = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + (1 / 12 - z * (1 / 360 - z / 1260)) / y - np.log(product)


def log_kt(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov block probability of counts."""
    return log_gamma(zero + 0.5) + log_gamma(one + 0.5) - log_gamma(zero + one + 1) - math.log(math.pi)


def _bits(symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[runs, 8] node within the byte (a leading 1, then the bits so far) and bit of each decision."""
    k = np.arange(8)
    s = symbol.astype(np.int64)[:, None]
    return (1 << k) | (s >> (8 - k)), (s >> (7 - k)) & 1


def _depth_nodes(context: np.ndarray, node: np.ndarray, bit: np.ndarray, n: np.ndarray):
    """Distinct nodes of one depth: (keys, place of each decision, zeros, ones)."""
    keys, place = np.unique(((context.astype(np.int64)[:, None] << 8) | node).ravel(), return_inverse=True)
    weight = np.repeat(n.astype(np.float64), 8)
    ones = np.bincount(place, weights=weight * bit.ravel(), minlength=len(keys))
    return keys, place, np.bincount(place, weights=weight, minlength=len(keys)) - ones, ones


def subtree(keys: np.ndarray, n: np.ndarray, depth: int, least: int):
    """Weighted nodes from ``depth`` up to ``least``: (p [runs, 8] of each decision given the subtree at
    ``least``, node keys, zeros, ones, log weighted probability at ``least``)."""
    node, bit = _bits(keys & np.uint64(255))
    context = (keys >> np.uint64(8)).astype(np.int64)
    p = lower = None
    for d in range(depth, least - 1, -1):
        own, place, zero, one = _depth_nodes(context & ((1 << 8 * d) - 1), node, bit, n)
        kt = log_kt(zero, one)
        guess = (np.where(bit.ravel() == 1, one[place], zero[place]) + 0.5) / (zero + one + 1)[place]
        if d == depth:
            weighted, p = kt, guess
        else:
            up = ((lower[0] >> 8) & ((1 << 8 * d) - 1)) << 8 | (lower[0] & 255)
            below = np.bincount(np.searchsorted(own, up), weights=lower[1], minlength=len(own))
            weighted = np.logaddexp(kt, below) - math.log(2)
            share = np.exp(np.minimum(kt - math.log(2) - weighted, 0))[place]
            p = share * guess + (1 - share) * p
        lower = (own, weighted)
    return p.reshape(-1, 8), own, zero, one, weighted


def top_levels(keys: np.ndarray, zero: np.ndarray, one: np.ndarray, weighted: np.ndarray):
    """(share of the own estimate, estimate of a 1) of each node at depths 1 ([256, 256]) and 0 ([256])."""
    out = []
    context, node = keys >> 8, keys & 255
    place, size = (context & 255) << 8 | node, 65536
    for _ in range(2):
        z, o, below = (np.bincount(place, weights=v, minlength=size) for v in (zero, one, weighted))
        kt = log_kt(z, o)
        weighted = np.logaddexp(kt, below) - math.log(2)
        out.append((np.exp(np.minimum(kt - math.log(2) - weighted, 0)), (o + 0.5) / (z + o + 1)))
        place, size, zero, one = np.arange(size) & 255, 256, z, o
    return out


def finish(keys: np.ndarray, p: np.ndarray, top) -> np.ndarray:
    """log10 probability of each run's last byte from its subtree's decisions and the two top levels."""
    node, bit = _bits(keys & np.uint64(255))
    last = ((keys >> np.uint64(8)) & np.uint64(255)).astype(np.int64)[:, None]
    for (share, guess), place in zip(top, (last << 8 | node, node)):
        g = np.where(bit == 1, guess[place], 1 - guess[place])
        p = share[place] * g + (1 - share[place]) * p
    return np.log10(p).sum(axis=1)


# ---- Spark -----------------------------------------------------------------------------------------

def _merged(parts: list) -> list:
    """Sums (key, n) pairs by key."""
    keys = np.concatenate([k for k, _ in parts])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], np.concatenate([v for _, v in parts])[order]
    head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return [(keys[head], np.add.reduceat(n, head) if len(head) else n)]


RUN, WORD, TEXT, ROW = 0, 1, 2, 3


def _blocks(depth: int):
    """The texts with their block; for each block its distinct runs and words with their counts in texts
    learnt from (0 if in none); and the number of texts learnt from."""
    def run(batches):
        part, block, size, texts = TaskContext.get().partitionId(), 0, 0, 0
        held, types = {RUN: [], WORD: []}, None

        def rows(kind, keys, n):
            m = len(keys)
            return pa.RecordBatch.from_arrays([pa.array(np.full(m, kind, np.int32)), pa.array(np.full(m, (part << 24) | block)), pa.array(keys), pa.array(n),
                                               *[pa.nulls(m, t) for t in types]], names=names)

        def flush():
            for kind in (RUN, WORD):
                for keys, n in _merged(held[kind]) if held[kind] else []:
                    for i in range(0, len(keys), 1 << 16):
                        yield rows(kind, keys[i:i + (1 << 16)].view(np.int64), n[i:i + (1 << 16)])
                held[kind] = []

        names = ["kind", "block", "key", "n", "doc_id", "learn", "text"]
        for batch, data, off in X.chunks(batches, "text"):
            types = [batch.column(c).type for c in names[4:]]
            if size and (size + len(data) > BLOCK_BYTES or sum(len(k) for k, _ in held[RUN]) > BLOCK_RUNS):
                yield from flush()
                block, size = block + 1, 0
            m = batch.num_rows
            size += len(data) + m
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, ROW, np.int32)), pa.array(np.full(m, (part << 24) | block)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()),
                                              *[batch.column(c) for c in names[4:]]], names=names)
            learn = np.asarray(batch.column("learn"))
            texts += int(learn.sum())
            low, starts, ends, first, hashes = X.words(data, off)
            seq, at = sequence(low, starts, ends, first)
            key = runs(seq, at, depth)
            for kind, values, mask in ((RUN, key, np.repeat(learn, np.diff(at))), (WORD, hashes, np.repeat(learn, np.diff(first)))):
                yes, n = np.unique(values[mask], return_counts=True)
                held[kind].append((yes, n.astype(np.int64)))
                if not learn.all():
                    no = np.unique(values[~mask])
                    held[kind].append((no, np.zeros(len(no), np.int64)))
                if sum(len(k) for k, _ in held[kind]) > MERGE_AT:
                    held[kind] = _merged(held[kind])
        if types:
            yield from flush()
            yield rows(TEXT, np.zeros(1, np.int64), np.array([texts], np.int64))
    return run


def _subtrees(depth: int):
    """Per partition of whole contexts of two bytes: a row per run (key, its eight decisions) and a row
    per node of depth 2 (key, zeros, ones, log weighted probability)."""
    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        keys, n = np.asarray(table.column("key")).view(np.uint64), np.asarray(table.column("n"))
        context = (keys >> np.uint64(8)) & np.uint64(65535)
        order = np.argsort(context, kind="stable")
        keys, n, context = keys[order], n[order], context[order]
        head = np.append(np.flatnonzero(np.append(True, context[1:] != context[:-1])), len(keys))
        names, begin = ["kind", "key", "value", "zero", "one", "weighted"], 0
        while begin < len(keys):  # whole contexts, as many as fit
            end = int(head[max(np.searchsorted(head, begin + SUBTREE_RUNS, side="right") - 1, np.searchsorted(head, begin, side="right"))])
            own_keys = keys[begin:end]
            p, own, zero, one, weighted = subtree(own_keys, n[begin:end], depth, 2)
            for i in range(0, len(own_keys), 1 << 15):
                part = np.ascontiguousarray(p[i:i + (1 << 15)])
                m = len(part)
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(m, np.int32)), pa.array(own_keys[i:i + m].view(np.int64)),
                                                  pa.array([r.tobytes() for r in part], pa.binary()), *[pa.nulls(m, pa.float64())] * 3], names=names)
            m = len(own)
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(m, np.int32)), pa.array(own), pa.nulls(m, pa.binary()), pa.array(zero), pa.array(one), pa.array(weighted)], names=names)
            begin = end
    return run


def _hash_table(keys: np.ndarray, values: np.ndarray) -> dict:
    """Open addressing, at most half full; the number of probes of the farthest key."""
    size = 1 << max(4, int(len(keys) * 2).bit_length())
    slots, out = np.full(size, np.iinfo(np.uint64).max, np.uint64), np.zeros(size, values.dtype)
    at, left, probes = (X._finish(keys) & np.uint64(size - 1)).astype(np.int64), np.arange(len(keys)), 0
    while len(left):
        probes += 1
        free = slots[at[left]] == np.iinfo(np.uint64).max
        cand = left[free]
        slots[at[cand]] = keys[cand]  # of several keys for one slot the last stays
        won = cand[slots[at[cand]] == keys[cand]]
        out[at[won]] = values[won]
        keep = np.ones(len(keys), bool)
        keep[won] = False
        left = left[keep[left]]
        at[left] = (at[left] + 1) & (size - 1)
    return {"keys": slots, "values": out, "probes": probes}


def _find(table: dict, keys: np.ndarray) -> np.ndarray:
    slots, mask = table["keys"], len(table["keys"]) - 1
    at = (X._finish(keys) & np.uint64(mask)).astype(np.int64)
    out = table["values"][at]
    left = np.flatnonzero(slots[at] != keys)
    for _ in range(table["probes"]):
        if not len(left):
            break
        at[left] = (at[left] + 1) & mask
        hit = slots[at[left]] == keys[left]
        out[left[hit]] = table["values"][at[left[hit]]]
        left = left[~hit]
    return out


def _packed(batches):
    """Rows of (block, kind, key, value) as one compressed piece for each block and kind of about PACK rows."""
    held, many = [], 0

    def flush():
        block, kind, key, value = (np.concatenate([h[i] for h in held]) for i in range(4))
        order = np.lexsort((key, kind, block))
        block, kind, key, value = block[order], kind[order], key[order], value[order]
        cuts = np.append(np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (kind[1:] != kind[:-1]))), len(block))
        out = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            own = value[a:b].astype(np.float32 if kind[a] == RUN else np.float64)
            planes = [x.view(np.uint8).reshape(b - a, -1).T.tobytes() for x in (np.diff(key[a:b], prepend=np.uint64(0)), own)]
            out.append(pa.compress(b"".join(planes), codec="zstd", asbytes=True))
        return pa.RecordBatch.from_arrays([pa.array(block[cuts[:-1]]), pa.array(kind[cuts[:-1]]), pa.array(np.diff(cuts)), pa.array(out, pa.binary())], names=["block", "kind", "size", "data"])

    for batch in batches:
        if batch.num_rows:
            held.append([np.asarray(batch.column(0)), np.asarray(batch.column(1)), np.asarray(batch.column(2)).view(np.uint64), np.asarray(batch.column(3))])
            many += batch.num_rows
        if many >= PACK:
            yield flush()
            held, many = [], 0
    if held:
        yield flush()


def _packed_texts(batches):
    """Rows of (block, ROW, size, data): a block's texts as compressed Arrow streams of at most one batch each."""
    for batch in batches:
        block = np.asarray(batch.column("block"))
        cuts = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(block)) if len(block) else np.zeros(1, np.int64)
        own = batch.select(["doc_id", "learn", "text"])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, own.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(own.slice(a, b - a))
            yield pa.RecordBatch.from_arrays([pa.array(block[a:a + 1]), pa.array([ROW], pa.int32()), pa.array([b - a], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                             names=["block", "kind", "size", "data"])


def _unpacked(kind: int, size: int, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    of = np.dtype(np.float32 if kind == RUN else np.float64)
    raw = np.frombuffer(pa.decompress(data, decompressed_size=size * (8 + of.itemsize), codec="zstd", asbytes=True), np.uint8)
    parts = raw[:8 * size].reshape(8, size), raw[8 * size:].reshape(of.itemsize, size)
    keys, values = (np.ascontiguousarray(x.T).reshape(-1).view(t) for x, t in zip(parts, (np.uint64, of)))
    return np.cumsum(keys, dtype=np.uint64), values


def _scores(depth: int):
    """A row per text, from partitions sorted by block and kind: a block's values stand before its texts."""
    def run(batches):
        now, held, tables = None, {RUN: [], WORD: []}, {}
        for batch in batches:
            block, kind = np.asarray(batch.column("block")), np.asarray(batch.column("kind"))
            new = np.append(True, (block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) if len(block) else np.empty(0, bool)
            cuts = np.append(np.flatnonzero(new), len(block))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if block[a] != now:
                    now, held, tables = block[a], {RUN: [], WORD: []}, {}
                piece, k = batch.slice(a, b - a), int(kind[a])
                if k != ROW:
                    held[k] += [_unpacked(k, n, data) for n, data in zip(piece.column("size").to_pylist(), piece.column("data").to_pylist())]
                    continue
                for k in (RUN, WORD) if not tables else ():
                    parts = held.pop(k) or [(np.empty(0, np.uint64), np.empty(0, np.float64))]
                    tables[k] = _hash_table(np.concatenate([x for x, _ in parts]), np.concatenate([v for _, v in parts]))
                texts = (t for data in piece.column("data") for t in pa.ipc.open_stream(data.as_buffer()))
                for own, data, off in X.chunks(texts, "text"):
                    low, starts, ends, first, hashes = X.words(data, off)
                    seq, at = sequence(low, starts, ends, first)
                    value = _find(tables[RUN], runs(seq, at, depth)).astype(np.float64)
                    c, count = _find(tables[WORD], hashes), np.diff(first)
                    place, m = np.repeat(np.arange(len(count)), count), len(count)
                    yield pa.RecordBatch.from_arrays([own.column("doc_id"), own.column("learn"), pa.array(count + 1, pa.int64()),
                                                      pa.array(np.bincount(place, weights=c > 0, minlength=m).astype(np.int64)),
                                                      pa.array(np.bincount(place, weights=np.log10(c + 1), minlength=m).astype(np.float64)), pa.array(np.diff(at)), pa.array(np.add.reduceat(value, at[:-1]))],
                                                     names=["doc_id", "learn", "n_tokens", "known", "s", "n_bytes", "score"])
    return run


def score(docs: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """Per row: doc_id, learn, n_tokens, n_known, train_tokens, bits_per_byte (code length), base_score, score (log10).

    ``learn``: a boolean expression, true for the rows to learn from; all rows are scored."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(learn, F.lit(False)).alias("learn"), F.col(text_col).cast("string").alias("text"))
    ident = rows.schema["doc_id"].dataType.simpleString()
    schema = f"block long, key long, n long, doc_id {ident}, learn boolean, text string, kind int"
    path = scratch_path(spark, "ctw-blocks")
    rows.mapInArrow(_blocks(depth), f"kind int, block long, key long, n long, doc_id {ident}, learn boolean, text string").write.partitionBy("kind").option("compression", "zstd").parquet(path)
    blocks = spark.read.schema(schema).parquet(path)
    path = scratch_path(spark, "ctw-counts")
    blocks.where(F.col("kind") != ROW).groupBy("kind", "key").agg(F.sum("n").alias("n")).write.partitionBy("kind").parquet(path)
    counts = spark.read.schema("key long, n long, kind int").parquet(path)
    grams = counts.where(F.col("kind") == RUN).select("key", "n")
    tree = materialize(grams.repartition(F.shiftright("key", 8).bitwiseAND(65535)).mapInArrow(_subtrees(depth), "kind int, key long, value binary, zero double, one double, weighted double"))
    ordered = F.aggregate(F.array_sort(F.collect_list("weighted")), F.lit(0.0), lambda a, x: a + x)  # the same sum in any order of rows
    nodes = tree.where("kind = 1").groupBy(F.col("key").bitwiseAND(65535).alias("key")).agg(F.sum("zero").alias("zero"), F.sum("one").alias("one"), ordered.alias("weighted")).toArrow()
    top = top_levels(*[nodes.column(c).to_numpy() for c in ("key", "zero", "one", "weighted")])
    levels = spark.sparkContext.broadcast(top)

    def values(batches):
        for batch in batches:
            keys = np.asarray(batch.column("key")).view(np.uint64)
            p = np.frombuffer(b"".join(batch.column("value").to_pylist()), np.float64).reshape(-1, 8)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(finish(keys, p, levels.value))], names=["key", "value"])

    learnt = tree.where("kind = 0").select("key", "value").mapInArrow(values, "key long, value double").select(F.lit(RUN).alias("kind"), "key", "value")
    learnt = learnt.union(counts.where(F.col("kind") == WORD).where("n > 0").select("kind", "key", F.col("n").cast("double").alias("value")))
    total = counts.where(F.col("kind") != RUN).groupBy("kind").agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v")).collect()
    total = {r["kind"]: (r["n"], r["v"]) for r in total}
    texts = total.get(TEXT, (0, 0))[0]
    n = total.get(WORD, (0, 0))[0] + texts
    v = total.get(WORD, (0, 0))[1] + (texts > 0)

    own = blocks.where(F.col("kind").isin(RUN, WORD)).select("block", "kind", "key").join(learnt, ["kind", "key"], "left")
    own = own.select("block", "kind", "key", F.coalesce("value", F.lit(0.0)).alias("value")).mapInArrow(_packed, "block long, kind int, size long, data binary")
    texts_ = blocks.where(F.col("kind") == ROW).select("block", "doc_id", "learn", "text").mapInArrow(_packed_texts, "block long, kind int, size long, data binary")
    each = own.union(texts_).repartition("block").sortWithinPartitions("block", "kind").mapInArrow(_scores(depth), f"doc_id {ident}, learn boolean, n_tokens long, known long, s double, n_bytes long, score double")
    end = math.log10(texts + 1)
    return each.select("doc_id", "learn", "n_tokens", (F.col("known") + int(texts > 0)).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
                       (F.col("score") * -math.log2(10) / F.col("n_bytes")).alias("bits_per_byte"),
                       (F.col("s") + end - F.col("n_tokens") * math.log10(n + v + 1)).alias("base_score"), "score")
