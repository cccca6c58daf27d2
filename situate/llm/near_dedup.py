"""Near-duplicate detection with b-bit MinHash.

Shingles are runs of ``n`` words ([^\\x20\\x09-\\x0D]+ after lower-casing A-Z) as 64-bit hashes; a text of
fewer words is one shingle, a text without words has the empty set and is linked with nothing. Two
documents are linked when intersection / union >= ``threshold``, confirmed on the full sets.

1. One scan gives each document its set's size and digest, the band keys (``BANDS`` bands of
   ``ROWS`` full minima) and the b-bit signature: the low ``BITS`` bits of each of ``BANDS * ROWS``
   minima, packed. Rows with equal sets collapse to one node, named by 63 bits of the set's digest, before
   anything else, so exact copies cost one row each however many they are, and ids may be null or repeat. A pair at 0.8 shares no band with a chance of 5e-8.
2. In each band bucket every member meets the bucket's smallest id only; the collision-corrected
   estimate from bit counts drops hopeless pairs, each document confirms its best such pivot on the full
   sets, and confirmed links are contracted to components.
3. Buckets that still hold several components are compared by signature in cells of two blocks of about
   ``BLOCK`` members, so no bucket has to fit a task; pairs within a component aren't looked at, and a
   pair belongs to the first band in which it agrees. Members with a pair whose estimate is within
   ``SIGMAS`` standard deviations of the threshold (or above) meet again with their texts, and every such
   pair is confirmed inside its cell; only one link for each two components leaves it. Nothing is capped.

Texts, links and components stay distributed; iterations are cut by checkpoint() in the shared folder.
Null text is empty. Every row is linked by its own text, whatever its id: repeated ids yield a row each, a
null id counts as the largest. A class whose ids are all null has a null component_id. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from situate.llm import textnum as X
from situate.session import materialize, scratch_path

BANDS, ROWS, BITS = 32, 4, 4
PERMS = BANDS * ROWS
SIGMAS = 5.0
BLOCK = 1024
NIBBLES = np.uint64(0x1111111111111111)


def shingle_sets(data: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of each text, where each text's begin)."""
    _, _, _, first, hashes = X.words(data, off, X.NON_SPACE)
    at, h = X.windows(hashes, first, n)
    doc = np.searchsorted(first, at, side="right") - 1
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        one = X.span_hash(hashes | np.uint64(1), first[short], first[short + 1])
        doc, h = np.concatenate([doc, short]), np.concatenate([h, one])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    doc, h = doc[new], h[new]
    return h, np.searchsorted(doc, np.arange(len(off)))


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    seeds = X._finish(np.arange(1, 2 * PERMS + 1, dtype=np.uint64))
    return (seeds[:PERMS] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (seeds[PERMS:] >> np.uint64(32)).astype(np.uint32)


def minima(sets: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """PERMS minima (uint32) of each non-empty set."""
    x = (sets >> np.uint64(32)).astype(np.uint32)
    full = begin[:-1][np.diff(begin) > 0]
    out = np.empty((len(full), PERMS), np.uint32)
    if len(full):
        for k, (a, r) in enumerate(zip(*_permutations())):
            out[:, k] = np.minimum.reduceat((x ^ r) * a, full)
    return out


def pack(mins: np.ndarray) -> np.ndarray:
    """Packed signatures: the low BITS bits of each (scrambled) minimum, uint64 words."""
    low = ((mins ^ (mins >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(12)) & np.uint32((1 << BITS) - 1)
    per = 64 // BITS
    low = low.astype(np.uint64).reshape(len(mins), PERMS // per, per) << (np.arange(per, dtype=np.uint64) * np.uint64(BITS))
    return np.bitwise_or.reduce(low, axis=2)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimates of signature rows: matching share less the chance matches of BITS bits."""
    x = a ^ b
    x = (x | (x >> np.uint64(1)) | (x >> np.uint64(2)) | (x >> np.uint64(3))) & NIBBLES
    match = 1.0 - np.bitwise_count(x).sum(axis=-1) / PERMS
    chance = 2.0 ** -BITS
    return (match - chance) / (1 - chance)


def cutoff(threshold: float) -> float:
    """The least estimate at which a pair of the given similarity may be: SIGMAS deviations below."""
    chance = 2.0 ** -BITS
    match = threshold + (1 - threshold) * chance
    return threshold - SIGMAS * math.sqrt(match * (1 - match) / PERMS) / (1 - chance)


def _features(n: int):
    def run(batches):
        for batch, data, off in X.chunks(batches, "text"):
            sets, begin = shingle_sets(data, off, n)
            size = np.diff(begin)
            mins = minima(sets, begin)
            sigs = pack(mins)
            rows = mins.astype(np.uint64).reshape(len(mins), BANDS, ROWS)
            keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(mins), BANDS)).copy()
            for r in range(ROWS):
                keys = X._finish(keys + rows[:, :, r])
            digest, bands, packed, k = [], [], [], 0
            for d in range(len(size)):
                if size[d]:
                    digest.append(int.from_bytes(hashlib.blake2b(sets[begin[d]:begin[d + 1]].tobytes(), digest_size=8).digest(), "little") >> 1)
                    bands.append(keys[k].view(np.int64))
                    packed.append(sigs[k].tobytes())
                    k += 1
                else:
                    digest.append(None)
                    bands.append(None)
                    packed.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(size, pa.int64()), pa.array(digest, pa.int64()),
                                              pa.array(bands, pa.list_(pa.int64())), pa.array(packed, pa.binary())],
                                             names=["doc_id", "text_key", "n_shingles", "doc", "bands", "sig"])
    return run


def _similar(n: int, percent: int):
    """Keeps the pairs whose full sets have 100 * intersection >= percent * union."""
    def run(batches):
        for batch in batches:
            for piece, da, oa in X.chunks([batch], "text_a"):
                sa, ba = shingle_sets(da, oa, n)
                sb, bb = shingle_sets(*X.utf8(piece.column("text_b")), n)
                keep = []
                for i in range(len(oa) - 1):
                    x, y = sa[ba[i]:ba[i + 1]], sb[bb[i]:bb[i + 1]]
                    both = len(x) + len(y) - len(np.union1d(x, y))
                    keep.append(len(x) > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                yield piece.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _estimated(batches):
    """Adds the estimate of each pair from its signatures."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b"))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(estimate(a, b), pa.float64())], names=["a", "b", "est"])


def _groups(batches, key: tuple[str, ...]):
    """Arrow tables of whole groups' rows, from a partition sorted by ``key`` (one or more groups each)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        cols = [np.asarray(batch.column(k)) for k in key]
        last = np.ones(batch.num_rows, bool)
        for c in cols:
            last &= c == c[-1]
        begin = int(np.argmax(last))  # the last group may go on in the next batch
        if begin == 0 and len(held) > 1 and all(np.asarray(held[0].column(k))[-1] == c[0] for k, c in zip(key, cols)):
            continue
        held[-1] = batch.slice(0, begin)
        table = pa.Table.from_batches(held)
        held = [batch.slice(begin)]
        if table.num_rows:
            yield table
    if held:
        yield pa.Table.from_batches(held)


def _cuts(table: pa.Table, key: tuple[str, ...]) -> np.ndarray:
    new = np.ones(table.num_rows, bool)
    new[1:] = False
    for k in key:
        c = np.asarray(table.column(k))
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)


CELL = ("key", "lo", "hi")


def _matrix(column, kind) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_list(column.type):
        return np.asarray(column.flatten()).reshape(len(column), -1)
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _open_pairs(table: pa.Table, least: float, percent: int):
    """For each cell: (its first row, left rows, right rows) of the pairs to confirm there.

    A pair is between different components, may be similar by size and estimate, and belongs to the
    first band in which the two agree, so each pair is met in one bucket only."""
    sig, bands = _matrix(table.column("sig"), np.uint64), _matrix(table.column("bands"), np.int64)
    n, comp, doc, side, band = (np.asarray(table.column(c)) for c in ("n", "comp", "doc", "side", "band"))
    cuts = _cuts(table, CELL)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        left, right = a + np.flatnonzero(side[a:b] != 1), a + np.flatnonzero(side[a:b] != 0)
        if not len(left) or not len(right):
            continue
        step, us, them = max(1, 65536 // len(right)), [], []
        for i in range(0, len(left), step):
            l = left[i:i + step, None]
            ok = (comp[l] != comp[right]) & (100 * np.minimum(n[l], n[right]) >= percent * np.maximum(n[l], n[right]))
            ok &= (side[l] != 2) | (doc[l] < doc[right])
            x, y = np.nonzero(ok)
            x, y = left[i + x], right[y]
            good = estimate(sig[x], sig[y]) >= least
            x, y = x[good], y[good]
            own = np.argmax(bands[x] == bands[y], axis=1) == band[a]
            us.append(x[own])
            them.append(y[own])
        us, them = np.concatenate(us), np.concatenate(them)
        if len(us):
            yield a, us, them


def _open_members(least: float, percent: int):
    """The rows of each cell that have a pair to confirm."""
    def run(batches):
        for table in _groups(batches, CELL):
            rows = [np.union1d(us, them) for _, us, them in _open_pairs(table, least, percent)]
            if rows:
                yield from table.select([*CELL, "band", "side", "doc", "comp"]).take(pa.array(np.concatenate(rows))).to_batches()
    return run


def _links(n: int, least: float, percent: int):
    """Confirms each cell's pairs on the full sets; a link for each two components that have one."""
    def run(batches):
        for table in _groups(batches, CELL):
            doc, comp = np.asarray(table.column("doc")), np.asarray(table.column("comp"))
            text = table.column("text")
            out = []
            for _, us, them in _open_pairs(table, least, percent):
                rows = np.union1d(us, them)
                sets, begin = shingle_sets(*X.utf8(text.take(pa.array(rows))), n)
                parent: dict[int, int] = {}

                def root(c):
                    while parent.setdefault(c, c) != c:
                        parent[c] = c = parent[parent[c]]
                    return c

                at, to = np.searchsorted(rows, us), np.searchsorted(rows, them)
                for i in np.unique(at).tolist():
                    own = sets[begin[i]:begin[i + 1]]
                    mine = to[at == i]
                    size = np.diff(begin)[mine]
                    near = sets[X.ragged(begin[mine], size)]
                    pos = np.minimum(np.searchsorted(own, near), len(own) - 1)
                    both = np.add.reduceat((own[pos] == near).astype(np.int64), np.cumsum(size) - size)
                    for j in mine[100 * both >= percent * (len(own) + size - both)].tolist():
                        one, two = root(int(comp[rows[i]])), root(int(comp[rows[j]]))
                        if one != two:
                            parent[one] = two
                            out.append((int(doc[rows[i]]), int(doc[rows[j]])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])
    return run


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable over ``edges`` (a, b), for each node of an edge.

    Each round takes the neighbours' smallest label and jumps to that label's label; rounds end when
    nothing changes. A node with very many links only ever aggregates minima."""
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("comp")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("m"))
        step = labels.join(near, "node").select("node", F.least("comp", "m").alias("comp"), F.col("comp").alias("old"))
        up = labels.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        step = materialize(step.join(up, "comp").select("node", F.least("comp", "up").alias("comp"), "old"))
        labels = step.select("node", "comp")
        if step.where("comp != old").isEmpty():
            return labels


def text_key(text: Column) -> Column:
    """Digest of a text; null is empty."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def row_classes(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, text_key, n_shingles, class (null without words), component_id
    (the smallest id of the class, its own without words)."""
    spark = docs.sparkSession
    least = cutoff(percent / 100)
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), text_key(text).alias("text_key"))
    path = scratch_path(spark, "minhash")
    rows.mapInArrow(_features(n), "doc_id long, text_key binary, n_shingles long, doc long, bands array<long>, sig binary").write.parquet(path)
    feats = spark.read.parquet(path)

    whole = feats.where("doc is not null").groupBy("doc").agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "text_key")).alias("row"),
                                                              F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    whole = materialize(whole)
    sigs = whole.select("doc", "n", "sig", "bands")
    slots = sigs.select("doc", F.posexplode("bands").alias("band", "key"))
    buckets = slots.groupBy("key").agg(F.min("doc").alias("pivot"), F.count("*").alias("size")).where("size > 1")
    members = materialize(slots.join(buckets, "key").select("key", "band", "doc", "pivot"))
    brief = sigs.select("doc", "n", "sig")
    known = members.select("doc").distinct().join(whole.select("doc", F.col("row.doc_id").alias("id"), F.col("row.text_key").alias("key")), "doc")
    text_path = scratch_path(spark, "minhash-texts")
    rows.join(known, rows["doc_id"].eqNullSafe(known["id"]) & (rows["text_key"] == known["key"])).select("doc", "text").dropDuplicates(["doc"]).write.option("compression", "zstd").parquet(text_path)
    texts = spark.read.parquet(text_path)

    def confirmed(pairs: DataFrame) -> DataFrame:
        a = texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a"))
        b = texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b"))
        return pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(_similar(n, percent), "a long, b long")

    # each document's best pivot
    stars = members.where("doc != pivot").select("doc", "pivot").distinct()
    sides = stars.join(brief.select("doc", F.col("n").alias("n_a"), F.col("sig").alias("sig_a")), "doc").join(
        brief.select(F.col("doc").alias("pivot"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b")), "pivot")
    sides = sides.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    scored = sides.select(F.col("doc").alias("a"), F.col("pivot").alias("b"), "sig_a", "sig_b").mapInArrow(_estimated, "a long, b long, est double")
    best = scored.where(F.col("est") >= least).groupBy("a").agg(F.max(F.struct("est", (-F.col("b")).alias("b"))).alias("m")).select("a", (-F.col("m.b")).alias("b"))
    edges = materialize(confirmed(best))

    # what is left between components of one bucket
    comps = connected_components(edges)
    named = members.join(comps.withColumnRenamed("node", "doc"), "doc", "left").select("key", "band", "doc", F.coalesce("comp", "doc").alias("comp"))
    left = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size")).where("lo != hi")
    cells = named.join(left.select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "key")
    cells = cells.withColumn("own", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "band",
                         F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"), "doc", "comp")
    some = materialize(cells.join(sigs, "doc").repartition(*CELL).sortWithinPartitions(*CELL).mapInArrow(_open_members(least, percent), cells.schema))
    full = some.join(sigs, "doc").join(texts, "doc").repartition(*CELL).sortWithinPartitions(*CELL)
    edges = materialize(edges.union(full.mapInArrow(_links(n, least, percent), "a long, b long")))
    comps = connected_components(edges)
    final = whole.select("doc", "least").join(comps.withColumnRenamed("node", "doc"), "doc", "left").select("doc", "least", F.coalesce("comp", "doc").alias("class"))
    names = final.groupBy("class").agg(F.min("least").alias("component_id"))
    out = feats.select("doc_id", "text_key", "n_shingles", "doc").join(final.select("doc", "class").join(names, "class"), "doc", "left")
    return out.select("doc_id", "text_key", "n_shingles", "class", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id, kept (rows with the smallest id of their class)."""
    out = row_classes(docs, n, percent, id_col, text_col)
    return out.select("doc_id", "n_shingles", "component_id", F.col("component_id").eqNullSafe(F.col("doc_id")).alias("kept"))


def kept_rows(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key) of the rows to keep: of each class the one with the smallest id (a null id last),
    then the smallest text_key; all without words."""
    rows = row_classes(docs, n, percent, id_col, text_col)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    first = rows.where("class is not null").groupBy("class").agg(F.min(order).alias("row")).select("row.doc_id", "row.text_key")
    return first.union(rows.where("class is null").select("doc_id", "text_key").distinct())
