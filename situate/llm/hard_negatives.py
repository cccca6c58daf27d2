"""Hard-negative mining with an angular triangle filter.

Scores are integer inner products of the components floor(scale * x). For each anchor the positives are
its best other rows of the same label; for each positive the negatives are the best rows of another label whose
score lies in [percent / 100, 1] times the positive's.

1. REFERENCES directions are spherical k-means centroids of SAMPLE rows (least hash of the id; the sample shapes the filter only,
   never the result). One scan stores each row's norm and its angles to all directions in the shared
   folder, ordered by nearest direction and angle, so neighbours in a file have narrow angle ranges.
2. Anchors come in blocks of ANCHORS (a broadcast of that many vectors at most, whatever the input). Each
   task walks over the stored rows in chunks of CHUNK. The spherical triangle inequality bounds the angle
   between anchor a and row x by |t(a) - t(x)| and t(a) + t(x) over all directions; the cosines of
   these bounds times both norms, widened by SLACK for rounding, bound the score. Whole chunks
   (by their angle ranges) and single rows whose bounds miss what an anchor still looks for are left out;
   integer scoring sees the rest only.
3. A first walk looks for scores that may enter an anchor's best positives; its windows are then known
   and a second walk looks for scores inside them, from the best found so far up. Tasks return their best few
   for each anchor or window, windows with a row limit merge them.

Every row is compared with every anchor unless a bound rules the pair out, so nothing is dropped: results are
exact whatever the references. Rows are split evenly (range partitions also by row number, so many equal
vectors spread); labels and ids are never a partitioning key of the rows.

Defined cases: rows with a null label or vector, or any null or non-finite component, take no part; a zero
or empty vector takes part (score 0); shorter vectors are padded by zeros; labels are compared as longs. Each row
counts by itself: rows that repeat an id are other rows, each anchor row has its own result. A null id is never
an anchor and comes last among ties. Scores beyond 64 bits are exact while compared within int arithmetic and
returned capped at the limits of long. Negative positive scores have empty windows. An empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from situate.llm import textnum as X
from situate.session import scratch_path

SAMPLE, REFERENCES, ROUNDS = 4096, 16, 8
ANCHORS, CHUNK, STRIP = 4096, 4096, 256
#: radians, and share of the norms' product, by which bounds are widened (float32 angles, arccos near 0)
SLACK, SHARE = 4e-6, 1e-9
NO_ID = np.iinfo(np.int64).max
LEAST, MOST = np.iinfo(np.int64).min + 1, np.iinfo(np.int64).max
FOUND = "anchor_row long, anchor_id long, slot int, positive_id long, positive_score long, id long, row long, score long"
FOUND_NAMES = [field.split(" ")[0] for field in FOUND.split(", ")]


def matrix(column, width: int = 0) -> np.ndarray:
    """A list column as a float64 matrix; short rows are padded by zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.diff(np.asarray(column.offsets)) if len(column) else np.empty(0, np.int64)
    flat = np.asarray(column.flatten()).astype(np.float64)
    d = max(int(size.max(initial=0)), width)
    if len(size) and (size == d).all():
        return flat.reshape(-1, d)
    out = np.zeros((len(size), d))
    out[np.repeat(np.arange(len(size)), size), X.ragged(np.zeros(len(size), np.int64), size)] = flat
    return out


def quantised(column, scale: int, width: int = 0) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.floor(scale * matrix(column, width))


def norms(q: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt(np.einsum("ij,ij->i", q, q))


def angles(q: np.ndarray, norm: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles to the (unit) directions; any angle does for a vector of norm 0."""
    d = max(q.shape[1], references.shape[1])
    q, references = (np.pad(m, ((0, 0), (0, d - m.shape[1]))) for m in (q, references))
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        unit = np.nan_to_num(q / norm[:, None], posinf=0, neginf=0)
    return np.arccos(np.clip(unit @ references.T, -1, 1)).astype(np.float32)


def references(sample: np.ndarray, k: int = REFERENCES, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of a bounded sample: farthest-first seeds, then spherical k-means rounds."""
    norm = norms(sample)
    unit = sample[(norm > 0) & np.isfinite(norm)] / norm[(norm > 0) & np.isfinite(norm), None]
    if not len(unit):
        return np.eye(1, max(sample.shape[1], 1))
    seeds, near = [0], unit @ unit[0]
    while len(seeds) < min(k, len(unit)):
        seeds.append(int(np.argmin(near)))
        near = np.maximum(near, unit @ unit[seeds[-1]])
    centers = unit[seeds]
    for _ in range(rounds):
        own = np.argmax(unit @ centers.T, axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, unit)
        size = norms(sums)
        centers = np.where(size[:, None] > 1e-9, sums / np.maximum(size, 1e-9)[:, None], centers)
    return centers


def score_bounds(t_a, n_a, t_x, n_x) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of every anchor's score with every row, from angles and norms alone."""
    least = np.zeros((len(n_a), len(n_x)), np.float32)
    most = np.full((len(n_a), len(n_x)), np.pi, np.float32)
    for r in range(t_a.shape[1]):
        a, x = t_a[:, r, None], t_x[None, :, r]
        np.maximum(least, np.abs(a - x), out=least)
        both = a + x
        np.minimum(most, np.minimum(both, np.float32(2 * np.pi) - both), out=most)
    with np.errstate(over="ignore", invalid="ignore"):
        scale = n_a[:, None] * n_x[None, :]
        wide = scale * SHARE + 1
        low = scale * np.cos(np.minimum(most.astype(np.float64) + SLACK, np.pi)) - wide
        high = scale * np.cos(np.maximum(least.astype(np.float64) - SLACK, 0)) + wide
    unknown = ~np.isfinite(scale)  # norms beyond double: no bound
    low[unknown], high[unknown] = -np.inf, np.inf
    return low, high


def chunk_bound(t_a, n_a, t_x, n_x) -> np.ndarray:
    """The most that any row of a chunk can score with each anchor, from the chunk's angle ranges."""
    apart = np.maximum(t_x.min(axis=0) - t_a, t_a - t_x.max(axis=0)).max(axis=1).astype(np.float64)
    cos = np.cos(np.maximum(apart - SLACK, 0))
    with np.errstate(over="ignore", invalid="ignore"):
        top = np.where(cos > 0, n_x.max(), n_x.min()) * n_a
        high = top * cos + top * SHARE + 1
    return np.where(np.isfinite(high), high, np.inf)


def products(a: np.ndarray, x: np.ndarray, most: float) -> np.ndarray:
    """Exact integer inner products (int64); ``most`` bounds the product of norms."""
    d = max(a.shape[1], x.shape[1])
    a, x = (np.pad(m, ((0, 0), (0, d - m.shape[1]))) if m.shape[1] < d else m for m in (a, x))
    if most < 2.0 ** 52:  # every partial sum is an integer that a double holds
        return (a @ x.T).astype(np.int64)
    if most < 2.0 ** 62:
        return a.astype(np.int64) @ x.astype(np.int64).T
    whole = [[sum(int(p) * int(q) for p, q in zip(u, v)) for v in x] for u in a]
    return np.array([[min(max(s, LEAST), MOST) for s in row] for row in whole], np.int64).reshape(len(a), len(x))


class _Best:
    """The best ``k`` (score, least id, least row) of each slot, over any number of offers."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot, self.score, self.id, self.row = (np.empty(0, np.int64) for _ in range(4))
        self.least = np.full(slots, LEAST, np.int64)  # the k-th score so far

    def offer(self, slot, score, ident, row) -> None:
        slot, score, ident, row = (np.concatenate(p) for p in ((self.slot, slot), (self.score, score), (self.id, ident), (self.row, row)))
        order = np.lexsort((row, ident, -score, slot))
        begin = np.searchsorted(slot[order], np.arange(len(self.least)))
        place = np.arange(len(order)) - begin[slot[order]]
        order, place = order[place < self.k], place[place < self.k]
        self.slot, self.score, self.id, self.row = (v[order] for v in (slot, score, ident, row))
        last = place == self.k - 1
        self.least[self.slot[last]] = self.score[last]


def _first_k(score: np.ndarray, ok: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, column) of each line's k largest marked scores; ties by column (columns ascend by id)."""
    if score.shape[1] > k:
        shown = np.where(ok, score, LEAST)
        kth = np.partition(shown, -k, axis=1)[:, -k, None]
        tie = ok & (score == kth)
        over = ok & (score > kth)
        ok = over | (tie & (np.cumsum(tie, axis=1) + over.sum(axis=1)[:, None] <= k))
    return np.nonzero(ok)


def _walk(batches, block: dict, scale: int, look):
    """Calls ``look(strip of anchors, rows)`` for the chunks of a partition that a bound doesn't rule out."""
    for batch in batches:
        for i in range(0, batch.num_rows, CHUNK):
            part = batch.slice(i, CHUNK)
            order = np.lexsort((np.asarray(part.column("row")), np.asarray(part.column("id"))))
            part = part.take(pa.array(order))
            rows = {k: np.asarray(part.column(k)) for k in ("row", "id", "label", "norm")}
            rows |= {"t": matrix(part.column("angle")).astype(np.float32), "vec": part.column("vec")}
            top = chunk_bound(block["t"], block["norm"], rows["t"], rows["norm"])
            for s in range(0, len(block["id"]), STRIP):
                look(np.arange(s, min(s + STRIP, len(block["id"]))), rows, top)


def _scored(block, rows, scale, at, need):
    """Integer scores of the strip's anchors and the chunk's rows that any needed pair has."""
    us, xs = np.flatnonzero(need.any(axis=1)), np.flatnonzero(need.any(axis=0))
    if "q" not in rows:
        rows["q"] = quantised(rows["vec"], scale)
    with np.errstate(over="ignore"):
        most = float(block["norm"][at[us]].max() * rows["norm"][xs].max())
    return us, xs, products(block["q"][at[us]], rows["q"][xs], most)


def _positives(shared, scale: int, k: int):
    def run(batches):
        block = shared.value
        best = _Best(len(block["id"]), k)

        def look(at, rows, top):
            at = at[top[at] >= best.least[at]]
            if not len(at):
                return
            need = (block["label"][at, None] == rows["label"]) & (block["row"][at, None] != rows["row"])
            _, high = score_bounds(block["t"][at], block["norm"][at], rows["t"], rows["norm"])
            need &= high >= best.least[at, None].astype(np.float64)
            if need.any():
                us, xs, score = _scored(block, rows, scale, at, need)
                i, j = _first_k(score, need[np.ix_(us, xs)] & (score >= best.least[at[us], None]), k)
                best.offer(at[us[i]], score[i, j], rows["id"][xs[j]], rows["row"][xs[j]])

        _walk(batches, block, scale, look)
        a, none = best.slot, pa.nulls(len(best.slot), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(block["row"][a]), pa.array(block["id"][a]), pa.array(np.zeros(len(a), np.int32)), none, none,
                                          pa.array(best.id), pa.array(best.row), pa.array(best.score)], names=FOUND_NAMES)
    return run


def _negatives(shared, scale: int, k: int):
    """``windows`` of the block: for each anchor a line of [low, high] score windows (empty: low > high)."""
    def run(batches):
        block = shared.value
        low, high = block["low"], block["high"]
        p = low.shape[1]
        best = _Best(low.size, k)

        def look(at, rows, top):
            floor = np.maximum(low[at], best.least.reshape(low.shape)[at])
            open_ = (floor <= high[at]) & (top[at, None] >= floor)
            some = open_.any(axis=1)
            at, floor, open_ = at[some], floor[some], open_[some]
            if not len(at):
                return
            lower, upper = score_bounds(block["t"][at], block["norm"][at], rows["t"], rows["norm"])
            need = np.zeros(lower.shape, bool)
            for w in range(p):
                need |= open_[:, w, None] & (upper >= floor[:, w, None].astype(np.float64)) & (lower <= high[at, w, None].astype(np.float64))
            need &= block["label"][at, None] != rows["label"]
            if need.any():
                us, xs, score = _scored(block, rows, scale, at, need)
                need = need[np.ix_(us, xs)]
                for w in range(p):
                    i, j = _first_k(score, need & (score >= floor[us, w, None]) & (score <= high[at[us], w, None]), k)
                    best.offer(at[us[i]] * p + w, score[i, j], rows["id"][xs[j]], rows["row"][xs[j]])

        _walk(batches, block, scale, look)
        a, w = best.slot // max(p, 1), best.slot % max(p, 1)
        yield pa.RecordBatch.from_arrays([pa.array(block["row"][a]), pa.array(block["id"][a]), pa.array(w.astype(np.int32)), pa.array(block["pos_id"][a, w]),
                                          pa.array(block["pos_score"][a, w]), pa.array(best.id), pa.array(best.row), pa.array(best.score)],
                                         names=FOUND_NAMES)
    return run


def _best_of(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each (anchor, slot) over all tasks, with their place."""
    order = Window.partitionBy("anchor_row", "slot").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def angle_index(rows: DataFrame, scale: int) -> DataFrame:
    """Stores row, id, label, vec, norm and angles of the rows that take part; see the module's head."""
    spark = rows.sparkSession
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("label").isNotNull() & F.col("vec").isNotNull()).where(sound)
    sample = rows.select("vec", F.xxhash64("id", "vec").alias("h")).orderBy("h").limit(SAMPLE).select("vec").toArrow()
    directions = references(quantised(sample.column("vec"), scale)) if sample.num_rows else np.eye(1)

    def run(batches):
        for batch in batches:
            q = quantised(batch.column("vec"), scale)
            norm = norms(q)
            t = angles(q, norm, directions)
            near = np.argmin(t, axis=1) if len(t) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(norm), pa.ListArray.from_arrays(pa.array(np.arange(len(t) + 1, dtype=np.int32) * t.shape[1]), pa.array(t.ravel())),
                                              pa.array(near.astype(np.int32)), pa.array(t[np.arange(len(t)), near])],
                                             names=[*batch.schema.names, "norm", "angle", "cell", "near"])

    known = rows.select(F.monotonically_increasing_id().alias("row"), F.coalesce("id", F.lit(int(NO_ID))).alias("id"), "label", "anchor", "vec")
    kind = known.schema["vec"].dataType.simpleString()
    stored = known.mapInArrow(run, f"row long, id long, label long, anchor boolean, vec {kind}, norm double, angle array<float>, cell int, near float")
    path = scratch_path(spark, "angles")
    stored.repartitionByRange("cell", "near", "row").sortWithinPartitions("cell", "near", "row").drop("cell", "near").write.parquet(path)
    return spark.read.parquet(path)


def _blocks(index: DataFrame, scale: int):
    """Blocks of at most ANCHORS anchor rows, read one partition at a time."""
    held = []
    for r in index.where("anchor").select("row", "id", "label", "vec", "norm", "angle").toLocalIterator():
        held.append(r)
        if len(held) == ANCHORS:
            yield _block(held, scale)
            held = []
    if held:
        yield _block(held, scale)


def _block(held, scale: int) -> dict:
    vec = pa.array([r["vec"] for r in held], pa.list_(pa.float64()))
    return {"row": np.array([r["row"] for r in held], np.int64), "id": np.array([r["id"] for r in held], np.int64), "label": np.array([r["label"] for r in held], np.int64),
            "norm": np.array([r["norm"] for r in held]), "t": np.array([r["angle"] for r in held], np.float32), "q": quantised(vec, scale)}


def _windows(block: dict, top, k: int, percent: int) -> dict:
    """Adds each anchor's positives (rows of ``top``) and their score windows."""
    shape = (len(block["id"]), k)
    at = {r: i for i, r in enumerate(block["row"].tolist())}
    out = {"low": np.ones(shape, np.int64), "high": np.zeros(shape, np.int64), "pos_id": np.zeros(shape, np.int64), "pos_score": np.zeros(shape, np.int64)}
    for r in top:
        i, w, s = at[r["anchor_row"]], r["place"] - 1, r["score"]
        out["pos_id"][i, w], out["pos_score"][i, w] = r["id"], s
        out["low"][i, w], out["high"][i, w] = max(-((-percent * s) // 100), LEAST), s  # the least n with 100 n >= percent * s
        if s < 0:
            out["low"][i, w], out["high"][i, w] = 1, 0
    return block | out


def mine(vectors: DataFrame, anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256,
         positives: int = 5, negatives: int = 5, percent: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for every anchor row.

    ``anchor`` marks the stated query set, ``label`` is an integer column; both are expressions over ``vectors``."""
    spark = vectors.sparkSession
    vec = F.col(f"`{vector_col}`")
    if not isinstance(vectors.schema[vector_col].dataType.elementType, (T.FloatType, T.DoubleType)):
        vec = vec.cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), vec.alias("vec"))
    index = angle_index(rows, scale)
    stored = index.drop("anchor")
    paths = []
    for block in _blocks(index, scale):
        shared = spark.sparkContext.broadcast(block)
        top = _best_of(stored.mapInArrow(_positives(shared, scale, positives), FOUND), positives).select("anchor_row", "place", "id", "score").collect()  # ANCHORS * positives rows at most
        shared.destroy()
        shared = spark.sparkContext.broadcast(_windows(block, top, positives, percent))
        path = scratch_path(spark, "hard-negatives")
        _best_of(stored.mapInArrow(_negatives(shared, scale, negatives), FOUND), negatives).write.parquet(path)
        shared.destroy()
        paths.append(path)
    found = spark.read.parquet(*paths) if paths else spark.createDataFrame([], FOUND + ", place int")
    known = lambda c: F.nullif(F.col(c), F.lit(int(NO_ID)))
    return found.select("anchor_id", known("positive_id").alias("positive_id"), F.col("place").alias("rank"), known("id").alias("negative_id"),
                        "positive_score", F.col("score").alias("negative_score"))
