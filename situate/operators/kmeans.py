"""All k-means fits of a search at once, and silhouettes of whole labellings (M2-M4).

A fit is a centroid set (k, restart); the sets of every k and restart are small (sum of k · restarts rows) and
travel to the tasks together. One pass over the points moves all sets that still move: a task returns
for each centroid the count, the sum and the cost of its points, Spark adds them up, the driver divides. So a search takes as many
passes as the slowest fit has rounds, not k · restarts times as many.

First centroids are drawn as in k-means++, by a race that SQL can repeat: seed j of restart r is the point with the least
-ln(u) / d², u a hash of (seed, r, j, id), d its distance to the restart's seeds so far. A set of k starts at the first k.
A centroid without points stays. A fit ends when no centroid moves.
"""

from __future__ import annotations

import itertools
import warnings

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from situate.functions.scoring import hash_uniform
from situate.session import materialize

#: partial sums come to the driver from this many tasks at most, else Spark adds them up first
DRIVER_TASKS = 32
#: the exact silhouette: most points (None: any number), points of a row, points compared with a row at once
EXACT_POINTS, EXACT_BLOCK, EXACT_TILE = None, 2048, 128
#: its slices of all points, tasks for each slice at most, and the part of |x|² + |y|² below which a squared distance is taken by differences
EXACT_SLICES, EXACT_TASKS, EXACT_NEAR = 8, 32, 1e-4


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).astype(np.float64).reshape(len(column), -1)


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances [points, centroids], difference by difference: equal vectors are exactly 0 apart."""
    out = np.zeros((len(x), len(c)))
    for j in range(x.shape[1]):
        d = x[:, j, None] - c[None, :, j]
        out += d * d
    return out


def _race(chosen: list[np.ndarray]):
    """Rows (r, race, id, v): a partition's winner of each restart, by race and id."""
    def run(batches):
        best: dict[int, tuple] = {}
        kind = None
        for batch in batches:
            kind = batch.schema.field("id").type
            x, u = _matrix(batch.column("v")), _matrix(batch.column("u"))
            if not len(x):
                continue
            ids = batch.column("id").to_pylist()
            for r, seeds in enumerate(chosen):
                far = _distances(x, seeds).min(axis=1) if len(seeds) else np.ones(len(x))
                with np.errstate(divide="ignore"):
                    race = np.where(far > 0, -np.log(u[:, r]) / far, np.inf)
                for i in np.flatnonzero(race == race.min()).tolist():
                    mine = (float(race[i]), ids[i], x[i].tolist())
                    if r not in best or mine[:2] < best[r][:2]:
                        best[r] = mine
        if not best:
            return
        yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int32()), pa.array([b[0] for b in best.values()], pa.float64()), pa.array([b[1] for b in best.values()], kind),
                                          pa.array([b[2] for b in best.values()], pa.list_(pa.float64()))], names=["r", "race", "id", "v"])

    return run


def first_centroids(points: DataFrame, most: int, restarts: int, seed: int) -> list[np.ndarray]:
    """For each restart its first ``most`` seeds; a pass for each seed number draws it for all restarts."""
    dims, kind = len(points.select("v").first()["v"]), points.schema["id"].dataType.simpleString()
    chosen = [np.empty((0, dims)) for _ in range(restarts)]
    for j in range(most):
        u = F.array(*[hash_uniform(F.lit(seed), F.lit(r), F.lit(j), F.col("id")) for r in range(restarts)])
        found = points.select("id", "v", u.alias("u")).mapInArrow(_race(chosen), f"r int, race double, id {kind}, v array<double>").collect()  # restarts rows a task
        for r in range(restarts):
            chosen[r] = np.vstack([chosen[r], min((x for x in found if x["r"] == r), key=lambda x: (x["race"], x["id"]))["v"]])
    return chosen


def _sums(centroids: np.ndarray, cuts: list[int]):
    """Rows (c, n, cost, s): a partition's points at their nearest centroid of each set centroids[cuts[i]:cuts[i + 1]]."""
    def run(batches):
        n, cost, s = np.zeros(len(centroids), np.int64), np.zeros(len(centroids)), np.zeros(centroids.shape)
        for batch in batches:
            x = _matrix(batch.column("v"))
            if not len(x):
                continue
            d = _distances(x, centroids)
            for a, b in zip(cuts[:-1], cuts[1:]):
                near = np.argmin(d[:, a:b], axis=1)
                n[a:b] += np.bincount(near, minlength=b - a)
                cost[a:b] += np.bincount(near, weights=d[np.arange(len(x)), a + near], minlength=b - a)
                for j in range(x.shape[1]):
                    s[a:b, j] += np.bincount(near, weights=x[:, j], minlength=b - a)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n))), pa.array(n), pa.array(cost), pa.array(list(s), pa.list_(pa.float64()))], names=["c", "n", "cost", "s"])
    return run


def _totals(points: DataFrame, centroids: np.ndarray, cuts: list[int], tasks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(count, cost, sum) of each centroid over all points."""
    part = points.select("v").mapInArrow(_sums(centroids, cuts), "c long, n long, cost double, s array<double>")
    if tasks > DRIVER_TASKS:
        dims = centroids.shape[1]
        part = part.groupBy("c").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), F.array(*[F.sum(F.col("s")[j]) for j in range(dims)]).alias("s"))
    n, cost, s = np.zeros(len(centroids), np.int64), np.zeros(len(centroids)), np.zeros(centroids.shape)
    for r in part.toArrow().to_pylist():
        n[r["c"]] += r["n"]
        cost[r["c"]] += r["cost"]
        s[r["c"]] += r["s"]
    return n, cost, s


def fit_sets(points: DataFrame, ks: list[int], restarts: int = 10, seed: int = 42, max_iter: int = 300) -> dict[int, tuple[float, np.ndarray]]:
    """For each k (least cost over all restarts, its centroids). ``points``: id (unique, not null), v (array of
    doubles), at least max(ks) rows; materialise it, each pass reads it."""
    start = first_centroids(points, max(ks), restarts, seed)
    sets = {(k, r): start[r][:k] for k in ks for r in range(restarts)}
    cost, moving, tasks = {}, list(sets), points.rdd.getNumPartitions()
    for _ in range(max_iter):
        if not moving:
            break
        cuts = np.append(0, np.cumsum([len(sets[m]) for m in moving])).tolist()
        n, far, s = _totals(points, np.concatenate([sets[m] for m in moving]), cuts, tasks)
        still = []
        for m, a, b in zip(moving, cuts[:-1], cuts[1:]):
            new = np.where(n[a:b, None] > 0, s[a:b] / np.maximum(n[a:b, None], 1), sets[m])
            cost[m] = float(far[a:b].sum())
            if np.abs(new - sets[m]).max() > 1e-12:
                sets[m] = new
                still.append(m)
        moving = still
    if moving:
        warnings.warn(f"k-means: {len(moving)} of {len(sets)} fits not converged after {max_iter} iterations", stacklevel=2)
    best = {k: min((r for r in range(restarts)), key=lambda r: (cost[k, r], r)) for k in ks}
    return {k: (cost[k, r], sets[k, r]) for k, r in best.items()}


def ordered(centroids: np.ndarray) -> np.ndarray:
    """Centroids in lexicographic order, so that labels don't depend on seeds."""
    return centroids[np.lexsort(centroids.T[::-1])]


def assign(points: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster_id): the nearest centroid's number."""
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("v"))
            near = np.argmin(_distances(x, centroids), axis=1) if len(x) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(near.astype(np.int32), pa.int32())], names=["id", "cluster_id"])

    return points.select("id", "v").mapInArrow(run, f"id {points.schema['id'].dataType.simpleString()}, cluster_id int")


def silhouettes(points: DataFrame, sets: dict[int, np.ndarray]) -> dict[int, float]:
    """Mean squared-Euclidean silhouette of each set's labelling, all in two passes.

    The mean squared distance of x to a cluster is ||x||² + Q/n - 2 x·S/n with the cluster's count n, sum S and squared norms' sum Q:
    first these, then the points' scores. One's own cluster without oneself: times n / (n - 1); a cluster of one scores 0."""
    keys = sorted(sets)
    every = np.concatenate([sets[k] for k in keys])
    cuts = np.append(0, np.cumsum([len(sets[k]) for k in keys])).tolist()
    n, cost, s = _totals(points, every, cuts, points.rdd.getNumPartitions())
    # Q from the cost: sum |x - c|² = Q - 2 c·S + n |c|²
    q = cost + 2 * (every * s).sum(axis=1) - n * (every * every).sum(axis=1)

    def run(batches):
        total, rows = np.zeros(len(keys)), 0
        for batch in batches:
            x = _matrix(batch.column("v"))
            if not len(x):
                continue
            rows += len(x)
            d = _distances(x, every)
            with np.errstate(divide="ignore", invalid="ignore"):
                mean = (x * x).sum(axis=1)[:, None] + q / n - 2 * (x @ s.T) / n
            mean[:, n == 0] = np.inf
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                at = np.arange(len(x))
                near = np.argmin(d[:, a:b], axis=1)
                size = n[a:b][near]
                own = np.maximum(mean[at, a + near], 0) * size / np.maximum(size - 1, 1)
                others = mean[:, a:b].copy()
                others[at, near] = np.inf
                other = np.maximum(others.min(axis=1), 0)
                top = np.maximum(own, other)
                score = np.where((size > 1) & (top > 0) & np.isfinite(top), (other - own) / np.where(top > 0, top, 1), 0.0)
                total[i] += score.sum()
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(total), pa.array([rows] * len(keys), pa.int64())], names=["k", "total", "rows"])

    out = points.select("v").mapInArrow(run, "k long, total double, rows long").groupBy("k").agg((F.sum("total") / F.sum("rows")).alias("score"))
    return {r["k"]: r["score"] for r in out.collect()}


def _block_rows(batches):
    """Rows (block, ids, runs, v): EXACT_BLOCK points at most, their labels as runs (label, n), their vectors as doubles."""
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        kind = batch.schema.field("label").type
        for i in range(0, batch.num_rows, EXACT_BLOCK):
            part = batch.slice(i, EXACT_BLOCK)
            runs = [{"label": k, "n": len(list(g))} for k, g in itertools.groupby(part.column("label").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([part.column("id").to_pylist()], pa.list_(part.schema.field("id").type)),
                                              pa.array([runs], pa.list_(pa.struct([("label", kind), ("n", pa.int64())]))), pa.array([_matrix(part.column("v")).tobytes()], pa.binary())], names=["block", "ids", "runs", "v"])
            number += 1


def _roots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances [x, y] by |x|² + |y|² - 2 x·y around the mean of x; pairs for which that would lose digits difference by difference."""
    with np.errstate(over="ignore", invalid="ignore"):
        centre = x.mean(axis=0)
        p, q = x - centre, y - centre
        m, n = (p * p).sum(axis=1), (q * q).sum(axis=1)
        if not np.isfinite(m.sum() + n.sum()):
            return np.sqrt(_distances(x, y))
    out = p @ q.T
    out *= -2
    out += m[:, None]
    out += n
    near = out < np.add.outer(EXACT_NEAR * m, EXACT_NEAR * n)
    pairs = int(np.count_nonzero(near))
    if 16 * pairs > near.size:
        return np.sqrt(_distances(x, y))
    if pairs:
        i, j = np.nonzero(near)
        d = x[i] - y[j]
        out[i, j] = (d * d).sum(axis=1)
    return np.sqrt(out, out=out)


class _Away:
    """Distance sums of a block's points to the labels of a slice, one label after the other."""

    def __init__(self, ids, runs, x):
        self.ids, self.x, self.labels, self.place, at = ids, x, [], {}, 0
        for r in runs:
            self.labels += [r["label"]] * r["n"]
            self.place[r["label"]] = slice(at, at + r["n"])
            at += r["n"]
        self.own, self.n_own, self.other = np.zeros(at), np.zeros(at, np.int64), np.full(at, np.inf)
        self.label, self.sum, self.n, self.seen = None, None, 0, set()

    def add(self, runs, y):
        begin = np.cumsum([0] + [r["n"] for r in runs[:-1]])
        sums = np.concatenate([np.add.reduceat(_roots(self.x[i:i + EXACT_TILE], y), begin, axis=1) for i in range(0, len(self.x), EXACT_TILE)])
        for k, r in enumerate(runs):
            if self.sum is None or r["label"] != self.label:
                self.close()
                if r["label"] in self.seen:
                    raise RuntimeError(f"the rows of label {r['label']} don't stand together")
                self.label, self.sum, self.n = r["label"], np.zeros(len(self.x)), 0
            self.sum += sums[:, k]
            self.n += r["n"]

    def close(self):
        if self.sum is None:
            return
        self.seen.add(self.label)
        mean = self.sum / self.n
        if (mine := self.place.get(self.label)) is not None:
            self.own[mine], self.n_own[mine], mean[mine] = self.sum[mine], self.n, np.inf
        self.other, self.sum = np.minimum(self.other, mean), None


def _away(batches):
    """Rows (block, pos, id, label, own, n_own, other): a block's points against a slice of all points."""
    held: dict[int, _Away] = {}
    rows = lambda v, n: np.frombuffer(v.as_buffer(), np.float64).reshape(n, -1)
    kinds = None
    for batch in batches:
        kinds = batch.schema.field("ids").type.value_type, batch.schema.field("runs").type.value_type.field("label").type
        blocks, others = batch.column("block").to_pylist(), batch.column("other_runs").to_pylist()
        for i, block in enumerate(blocks):
            if block not in held:
                ids = batch.column("ids")[i].as_py()
                held[block] = _Away(ids, batch.column("runs")[i].as_py(), rows(batch.column("v")[i], len(ids)).copy())
            held[block].add(others[i], rows(batch.column("other_v")[i], sum(r["n"] for r in others[i])))
    for block, a in held.items():
        a.close()
        n = len(a.ids)
        yield pa.RecordBatch.from_arrays([pa.array([block] * n, pa.int64()), pa.array(np.arange(n)), pa.array(a.ids, kinds[0]), pa.array(a.labels, kinds[1]), pa.array(a.own),
                                          pa.array(a.n_own), pa.array(a.other)], names=["block", "pos", "id", "label", "own", "n_own", "other"])


def silhouette_exact(points: DataFrame, vector: str, label: str, id_col: str) -> DataFrame:
    """M3 with Euclidean distance, over all pairs: (id, label, silhouette) of each point.

    Rows of up to EXACT_BLOCK points, in EXACT_SLICES slices by label with each label's points together, meet each other in a
    cartesian product: a task has some blocks and one slice, streams the slice past them and keeps, for each of its points, the
    distance sum of the label in hand, of its own label and the least mean of the others. So no pair is ever a row, nothing passes
    through the driver and a task holds its blocks only. The work is quadratic; EXACT_POINTS, if set, is an error beyond so many points.
    A cluster of one scores 0, and so does a labelling of one cluster. Rows with a null label or vector have no part."""
    rows = points.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    rows = rows.where("label is not null and v is not null")
    if EXACT_POINTS is not None and (n := rows.count()) > EXACT_POINTS:
        raise ValueError(f"{n} points: the exact silhouette compares at most {EXACT_POINTS}")
    kind = lambda c: rows.schema[c].dataType.simpleString()
    together = rows.repartition(EXACT_SLICES, "label").sortWithinPartitions("label")
    blocks = materialize(together.mapInArrow(_block_rows, f"block long, ids array<{kind('id')}>, runs array<struct<label:{kind('label')},n:long>>, v binary"))
    slices = blocks.select(F.col("runs").alias("other_runs"), F.col("v").alias("other_v")).hint("shuffle_replicate_nl")
    mine = blocks.repartition(max(1, min(EXACT_TASKS, blocks.count())))
    part = mine.crossJoin(slices).mapInArrow(_away, f"block long, pos long, id {kind('id')}, label {kind('label')}, own double, n_own long, other double")
    sums = part.groupBy("block", "pos", "id", "label").agg(
        F.sum("own").alias("own"), F.sum("n_own").alias("n_own"), F.when(~F.bool_or(F.isnan("other")), F.min("other")).alias("other"))
    own = F.col("own") / F.greatest(F.col("n_own") - 1, F.lit(1))
    top = F.greatest(own, "other")
    fits = (F.col("n_own") > 1) & F.col("other").isNotNull() & ~F.isnan(top) & (top > 0) & (top < float("inf"))
    score = F.when(fits, (F.col("other") - own) / top).otherwise(F.lit(0.0))
    return sums.select(F.col("id").alias(id_col), F.col("label").alias(label), score.alias("silhouette"))
