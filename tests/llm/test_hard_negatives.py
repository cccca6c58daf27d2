"""Angular triangle filter: exact results against brute force, bounds that hold, chunks that are left out."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from situate.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, score int, `row` string"


def brute(rows, positives=5, negatives=5, percent=80):
    """Rows (anchor, positive, rank, negative, scores) by scoring every pair with Python ints."""
    ok = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for a, (aid, av, ay) in enumerate(ok):
        if aid is None or aid % 10:
            continue
        scored = [(sum(p * q for p, q in zip(av, v)), i, y) for b, (i, v, y) in enumerate(ok) if b != a]
        for ps, pid, _ in sorted((s for s in scored if s[2] == ay), key=order)[:positives]:
            near = [s for s in scored if s[2] != ay and percent * ps <= 100 * s[0] <= 100 * ps]
            out += [(aid, pid, k, nid, ps, ns) for k, (ns, nid, _) in enumerate(sorted(near, key=order)[:negatives], 1)]
    return sorted(out, key=str)


def mined(spark, rows, **more):
    df = spark.createDataFrame([(i, v, y, 1, "x") for i, v, y in rows], SCHEMA).repartition(3)
    got = H.mine(df, F.col("vec_id") % 10 == 0, F.col("label"), **more)
    return sorted((tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=str)


def clustered(rng, n=240, d=8):
    centers = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(6)]
    return [(i, [float(np.float32(c + rng.gauss(0, 0.2))) for c in centers[rng.randrange(6)]], rng.randrange(3)) for i in range(n)]


@pytest.mark.parametrize("chunk,anchors,strip", [(4096, 4096, 256), (16, 5, 2)])
def test_against_every_pair(spark, monkeypatch, chunk, anchors, strip):
    monkeypatch.setattr(H, "CHUNK", chunk)
    monkeypatch.setattr(H, "ANCHORS", anchors)
    monkeypatch.setattr(H, "STRIP", strip)
    rows = clustered(random.Random(1))
    want = brute(rows)
    assert want and mined(spark, rows) == want


def test_odd_rows(spark):
    rng = random.Random(2)
    rows = clustered(rng, 60, 4)
    same = [0.5, 0.5, 0.25, 0.0]
    rows += [(i, same, i % 2) for i in range(100, 130)]  # ties: many equal vectors
    rows += [(100, same, 0), (None, same, 1), (110, same, 1)]  # repeated ids and a null id
    rows += [(200, None, 1), (210, [1.0, None, 0.0, 0.0], 1), (220, [float("nan")] * 4, 1), (230, [float("inf")] * 4, 1), (240, same, None)]
    rows += [(250, [0.0] * 4, 1), (260, [], 0), (270, [1.0, 2.0], 1), (280, [-1.0] * 4, 0), (290, [1e30, 1.0, 0.0, 0.0], 2)]
    got, want = mined(spark, [r for r in rows if r[0] != 290]), brute([r for r in rows if r[0] != 290])
    want = brute([(i, None if v is None else v + [0.0] * (4 - len(v)), y) for i, v, y in rows if i != 290])  # short vectors end in zeros
    assert got == want
    assert len(mined(spark, rows)) >= len(want)  # a huge component neither crashes nor hides others


def test_nothing(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == [] and mined(spark, [(10, None, 1)]) == []
    assert mined(spark, [(10, [1.0], 1)]) == []


def test_bounds_hold_and_rule_out():
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(8, 32))
    q = np.floor(256 * (centers[rng.integers(0, 8, 600)] + 0.1 * rng.normal(size=(600, 32))))
    norm = H.norms(q)
    t = H.angles(q, norm, H.references(q))
    low, high = H.score_bounds(t[:50], norm[:50], t, norm)
    exact = q[:50] @ q.T
    assert (low <= exact).all() and (exact <= high).all()
    best = np.sort(exact, axis=1)[:, -6]
    assert (high < best[:, None]).mean() > 0.5  # most rows of other clusters need no scoring
    order = np.argsort(np.argmin(t, axis=1), kind="stable")
    for i in range(0, 600, 50):
        part = order[i:i + 50]
        assert (H.chunk_bound(t[:50], norm[:50], t[part], norm[part])[:, None] >= exact[:, part]).all()


def test_scored_pairs_are_few_on_clusters(monkeypatch):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(16, 32))
    q = np.floor(256 * (centers[rng.integers(0, 16, 2000)] + 0.1 * rng.normal(size=(2000, 32))))
    norm = H.norms(q)
    t = H.angles(q, norm, H.references(q))
    order = np.lexsort((t.min(axis=1), np.argmin(t, axis=1)))
    counted, plain = [0], H.products
    monkeypatch.setattr(H, "products", lambda a, x, most: counted.__setitem__(0, counted[0] + len(a) * len(x)) or plain(a, x, most))
    monkeypatch.setattr(H, "CHUNK", 125)
    label = rng.integers(0, 3, 2000)
    batch = pa.RecordBatch.from_arrays([pa.array(order), pa.array(order), pa.array(label[order]), pa.array([list(v) for v in q[order] / 256], pa.list_(pa.float64())),
                                        pa.array(norm[order]), pa.array(list(t[order]), pa.list_(pa.float32()))], names=["row", "id", "label", "vec", "norm", "angle"])

    class Shared:
        value = {"row": np.arange(64), "id": np.arange(64), "label": label[:64], "norm": norm[:64], "t": t[:64], "q": q[:64]}

    found = next(H._positives(Shared, 256, 5)([batch]))
    exact = q[:64] @ q.T
    for a in range(64):
        mine = sorted((-int(exact[a, x]), x) for x in range(2000) if x != a and label[x] == label[a])[:5]
        got = [(-r["score"], r["id"]) for r in found.to_pylist() if r["anchor_row"] == a]
        assert got == mine
    assert counted[0] < 0.5 * 64 * 2000


@pytest.mark.parametrize("size", [1.0, 2.0 ** 22, 2.0 ** 27, 2.0 ** 40])
def test_products_are_exact(size):
    rng = np.random.default_rng(7)
    a, x = np.floor(size * rng.normal(size=(3, 8))), np.floor(size * rng.normal(size=(4, 8)))
    most = float(H.norms(a).max() * H.norms(x).max())
    want = [[min(max(sum(int(p) * int(q) for p, q in zip(u, v)), H.LEAST), H.MOST) for v in x] for u in a]
    assert H.products(a, x, most).tolist() == want
