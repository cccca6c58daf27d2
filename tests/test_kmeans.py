"""All fits at once against Spark's own k-means; exact silhouettes against every pair."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from situate.operators import kmeans as KM
from situate.operators import segments as SG
from situate.session import materialize


def blobs(spark, n=300, d=4, seed=1, parts=3):
    rng = random.Random(seed)
    centers = [[rng.gauss(0, 2) for _ in range(d)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.8) for c in centers[i % 5]]) for i in range(n)]
    return materialize(spark.createDataFrame(rows, "id long, v array<double>").repartition(parts)), np.array([r[1] for r in rows])


def lloyd(x, c):
    while True:
        d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        near = d.argmin(axis=1)
        new = np.array([x[near == k].mean(axis=0) if (near == k).any() else c[k] for k in range(len(c))])
        if np.abs(new - c).max() <= 1e-12:
            return float(d.min(axis=1).sum()), new
        c = new


@pytest.mark.parametrize("tasks", [32, 0])
def test_each_fit_is_a_whole_kmeans_run(spark, monkeypatch, tasks):
    monkeypatch.setattr(KM, "DRIVER_TASKS", tasks)
    points, x = blobs(spark)
    start = KM.first_centroids(points, 6, 4, 42)
    assert all({tuple(v) for v in s} <= {tuple(v) for v in x} and len({tuple(v) for v in s}) == 6 for s in start)
    got = KM.fit_sets(points, [3, 4, 6], restarts=4)
    for k in (3, 4, 6):
        cost, centers = min((lloyd(x, s[:k]) for s in start), key=lambda f: f[0])
        assert got[k][0] == pytest.approx(cost, rel=1e-9) and np.allclose(KM.ordered(got[k][1]), KM.ordered(centers), atol=1e-9)


def test_cost_of_spark_ml(spark):
    """From the same seeds mllib ends at the same cost; ten restarts are as good as ten of Spark ML's."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    from pyspark.mllib.clustering import KMeans as Old
    from pyspark.mllib.clustering import KMeansModel

    points, x = blobs(spark, seed=3)
    seeds = KM.first_centroids(points, 5, 1, 42)[0]
    rdd = spark.sparkContext.parallelize(x.tolist(), 2)
    old = Old.train(rdd, 5, maxIterations=300, epsilon=0.0, initialModel=KMeansModel(seeds.tolist()))
    ours = KM.fit_sets(points, [5], restarts=1)[5][0]
    assert ours == pytest.approx(old.computeCost(rdd), rel=1e-6)
    vectors = materialize(points.select(array_to_vector("v").alias("features")))
    best = min(KMeans(k=5, seed=42 + r, maxIter=300, tol=0.0).fit(vectors).summary.trainingCost for r in range(10))
    assert KM.fit_sets(points, [5], restarts=10)[5][0] <= best * (1 + 1e-6)


def test_silhouettes_of_all_sets(spark):
    points, _ = blobs(spark, n=120)
    sets = {k: c for k, (_, c) in KM.fit_sets(points, [2, 3, 5], restarts=2).items()}
    got = KM.silhouettes(points, sets)
    for k, c in sets.items():
        labelled = points.join(KM.assign(points, c), "id")
        assert got[k] == pytest.approx(SG.silhouette_score(labelled, "v", "cluster_id", "id").first()["silhouette"], abs=1e-9)


def test_few_points_repeated_points_and_text_ids(spark):
    df = materialize(spark.createDataFrame([("a", [1.0, 1.0]), ("b", [1.0, 1.0]), ("c", [1.0, 1.0]), ("d", [5.0, 5.0])], "id string, v array<double>"))
    got = KM.fit_sets(df, [2, 3], restarts=3)
    assert got[2][0] == 0.0 and got[3][0] == 0.0
    labels = {r["id"]: r["cluster_id"] for r in KM.assign(df, KM.ordered(got[2][1])).collect()}
    assert labels == {"a": 0, "b": 0, "c": 0, "d": 1}
    assert KM.silhouettes(df, {2: got[2][1]})[2] == pytest.approx(0.75)  # d is alone and scores 0


def brute_silhouette(rows):
    out = {}
    for i, label, v in rows:
        by = {}
        for j, other, w in rows:
            if i != j:
                by.setdefault(other, []).append(math.dist(v, w))
        own, rest = by.get(label, []), [sum(d) / len(d) for k, d in by.items() if k != label]
        if not own or not rest:
            out[i] = 0.0
        else:
            a, b = sum(own) / len(own), min(rest)
            out[i] = (b - a) / max(a, b) if max(a, b) > 0 else 0.0
    return out


def test_exact_silhouette_against_every_pair(spark, monkeypatch):
    monkeypatch.setattr(KM, "EXACT_BLOCK", 7)
    rng = random.Random(8)
    rows = [(i, rng.choice("aabbbcd"), [rng.gauss(0, 1) for _ in range(3)]) for i in range(60)] + [(60, "lone", [9.0, 9.0, 9.0]), (61, "a", [0.0, 0.0, 0.0]), (62, "a", [0.0, 0.0, 0.0])]
    df = spark.createDataFrame([*rows, (70, None, [1.0, 1.0, 1.0]), (71, "a", None)], "id long, label string, v array<double>").repartition(4)
    got = {r["id"]: r["silhouette"] for r in KM.silhouette_exact(df, "v", "label", "id").collect()}
    assert got == pytest.approx(brute_silhouette(rows))
    one = KM.silhouette_exact(df.withColumn("label", F.lit(1)), "v", "label", "id").agg(F.max("silhouette"), F.min("silhouette")).first()
    assert tuple(one) == (0.0, 0.0) and KM.silhouette_exact(df.where("false"), "v", "label", "id").count() == 0
    monkeypatch.setattr(KM, "EXACT_POINTS", 10)
    with pytest.raises(ValueError, match="at most 10"):
        KM.silhouette_exact(df, "v", "label", "id")


def test_exact_silhouette_is_compared_in_blocks(spark, monkeypatch):
    """Close clusters far from the origin, copies, an outlier, repeated and null ids, a label over many blocks; no bound on the points."""
    assert KM.EXACT_POINTS is None
    monkeypatch.setattr(KM, "EXACT_BLOCK", 5)
    monkeypatch.setattr(KM, "EXACT_TILE", 3)
    rng = random.Random(9)
    rows = [(i, i % 3 if i % 2 else 0, [1e4 + (i % 3) * 1e-3 + rng.gauss(0, 1e-4), rng.gauss(0, 1e-4)]) for i in range(90)]
    rows += [(90 + i, 1, [1e4, 0.0]) for i in range(12)] + [(102, 2, [-1e6, 1e6])]
    want = brute_silhouette(rows)
    ids = lambda i: None if i == 4 else 7 if i == 8 else i
    df = spark.createDataFrame([(ids(i), c, v) for i, c, v in rows], "id long, label int, v array<double>").repartition(3)
    out = KM.silhouette_exact(df, "v", "label", "id")
    assert "CartesianProduct" in out._jdf.queryExecution().toString()
    assert sorted(r["silhouette"] for r in out.collect()) == pytest.approx(sorted(want.values()), abs=1e-9)
    assert sorted(r["id"] is None for r in out.collect()) == [False] * 102 + [True]
    huge = spark.createDataFrame([(0, "a", [1e200]), (1, "a", [1e200]), (2, "b", [float("inf")]), (3, "b", [0.0]), (4, "c", [float("nan")])], "id long, label string, v array<double>")
    assert KM.silhouette_exact(huge, "v", "label", "id").count() == 5
