"""User features and segmentation."""

import json

import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from situate.operators import segments as SG
from situate.operators.enrich import apply_user_segments, enrich_log
from situate.sources.tables import read_table
from conftest import SF01


@pytest.fixture()
def cluster_log(spark):
    rows = []
    for u in range(12):
        for i in range(5):
            ctx = ({"sky": "clear", "temp": 25.0, "precip": "none", "weekend": 1} if i % 2 == 0
                   else {"sky": "cloudy", "temp": 20.0, "precip": "rain", "weekend": 0})
            clicked = int((u + i) % 3 == 0)
            rows.append((f"imp_{u}_{i}", f"user_{u + 1:04d}", "", json.dumps(ctx),
                         "event_001" if u % 2 == 0 else "tour_001", clicked, int(clicked and u % 4 == 0)))
    log = spark.createDataFrame(rows, "impression_id string, user_id string, user_segment string, "
                                      "context_features string, creative_id string, clicked int, converted int")
    cat = spark.createDataFrame([("event_001", "event", "축제"), ("tour_001", "tour", "음식점"),
                                 ("event_002", "event", "전시")], "creative_id string, creative_type string, category string")
    return log, cat


def test_features_and_segments(spark, cluster_log):
    log, cat = cluster_log
    en = enrich_log(log, cat)
    feats = SG.user_features(en)
    assert feats.count() == 12
    assert set(SG.FEATURE_COLUMNS) <= set(feats.columns)
    res = SG.cluster_users(en, restarts=2)
    assert SG.K_MIN <= res.best_k <= SG.K_MAX
    assert all(-1.0 <= s <= 1.0 for s in res.silhouette_scores.values())
    segs = res.user_segments.select("user_segment").distinct().count()
    assert segs == res.best_k
    seg_log = apply_user_segments(log, res.user_segments)
    assert seg_log.where(F.col("user_segment").isNull()).count() == 0
    assert seg_log.count() == log.count()


def test_too_few_users(spark, cluster_log):
    log, cat = cluster_log
    en = enrich_log(log.where(F.col("user_id") <= "user_0005"), cat)
    with pytest.raises(ValueError):
        SG.cluster_users(en, restarts=1)


def test_zscore_population_and_constant(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0)], "user_id int, a double, b double")
    out = {r.user_id: (r.a, r.b) for r in SG.zscore(df, ["a", "b"]).collect()}
    assert out == {1: (-1.0, 0.0), 2: (1.0, 0.0)}


def test_squared_silhouette_matches_spark_evaluator(spark):
    emb = read_table(spark, SF01, "embeddings")
    ours = SG.silhouette_score(emb, "embedding", "label", "vec_id").first().silhouette
    vec = emb.select("label", F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    vec = VectorAssembler(inputCols=[f"e{i}" for i in range(64)], outputCol="features").transform(
        vec.select("label", *[F.col("e")[i].alias(f"e{i}") for i in range(64)]))
    ref = ClusteringEvaluator(featuresCol="features", predictionCol="label",
                              distanceMeasure="squaredEuclidean").evaluate(vec.withColumn("label", F.col("label").cast("double")))
    assert ours == pytest.approx(ref, abs=1e-9)
