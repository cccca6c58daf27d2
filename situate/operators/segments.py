"""User features and segmentation.

Features are one ``groupBy(user_id)`` of conditional averages, scaled by one attached row of statistics. The k search
is :mod:`situate.operators.kmeans`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from situate.operators import kmeans as KM
from situate.operators.joins import attach_row
from situate.session import materialize

FEATURE_COLUMNS = [
    "impression_count", "overall_ctr", "overall_cvr", "outdoor_ctr", "indoor_ctr", "weekend_ratio",
    "clear_weather_ctr", "rainy_weather_ctr", "event_ctr", "tour_ctr",
]
K_MIN, K_MAX, SEED = 3, 6, 42  # fixed values: k range and seed


def _subset_ctr(cond):
    return F.coalesce(F.avg(F.when(cond, F.col("clicked"))), F.lit(0.0))


def user_features(enriched: DataFrame) -> DataFrame:
    """A6 ``build_user_features``: one row per user, ten measures, one aggregate."""
    return enriched.groupBy("user_id").agg(
        F.count("*").alias("impression_count"),
        F.coalesce(F.avg("clicked"), F.lit(0.0)).alias("overall_ctr"),
        F.coalesce(F.avg(F.when(F.col("clicked") == 1, F.col("converted"))), F.lit(0.0)).alias("overall_cvr"),
        _subset_ctr(F.col("is_outdoor")).alias("outdoor_ctr"),
        _subset_ctr(F.col("is_indoor")).alias("indoor_ctr"),
        F.avg(F.col("is_weekend").cast("double")).alias("weekend_ratio"),
        _subset_ctr(F.col("is_clear")).alias("clear_weather_ctr"),
        _subset_ctr(F.col("is_rainy")).alias("rainy_weather_ctr"),
        _subset_ctr(F.col("creative_type") == "event").alias("event_ctr"),
        _subset_ctr(F.col("creative_type") == "tour").alias("tour_ctr"),
    )


def zscore(features: DataFrame, columns=FEATURE_COLUMNS) -> DataFrame:
    """M1: population z-score per column; a constant column scales to 0.

    One global aggregate (1 row) attached by a broadcast of that row.
    """
    stats = features.agg(*[F.avg(c).alias(f"__m_{c}") for c in columns],
                         *[F.stddev_pop(c).alias(f"__s_{c}") for c in columns])
    j = attach_row(features, stats)
    scaled = [
        F.when(F.col(f"__s_{c}") > 0, (F.col(c) - F.col(f"__m_{c}")) / F.col(f"__s_{c}")).otherwise(F.lit(0.0)).alias(c)
        for c in columns
    ]
    others = [c for c in features.columns if c not in columns]
    return j.select(*others, *scaled)


def squared_silhouette(points: DataFrame, vector: str, label: str, id_col: str) -> DataFrame:
    """M3: per-point silhouette with squared Euclidean distance, in linear time.

    For a point x and cluster C: mean ||x-y||² = ||x||² + Q_C/n_C - 2·x·S_C/n_C with S_C the
    vector sum and Q_C the sum of squared norms. Cluster stats (k × dim numbers) are
    aggregated per (cluster, dimension) and attached as one row; no point pairs are formed.
    Own-cluster mean excludes the point itself (×n/(n-1)); singleton clusters score 0.
    """
    p = points.select(F.col(id_col).alias("__id"), F.col(label).alias("__c"),
                      F.transform(F.col(vector), lambda v: v.cast("double")).alias("__v"))
    p = p.withColumn("__nrm", F.aggregate("__v", F.lit(0.0), lambda a, v: a + v * v))
    # one pass for the cluster statistics: per (cluster, dimension) sum and count; the norm sum
    # Q_C is the sum over dimensions of the squared components
    per_dim = (p.select("__c", F.posexplode("__v").alias("__pos", "__x"))
               .groupBy("__c", "__pos").agg(F.sum("__x").alias("__s"), F.sum(F.col("__x") * F.col("__x")).alias("__q"),
                                            F.count("*").alias("__k")))
    clusters = per_dim.groupBy("__c").agg(
        F.max(F.when(F.col("__pos") == 0, F.col("__k"))).alias("__n"), F.sum("__q").alias("__Q"),
        F.transform(F.array_sort(F.collect_list(F.struct("__pos", "__s"))), lambda e: e["__s"]).alias("__S"))
    one = clusters.agg(F.collect_list(F.struct("__c", "__n", "__Q", "__S")).alias("__clusters"))
    j = attach_row(p, one)

    def mean_dist(c):
        dot = F.aggregate(F.zip_with("__v", c["__S"], lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
        return F.col("__nrm") + c["__Q"] / c["__n"] - 2 * dot / c["__n"]

    dists = F.transform("__clusters", lambda c: F.struct(c["__c"].alias("c"), c["__n"].alias("n"),
                                                          mean_dist(c).alias("d")))
    j = j.withColumn("__dists", dists)
    own = F.filter("__dists", lambda e: e["c"] == F.col("__c"))[0]
    others = F.filter("__dists", lambda e: e["c"] != F.col("__c"))
    a = own["d"] * own["n"] / (own["n"] - 1)
    b = F.array_min(F.transform(others, lambda e: e["d"]))
    s = (F.when(own["n"] <= 1, F.lit(0.0))
         .when(a < b, 1 - a / b)
         .when(a > b, b / a - 1)
         .otherwise(F.lit(0.0)))
    return j.select(F.col("__id").alias(id_col), F.col("__c").alias(label), s.alias("silhouette"))


def silhouette_score(points: DataFrame, vector: str, label: str, id_col: str) -> DataFrame:
    """Mean squared-Euclidean silhouette as a one-row DataFrame."""
    return squared_silhouette(points, vector, label, id_col).agg(
        F.avg("silhouette").alias("silhouette"), F.countDistinct(label).alias("n_clusters"),
        F.count("*").alias("n_points"))


@dataclass(frozen=True)
class SegmentationResult:
    user_segments: DataFrame          # user_id, features, cluster_id, user_segment
    best_k: int
    silhouette_scores: dict
    best_silhouette: float


def segmentation_checks(result: SegmentationResult, slack: float = 0.01) -> DataFrame:
    """One row: users, k within the range, cluster sizes adding up, names in centroid order, and all but
    ``slack`` of the users nearest to the mean of their own cluster."""
    users = result.user_segments
    scaled = zscore(users.select("user_id", "cluster_id", *FEATURE_COLUMNS))
    means = scaled.groupBy("cluster_id").agg(F.count("*").alias("n"), F.array(*[F.avg(c) for c in FEATURE_COLUMNS]).alias("mean"))
    one = means.agg(F.array_sort(F.collect_list(F.struct("cluster_id", "n", "mean"))).alias("__all"))
    j = attach_row(scaled.withColumn("__v", F.array(*FEATURE_COLUMNS)), one)
    far = lambda c: F.aggregate(F.zip_with("__v", c["mean"], lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    nearest = F.array_min(F.transform("__all", lambda c: F.struct(far(c).alias("d"), c["cluster_id"].alias("c"))))["c"]
    order = F.transform("__all", lambda c: c["mean"])
    out = j.select("cluster_id", nearest.alias("near"), (F.array_sort(order) == order).alias("ordered"),
                   F.aggregate("__all", F.lit(0).cast("long"), lambda s, c: s + c["n"]).alias("total"))
    return out.agg(F.count("*").alias("n_users"), F.lit(K_MIN <= result.best_k <= K_MAX).alias("k_in_range"),
                   (F.countDistinct("cluster_id") == result.best_k).alias("k_clusters"), (F.max("total") == F.count("*")).alias("sizes_add_up"),
                   F.bool_and("ordered").alias("named_in_order"),
                   (F.avg((F.col("near") == F.col("cluster_id")).cast("double")) >= 1 - slack).alias("nearest_mean"))


def cluster_users(enriched: DataFrame, k_min: int = K_MIN, k_max: int = K_MAX, seed: int = SEED,
                  restarts: int = 10) -> SegmentationResult:
    """M6 ``cluster_users``: features → z-score → k search → labelled users.

    All fits of all k run as one (:mod:`situate.operators.kmeans`); of each k the least cost counts, of
    the k in [k_min, k_max] the best squared-Euclidean silhouette (strict >: smallest k wins ties). Clusters are numbered by centroid.
    A row of log without a user forms no segment."""
    # read by every pass: materialised once in the checkpoint folder, so neither reuse nor a lost executor
    # re-aggregates the log
    feats = materialize(user_features(enriched))
    points = materialize(zscore(feats).where("user_id is not null").select(F.col("user_id").alias("id"), F.array(*FEATURE_COLUMNS).alias("v")))
    n = points.count()
    if n <= k_max:
        raise ValueError(f"number of users ({n}) must exceed k_max ({k_max})")
    fits = {k: KM.ordered(c) for k, (_, c) in KM.fit_sets(points, list(range(k_min, k_max + 1)), restarts, seed).items()}
    scores = KM.silhouettes(points, fits)
    best_k = max(sorted(scores), key=lambda k: scores[k])
    segs = KM.assign(points, fits[best_k]).withColumnRenamed("id", "user_id")
    users = feats.join(segs.withColumn("user_segment", F.format_string("segment_%d", F.col("cluster_id"))), "user_id", "left")
    return SegmentationResult(users, best_k, scores, scores[best_k])
