"""Hot keys: one key holds a third of all rows. Results stay exact and whole, and the plans
combine on the map side before the shuffle (so the hot key is not one huge task)."""

from pyspark.sql import functions as F

from situate.operators import evaluation as EV
from situate.operators import segments as SG
from situate.operators.rows import dedupe_first
from situate.operators.sampling import weighted_choice

N = 30000


def _skewed(spark):
    # user 0 holds one third of the rows; the rest spread over 2000 users
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).alias("user_id"),
        F.col("id").alias("impression_id"),
        (F.col("id") % 5 == 0).cast("int").alias("clicked"),
        (F.col("id") % 10 == 0).cast("int").alias("converted"),
        (F.col("id") % 7 == 0).alias("is_outdoor"), (F.col("id") % 11 == 0).alias("is_indoor"),
        (F.col("id") % 2).cast("int").alias("is_weekend"), (F.col("id") % 3 == 1).alias("is_clear"),
        (F.col("id") % 4 == 1).alias("is_rainy"),
        F.when(F.col("id") % 2 == 0, "event").otherwise("tour").alias("creative_type"),
    ).repartition(16)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_user_features_hot_user(spark):
    df = _skewed(spark)
    feats = SG.user_features(df)
    hot = feats.where(F.col("user_id") == 0).first()
    assert hot.impression_count == N // 3
    assert abs(hot.overall_ctr - df.where(F.col("user_id") == 0).agg(F.avg("clicked")).first()[0]) < 1e-12
    assert feats.count() == 2001
    assert "partial_count" in _plan(feats)


def test_dedupe_and_choice_hot_key(spark):
    df = _skewed(spark)
    first = dedupe_first(df, ["user_id"], ["impression_id"])
    assert first.where(F.col("user_id") == 0).first().impression_id == 0
    assert _plan(first).count("WindowGroupLimit") == 2  # before and after the shuffle
    pick = weighted_choice(df, ["user_id"], F.lit(1.0) + F.col("clicked"), ["impression_id"])
    assert pick.count() == 2001
    assert _plan(pick).count("WindowGroupLimit") == 2


def test_pass_at_k_hot_case(spark):
    trials = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.format_string("c%d", F.col("id") % 500)).alias("case_id"),
        F.col("id").cast("int").alias("trial"), (F.col("id") % 4 != 0).alias("passed"))
    res = EV.case_results(trials, 3)
    hot = res.where(F.col("case_id") == "hot").first()
    # hot case trials are 0, 3, 6 → passes F, T, T
    assert hot.first_k_passes == [False, True, True] and hot.pass_at_k and not hot.pass_pow_k
    plan = _plan(res)
    assert "WindowGroupLimit" in plan and plan.index("Partial") > 0
