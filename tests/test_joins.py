"""Left joins with popular and null ids: same rows as a plain join, few rows shuffled, pruned scans."""

import re

import pytest
from pyspark.sql import functions as F

from situate.operators import joins as J
from situate.operators.enrich import apply_user_segments, enrich_log


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def log_of(spark, creative):
    """A stored, wide log of 4000 impressions."""
    from situate.session import scratch_path

    df = spark.range(4000).select(
        F.col("id").alias("impression_id"), (F.col("id") % 50).alias("user_id"), F.lit(None).cast("string").alias("user_segment"),
        F.lit('{"sky": "clear", "temp": 1.0, "precip": "none", "weekend": 1}').alias("context_features"),
        F.expr(creative).alias("creative_id"), (F.col("id") % 3 == 0).cast("int").alias("clicked"), F.lit(0).alias("converted"),
        F.repeat(F.lit("wide"), 50).alias("payload"), F.create_map(F.lit("k"), F.col("id")).alias("tags"))
    path = scratch_path(spark, "wide-log")
    df.write.parquet(path)
    return spark.read.parquet(path)


def catalog(spark):
    return spark.range(100).select(F.col("id").alias("creative_id"), F.when(F.col("id") % 2 == 0, "event").otherwise("tour").alias("creative_type"), F.lit("축제").alias("category"))


CASES = {"one id on half the rows": "IF(id % 2 = 0, 7, id % 120)", "half null": "IF(id % 2 = 0, NULL, id % 120)",
         "both": "CASE id % 3 WHEN 0 THEN 7 WHEN 1 THEN NULL ELSE id % 120 END", "even": "id % 120", "all null": "CAST(NULL AS BIGINT)"}


@pytest.mark.parametrize("case", CASES)
def test_same_rows_as_a_plain_join(spark, no_broadcast, case):
    log, cat = log_of(spark, CASES[case]), catalog(spark)
    plain = log.join(cat, "creative_id", "left").select("impression_id", "creative_id", "creative_type")
    got = enrich_log(log, cat).select("impression_id", "creative_id", "creative_type")
    key = lambda r: r["impression_id"]
    assert sorted(got.collect(), key=key) == sorted(plain.collect(), key=key)


def test_popular_ids_are_not_shuffled(spark, no_broadcast):
    log = log_of(spark, CASES["both"])
    assert J.heavy_keys(log, "creative_id", 0.05) == ([7], True)
    assert J.heavy_keys(log_of(spark, CASES["even"]), "creative_id", 0.05) == ([], False)
    out = enrich_log(log, catalog(spark)).select("impression_id", "creative_type")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan


def test_ids_that_repeat_in_the_catalog(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(J, "HOT_ROWS", 3)
    log = log_of(spark, CASES["both"])
    cat = catalog(spark).unionByName(catalog(spark).where("creative_id = 7")).unionByName(catalog(spark).where("creative_id in (7, 8)")).unionByName(catalog(spark).where("creative_id = 7"))
    assert enrich_log(log, cat).count() == log.join(cat, "creative_id", "left").count()


def test_only_used_columns_are_read(spark, no_broadcast):
    for case in ("both", "even"):
        out = enrich_log(log_of(spark, CASES[case]), catalog(spark)).groupBy("creative_type").agg(F.sum("clicked"))
        schemas = re.findall(r"ReadSchema: struct<([^>]*)>", out._jdf.queryExecution().executedPlan().toString())
        wide = [s for s in schemas if "clicked" in s]
        assert wide and all(set(re.findall(r"(\w+):", s)) <= {"creative_id", "clicked"} for s in wide)


def test_segments_for_popular_and_null_users(spark, no_broadcast):
    log = log_of(spark, "id").withColumn("user_id", F.expr("CASE id % 3 WHEN 0 THEN 1 WHEN 1 THEN NULL ELSE id % 40 END".replace("id %", "impression_id %")))
    users = spark.range(30).select(F.col("id").alias("user_id"), F.format_string("segment_%d", "id").alias("user_segment"))
    got = {r["impression_id"]: (r["user_id"], r["user_segment"]) for r in apply_user_segments(log, users).collect()}
    assert len(got) == 4000 and all(s == (f"segment_{u}" if u is not None and u < 30 else None) for u, s in got.values())
