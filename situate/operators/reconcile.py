"""Checks of reported strategies against the pipeline's ground truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from situate.functions.formatting import py_float_repr
from situate.operators.rows import first_rows

# ---- fixed values: tolerance, checked metrics (in order) and issue texts ------
METRIC_TOLERANCE = 1e-6
CHECKED_METRICS = ("expected_ctr_gain", "expected_cvr_gain", "support", "confidence", "lift", "strategy_score")
UNKNOWN_ID_ISSUE = "하층 파이프라인에 없는 strategy_id"
METRIC_MISMATCH = " 불일치"
# ------------------------------------------------------------------------------


def merge_narratives(strategies: DataFrame, narratives: DataFrame) -> DataFrame:
    """Operational reason by strategy id (last narrative per id wins), else the strategy's own reason."""
    last = first_rows(narratives.where("ordinal is not null"), ["strategy_id"], [F.desc("ordinal")]).select("strategy_id", F.col("operational_reason").alias("__narrative"))
    j = strategies.join(last, "strategy_id", "left")
    return j.withColumn("operational_reason", F.coalesce(F.col("__narrative"), F.col("reason"))).drop("__narrative")


def metric_issues(truth: DataFrame, reported: DataFrame, tolerance: float = METRIC_TOLERANCE) -> DataFrame:
    """J4 + J5 ``_python_metric_checks``: one issue per unknown id, one per (id, metric) whose
    |actual - expected| exceeds the tolerance.

    One left join and one explode: a known id unpivots into its six checks, an unknown id into
    a single marker row; then one filter. Output: strategy_id, ordinal (reported order),
    metric_pos, metric, expected, actual, issue. A null or NaN on either side is no mismatch (nothing
    exceeds the tolerance); of several truths of one id the last by ``ordinal`` counts.
    """
    if "ordinal" in truth.columns:  # the last truth of an id counts
        truth = first_rows(truth.where("ordinal is not null"), ["strategy_id"], [F.desc("ordinal")])
    t = truth.select("strategy_id", F.lit(True).alias("__known"), *[F.col(m).alias(f"t_{m}") for m in CHECKED_METRICS])
    j = reported.join(t, "strategy_id", "left")
    check_t = "struct<metric_pos:int,metric:string,expected:double,actual:double>"
    checks = F.array(*[
        F.struct(F.lit(i).alias("metric_pos"), F.lit(m).alias("metric"), F.col(f"t_{m}").cast("double").alias("expected"),
                 F.col(m).cast("double").alias("actual"))
        for i, m in enumerate(CHECKED_METRICS)
    ])
    unknown = F.array(F.struct(F.lit(-1).alias("metric_pos"), F.lit(None).cast("string").alias("metric"),
                               F.lit(None).cast("double").alias("expected"), F.lit(None).cast("double").alias("actual")))
    rows = F.when(F.col("__known").isNull(), unknown.cast(f"array<{check_t}>")).otherwise(checks.cast(f"array<{check_t}>"))
    long = j.select("strategy_id", "ordinal", F.explode(rows).alias("__c")).select("strategy_id", "ordinal", "__c.*")
    off = F.abs(F.col("actual") - F.col("expected"))
    bad = long.where(F.col("metric").isNull() | (~F.isnan(off) & (off > F.lit(tolerance))))
    text = F.concat(F.col("metric"), F.lit(METRIC_MISMATCH + " (expected="), py_float_repr(F.col("expected")),
                    F.lit(", actual="), py_float_repr(F.col("actual")), F.lit(")"))
    return bad.withColumn("issue", F.when(F.col("metric").isNull(), F.lit(UNKNOWN_ID_ISSUE)).otherwise(text))


def merge_issues(python_issues: DataFrame, model_issues: DataFrame) -> DataFrame:
    """U4: python issues plus model issues not already among them (null-safe on id and text)."""
    p = python_issues.select("strategy_id", "issue")
    m = model_issues.select("strategy_id", "issue")
    cond = [m.strategy_id.eqNullSafe(p.strategy_id), m.issue.eqNullSafe(p.issue)]
    new = m.join(p, cond, "left_anti")
    return p.withColumn("source", F.lit("python")).unionByName(new.withColumn("source", F.lit("model")))
