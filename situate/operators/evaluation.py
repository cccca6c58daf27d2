"""Batch evaluation: pass@k / pass^k (A18-A20), grading (E1, E2), case × trial (E3), case filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from situate.functions.formatting import py_bool, py_str_list

# ---- fixed values: grading messages ------------------------------------------
APPROVAL_MISMATCH = "critic 승인 불일치"
ID_MISMATCH = "strategy_id 불일치"
MISSING_KEYWORD = "필수 키워드 누락: "
FORBIDDEN_KEYWORD = "금지 키워드 포함: "
MISSING_RESULT = "결과 없음"
# ------------------------------------------------------------------------------


def first_k_trials(trials: DataFrame, k: int) -> DataFrame:
    """The first ``k`` trials of each case in (case_id, trial) order.

    ``row_number() <= k`` lets Spark insert a map-side WindowGroupLimit, so even a
    case holding a third of all trials reaches the shuffle as ``k`` rows per task.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    w = Window.partitionBy("case_id").orderBy("trial")
    return trials.withColumn("__pos", F.row_number().over(w)).where(F.col("__pos") <= k)


def case_results(trials: DataFrame, k: int) -> DataFrame:
    """A18/A19 per case: pass@k (any of first k), pass^k (all of first k, at least k trials), pass@1."""
    firsts = first_k_trials(trials, k)
    return firsts.groupBy("case_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("__pos", "passed"))), lambda e: e["passed"]).alias("first_k_passes"),
        F.coalesce(F.bool_or("passed"), F.lit(False)).alias("pass_at_k"),
        ((F.count("*") >= k) & F.bool_and(F.coalesce("passed", F.lit(False)))).alias("pass_pow_k"),
        F.coalesce(F.bool_or(F.when(F.col("__pos") == 1, F.col("passed"))), F.lit(False)).alias("pass_at_1"),
    )


def eval_suite(trials: DataFrame, k: int = 3, n_trials: int = 3) -> DataFrame:
    """A20 ``aggregate_suite_results``: one row of case count and mean pass@k, pass^k, pass@1 (0.0 if no case)."""
    cases = case_results(trials, k)
    as_d = lambda c: F.col(c).cast("double")
    return cases.agg(
        F.lit(k).alias("k"),
        F.lit(n_trials).alias("trials"),
        F.count("*").alias("case_count"),
        F.coalesce(F.avg(as_d("pass_at_k")), F.lit(0.0)).alias("pass_at_k"),
        F.coalesce(F.avg(as_d("pass_pow_k")), F.lit(0.0)).alias("pass_pow_k"),
        F.coalesce(F.avg(as_d("pass_at_1")), F.lit(0.0)).alias("pass_at_1"),
    )


def text_blob(overall, report, reasons) -> F.Column:
    """Overall, report, then operational reasons, joined by single spaces."""
    return F.concat_ws(" ", overall, report, F.array_join(F.coalesce(reasons, F.array().cast("array<string>")), " "))


def grade_cases(cases: DataFrame, results: DataFrame) -> DataFrame:
    """E1 ``grade_golden_case`` for every case (and trial, where the results have one): ordered reasons
    and ``passed``; a case without any result fails with the one reason that it has none.


    Checks: approval equality, strategy-id set equality, required keywords present and
    forbidden keywords absent (case-sensitive substring) in the text blob.
    """
    trial = ["trial"] if "trial" in results.columns else []
    j = cases.join(results.withColumn("__has", F.lit(True)), "case_id", "left")
    text = text_blob(F.col("overall_recommendation"), F.col("report"), F.col("operational_reasons"))
    exp_ids = F.array_sort(F.array_distinct("expected_ids"))
    act_ids = F.array_sort(F.array_distinct("actual_ids"))
    approval = F.when(
        F.col("approved") != F.col("expected_approved"),
        F.array(F.concat(F.lit(APPROVAL_MISMATCH + " (expected="), py_bool(F.col("expected_approved")),
                         F.lit(", actual="), py_bool(F.col("approved")), F.lit(")"))),
    ).otherwise(F.array().cast("array<string>"))
    ids = F.when(
        exp_ids != act_ids,
        F.array(F.concat(F.lit(ID_MISMATCH + " (expected="), py_str_list(exp_ids), F.lit(", actual="),
                         py_str_list(act_ids), F.lit(")"))),
    ).otherwise(F.array().cast("array<string>"))
    j = j.withColumn("__text", text)
    missing = F.transform(F.filter("required_keywords", lambda kw: F.instr(F.col("__text"), kw) == 0),
                          lambda kw: F.concat(F.lit(MISSING_KEYWORD), kw))
    present = F.transform(F.filter("forbidden_keywords", lambda kw: F.instr(F.col("__text"), kw) > 0),
                          lambda kw: F.concat(F.lit(FORBIDDEN_KEYWORD), kw))
    reasons = F.when(F.col("__has").isNull(), F.array(F.lit(MISSING_RESULT))).otherwise(F.concat(approval, ids, missing, present))
    return j.select("case_id", *trial, reasons.alias("reasons")).withColumn("passed", F.size("reasons") == 0)


def case_trials(cases: DataFrame, n_trials: int) -> DataFrame:
    """Every case × trial 1..n (an explode per case, not a join)."""
    return cases.select("*", F.explode(F.sequence(F.lit(1), F.lit(n_trials))).alias("trial"))


def filter_cases(cases: DataFrame, case_ids: DataFrame | Sequence) -> DataFrame:
    """keep the selected case ids (left-semi join); error if none match."""
    if not isinstance(case_ids, DataFrame):
        case_ids = cases.sparkSession.createDataFrame([(c,) for c in case_ids], ["case_id"])
    kept = cases.join(case_ids.select("case_id").distinct(), "case_id", "left_semi")
    if kept.isEmpty():
        raise ValueError("no case matches the requested ids")
    return kept
