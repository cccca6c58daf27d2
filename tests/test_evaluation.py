"""Evaluation (A18-A20, E1-E3, F11) and reconciliation."""

import pytest
from pyspark.sql import functions as F

from situate.operators import evaluation as EV
from situate.operators import reconcile as RC
from situate.sources import adapters as A
from conftest import SF01


def _trials(spark, cases):
    rows = [(cid, i + 1, p) for cid, ps in cases.items() for i, p in enumerate(ps)]
    return spark.createDataFrame(rows, "case_id string, trial int, passed boolean")


def test_pass_at_k_and_pow_k(spark):
    t = _trials(spark, {"gs_a": [True, False, True], "gs_b": [True, True, True]})
    s = EV.eval_suite(t, k=3, n_trials=3).first()
    assert (s.case_count, s.pass_at_k, s.pass_pow_k, s.pass_at_1) == (2, 1.0, 0.5, 1.0)


def test_short_cases_and_order(spark):
    rows = [("a", 3, False), ("a", 1, True), ("b", 1, False), ("c", 2, True), ("c", 1, False)]
    t = spark.createDataFrame(rows, "case_id string, trial int, passed boolean")
    got = {r.case_id: (r.pass_at_k, r.pass_pow_k, r.pass_at_1, r.first_k_passes)
           for r in EV.case_results(t, 3).collect()}
    assert got["a"] == (True, False, True, [True, False])
    assert got["b"] == (False, False, False, [False])
    assert got["c"] == (True, False, False, [False, True])


def test_survey_probe_values(spark):
    s = EV.eval_suite(A.v_trials(spark, SF01), 3, 3).first()
    assert s.case_count == 97
    assert (round(s.pass_at_1, 6), round(s.pass_at_k, 6), round(s.pass_pow_k, 6)) == (0.773196, 0.958763, 0.360825)


def test_empty_suite(spark):
    t = spark.createDataFrame([], "case_id string, trial int, passed boolean")
    s = EV.eval_suite(t).first()
    assert (s.case_count, s.pass_at_k) == (0, 0.0)


def _grade(spark, case, result):
    cases = spark.createDataFrame([case], "case_id int, expected_approved boolean, expected_ids array<string>, "
                                          "required_keywords array<string>, forbidden_keywords array<string>")
    res = spark.createDataFrame([result], "case_id int, approved boolean, actual_ids array<string>, "
                                          "overall_recommendation string, report string, operational_reasons array<string>")
    r = EV.grade_cases(cases, res).first()
    return r.passed, r.reasons


def test_grade_pass(spark):
    ok = _grade(spark, (1, True, ["strategy_001"], ["비 오는 날"], ["보장"]),
                (1, True, ["strategy_001"], "비 오는 날 실내", "report", ["reason"]))
    assert ok == (True, [])


def test_grade_reasons_in_order(spark):
    passed, reasons = _grade(spark, (1, True, ["strategy_002", "strategy_001"], ["없는말"], ["보장"]),
                             (1, False, ["strategy_001"], "매출 보장", "r", []))
    assert not passed
    assert reasons == [
        "critic 승인 불일치 (expected=True, actual=False)",
        "strategy_id 불일치 (expected=['strategy_001', 'strategy_002'], actual=['strategy_001'])",
        "필수 키워드 누락: 없는말",
        "금지 키워드 포함: 보장",
    ]


def test_case_trials_and_filter(spark):
    cases = spark.createDataFrame([("a",), ("b",)], "case_id string")
    assert EV.case_trials(cases, 3).count() == 6
    assert [r.case_id for r in EV.filter_cases(cases, ["b", "z"]).collect()] == ["b"]
    with pytest.raises(ValueError):
        EV.filter_cases(cases, ["z"])


def _strategies(spark, rows):
    return spark.createDataFrame(rows, "strategy_id string, ordinal long, reason string, expected_ctr_gain double, "
                                       "expected_cvr_gain double, support double, confidence double, lift double, "
                                       "strategy_score double")


def test_drift_detected(spark):
    truth = _strategies(spark, [("strategy_001", 1, "r", 0.02, 0.03, 0.1, 0.6, 1.2, 0.3)])
    reported = _strategies(spark, [("strategy_001", 1, "r", 0.99, 0.03, 0.1, 0.6, 1.2, 0.3),
                                   ("strategy_404", 2, "r", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)])
    issues = RC.metric_issues(truth, reported).orderBy("ordinal", "metric_pos").collect()
    assert len(issues) == 2
    assert issues[0].metric == "expected_ctr_gain"
    assert issues[0].issue == "expected_ctr_gain 불일치 (expected=0.02, actual=0.99)"
    assert issues[1].issue == RC.UNKNOWN_ID_ISSUE


def test_merge_narratives_last_wins(spark):
    truth = _strategies(spark, [("s1", 1, "own", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0),
                                ("s2", 2, "own2", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)])
    narr = spark.createDataFrame([("s1", "first", 1), ("s1", "last", 2)],
                                 "strategy_id string, operational_reason string, ordinal long")
    got = {r.strategy_id: r.operational_reason for r in RC.merge_narratives(truth, narr).collect()}
    assert got == {"s1": "last", "s2": "own2"}


def test_merge_issues(spark):
    py = spark.createDataFrame([("s1", "x"), (None, "y")], "strategy_id string, issue string")
    model = spark.createDataFrame([("s1", "x"), (None, "y"), ("s1", "new"), ("s1", "new")], "strategy_id string, issue string")
    out = RC.merge_issues(py, model)
    assert out.where(F.col("source") == "model").count() == 2
    assert out.count() == 4
