"""KPIs (A1-A5): the reference's metric cases."""

import pytest

from situate.operators.metrics import kpi_metrics, log_counts


def _log(spark, clicked, converted):
    rows = list(zip(clicked, converted))
    return spark.createDataFrame(rows, "clicked int, converted int")


def _kpi(spark, clicked, converted):
    return kpi_metrics(_log(spark, clicked, converted)).first().asDict()


def test_ctr(spark):
    assert _kpi(spark, [1, 0, 1, 0], [1, 0, 0, 0])["ctr"] == pytest.approx(0.5)


def test_all_three(spark):
    k = _kpi(spark, [1, 1, 0, 0], [1, 0, 0, 0])
    assert k == pytest.approx({"ctr": 0.5, "cvr": 0.5, "ctcvr": 0.25})


def test_no_clicks_cvr_zero(spark):
    assert _kpi(spark, [0, 0], [0, 0])["cvr"] == 0.0


def test_empty_log_all_zero(spark):
    assert _kpi(spark, [], []) == {"ctr": 0.0, "cvr": 0.0, "ctcvr": 0.0}


def test_grouped_and_counts(spark):
    df = spark.createDataFrame([(1, "a", 1, 0), (1, "a", 0, 0), (2, "b", 1, 1)],
                               "user_id int, g string, clicked int, converted int")
    got = {r.g: r.ctr for r in kpi_metrics(df, ["g"]).collect()}
    assert got == {"a": 0.5, "b": 1.0}
    c = log_counts(df).first()
    assert (c.impression_count, c.user_count) == (3, 2)


def test_kpi_summary_exact_and_approx(spark):
    from situate.operators.metrics import kpi_summary

    df = spark.range(20000).selectExpr("id % 1000 AS user_id", "CAST(id % 3 = 0 AS INT) AS clicked",
                                       "CAST(id % 6 = 0 AS INT) AS converted")
    exact = kpi_summary(df).first()
    assert (exact.impression_count, exact.user_count) == (20000, 1000)
    assert exact.cvr == pytest.approx(3334 / 6667)
    approx = kpi_summary(df, approx_rsd=0.02).first()
    assert abs(approx.user_count - 1000) <= 60
