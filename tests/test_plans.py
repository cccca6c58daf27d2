"""Plan shape guards for the flagship and the hot-key operators."""

import re

from situate.plans.queries import QUERIES
from conftest import SF001


def _executed(df):
    df.collect()  # runs this very DataFrame, so its plan below is the final adaptive one
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "AdaptiveSparkPlan" not in plan or "isFinalPlan=true" in plan
    return plan.split("== Initial Plan ==")[0]



def test_flagship_reads_each_input_once(spark):
    plan = _executed(QUERIES["top_strategies_big"](spark, SF001))
    tables = re.findall(r"/(\w+)\.parquet", plan)
    assert sorted(set(tables)) == ["lineitem", "orders", "part"]
    assert plan.count("FileScan parquet") == 3
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan and "SortAggregate" not in plan
    # the grand total reuses the exchange of the pre-aggregated log; the frequent rows of the cube move to one
    # partition once, later windows add no exchange
    assert plan.count("ReusedExchange") == 1 and plan.count("Exchange SinglePartition") == 2
    assert "Expand" in plan and "partial_sum" in plan


def test_user_features_single_shuffle(spark):
    plan = _executed(QUERIES["user_features_big"](spark, SF001))
    shuffles = re.findall(r"Exchange (hashpartitioning|SinglePartition|rangepartitioning)", plan)
    assert len(shuffles) == 1 and "partial_count" in plan


def test_no_python_udfs_anywhere(spark):
    for key in ("top_strategies", "event_clean", "grade_cases", "decode_envelope", "weighted_choice"):
        plan = _executed(QUERIES[key](spark, SF001))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, key


def test_first_row_by_order_without_sorted_aggregates(spark):
    for key in ("dedupe_first", "weather_pivot", "merge_narratives", "weighted_choice"):
        plan = _executed(QUERIES[key](spark, SF001))
        assert "SortAggregate" not in plan, key
        assert "WindowGroupLimit" in plan or key == "weather_pivot"


def test_digest_without_nested_loops(spark):
    plan = _executed(QUERIES["digest_sections"](spark, SF001))
    loops = plan.count("BroadcastNestedLoopJoin")
    assert loops <= 2 and "CartesianProduct" not in plan  # one-row broadcasts to the cube
    assert plan.count("FileScan parquet") <= 5
