"""Cube-based rules and strategies (A8-A14, W2, X28): reference cases plus cross-checks."""

import itertools
import json

import pytest
from pyspark.sql import functions as F

from situate.functions.scoring import strategy_score
from situate.operators import itemsets as IS
from situate.operators import strategies as ST
from situate.operators.enrich import enrich_log
from situate.sources import adapters as A
from conftest import SF001, SF01


def _ctx(sky, temp, precip, weekend):
    return json.dumps({"sky": sky, "temp": temp, "precip": precip, "weekend": weekend}, ensure_ascii=False)


@pytest.fixture()
def strategy_log(spark):
    rows = []
    for i in range(40):
        ctx = _ctx("clear", 25.0, "none", 1) if i % 3 != 0 else _ctx("cloudy", 20.0, "rain", 0)
        rows.append((f"imp_{i:06d}", f"user_{i % 5 + 1:04d}", "", ctx, "event_001" if i % 2 == 0 else "tour_001",
                     int(i % 4 == 0), int(i % 8 == 0)))
    log = spark.createDataFrame(rows, "impression_id string, user_id string, user_segment string, "
                                      "context_features string, creative_id string, clicked int, converted int")
    cat = spark.createDataFrame([("event_001", "event", "축제"), ("tour_001", "tour", "음식점")],
                                "creative_id string, creative_type string, category string")
    return enrich_log(log, cat)


def test_score_formula(spark):
    v = spark.range(1).select(strategy_score(F.lit(0.05), F.lit(0.03), F.lit(2.0), F.lit(0.6), F.lit(2.0))).first()[0]
    assert v == pytest.approx(0.35 * 0.05 + 0.35 * 0.03 + 0.15 + 0.09)
    v0 = spark.range(1).select(strategy_score(F.lit(0.0), F.lit(0.0), F.lit(2.0), F.lit(0.6), F.lit(0.0))).first()[0]
    assert v0 == pytest.approx(0.09)


def test_rules_and_top3(strategy_log):
    rules = IS.mine_rules(strategy_log, min_support=0.05, min_confidence=0.1, min_lift=1.0)
    assert rules.count() > 0
    top = ST.build_strategies(rules, top_n=3).collect()
    assert len(top) <= 3
    for r in top:
        assert r.expected_ctr_gain > 0 and r.expected_cvr_gain > 0.01


def _brute_force_itemsets(spark, enriched, min_support):
    rows = IS.transactions(enriched).collect()
    n = len(rows)
    counts = {}
    for r in rows:
        items = [p + v for p, v in zip(("sky_", "precip_", "weekend_", "type_", "category_group_"),
                                       (r.sky, r.precip, r.weekend, r.type, r.category_group))]
        for k in range(1, 6):
            for combo in itertools.combinations(sorted(items), k):
                counts[combo] = counts.get(combo, 0) + 1
    return {k: v for k, v in counts.items() if v / n >= min_support}


def test_cube_equals_fpgrowth_and_brute_force(spark):
    en = enrich_log(A.v_log(spark, SF001), A.v_creative(spark, SF001))
    cube = {tuple(r.items): r.n for r in IS.frequent_itemsets(en, 0.01).collect()}
    fp = {tuple(r.items): r.n for r in IS.frequent_itemsets_general(en, 0.01).collect()}
    brute = _brute_force_itemsets(spark, en, 0.01)
    assert cube == brute
    assert fp == brute


def test_sf001_counts_match_survey_probe(spark):
    en = enrich_log(A.v_log(spark, SF01), A.v_creative(spark, SF01))
    its = IS.frequent_itemsets(en)
    assert its.count() == 496
    assert IS.association_rules(its, 0.0, 0.0).count() == 426
    rules = IS.association_rules(its)
    assert rules.count() == 174
    # multi-item consequents exist (FPGrowth.associationRules would drop them)
    assert rules.where(F.size("consequents") == 2).count() > 0


def test_rule_match_generic_equals_cube(spark):
    en = enrich_log(A.v_log(spark, SF001), A.v_creative(spark, SF001))
    rules = IS.mine_rules(en)
    cube = {r.rule_no: (r.n_matched, round(r.ctr, 9), round(r.cvr, 9)) for r in rules.collect()}
    generic = {r.rule_no: (r.n_matched, round(r.ctr, 9), round(r.cvr, 9)) for r in IS.rule_match_counts(en, rules).collect()}
    assert cube == generic


def _strategies(spark, rows):
    return spark.createDataFrame(rows, "strategy_id string, strategy_name string, target_condition string, "
                                       "recommended_action string, expected_ctr_gain double, expected_cvr_gain double, "
                                       "support double, confidence double, lift double, strategy_score double, "
                                       "reason string, rule_no int")


def _row(i, ctr, cvr, conf, lift, score):
    return (f"strategy_{i:03d}", "n", f"c{i}", "a", ctr, cvr, 0.1, conf, lift, score, "r", i)


def test_weak_cvr_excluded(spark):
    s = _strategies(spark, [_row(1, 0.05, 0.03, 0.6, 1.2, 0.3), _row(2, 0.05, 0.005, 0.6, 1.2, 0.4)])
    ids = [r.strategy_id for r in ST.select_tiered(s, 5).collect()]
    assert ids == ["strategy_001"]


def test_tiers_fill_and_fallback(spark):
    # more than N in tier 1
    s = _strategies(spark, [_row(i, 0.05, 0.03, 0.6, 1.2, 0.1 * i) for i in range(1, 8)])
    ids = [r.strategy_id for r in ST.select_tiered(s, 5).orderBy("rank").collect()]
    assert ids == [f"strategy_{i:03d}" for i in (7, 6, 5, 4, 3)]
    # tier 1 short, tier 2 fills (even with a higher score)
    s = _strategies(spark, [_row(1, 0.05, 0.03, 0.6, 1.2, 0.1), _row(2, 0.05, 0.03, 0.47, 1.2, 0.9),
                            _row(3, 0.05, 0.03, 0.3, 1.2, 0.95)])
    ids = [r.strategy_id for r in ST.select_tiered(s, 5).orderBy("rank").collect()]
    assert ids == ["strategy_001", "strategy_002"]
    # neither tier → fallback on positive gains only, by score
    s = _strategies(spark, [_row(1, 0.05, 0.03, 0.3, 1.0, 0.2), _row(2, 0.05, 0.03, 0.2, 0.9, 0.5),
                            _row(3, -0.05, 0.03, 0.9, 2.0, 0.9)])
    ids = [r.strategy_id for r in ST.select_tiered(s, 5).orderBy("rank").collect()]
    assert ids == ["strategy_002", "strategy_001"]
    # equal scores → by id
    s = _strategies(spark, [_row(2, 0.05, 0.03, 0.6, 1.2, 0.5), _row(1, 0.05, 0.03, 0.6, 1.2, 0.5)])
    ids = [r.strategy_id for r in ST.select_tiered(s, 5).orderBy("rank").collect()]
    assert ids == ["strategy_001", "strategy_002"]


def test_empty_rules_give_empty_table(spark):
    en = enrich_log(A.v_log(spark, SF001), A.v_creative(spark, SF001))
    out = ST.top_strategies(en, min_support=0.99)
    assert out.count() == 0
    assert out.columns[:11] == ST.STRATEGY_COLUMNS
