"""Item arrays of any names: bitmap itemsets, lattice rules and containment against brute force."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from situate.functions.context import CONTENT_PREFIXES, CONTEXT_PREFIXES
from situate.operators import itemsets as IS
from situate.operators import wide_itemsets as W
from situate.operators.enrich import enrich_log
from situate.plans.queries import item_arrays
from situate.sources import adapters as A
from conftest import SF001

TX = "items array<string>, clicked int, converted int"


def transactions(seed, n=300, width=9):
    rng = random.Random(seed)
    names = [f"item {i}" for i in range(14)] + ["é", "a,b", ""]
    rows = []
    for _ in range(n):
        items = rng.choices(names, weights=[3.0 / (i + 1) + .1 for i in range(len(names))], k=rng.randint(0, width))
        rows.append((items + [None] * (rng.random() < .1), int(rng.random() < .5), int(rng.random() < .2)))
    return rows + [(None, 1, 0), ([], None, None), ([None], 0, 0)]


def sets_of(rows):
    return [frozenset(x for x in r[0] or [] if x is not None) for r in rows]


def brute_itemsets(rows, support):
    counts = {}
    for s in sets_of(rows):
        for k in range(1, len(s) + 1):
            for c in itertools.combinations(sorted(s), k):
                counts[c] = counts.get(c, 0) + 1
    return {k: n for k, n in counts.items() if n / len(rows) >= support}


@pytest.mark.parametrize("small", [False, True])
def test_itemsets_against_brute_force(spark, monkeypatch, small):
    if small:  # many shards and several jobs a level
        monkeypatch.setattr(W, "SHARD_BYTES", 16)
        monkeypatch.setattr(W, "CANDIDATES", 7)
    rows = transactions(1)
    df = spark.createDataFrame(rows, TX).repartition(3)
    got = W.mine_itemsets(df, min_support=0.03).collect()
    assert {tuple(r["items"]): r["n"] for r in got} == brute_itemsets(rows, 0.03) and len(got) == len({tuple(r["items"]) for r in got})
    assert max(len(r["items"]) for r in got) >= 4 and {r["n_total"] for r in got} == {len(rows)}
    two = W.mine_itemsets(df, min_support=0.03, longest=2).collect()
    assert {tuple(r["items"]) for r in two} == {k for k in brute_itemsets(rows, 0.03) if len(k) <= 2}


def test_no_transactions_and_too_many_itemsets(spark, monkeypatch):
    df = spark.createDataFrame(transactions(2, 40), TX)
    assert W.mine_itemsets(df.where("false")).count() == 0 and W.lattice_rules(W.mine_itemsets(df.where("false"))).count() == 0
    assert W.mine_itemsets(spark.createDataFrame([(None, 1, 1)], TX)).count() == 0
    monkeypatch.setattr(W, "MOST_ITEMSETS", 20)
    with pytest.raises(ValueError, match="min_support"):
        W.mine_itemsets(df, min_support=0.02)


def test_lattice_rules_against_brute_force(spark):
    rows = transactions(3, 200, 6)
    its = brute_itemsets(rows, 0.05)
    n = len(rows)
    want = {}
    for s, c in its.items():
        for k in range(1, len(s)):
            for a in itertools.combinations(s, k):
                rest = tuple(x for x in s if x not in a)
                conf = c / its[a]
                if conf >= 0.1 and conf / (its[rest] / n) >= 1.0:
                    want[a, rest] = (c, round(conf, 9), round(conf / (its[rest] / n), 9))
    table = W.mine_itemsets(spark.createDataFrame(rows, TX), min_support=0.05)
    got = {(tuple(r["antecedents"]), tuple(r["consequents"])): (r["n_matched"], round(r["confidence"], 9), round(r["lift"], 9)) for r in W.lattice_rules(table, None, None, 0.1, 1.0).collect()}
    assert got == want and any(len(c) > 1 for _, c in got)
    left = W.lattice_rules(table, W.starts_with_any(["item 0", "item 1"]), None, 0.0, 0.0).collect()
    assert left and all(x.startswith(("item 0", "item 1")) for r in left for x in r["antecedents"])


def test_equal_to_the_cube_on_five_dimensions(spark):
    en = enrich_log(A.v_log(spark, SF001), A.v_creative(spark, SF001))
    cube = {(tuple(r["antecedents"]), tuple(r["consequents"])): (r["rule_no"], r["n_matched"], round(r["lift"], 9), round(r["zhangs_metric"], 9)) for r in IS.mine_rules(en).collect()}
    table = W.mine_itemsets(item_arrays(en))
    rules = W.numbered(W.lattice_rules(table, W.starts_with_any(CONTEXT_PREFIXES), W.starts_with_any(CONTENT_PREFIXES)))
    assert {(tuple(r["antecedents"]), tuple(r["consequents"])): (r["rule_no"], r["n_matched"], round(r["lift"], 9), round(r["zhangs_metric"], 9)) for r in rules.collect()} == cube


def test_rule_matching_against_every_pair(spark):
    rows = transactions(4)
    rng = random.Random(5)
    names = sorted({x for s in sets_of(rows) for x in s}) + ["never"]
    rules = [(i, rng.sample(names, rng.randint(1, 3)) + [None] * (i % 7 == 0)) for i in range(60)] + [(100, []), (101, None), (102, ["item 0", "item 0"]), (7, ["item 1"])]
    wanted = {}
    for i, items in rules:
        wanted.setdefault(i, set()).update(x for x in items or [] if x is not None)
    rate = lambda v: sum(v) / len(v) if v else 0.0

    def rates(part):
        return rate([r[1] for r in part if r[1] is not None]), rate([r[2] for r in part if r[1] == 1 and r[2] is not None])

    base = rates(rows)
    want = {}
    for i, need in wanted.items():
        part = [r for r, s in zip(rows, sets_of(rows)) if need <= s]
        ctr, cvr = rates(part)
        want[i] = (len(part), round(ctr, 9), round(cvr, 9), round(ctr - base[0], 9) if part else 0.0, round(cvr - base[1], 9) if part else 0.0)
    got = W.rule_match_arrays(spark.createDataFrame(rows, TX).repartition(4), spark.createDataFrame(rules, "rule_no int, items array<string>")).collect()
    assert {r["rule_no"]: (r["n_matched"], *(round(r[c], 9) for c in ("ctr", "cvr", "ctr_gain", "cvr_gain"))) for r in got} == want and len(got) == len(want)


def test_matching_joins_on_items_only(spark):
    """No nested loop: a transaction meets the rules of its items."""
    tx = spark.createDataFrame(transactions(6), TX)
    rules = spark.createDataFrame([(1, ["item 1"]), (2, ["item 2", "item 0"])], "rule_no int, items array<string>")
    plan = W.rule_match_arrays(tx, rules)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "array_except" in plan


def test_infrequent_rows_are_gone_before_the_single_partition(spark):
    en = enrich_log(A.v_log(spark, SF001), A.v_creative(spark, SF001))
    cube = IS.itemset_cube(en)
    assert cube.rdd.getNumPartitions() == 1 and cube.where("n / n_total < 0.01").count() == 0
    assert IS.itemset_cube(en.where(F.lit(False))).count() == 0
