"""Landed pages: items in quarantine, completeness by ranges against single positions."""

import json
import random

import pytest
from pyspark.sql import functions as F

from situate.plans.queries import ITEM_SCHEMA
from situate.sources import landing as LD

PAGE = "page_id long, feed string, start_index long, declared_rows long, body string"


def body(items, code="00"):
    return json.dumps({"response": {"header": {"resultCode": code}, "body": {"items": {"item": items}}}})


def test_bad_items_go_to_quarantine(spark):
    good = {"event_id": 1, "user_id": 2, "event_type": "view", "value": 1.5}
    pages = [(1, [good, "oops", {**good, "event_id": "x"}, None, 7, {**good, "event_id": 3}]), (2, "oops"), (3, {**good, "value": [1]}), (4, {}), (5, good), (6, [])]
    rows = [(i, "weather", 1, 1, body(items)) for i, items in pages] + [(7, "weather", 1, 1, body(["oops"], "99"))]
    dec = LD.decode_pages(spark.createDataFrame(rows, PAGE), ITEM_SCHEMA)
    landed = sorted((r["page_id"], r["item_pos"], r["event_id"]) for r in LD.landed_rows(dec).collect())
    assert landed == [(1, 0, 1), (1, 5, 3), (4, 0, None), (5, 0, 1)]
    bad = sorted((r["page_id"], r["item_pos"], r["problem"]) for r in LD.quarantined_items(dec).collect())
    assert bad == [(1, 1, "not an object"), (1, 2, "not an item of the schema"), (1, 3, "not an object"), (1, 4, "not an object"),
                   (2, 0, "not an object"), (3, 0, "not an item of the schema")]
    assert LD.quarantine(dec).count() == 1


def gaps_of(pages, targets):
    out = []
    for feed, target in targets.items():
        held = {p for f, a, n, ok in pages if f == feed and ok and a is not None for p in range(a, a + n)}
        miss = [p for p in range(1, (target or 0) + 1) if p not in held]
        for p in miss:
            if out and out[-1][0] == feed and out[-1][2] == p - 1:
                out[-1][2] = p
            else:
                out.append([feed, p, p])
    return sorted((f, a, b, b - a + 1) for f, a, b in out)


@pytest.mark.parametrize("bucket", [1 << 20, 16, 1])
def test_ranges_against_positions(spark, monkeypatch, bucket):
    monkeypatch.setattr(LD, "BUCKET", bucket)
    rng = random.Random(bucket)
    pages = [(rng.choice(["weather", "tour"]), rng.choice([None, *range(-5, 90)]), rng.randint(0, 9), rng.random() < .8) for _ in range(25)]
    item = {"event_id": 1, "user_id": 2, "event_type": "view", "value": 1.0}
    code = lambda f, ok: ("00" if f == "weather" else "0000") if ok else "99"
    rows = [(i, f, a, 4, body([item] * n, code(f, ok))) for i, (f, a, n, ok) in enumerate(pages)]
    dec = LD.decode_pages(spark.createDataFrame(rows, PAGE), ITEM_SCHEMA)
    targets = {"weather": 80, "tour": 60, "never landed": 5, "nothing": 0, "unknown": None}
    got = LD.landing_gaps_ranges(dec, spark.createDataFrame(list(targets.items()), "feed string, target long"))
    assert sorted(tuple(r) for r in got.collect()) == gaps_of(pages, targets)
    declared = {f: 4 * sum(p[0] == f for p in pages) for f in {p[0] for p in pages}}
    assert sorted(tuple(r) for r in LD.landing_gaps_ranges(dec).collect()) == gaps_of(pages, declared)
    assert LD.landing_gaps_ranges(dec.where(F.lit(False))).count() == 0


def test_one_scan(spark, tmp_dir):
    spark.createDataFrame([(1, "weather", 1, 3, body([]))], PAGE).write.mode("overwrite").parquet(tmp_dir + "/pages")
    out = LD.landing_gaps_ranges(LD.decode_pages(spark.read.parquet(tmp_dir + "/pages"), ITEM_SCHEMA))
    out.collect()
    assert out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("FileScan") == 1
