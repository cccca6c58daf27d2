"""Sources and sinks (S1-S11) and the streaming ingest."""

import json
import os

import pytest
from pyspark.sql import functions as F

from situate import schemas
from situate.operators.enrich import enrich_log
from situate.plans import cleaning as CL
from situate.sources import files as FS
from situate.sources import landing as LD
from situate.sources import adapters as A
from situate.plans.queries import ITEM_SCHEMA
from situate.streaming.ingest import start_clean_stream
from conftest import SF001


def test_raw_json_array_and_object(spark, tmp_dir):
    good = os.path.join(tmp_dir, "good.json")
    with open(good, "w", encoding="utf-8") as f:
        json.dump([{"TITLE": "a", "DATE": "2026-06-01"}, {"TITLE": "b", "USE_FEE": "무료"}], f, ensure_ascii=False)
    df = FS.scan_raw_json(spark, good, schemas.RAW_EVENT)
    assert sorted(r.TITLE for r in df.collect()) == ["a", "b"]
    bad = os.path.join(tmp_dir, "bad.json")
    with open(bad, "w", encoding="utf-8") as f:
        json.dump({"TITLE": "a"}, f)
    with pytest.raises(ValueError):
        FS.scan_raw_json(spark, bad, schemas.RAW_EVENT)


def test_csv_round_trip_keeps_json_quotes_newlines(spark, tmp_dir):
    rows = [("1", '{"sky": "clear", "temp": 25.0, "precip": "none", "weekend": 1}', 'say "hi",\nthere', ""),
            ("2", None, "plain", None)]
    df = spark.createDataFrame(rows, "id string, ctx string, note string, empty string")
    path = os.path.join(tmp_dir, "rt")
    FS.write_csv(df, path)
    back = FS.scan_csv(spark, path, df.schema).orderBy("id").collect()
    assert back[0].ctx == rows[0][1] and back[0].note == rows[0][2]
    assert back[1].ctx is None


def test_latest_snapshot_by_prefix(spark, tmp_dir):
    FS.sink_snapshot(spark.range(3), tmp_dir, "synthetic_log")
    FS.sink_snapshot(spark.range(5), tmp_dir, "synthetic_log")
    FS.sink_snapshot(spark.range(7), tmp_dir, "creatives")
    latest = FS.latest_snapshot(spark, tmp_dir, "synthetic_log")
    assert "synthetic_log_" in latest and spark.read.parquet(latest).count() == 5
    with pytest.raises(FileNotFoundError):
        FS.latest_snapshot(spark, tmp_dir, "context")


def _page(spark, feed, body):
    return spark.createDataFrame([(1, feed, 1, 1, body)], "page_id long, feed string, start_index long, "
                                                         "declared_rows long, body string")


def test_envelopes(spark):
    item = {"event_id": 1, "user_id": 2, "event_type": "view", "value": 1.5}
    cases = [
        ("cultural_event", {"culturalEventInfo": {"RESULT": {"CODE": "INFO-000"}, "row": [item, item]}}, 2, True),
        ("tour", {"response": {"header": {"resultCode": "0000"}, "body": {"items": {"item": item}}}}, 1, True),
        ("weather", {"response": {"header": {"resultCode": "00"}, "body": {"items": ""}}}, 0, True),
        ("weather", {"response": {"header": {"resultCode": "03"}, "body": {"items": {"item": [item]}}}}, 0, False),
    ]
    for feed, body, n, ok in cases:
        dec = LD.decode_pages(_page(spark, feed, json.dumps(body)), ITEM_SCHEMA)
        assert dec.first().ok == ok
        assert LD.landed_rows(dec).count() == n
        assert LD.quarantine(dec).count() == (0 if ok else 1)


def test_stream_matches_batch(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    FS.sink_json(A.v_raw_event(spark, SF001), landing)
    q = start_clean_stream(spark, "cultural_event", landing, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"))
    q.awaitTermination()
    streamed = spark.read.parquet(os.path.join(tmp_dir, "out"))
    batch = CL.transform_events(A.v_raw_event(spark, SF001))
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0
    assert streamed.count() == batch.count()


def test_parse_json_context_path(spark):
    log = A.v_log(spark, SF001)
    typed = enrich_log(log, A.v_creative(spark, SF001)).select("impression_id", "sky", "precip", "is_weekend")
    text = enrich_log(log.drop("context"), A.v_creative(spark, SF001)).select("impression_id", "sky", "precip", "is_weekend")
    assert typed.exceptAll(text).count() == 0


def test_tour_stream_matches_batch(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing_tour")
    FS.sink_json(A.v_raw_tour(spark, SF001), landing)
    q = start_clean_stream(spark, "tour", landing, os.path.join(tmp_dir, "out_t"), os.path.join(tmp_dir, "ck_t"))
    q.awaitTermination()
    streamed = spark.read.parquet(os.path.join(tmp_dir, "out_t"))
    batch = CL.transform_tour(A.v_raw_tour(spark, SF001))
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_snapshot_names_never_collide(spark, tmp_dir):
    import datetime as dt

    when = dt.datetime(2026, 6, 3, 5, 0, 0, tzinfo=dt.UTC)
    a = FS.sink_snapshot(spark.range(1), tmp_dir, "creatives", when=when)
    b = FS.sink_snapshot(spark.range(2), tmp_dir, "creatives", when=when)
    assert a.endswith("creatives_20260603_050000") and b.endswith("creatives_20260603_050000_1")
    assert spark.read.parquet(a).count() == 1 and spark.read.parquet(b).count() == 2


def test_landing_gaps_missing_and_short(spark):
    item = {"event_id": 1, "user_id": 2, "event_type": "view", "value": 1.0}
    ok = lambda n: json.dumps({"response": {"header": {"resultCode": "00"}, "body": {"items": {"item": [item] * n}}}})
    bad = json.dumps({"response": {"header": {"resultCode": "99"}, "body": {"items": ""}}})
    pages = spark.createDataFrame(
        [(1, "weather", 1, 3, ok(3)), (2, "weather", 4, 3, bad), (3, "weather", 7, 3, ok(1))],
        "page_id long, feed string, start_index long, declared_rows long, body string")
    dec = LD.decode_pages(pages, ITEM_SCHEMA)
    targets = spark.createDataFrame([("weather", 9)], "feed string, target long")
    gaps = {(r.start_index, r.end_index, r.status, r.n_items) for r in LD.landing_gaps(dec, 3, targets).collect()}
    assert gaps == {(4, 6, "missing", 0), (7, 9, "short", 1)}


def test_raw_json_directory_of_arrays(spark, tmp_dir):
    d = os.path.join(tmp_dir, "landed")
    os.makedirs(d)
    for i in range(3):
        with open(os.path.join(d, f"page_{i}.json"), "w", encoding="utf-8") as f:
            f.write("\n  " + json.dumps([{"TITLE": f"t{i}_{j}"} for j in range(i + 1)]))
    assert FS.scan_raw_json(spark, d, schemas.RAW_EVENT).count() == 6
    with open(os.path.join(d, "page_bad.json"), "w", encoding="utf-8") as f:
        f.write('{"TITLE": "x"}')
    with pytest.raises(ValueError):
        FS.scan_raw_json(spark, d, schemas.RAW_EVENT)


def test_zero_weight_never_chosen(spark):
    from situate.operators.sampling import weighted_choice

    df = spark.createDataFrame([(1, 1, 0.0), (1, 2, 1.0), (2, 3, 0.0)], "k int, rid int, w double")
    got = {r.k: r.rid for r in weighted_choice(df, ["k"], F.col("w"), ["rid"]).collect()}
    assert got == {1: 2, 2: None}  # no positive weight: the key stays, without a pick
