"""Landed JSON arrays in byte ranges: whatever the layout and the cuts, the records of json.loads."""

import json
import os
import random

import pytest
from pyspark.sql import types as T

from situate.sources import files as FS

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType())),
                       T.StructField("inner", T.StructType([T.StructField("x", T.DoubleType())])), T.StructField("ordinal", T.LongType())])
TRICKY = ["plain", "} ] {", '"quoted" \\"', "\\", "\\\\", "é 축제 \U0001f600", "line\nbreak", "}", "", "{[", 'a\\"}', "\\\\\"}"]


def landed(tmp_dir, texts):
    for k, text in enumerate(texts):
        with open(os.path.join(tmp_dir, f"f{k:03d}.json"), "wb") as f:
            f.write(text if isinstance(text, bytes) else text.encode())
    return tmp_dir


def records(rng, n):
    return [{"id": i, "name": rng.choice(TRICKY), "tags": [rng.choice(TRICKY) for _ in range(rng.randint(0, 3))], "inner": rng.choice([None, {"x": 1.5}])} for i in range(n)]


@pytest.fixture()
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def as_dict(r):
    return {"id": r["id"], "name": r["name"], "tags": r["tags"], "inner": r["inner"].asDict() if r["inner"] else None}


@pytest.mark.parametrize("layout", [{}, {"indent": 2}, {"ensure_ascii": False}, {"separators": (",", ":")}, {"indent": 1, "ensure_ascii": False}])
def test_ranges_give_the_records_of_the_file(spark, small_ranges, tmp_dir, layout):
    rng = random.Random(str(layout))
    lists = [records(rng, n) for n in (60, 0, 1, 25)]
    path = landed(tmp_dir, [json.dumps(x, **layout) for x in lists])
    df = FS.scan_raw_json(spark, path, SCHEMA)
    got = sorted(df.collect(), key=lambda r: r["ordinal"])
    assert df.rdd.getNumPartitions() > 4
    assert [as_dict(r) for r in got] == [x for part in lists for x in part]
    assert [r["ordinal"] for r in got] == [(k << 32) + i for k, part in enumerate(lists) for i in range(len(part))]


def test_one_large_record_over_many_ranges(spark, small_ranges, tmp_dir):
    rows = [{"id": 1, "name": "x} " * 2000, "tags": ["}"] * 500, "inner": None}, {"id": 2, "name": "y", "tags": [], "inner": {"x": 0.5}}]
    got = FS.scan_raw_json(spark, landed(tmp_dir, [json.dumps(rows, indent=1)]), SCHEMA).collect()
    assert sorted((as_dict(r) for r in got), key=lambda r: r["id"]) == rows


BROKEN = {"cut in a record": '[{"id": 1}, {"id": 2', "cut after a brace": '[{"id": 1}', "cut in a string": '[{"id": 1, "name": "x', "object": '{"id": 1}', "no bytes": "",
          "number": "12", "blank": "  \n", "extra brace": '[{"id": 1}]}', "two arrays": '[{"id": 1}][', "closed twice": '[{"id": 1}]]'}


@pytest.mark.parametrize("case", BROKEN)
def test_a_broken_file_raises(spark, tmp_dir, case):
    path = landed(tmp_dir, ['[{"id": 5}]', BROKEN[case]])
    with pytest.raises(ValueError, match="f001"):
        FS.scan_raw_json(spark, path, SCHEMA)
    assert [r["id"] for r in FS.scan_raw_json(spark, path, SCHEMA, errors="quarantine").collect()] == [5]
    q = FS.quarantined_records(spark, path, SCHEMA).collect()
    assert any(r["record"] == -1 and r["file"].endswith("f001.json") for r in q) and all(r["file"].endswith("f001.json") for r in q)


CORRUPT = {"mistyped": '[{"id": 1}, {"id": "x"}, {"id": 3}]', "not an object": '[{"id": 1}, 7, {"id": 3}]', "missing comma": '[{"id": 1} {"id": 2}, {"id": 3}]',
           "bad json": '[{"id": 1}, {"id": }, {"id": 3}]', "comma at the end": '[{"id": 1}, {"id": 3},]', "two commas": '[{"id": 1},, {"id": 2}, {"id": 3}]'}


@pytest.mark.parametrize("case", CORRUPT)
def test_a_corrupt_record_stands_alone(spark, tmp_dir, case):
    path = landed(tmp_dir, [CORRUPT[case]])
    with pytest.raises(Exception, match="record 1|record 2"):
        FS.scan_raw_json(spark, path, SCHEMA).collect()
    good = sorted(r["id"] for r in FS.scan_raw_json(spark, path, SCHEMA, errors="quarantine").collect())
    assert good == ([1] if case == "not an object" else [1, 3])
    assert [r["problem"] is not None and r["text"] is not None for r in FS.quarantined_records(spark, path, SCHEMA).collect()] == [True]


def test_byte_order_mark_and_blanks(spark, tmp_dir):
    path = landed(tmp_dir, [b"\xef\xbb\xbf [ {\"id\": 1} , {\"id\": 2} ] \n", b"\n[\n]\n", b"\xef\xbb\xbf[]"])
    assert sorted(r["id"] for r in FS.scan_raw_json(spark, path, SCHEMA).collect()) == [1, 2]


def test_a_large_file_is_read_by_several_tasks(spark, tmp_dir):
    """100 MB in one file."""
    row = json.dumps({"id": 7, "name": "n" * 960, "tags": ["}"], "inner": None})
    n = 100_000
    with open(os.path.join(tmp_dir, "big.json"), "w") as f:
        f.write("[" + ", ".join([row] * n) + "]")
    df = FS.scan_raw_json(spark, tmp_dir, SCHEMA)
    assert os.path.getsize(os.path.join(tmp_dir, "big.json")) > 100e6 and df.rdd.getNumPartitions() >= 4
    row = df.selectExpr("count(*) AS n", "count(DISTINCT ordinal) AS d", "max(ordinal) AS m", "min(length(name)) AS l").first()
    assert tuple(row) == (n, n, n - 1, 960)


def test_texts_are_parsed_once_and_not_shuffled(spark, tmp_dir):
    path = landed(tmp_dir, [json.dumps(records(random.Random(k), 3)) for k in range(4)])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = FS.scan_raw_json(spark, path, SCHEMA)
        plan = df._jdf.queryExecution()
        assert plan.optimizedPlan().toString().count("from_json(") == 1
        assert "SortMergeJoin" not in plan.executedPlan().toString()
        assert sorted(r["ordinal"] for r in df.collect()) == [(k << 32) + i for k in range(4) for i in range(3)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_landed_files_keep_the_order_of_their_blocks(spark, tmp_dir):
    """More files than a folder holds, and repeated keys."""
    from situate.plans import queries as Q

    keys = [k * Q.RAW_FILE_ROWS for k in range(2 * Q.RAW_FOLDER_FILES + 5)] + [3, 3]
    rows = [(k, 1, "O", 1.0, None, "1-URGENT") for k in keys]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{tmp_dir}/orders.parquet")
    got = {r["ordinal"]: r["TITLE"] for r in Q.q_scan_raw_array(spark, tmp_dir).collect()}
    files = len(keys) - 2
    assert got == {**{k << 32: f"event {k * Q.RAW_FILE_ROWS}" for k in range(files)}, 1: "event 3", 2: "event 3"}
