"""Quoted CSV in byte ranges: the rows of the multi-line reader, whatever the cuts."""

import os
import random

import pytest
from pyspark.sql import types as T

from situate.sources import files as FS

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType()), T.StructField("x", T.DoubleType())])
TEXTS = ["plain", "two\nlines", 'say "hi"', "a,b", "", None, " blanks ", '"', '""', "\n", "\n\n\n", 'x"\n"y', "é 축제", "tab\t", "long " * 40 + "\n" + "text " * 60]


@pytest.fixture(params=["64", "300", "100000"])
def small_ranges(spark, request):
    keys = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def read_back(rows):
    """The reader's options give an empty text back as null."""
    return sorted((tuple(None if v == "" else v for v in r) for r in rows), key=str)


def test_rows_of_the_reader(spark, small_ranges, tmp_dir):
    rng = random.Random(7)
    rows = [(i, rng.choice(TEXTS), rng.choice(TEXTS), rng.choice([None, 1.5, -2e9])) for i in range(120)]
    path = FS.write_csv(spark.createDataFrame(rows, SCHEMA).coalesce(2), os.path.join(tmp_dir, "csv"))
    got = FS.scan_csv_parallel(spark, path, SCHEMA)
    assert rows_of(got) == rows_of(FS.scan_csv(spark, path, SCHEMA)) == read_back(rows)


def test_one_record_over_many_ranges(spark, small_ranges, tmp_dir):
    rows = [(1, "x", "y", 1.0), (2, 'line "q"\n' * 300, "\n" * 200, None), (3, "z", None, 2.0)]
    path = FS.write_csv(spark.createDataFrame(rows, SCHEMA).coalesce(1), os.path.join(tmp_dir, "csv"))
    assert rows_of(FS.scan_csv_parallel(spark, path, SCHEMA)) == read_back(rows)


def test_other_line_ends_and_broken_rows(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "f.csv"), "wb") as f:
        f.write(b'id,a,b,x\r\n1,p,"q\r\nr",2.5\r\n\r\n2,short\r\nbad,t,u,v\r\n3,"end",,')
    kept = [(i, a, b.replace("\r\n", "\n") if b else b, x) for i, a, b, x in rows_of(FS.scan_csv_parallel(spark, tmp_dir, SCHEMA))]
    assert (1, "p", "q\r\nr", 2.5) in rows_of(FS.scan_csv_parallel(spark, tmp_dir, SCHEMA))  # the reader turns it into \n
    assert kept == rows_of(FS.scan_csv(spark, tmp_dir, SCHEMA))


def test_unclosed_quote_and_empty_files(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "e"))
    with open(os.path.join(tmp_dir, "e", "only_header.csv"), "w") as f:
        f.write("id,a,b,x\n")
    open(os.path.join(tmp_dir, "e", "empty.csv"), "w").close()
    assert FS.scan_csv_parallel(spark, os.path.join(tmp_dir, "e"), SCHEMA).count() == 0
    with open(os.path.join(tmp_dir, "bad.csv"), "w") as f:
        f.write('id,a,b,x\n1,"open,2,3\n4,5,6,7\n')
    with pytest.raises(ValueError, match="bad.csv"):
        FS.scan_csv_parallel(spark, os.path.join(tmp_dir, "bad.csv"), SCHEMA)


def test_one_file_is_read_by_several_tasks(spark, tmp_dir):
    rows = spark.range(60_000).selectExpr("id", "concat('line one\n', repeat('w, \"q\" ', 60)) AS a", "CAST(NULL AS STRING) AS b", "id / 2 AS x").coalesce(1)
    path = FS.write_csv(rows, os.path.join(tmp_dir, "big"))
    df = FS.scan_csv_parallel(spark, path, SCHEMA)
    assert df.rdd.getNumPartitions() >= 4 and FS.scan_csv(spark, path, SCHEMA).rdd.getNumPartitions() == 1
    row = df.selectExpr("count(*)", "count(DISTINCT id)", "min(length(a))", "max(length(a))", "sum(x) = sum(id / 2)").first()
    assert tuple(row) == (60_000, 60_000, 9 + 420, 9 + 420, True)
