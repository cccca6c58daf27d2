"""Row operators: sequential keys, keep-first dedupe, weighted choice."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from situate.operators.rows import conform_schema, dedupe_first, sequential_index
from situate.operators.sampling import weighted_choice
from situate import schemas


def test_sequential_index_equals_row_number(spark):
    df = spark.range(0, 5000, 3, numPartitions=7).withColumn("ordinal", (F.col("id") * 7919) % 100003)
    got = {r.ordinal: r.seq for r in sequential_index(df, ["ordinal"]).collect()}
    want = {r.ordinal: r.rn - 1 for r in df.select("ordinal", F.row_number().over(Window.orderBy("ordinal")).alias("rn")).collect()}
    assert got == want


def test_dedupe_first(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 5, "only"), (None, 1, "n1"), (None, 0, "n0")],
                               "k string, ord int, v string")
    got = {r.k: r.v for r in dedupe_first(df, ["k"], ["ord"]).collect()}
    assert got == {"a": "early", "b": "only", None: "n0"}


def test_dedupe_first_with_null_order_and_many_types(spark):
    """A null order value comes last, rows of one key are never lost."""
    df = spark.createDataFrame([("a", None, "x", [1]), ("a", 2, "y", [2]), ("b", None, "z", None)], "k string, ord int, v string, w array<int>")
    assert {r.k: (r.v, r.w) for r in dedupe_first(df, ["k"], ["ord"]).collect()} == {"a": ("y", [2]), "b": ("z", None)}
    assert dedupe_first(df, ["k"], ["ord"]).columns == df.columns and dedupe_first(df.where("false"), ["k"], ["ord"]).count() == 0


def test_conform_schema(spark):
    df = spark.createDataFrame([("1", "t")], "contentid string, title string")
    out = conform_schema(df, schemas.RAW_TOUR)
    assert out.columns == [f.name for f in schemas.RAW_TOUR.fields]
    assert out.first().addr1 is None


def test_weighted_choice_deterministic_and_proportional(spark):
    df = spark.range(40000).select((F.col("id") % 4).alias("key"), F.col("id").alias("rid"),
                                   F.when(F.col("id") % 2 == 0, 3.0).otherwise(1.0).alias("w"))
    a = {r.key: r.rid for r in weighted_choice(df, ["key"], F.col("w"), ["rid"]).collect()}
    b = {r.key: r.rid for r in weighted_choice(df.repartition(13), ["key"], F.col("w"), ["rid"]).collect()}
    assert a == b
    # many groups: heavy rows (weight 3) should win about 3/4 of the time
    g = spark.range(40000).select((F.col("id") / 4).cast("long").alias("key"), F.col("id").alias("rid"),
                                  F.when(F.col("id") % 4 == 0, 3.0).otherwise(1.0).alias("w"))
    picks = weighted_choice(g, ["key"], F.col("w"), ["rid"])
    share = picks.where(F.col("rid") % 4 == 0).count() / picks.count()
    assert 0.45 < share < 0.55  # 3 / (3 + 1 + 1 + 1) = 0.5
