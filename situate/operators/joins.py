"""Join helpers: one-row attach, and left joins that hold when few keys have most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: ids that a key sketch may report, counters it may hold, and rows of the other side they may bring along
HOT_IDS, TRACKED, HOT_ROWS = 1000, 20_000, 100_000


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row DataFrame (a global aggregate) to every row.

    The one-row side is broadcast; Spark may plan it as a nested loop over that single row.
    """
    key = "__one"
    return df.withColumn(key, F.lit(0)).join(F.broadcast(one_row.withColumn(key, F.lit(0))), key).drop(key)


def merge_rows(*parts: DataFrame) -> DataFrame:
    """One row of the columns of several one-row DataFrames (names differ), without a join: their union, then
    the value of each column that a part has. At most one row a part meets in one task."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part, allowMissingColumns=True)
    return every.agg(*[F.first(f"`{c}`", ignorenulls=True).alias(c) for c in every.columns])


def small_enough(df: DataFrame) -> bool:
    """Whether Spark's own size estimate lets it broadcast ``df``: then a join shuffles nothing."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def heavy_keys(df: DataFrame, key: str, share: float) -> tuple[list, bool]:
    """(ids that may hold more than ``share`` of the rows, whether null ids do).

    One scan of the key column: a sketch of TRACKED counters in each task, merged by Spark. The sketch may
    report an id too many, never miss one above 1 / TRACKED of the rows."""
    row = df.agg(F.count("*").alias("n"), F.count_if(F.col(key).isNull()).alias("none"),
                 F.expr(f"approx_top_k(`{key}`, {HOT_IDS}, {TRACKED})").alias("top")).first()
    least = max(1, share * row["n"])
    return [e["item"] for e in row["top"] or [] if e["item"] is not None and e["count"] > least], row["none"] > least


def spread_left_join(left: DataFrame, right: DataFrame, key: str, share: float | None = None) -> DataFrame:
    """``left`` ⟕ ``right`` on ``key``; no task gets a popular id's rows, or all rows without an id.

    When Spark can broadcast ``right``, that is all: nothing is shuffled. Else a sketch finds the ids with more than ``share``
    of the rows (default: a shuffle partition's part). Their few rows of ``right`` are counted, then broadcast;
    rows of ``left`` with these ids and with a null id never leave their task. The rest is joined by
    shuffle. Only ``left``'s key is read beside the columns that the query uses."""
    if small_enough(right):
        return left.join(right, key, "left")
    spark = left.sparkSession
    ids, none = heavy_keys(left, key, share or 1 / int(spark.conf.get("spark.sql.shuffle.partitions")))
    if not ids and not none:
        return left.join(right, key, "left")
    id_ = F.col(key)
    few = right.where(id_.isin(ids)) if ids else right.where(F.lit(False))
    if few.limit(HOT_ROWS + 1).count() > HOT_ROWS:  # ids repeat on the other side: these joins stay with the shuffle
        ids, few = [], right.where(F.lit(False))
    beside = id_.isNull() | id_.isin(ids) if ids else id_.isNull()
    near = left.where(beside).join(F.broadcast(few), key, "left")
    return near.unionByName(left.where(~beside).join(right, key, "left"))
