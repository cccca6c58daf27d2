"""Row-shape operators: schema conformance, keep-first dedupe, sequential keys, row caps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from situate.session import materialize


def conform_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add missing columns as typed nulls and select the fixed column list in order."""
    cols = []
    present = set(df.columns)
    for f in schema.fields:
        if f.name in present:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in ``order``, all columns. Null keys form their own group.

    A window with row limit 1: each task keeps one row a key before the shuffle (``WindowGroupLimit``), so a hot key
    reaches its task as one row from each task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__first", F.row_number().over(w)).where(F.col("__first") == 1).drop("__first")


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row per key in ``order`` (``drop_duplicates(keep='first')``).

    Null keys form their own group, as in pandas; a null order value comes last."""
    if not [c for c in df.columns if c not in keys]:
        return df.select(*keys).distinct()
    return first_rows(df, keys, [(F.col(o) if isinstance(o, str) else o).asc_nulls_last() for o in order])


def sequential_index(df: DataFrame, order: Sequence[str], name: str = "seq") -> DataFrame:
    """0-based position of each row in ``order`` without a single-partition window, carried by the row itself.

    Range-partition on the order, number rows inside each partition, and add the
    running count of the preceding partitions (a table of one row per partition,
    so its broadcast is bounded by the partition count). Nulls come last, equal rows in the order of the
    input: that place is part of the range, so many equal or null values still spread over tasks.
    """
    ordered = [*[F.col(c).asc_nulls_last() for c in order], F.col("__place")]
    placed = df.withColumn("__place", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange(*ordered).sortWithinPartitions(*ordered).drop("__place")
    # written once, so that the counts and the numbered rows see the same partitions
    tagged = materialize(ranged.withColumn("__mid", F.monotonically_increasing_id()))
    tagged = tagged.withColumn("__part", F.shiftright("__mid", 33))
    counts = tagged.groupBy("__part").agg(F.count("*").alias("__n"))
    w = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    out = tagged.join(offsets, "__part")
    local = F.col("__mid") - F.shiftleft(F.col("__part"), 33)
    return out.withColumn(name, F.col("__off") + local).drop("__mid", "__part", "__off")


def limit_rows(df: DataFrame, n: int | None, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows by ingest order (the reference's ``--limit``); None keeps all."""
    if n is None:
        return df
    return df.orderBy(*order).limit(n)
