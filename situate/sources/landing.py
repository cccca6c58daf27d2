"""Landed API pages (S9 decode, S10 completeness)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: positions of a feed that one task sweeps
BUCKET = 1 << 20

# ---- fixed values: envelope paths and success codes of the three feeds -------
ENVELOPES = {
    "cultural_event": {"code": "$.culturalEventInfo.RESULT.CODE", "items": "$.culturalEventInfo.row",
                    "total": "$.culturalEventInfo.list_total_count", "ok": "INFO-000"},
    "tour": {"code": "$.response.header.resultCode", "items": "$.response.body.items.item",
             "total": "$.response.body.totalCount", "ok": "0000"},
    "weather": {"code": "$.response.header.resultCode", "items": "$.response.body.items.item",
                "total": "$.response.body.totalCount", "ok": "00"},
}
# ------------------------------------------------------------------------------


def _by_feed(feed: Column, key: str, body: Column) -> Column:
    expr = None
    for name, env in ENVELOPES.items():
        v = F.get_json_object(body, env[key]) if key != "ok" else F.lit(env["ok"])
        expr = F.when(feed == name, v) if expr is None else expr.when(feed == name, v)
    return expr


CORRUPT = "_corrupt"


def decode_pages(pages: DataFrame, item_schema: T.StructType) -> DataFrame:
    """Per page, pick the envelope of its feed, check the result code, and normalise the
    item (null → no rows, one object → one row, list → rows). Returns pages with ``ok``,
    ``result_code``, ``total`` and ``items``: (problem, text, item), ``problem`` null where an item is an object of the schema.
    A list that doesn't parse is one item with a problem."""
    body, feed = F.col("body"), F.col("feed")
    # one projection extracts code, item text and total (each page body is read once per path);
    # the next one tests the code and parses the items, referring to those columns
    staged = pages.select("*", _by_feed(feed, "code", body).alias("result_code"),
                          _by_feed(feed, "items", body).alias("__raw"),
                          _by_feed(feed, "total", body).try_cast("bigint").alias("total"))
    raw = F.col("__raw")
    texts = (
        F.when(raw.isNull() | (py_trim(raw) == ""), F.array().cast("array<string>"))
        .when(py_trim(raw).startswith("["), F.coalesce(F.from_json(raw, T.ArrayType(T.StringType())), F.array(raw)))
        .otherwise(F.array(raw))
    )
    flat = T.StructType([*item_schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}

    def checked(text: Column) -> Column:
        row = F.from_json(text, flat, options)
        problem = F.when(~F.coalesce(py_trim(text).startswith("{"), F.lit(False)), "not an object").when(row[CORRUPT].isNotNull(), "not an item of the schema")
        return F.struct(problem.alias("problem"), text.alias("text"), row.dropFields(CORRUPT).alias("item"))

    return staged.select(
        *pages.columns, "result_code",
        (F.col("result_code") == _by_feed(feed, "ok", body)).alias("ok"),
        "total",
        F.transform(texts, checked).alias("items"),
    )


def py_trim(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _items(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("ok")).select("page_id", "feed", F.posexplode("items").alias("item_pos", "__i"))


def landed_rows(decoded: DataFrame) -> DataFrame:
    """Sound items of the successful pages, a row each (``item_pos``: the place in the page, bad items counted)."""
    return _items(decoded).where("__i.problem is null").select("page_id", "feed", "item_pos", "__i.item.*")


def quarantined_items(decoded: DataFrame) -> DataFrame:
    """(page_id, feed, item_pos, problem, text) of items on successful pages that are no object of the schema."""
    return _items(decoded).where("__i.problem is not null").select("page_id", "feed", "item_pos", "__i.problem", "__i.text")


def quarantine(decoded: DataFrame) -> DataFrame:
    """Pages with a failing result code, kept aside instead of failing the job."""
    return decoded.where(~F.coalesce(F.col("ok"), F.lit(False))).select("page_id", "feed", "result_code")


def landing_gaps(decoded: DataFrame, page_size: int, targets: DataFrame) -> DataFrame:
    """Compare landed pages with the paging plan of each feed.

    ``targets`` holds (feed, target): the plan is the ranges ``[s, min(s + page_size - 1, target)]``
    for ``s`` in 1, 1 + page_size, ... Ranges without a successful page are ``missing``;
    landed pages with fewer items than their range are ``short`` (no item list counts as no items).
    A feed with nothing to land (target below 1 or null) has no ranges.
    """
    plan = targets.where("target >= 1").select("feed", "target", F.explode(F.sequence(F.lit(1), F.col("target"), F.lit(page_size))).alias("start_index"))
    plan = plan.withColumn("end_index", F.least(F.col("start_index") + page_size - 1, F.col("target")))
    landed = decoded.where(F.col("ok")).select("feed", "start_index", F.greatest(F.coalesce(F.size("items"), F.lit(0)), F.lit(0)).alias("n_items"))
    missing = plan.join(landed, ["feed", "start_index"], "left_anti").select(
        "feed", "start_index", "end_index", F.lit("missing").alias("status"), F.lit(0).alias("n_items"))
    short = plan.join(landed, ["feed", "start_index"], "inner").where(
        F.col("n_items") < F.col("end_index") - F.col("start_index") + 1).select(
        "feed", "start_index", "end_index", F.lit("short").alias("status"), "n_items")
    return missing.unionByName(short)


def landing_gaps_ranges(decoded: DataFrame, targets: DataFrame | None = None, declared: str = "declared_rows") -> DataFrame:
    """S10 without a paging plan: the positions of a feed that no landed page covers, as (feed, first, last, n_missing).

    A successful page of n items covers [start_index, start_index + n - 1], wherever it starts: shifted, partial, repeated
    and overlapping pages count for what they hold. What is expected is [1, target]: the feed's row of ``targets``
    (feed, target), or else the sum of ``declared`` over all its pages, taken in the same pass; with ``declared`` a feed without pages is not known.

    One scan, a gaps-and-islands sweep in two levels: pages are merged to islands within BUCKET positions of a feed, so
    a feed is swept by many tasks; only islands meet in the sweep of the feed. A page without items or a start covers
    nothing, positions outside [1, target] are ignored, a target below 1 or null expects nothing."""
    pages = decoded.select("feed", F.col("start_index").cast("long").alias("a"), F.when(F.col("ok"), F.size("items")).otherwise(0).cast("long").alias("n"),
                           (F.col(declared).cast("long") if targets is None else F.lit(0).cast("long")).alias("declared"))
    covers = F.coalesce((F.col("n") > 0) & (F.col("a") + F.col("n") > 1), F.lit(False))
    pages = pages.select("feed", F.when(covers, F.greatest("a", F.lit(1))).alias("first"), F.when(covers, F.col("a") + F.col("n") - 1).alias("last"), "declared")
    pages = pages.withColumn("bucket", F.coalesce(F.expr(f"first div {BUCKET}"), F.lit(-1)))

    def islands(rows: DataFrame, keys: list[str]) -> DataFrame:
        """Ranges of ``keys`` that touch or overlap as one; rows without a range stay together."""
        order = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("first"), "last")
        reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
        fresh = rows.withColumn("reach", reach).withColumn("fresh", (F.col("first").isNotNull() & (F.col("reach").isNull() | (F.col("first") > F.col("reach") + 1))).cast("int"))
        return fresh.withColumn("island", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))

    near = islands(pages, ["feed", "bucket"]).groupBy("feed", "bucket", "island").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("declared").alias("declared"))
    feed = Window.partitionBy("feed")
    if targets is None:
        known = near.withColumn("target", F.sum("declared").over(feed))
    else:  # every expected feed, landed or not
        known = targets.select("feed", F.col("target").cast("long").alias("target")).join(near, "feed", "left")
    order = feed.orderBy(F.asc_nulls_first("first"), "last")
    swept = known.withColumn("before", F.coalesce(F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    swept = swept.withColumn("final", F.row_number().over(order) == F.count("*").over(feed))
    swept = swept.withColumn("covered", F.greatest("before", F.coalesce("last", F.lit(0))))
    gaps = F.array(F.when(F.col("first").isNotNull(), F.struct((F.col("before") + 1).alias("first"), F.least(F.col("first") - 1, F.col("target")).alias("last"))),
                   F.when(F.col("final"), F.struct((F.col("covered") + 1).alias("first"), F.col("target").alias("last"))))
    out = swept.select("feed", F.explode(gaps).alias("g")).where("g.first <= g.last").select("feed", "g.first", "g.last")
    return out.withColumn("n_missing", F.col("last") - F.col("first") + 1)
