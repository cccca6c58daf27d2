"""KPIs: CTR / CVR / CTCVR (A1-A4), counts (A5), per-user load (A16), scenario CTR."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from situate.functions.context import context_flags


def ctr_expr(clicked: Column | None = None) -> Column:
    """A1: mean(clicked), 0.0 when empty."""
    clicked = F.col("clicked") if clicked is None else clicked
    return F.coalesce(F.avg(clicked), F.lit(0.0))


def cvr_expr(clicked: Column | None = None, converted: Column | None = None) -> Column:
    """A2: mean(converted | clicked == 1), 0.0 without clicks (conditional aggregate, no second scan)."""
    clicked = F.col("clicked") if clicked is None else clicked
    converted = F.col("converted") if converted is None else converted
    return F.coalesce(F.avg(F.when(clicked == 1, converted)), F.lit(0.0))


def ctcvr_expr(converted: Column | None = None) -> Column:
    """A3."""
    converted = F.col("converted") if converted is None else converted
    return F.coalesce(F.avg(converted), F.lit(0.0))


def kpi_metrics(log: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """A4: ctr, cvr, ctcvr in one aggregate (global: one row; grouped: one row per group)."""
    aggs = [ctr_expr().alias("ctr"), cvr_expr().alias("cvr"), ctcvr_expr().alias("ctcvr")]
    return log.groupBy(*group_by).agg(*aggs) if group_by else log.agg(*aggs)


def _distinct_users(approx_rsd: float | None) -> Column:
    if approx_rsd is None:
        return F.countDistinct("user_id")
    return F.approx_count_distinct("user_id", rsd=approx_rsd)


def log_counts(log: DataFrame, group_by: Sequence[str] = (), approx_rsd: float | None = None) -> DataFrame:
    """A5: impression count and distinct users (0 if no ``user_id`` column).

    Exact by default; ``approx_rsd`` switches to HyperLogLog++ (no shuffle by user at all).
    """
    users = _distinct_users(approx_rsd) if "user_id" in log.columns else F.lit(0).cast("bigint")
    aggs = [F.count("*").alias("impression_count"), users.alias("user_count")]
    return log.groupBy(*group_by).agg(*aggs) if group_by else log.agg(*aggs)


def kpi_summary(log: DataFrame, group_by: Sequence[str] = (), approx_rsd: float | None = None) -> DataFrame:
    """A4 + A5 in one aggregate (one pass over the log): counts, distinct users, CTR, CVR, CTCVR.

    ``approx_rsd`` (e.g. 0.01) counts users with HyperLogLog++ instead of an exact distinct.
    """
    aggs = [F.count("*").alias("impression_count"), _distinct_users(approx_rsd).alias("user_count"),
            ctr_expr().alias("ctr"), cvr_expr().alias("cvr"), ctcvr_expr().alias("ctcvr")]
    return log.groupBy(*group_by).agg(*aggs) if group_by else log.agg(*aggs)


def per_user_load(log: DataFrame) -> DataFrame:
    """Mean impressions per user and distinct users (two-level aggregate)."""
    per_user = log.groupBy("user_id").agg(F.count("*").alias("n"))
    return per_user.agg(F.avg("n").alias("mean_impressions_per_user"), F.count("*").alias("user_count"))


def scenario(flags: Column) -> Column:
    """Context scenario of an impression (the simulator's three target scenarios, else 'other')."""
    wk = flags["is_weekend"]
    return (
        F.when(flags["rainy"] & ~wk, "rain_weekday")
        .when(flags["clear"] & wk, "clear_weekend")
        .when(flags["overcast"] & ~wk, "overcast_weekday")
        .otherwise("other")
    )


def scenario_ctr(enriched: DataFrame) -> DataFrame:
    """CTR by scenario × category group."""
    flags = context_flags(F.col("sky"), F.col("precip"), F.col("is_weekend"))
    return (
        enriched.withColumn("scenario", scenario(flags))
        .groupBy("scenario", "category_group")
        .agg(F.count("*").alias("impressions"), ctr_expr().alias("ctr"))
    )
