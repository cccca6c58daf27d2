"""Enrich the impression log with creative and context features, map segments back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from situate.functions.context import (
    category_group,
    is_clear,
    is_indoor,
    is_outdoor,
    is_rainy,
    parse_context,
)
from situate.operators.joins import spread_left_join

ENRICHED_EXTRA = ("creative_type", "category", "sky", "precip", "is_weekend", "is_outdoor", "is_indoor",
                  "is_clear", "is_rainy")


def enrich_log(log: DataFrame, creative_catalog: DataFrame, strict_json: bool = False,
               extra_columns: tuple[str, ...] = ()) -> DataFrame:
    """``enrich_log_with_features``: log ⟕ catalog(creative_id, creative_type, category) + context flags.

    The context comes from a ``context`` struct column when the log has one, else from the
    ``context_features`` JSON text (X20).

    Only three catalog columns (plus ``extra_columns``) cross the join, which keeps popular and null ids
    off the shuffle (:func:`situate.operators.joins.spread_left_join`).
    """
    cat = creative_catalog.select("creative_id", "creative_type", "category", *extra_columns)
    j = spread_left_join(log, cat, "creative_id")
    # a typed ``context`` struct is used as is; JSON text is parsed once (pruned to the fields read)
    ctx = F.col("context") if "context" in log.columns else parse_context(F.col("context_features"), strict=strict_json)
    j = j.withColumn("__ctx", ctx)
    sky, precip = F.col("__ctx.sky"), F.col("__ctx.precip")
    return (
        j.withColumn("sky", sky)
        .withColumn("precip", precip)
        .withColumn("is_weekend", F.coalesce(F.col("__ctx.weekend"), F.lit(0)).cast("int"))
        .withColumn("is_outdoor", is_outdoor(F.col("category")))
        .withColumn("is_indoor", is_indoor(F.col("category")))
        .withColumn("is_clear", is_clear(sky, precip))
        .withColumn("is_rainy", is_rainy(precip))
        .withColumn("category_group", category_group(F.col("category")))
        .drop("__ctx")
    )


def apply_user_segments(log: DataFrame, segmented_users: DataFrame) -> DataFrame:
    """Replace ``user_segment`` by the user's segment (left join on ``user_id``); null users have none."""
    return spread_left_join(log.drop("user_segment"), segmented_users.select("user_id", "user_segment"), "user_id")
