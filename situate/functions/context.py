"""Context/content flags, the impression context JSON and transaction items."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from situate.functions.lookups import INDOOR_KEYWORDS, OUTDOOR_KEYWORDS, contains_any

CONTEXT_SCHEMA = T.StructType([
    T.StructField("sky", T.StringType()),
    T.StructField("temp", T.DoubleType()),
    T.StructField("precip", T.StringType()),
    T.StructField("weekend", T.IntegerType()),
])

# transaction dimensions, in the order that fixes the grouping_id bits of the cube
ITEM_PREFIXES = ("sky_", "precip_", "weekend_", "type_", "category_group_")
CONTEXT_PREFIXES = ITEM_PREFIXES[:3]
CONTENT_PREFIXES = ITEM_PREFIXES[3:]
MISSING_ITEM_VALUE = "nan"


def is_outdoor(category: Column) -> Column:
    """any outdoor keyword in the category text; null → False."""
    return contains_any(category, OUTDOOR_KEYWORDS)


def is_indoor(category: Column) -> Column:
    return contains_any(category, INDOOR_KEYWORDS)


def category_group(category: Column) -> Column:
    """Outdoor wins over indoor, else other."""
    return F.when(is_outdoor(category), "outdoor").when(is_indoor(category), "indoor").otherwise("other")


def is_rainy(precip: Column) -> Column:
    """not null and not in {'none', ''}."""
    return F.coalesce(~precip.isin("none", ""), F.lit(False))


def is_overcast_sky(sky: Column) -> Column:
    """F4."""
    return F.coalesce(sky.isin("overcast", "cloudy"), F.lit(False))


def is_clear(sky: Column, precip: Column) -> Column:
    """sky == 'clear' and not rainy."""
    return F.coalesce(sky == "clear", F.lit(False)) & ~is_rainy(precip)


def context_flags(sky: Column, precip: Column, weekend: Column) -> Column:
    """struct(is_weekend, rainy, clear, overcast); overcast excludes rainy contexts."""
    rainy = is_rainy(precip)
    return F.struct(
        F.coalesce(weekend.cast("boolean"), F.lit(False)).alias("is_weekend"),
        rainy.alias("rainy"),
        is_clear(sky, precip).alias("clear"),
        (is_overcast_sky(sky) & ~rainy).alias("overcast"),
    )


def parse_context(json_text: Column, strict: bool = False) -> Column:
    """JSON text → struct<sky,temp,precip,weekend>. null → all-null struct.

    PERMISSIVE by default (broken JSON → null fields); ``strict=True`` fails the job like ``json.loads``.
    The struct is returned as parsed, so Catalyst can prune it to the fields a query reads
    (one parse per row); use :func:`clean_temp` where a ``NaN`` temperature must become null.
    """
    opts = {"mode": "FAILFAST"} if strict else {}
    return F.from_json(json_text, CONTEXT_SCHEMA, opts)


def clean_temp(temp: Column) -> Column:
    """``NaN`` temperature (accepted by the JSON reader) → null."""
    return F.when(~F.isnan(temp), temp)


def encode_context(sky: Column, temp: Column, precip: Column, weekend: Column) -> Column:
    """Context → compact JSON with explicit nulls."""
    return F.to_json(
        F.struct(sky.alias("sky"), temp.cast("double").alias("temp"), precip.alias("precip"),
                 weekend.cast("int").alias("weekend")),
        {"ignoreNullFields": "false"},
    )


def item_values(sky: Column, precip: Column, weekend: Column, creative_type: Column, category: Column):
    """The five single-valued transaction dimensions (value part only, nulls spelled 'nan')."""
    return [
        F.coalesce(sky.cast("string"), F.lit(MISSING_ITEM_VALUE)),
        F.coalesce(precip.cast("string"), F.lit(MISSING_ITEM_VALUE)),
        F.coalesce(weekend.cast("int"), F.lit(0)).cast("string"),
        F.coalesce(creative_type.cast("string"), F.lit(MISSING_ITEM_VALUE)),
        category_group(category),
    ]


def impression_items(sky: Column, precip: Column, weekend: Column, creative_type: Column,
                     category: Column) -> Column:
    """Array of 5 items ``sky_ precip_ weekend_ type_ category_group_``."""
    values = item_values(sky, precip, weekend, creative_type, category)
    return F.array(*[F.concat(F.lit(p), v) for p, v in zip(ITEM_PREFIXES, values)])
