"""Clean the three raw feeds (3.1) and build the creative and context catalogs (3.2).

All steps are per-row column expressions except the forecast pivot (one aggregate on
the four forecast keys) and the keep-first dedupes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from situate import schemas
from situate.functions.dates import (
    DATE_RANGE_PATTERN,
    SINGLE_DATE_PATTERN,
    date_from_text,
    duration_days,
    loose_date_text,
    season_of,
    weekday_name,
)
from situate.functions.lookups import (
    CONTENT_TYPE_NAMES,
    DISTRICT_NAMES,
    FORECAST_CATEGORIES,
    PRECIPITATION_TYPE_NAMES,
    SKY_STATUS_NAMES,
    map_lookup,
)
from situate.functions.text import coerce_double, coerce_int, has_text, infer_is_free, join_address, py_strip
from situate.operators.rows import conform_schema, dedupe_first, sequential_index
from situate.session import scratch_path

# ---- fixed values: raw column → clean column of the two feeds ----
EVENT_RENAME = {
    "TITLE": "title", "CODENAME": "codename", "GUNAME": "guname", "PLACE": "place", "DATE": "date_text",
    "USE_FEE": "use_fee", "ORG_NAME": "org_name", "PROGRAM": "program", "HMPG_ADDR": "hmpg_addr",
    "MAIN_IMG": "main_img", "LOT": "lot", "LAT": "lat",
}

TOUR_RENAME = {
    "contentid": "content_id", "contenttypeid": "content_type_id", "title": "title", "addr1": "address",
    "areacode": "area_code", "sigungucode": "sigungu_code", "cat1": "category_large",
    "cat2": "category_middle", "cat3": "category_small", "mapx": "longitude", "mapy": "latitude",
    "firstimage": "image_url", "firstimage2": "thumbnail_url", "createdtime": "created_time",
    "modifiedtime": "modified_time",
}
# ------------------------------------------------------------------


def transform_events(raw: DataFrame, keep_ordinal: bool = True) -> DataFrame:
    """``transform_events``: raw cultural events → typed event rows.

    Staged projections: every parse runs once per row; Catalyst does not inline the
    regex-heavy columns into the later stages because they are referenced more than once.
    """
    r = conform_schema(raw, schemas.RAW_EVENT)
    text = F.col("DATE")
    date_cols = ["__s", "__e", "__r1", "__r2", "__one"]
    texts = r.select(
        *[F.col(k).alias(v) for k, v in EVENT_RENAME.items()], "ordinal",
        loose_date_text(F.coalesce(F.nullif(F.col("START_DATE"), F.lit("")), F.col("STRTDATE"))).alias("__s"),
        loose_date_text(F.coalesce(F.nullif(F.col("END_DATE"), F.lit("")), F.col("ENDDATE"))).alias("__e"),
        F.coalesce(text.rlike(DATE_RANGE_PATTERN), F.lit(False)).alias("__is_range"),
        loose_date_text(F.regexp_extract(text, DATE_RANGE_PATTERN, 1)).alias("__r1"),
        loose_date_text(F.regexp_extract(text, DATE_RANGE_PATTERN, 2)).alias("__r2"),
        loose_date_text(F.regexp_extract(text, SINGLE_DATE_PATTERN, 1)).alias("__one"),
    )
    staged = texts.select(*EVENT_RENAME.values(), "ordinal", "__is_range",
                          *[date_from_text(F.col(c)).alias(c) for c in date_cols])
    explicit = F.col("__s").isNotNull() | F.col("__e").isNotNull()
    dated = staged.select(
        *EVENT_RENAME.values(), "ordinal",
        F.when(explicit, F.col("__s")).when(F.col("__is_range"), F.col("__r1")).otherwise(F.col("__one")).alias("start_date"),
        F.when(explicit, F.col("__e")).when(F.col("__is_range"), F.col("__r2")).otherwise(F.col("__one")).alias("end_date"),
    )
    start, end = F.col("start_date"), F.col("end_date")
    out = dated.select(
        *EVENT_RENAME.values(),
        "start_date", "end_date",
        infer_is_free(F.col("use_fee")).alias("is_free"),
        F.month(start).alias("month"),
        weekday_name(start).alias("weekday"),
        season_of(start).alias("season"),
        duration_days(start, end).alias("duration_days"),
        has_text(F.col("main_img")).alias("has_image"),
        has_text(F.col("hmpg_addr")).alias("has_website"),
        "ordinal",
    )
    return out if keep_ordinal else out.drop("ordinal")


def transform_tour(raw: DataFrame, keep_ordinal: bool = True) -> DataFrame:
    """``transform_tour``: raw tourist spots → typed rows."""
    r = conform_schema(raw, schemas.RAW_TOUR)
    r = r.withColumn("addr1", join_address(F.col("addr1"), F.col("addr2"))).drop("addr2")
    r = r.withColumnsRenamed(TOUR_RENAME)
    district_code = F.when(py_strip(F.col("sigungu_code")) != "",
                           coerce_int(F.col("sigungu_code")))
    out = r.select(
        "content_id", "content_type_id", "title", "address", "area_code", "sigungu_code",
        "category_large", "category_middle", "category_small",
        coerce_double(F.col("longitude")).alias("longitude"),
        coerce_double(F.col("latitude")).alias("latitude"),
        "image_url", "thumbnail_url", "created_time", "modified_time",
        has_text(F.col("image_url")).alias("has_image"),
        map_lookup(CONTENT_TYPE_NAMES, py_strip(F.col("content_type_id"))).alias("content_type_name"),
        map_lookup(DISTRICT_NAMES, district_code).alias("district"),
        "ordinal",
    )
    return out if keep_ordinal else out.drop("ordinal")


def transform_weather(raw: DataFrame) -> DataFrame:
    """A7 ``transform_weather``: long forecast rows → one wide row per forecast key.

    First non-null value per (key, category) in ingest order; null keys and keys without any value are dropped;
    all six measure columns are always present (null when a category never occurs). Values become numbers before the
    aggregate, so its buffers have a fixed width and nothing is sorted: a text that is no number still is the first value.
    """
    r = conform_schema(raw, schemas.RAW_WEATHER)
    keys = ["baseDate", "baseTime", "fcstDate", "fcstTime"]
    r = r.where(F.col("category").isin(*FORECAST_CATEGORIES.keys()) & F.col("fcstValue").isNotNull())
    r = r.where(F.col("baseDate").isNotNull() & F.col("baseTime").isNotNull()
                & F.col("fcstDate").isNotNull() & F.col("fcstTime").isNotNull())
    r = r.select(*keys, "category", "ordinal", coerce_double(F.col("fcstValue")).alias("__value"))
    at = {name: F.when(F.col("category") == code, F.col("ordinal")) for code, name in FORECAST_CATEGORIES.items()}
    wide = r.groupBy(*keys).agg(*[F.min_by("__value", place).alias(name) for name, place in at.items()], *[F.min(place).alias(f"__at_{name}") for name, place in at.items()])
    measures = list(FORECAST_CATEGORIES.values())
    wide = wide.where(F.greatest(*[F.col(f"__at_{m}").isNotNull() for m in measures]))
    wide = wide.select(
        F.col("baseDate").alias("base_date"), F.col("baseTime").alias("base_time"),
        F.col("fcstDate").alias("fcst_date"), F.col("fcstTime").alias("fcst_time"), *measures,
    )

    def code_name(col, mapping):
        whole = F.when(F.col(col) == F.floor(F.col(col)), F.col(col).cast("int"))
        return map_lookup(mapping, whole)

    return wide.select(
        *[f.name for f in schemas.WEATHER.fields if f.name not in ("sky_status_name", "precipitation_type_name")],
        code_name("sky_status", SKY_STATUS_NAMES).alias("sky_status_name"),
        code_name("precipitation_type", PRECIPITATION_TYPE_NAMES).alias("precipitation_type_name"),
    )


def event_creatives(events: DataFrame) -> DataFrame:
    """P5/P6 ``build_event_creatives``: ``event_{position:06d}`` by ingest order, event → creative schema.

    The rows carry their number: nothing is joined back, so null and repeated ordinals keep all their rows (nulls
    last). Cleaned rows are written once, as the range partitioning reads its input twice.
    """
    rows = events.select(
        F.lit("event").alias("creative_type"),
        "title",
        F.col("guname").alias("district"),
        F.col("codename").alias("category"),
        "season", "month", "weekday", "is_free", "has_image", "has_website",
        coerce_double(F.col("lat")).alias("latitude"),
        coerce_double(F.col("lot")).alias("longitude"),
        F.col("ordinal"),
    )
    path = scratch_path(events.sparkSession, "event-creatives")
    rows.write.parquet(path)
    numbered = sequential_index(events.sparkSession.read.parquet(path), ["ordinal"], "__seq")
    return numbered.select(F.format_string("event_%06d", F.col("__seq")).alias("creative_id"), *rows.columns)


def tour_creatives(tour: DataFrame) -> DataFrame:
    """P7 ``build_tour_creatives``: key ``tour_{int(content_id)}``, five null columns."""
    cid = coerce_int(F.col("content_id"), 63)
    return tour.select(
        F.concat(F.lit("tour_"), cid.cast("string")).alias("creative_id"),
        F.lit("tour").alias("creative_type"),
        "title", "district",
        F.col("content_type_name").alias("category"),
        F.lit(None).cast("string").alias("season"),
        F.lit(None).cast("int").alias("month"),
        F.lit(None).cast("string").alias("weekday"),
        F.lit(None).cast("boolean").alias("is_free"),
        "has_image",
        F.lit(None).cast("boolean").alias("has_website"),
        "latitude", "longitude",
        F.col("ordinal"),
    )


def creative_catalog(events: DataFrame, tour: DataFrame) -> DataFrame:
    """U1 + W1 ``build_creative_catalog``: events then tours, first row per creative_id.

    Event ids are positions (``event_%06d``), unique by construction, and cannot collide with
    ``tour_…`` ids, so only the tour side needs the keep-first aggregate: the events are never
    shuffled for the dedupe.
    """
    ev = event_creatives(events)
    tr = dedupe_first(tour_creatives(tour), ["creative_id"], ["ordinal"])
    return conform_schema(ev.unionByName(tr), schemas.CREATIVE)


def context_catalog(weather: DataFrame) -> DataFrame:
    """U2 + P8 ``build_context_catalog``: ``{fcst_date}_{fcst_time}`` (unpadded ints), first row per id.

    Rows are taken in the pivot's key order, as the reference's sorted pivot output.
    """
    as_int = lambda c: coerce_int(F.col(c))
    # a part that is no number keeps its own text, so unreadable times don't share an id
    part = lambda c: F.coalesce(as_int(c).cast("string"), F.col(c).cast("string"), F.lit("null"))
    w = weather.withColumn("context_id", F.concat(part("fcst_date"), F.lit("_"), part("fcst_time")))
    first = dedupe_first(w, ["context_id"], ["base_date", "base_time", "fcst_date", "fcst_time"])
    first = first.select(
        "context_id", *[as_int(c).alias(c) for c in ("base_date", "base_time", "fcst_date", "fcst_time")],
        *[c for c in weather.columns if c not in ("base_date", "base_time", "fcst_date", "fcst_time")],
    )
    return conform_schema(first, schemas.CONTEXT)
