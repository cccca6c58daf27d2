"""Fixed schemas of the raw feeds and the processed tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, B, DT, L = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType(), T.DateType(), T.LongType()


def struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


RAW_EVENT = struct(*[(c, S) for c in (
    "TITLE", "CODENAME", "GUNAME", "PLACE", "DATE", "USE_FEE", "ORG_NAME", "PROGRAM", "HMPG_ADDR",
    "MAIN_IMG", "LOT", "LAT", "START_DATE", "STRTDATE", "END_DATE", "ENDDATE")], ("ordinal", L))

EVENT = struct(
    ("title", S), ("codename", S), ("guname", S), ("place", S), ("date_text", S), ("use_fee", S),
    ("org_name", S), ("program", S), ("hmpg_addr", S), ("main_img", S), ("lot", S), ("lat", S),
    ("start_date", DT), ("end_date", DT), ("is_free", B), ("month", I), ("weekday", S), ("season", S),
    ("duration_days", I), ("has_image", B), ("has_website", B),
)

RAW_TOUR = struct(*[(c, S) for c in (
    "contentid", "contenttypeid", "title", "addr1", "addr2", "areacode", "sigungucode", "cat1", "cat2",
    "cat3", "mapx", "mapy", "firstimage", "firstimage2", "createdtime", "modifiedtime")], ("ordinal", L))

TOUR = struct(
    ("content_id", S), ("content_type_id", S), ("title", S), ("address", S), ("area_code", S),
    ("sigungu_code", S), ("category_large", S), ("category_middle", S), ("category_small", S),
    ("longitude", D), ("latitude", D), ("image_url", S), ("thumbnail_url", S), ("created_time", S),
    ("modified_time", S), ("has_image", B), ("content_type_name", S), ("district", S),
)

RAW_WEATHER = struct(*[(c, S) for c in ("baseDate", "baseTime", "fcstDate", "fcstTime", "category", "fcstValue")],
                     ("ordinal", L))

WEATHER = struct(
    ("base_date", S), ("base_time", S), ("fcst_date", S), ("fcst_time", S), ("temperature", D),
    ("sky_status", D), ("precipitation_type", D), ("precipitation_probability", D), ("humidity", D),
    ("wind_speed", D), ("sky_status_name", S), ("precipitation_type_name", S),
)

CREATIVE = struct(
    ("creative_id", S), ("creative_type", S), ("title", S), ("district", S), ("category", S), ("season", S),
    ("month", I), ("weekday", S), ("is_free", B), ("has_image", B), ("has_website", B), ("latitude", D),
    ("longitude", D),
)

CONTEXT = struct(
    ("context_id", S), ("base_date", I), ("base_time", I), ("fcst_date", I), ("fcst_time", I),
    ("temperature", D), ("sky_status", D), ("sky_status_name", S), ("precipitation_probability", D),
    ("precipitation_type", D), ("precipitation_type_name", S), ("humidity", D), ("wind_speed", D),
)

IMPRESSION_LOG = struct(
    ("impression_id", S), ("user_id", S), ("timestamp", T.TimestampNTZType()), ("user_segment", S),
    ("context_features", S), ("creative_id", S), ("clicked", I), ("converted", I),
)
