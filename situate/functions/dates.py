"""Date and time expressions (loose date parsing, calendar parts, forecast slots)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from situate.functions.lookups import (
    FORECAST_ISSUE_HOURS,
    FORECAST_PUBLISH_DELAY_MINUTES,
    SEASON_BY_MONTH,
    map_lookup,
)
from situate.functions.text import coerce_int, py_strip

# ---- fixed values: date patterns of the free date text ----
DATE_TOKEN = r"\d{4}[-./]\d{1,2}[-./]\d{1,2}"
DATE_RANGE_PATTERN = rf"({DATE_TOKEN})\s*[~\-–]\s*({DATE_TOKEN})"
SINGLE_DATE_PATTERN = rf"({DATE_TOKEN})"
# -----------------------------------------------------------


def loose_date_text(value: Column) -> Column:
    """X1, text half: trim, '.' and '/' → '-', 8 digits → ISO, a month → its first day, keep the ``y-m-d``
    day before a time of day ('' if the text is anything else)."""
    s = F.translate(py_strip(value.cast("string")), "./", "--")
    iso = F.regexp_replace(s, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    iso = F.regexp_replace(iso, r"^(\d{4}-\d{1,2})$", "$1-1")
    return F.regexp_extract(iso, r"^(\d{4}-\d{1,2}-\d{1,2})(?:[ T]\d{1,2}(?::\d{1,2}){0,2}(?:[-,]\d+)?\s*(?:Z|[+-]\d{2}:?\d{2})?)?$", 1)


def date_from_text(day_text: Column) -> Column:
    """X1, date half: ``'y-m-d'`` text → DATE; '' or an impossible date → null.

    One compact expression (keeps whole-stage generated code small enough to be JIT-compiled).
    """
    return F.to_date(F.try_to_timestamp(F.nullif(day_text, F.lit("")), F.lit("yyyy-M-d")))


def parse_loose_date(value: Column) -> Column:
    """Trim, '.' and '/' → '-', 8 digits → ISO, keep the day; unparsable → null.

    A trailing time part (``2026-06-01 00:00:00.0``) still yields the day.
    """
    return date_from_text(loose_date_text(value))


def split_date_text(text: Column) -> Column:
    """struct(start, end) from a free date text; a range wins over a single date."""
    t = text.cast("string")
    is_range = F.coalesce(t.rlike(DATE_RANGE_PATTERN), F.lit(False))
    is_single = F.coalesce(t.rlike(SINGLE_DATE_PATTERN), F.lit(False))
    r1 = parse_loose_date(F.regexp_extract(t, DATE_RANGE_PATTERN, 1))
    r2 = parse_loose_date(F.regexp_extract(t, DATE_RANGE_PATTERN, 2))
    one = parse_loose_date(F.regexp_extract(t, SINGLE_DATE_PATTERN, 1))
    start = F.when(is_range, r1).when(is_single, one)
    end = F.when(is_range, r2).when(is_single, one)
    return F.struct(start.alias("start"), end.alias("end"))


def resolve_start_end(start_date: Column, strt_date: Column, end_date: Column, end_date2: Column,
                      date_text: Column) -> Column:
    """Explicit columns first (``a or b`` → coalesce(nullif(a,''), b)); else the DATE text."""
    start = parse_loose_date(F.coalesce(F.nullif(start_date, F.lit("")), strt_date))
    end = parse_loose_date(F.coalesce(F.nullif(end_date, F.lit("")), end_date2))
    split = split_date_text(date_text)
    explicit = start.isNotNull() | end.isNotNull()
    return F.struct(
        F.when(explicit, start).otherwise(split["start"]).alias("start"),
        F.when(explicit, end).otherwise(split["end"]).alias("end"),
    )


def season_of(d: Column) -> Column:
    """X6."""
    return map_lookup(SEASON_BY_MONTH, F.month(d))


def weekday_name(d: Column) -> Column:
    """Lower-case English weekday."""
    return F.lower(F.date_format(d, "EEEE"))


def duration_days(start: Column, end: Column) -> Column:
    """Inclusive length in days; may be <= 0 when end precedes start."""
    return F.datediff(end, start) + 1


def forecast_timestamp(fcst_date: Column, fcst_time: Column) -> Column:
    """Yyyymmdd + zero-padded hhmm → timestamp; invalid → null."""
    d = coerce_int(fcst_date, 63)
    t = coerce_int(fcst_time, 63)
    text = F.concat(d.cast("string"), F.lpad(t.cast("string"), 4, "0"))
    return F.try_to_timestamp(text, F.lit("yyyyMMddHHmm")).cast("timestamp_ntz")


def is_weekend(ts: Column) -> Column:
    """Saturday/Sunday (``weekday() >= 5``, Monday = 0); null → False."""
    return F.coalesce(F.weekday(ts) >= 5, F.lit(False))


def forecast_issue_slot(ts_utc: Column, tz: str = "Asia/Seoul") -> Column:
    """Latest forecast issue (02,05,..,23 h local) published at least 40 minutes before ``ts``.

    Returns struct(base_date 'yyyyMMdd', base_time 'HHmm'); before 02:40 it is 23:00 of the day before.
    ``ts_utc`` is a UTC wall-clock timestamp; the conversion does not depend on the session time zone.
    """
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), ts_utc.cast("timestamp_ntz"))
    t = local - F.expr(f"INTERVAL {FORECAST_PUBLISH_DELAY_MINUTES} MINUTES")
    h = F.hour(t)
    first, step = FORECAST_ISSUE_HOURS[0], FORECAST_ISSUE_HOURS[1] - FORECAST_ISSUE_HOURS[0]
    slot_hour = F.lit(first) + F.lit(step) * F.floor((h - first) / step)
    day = F.to_date(t)
    base_day = F.when(h < first, F.date_sub(day, 1)).otherwise(day)
    base_hour = F.when(h < first, F.lit(FORECAST_ISSUE_HOURS[-1])).otherwise(slot_hour)
    return F.struct(
        F.date_format(base_day, "yyyyMMdd").alias("base_date"),
        F.concat(F.lpad(base_hour.cast("string"), 2, "0"), F.lit("00")).alias("base_time"),
    )
