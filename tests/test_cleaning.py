"""Cleaning transforms and catalogs (X1-X14, A7, P5-P8, U1, U2) on the FIXTURES.md B cases."""

import datetime as dt

from pyspark.sql import functions as F

from situate import schemas
from situate.functions.dates import forecast_issue_slot
from situate.plans import cleaning as CL

D = dt.date


def _raw_events(spark, rows):
    cols = ["START_DATE", "STRTDATE", "END_DATE", "DATE", "USE_FEE", "MAIN_IMG"]
    data = [dict(zip(cols, r), ordinal=i) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, schema=schemas.struct(*[(c, schemas.S) for c in cols], ("ordinal", schemas.L)))


def test_event_dates(spark):
    cases = [
        ((None, None, None, "2026-06-01~2026-06-05"), (D(2026, 6, 1), D(2026, 6, 5))),
        ((None, None, None, "2026.6.1 ~ 2026.6.5"), (D(2026, 6, 1), D(2026, 6, 5))),
        ((None, None, None, "2026/06/01"), (D(2026, 6, 1), D(2026, 6, 1))),
        (("", "2026-06-01 00:00:00.0", "20260605", "ignored"), (D(2026, 6, 1), D(2026, 6, 5))),
        (("2026-06-01", None, None, "2026-07-01~2026-07-02"), (D(2026, 6, 1), None)),
        ((None, None, None, "상시"), (None, None)),
        ((None, None, None, ""), (None, None)),
        ((None, None, None, None), (None, None)),
        ((None, None, None, "2026-13-01"), (None, None)),
        ((None, None, None, "2026-02-30"), (None, None)),
        ((None, None, None, "기간 2026-06-10 - 2026-06-01 까지"), (D(2026, 6, 10), D(2026, 6, 1))),
    ]
    raw = _raw_events(spark, [c[0] + (None, None) for c in cases])
    out = CL.transform_events(raw).orderBy("ordinal").collect()
    for (inp, (s, e)), r in zip(cases, out):
        assert (r.start_date, r.end_date) == (s, e), inp
    assert out[-1].duration_days == -8


def test_use_fee_and_parts(spark):
    fees = ["무료", "Free", "10,000원", "유료", "10,000원 (어린이 무료)", "문의", " ", None]
    expect = [True, True, False, False, True, None, None, None]
    raw = _raw_events(spark, [(None, None, None, "2026-06-01", f, " ") for f in fees])
    out = CL.transform_events(raw).orderBy("ordinal").collect()
    assert [r.is_free for r in out] == expect
    r = out[0]
    assert (r.month, r.weekday, r.season, r.duration_days, r.has_image) == (6, "monday", "summer", 1, False)


def test_tour(spark):
    rows = [
        {"contentid": "1", "contenttypeid": "12", "addr1": " A ", "addr2": "B", "sigungucode": "1", "mapx": "126.9"},
        {"contentid": "2", "contenttypeid": " 12 ", "addr1": "A", "addr2": " ", "sigungucode": "1.0", "mapx": "n/a"},
        {"contentid": "3", "contenttypeid": "12.0", "addr1": None, "addr2": None, "sigungucode": "26"},
        {"contentid": "4", "contenttypeid": "99", "sigungucode": ""},
        {"contentid": "5", "sigungucode": "x"},
        {"contentid": "6", "sigungucode": None},
    ]
    for i, r in enumerate(rows):
        r["ordinal"] = i
    raw = spark.createDataFrame(rows, schema=schemas.RAW_TOUR)
    out = CL.transform_tour(raw).orderBy("ordinal").collect()
    assert [r.address for r in out[:3]] == ["A B", "A", ""]
    assert [r.content_type_name for r in out[:4]] == ["관광지", "관광지", None, None]
    assert [r.district for r in out] == ["종로구", "종로구", None, None, None, None]
    assert out[0].longitude == 126.9 and out[1].longitude is None


def test_weather_pivot(spark):
    S = schemas.RAW_WEATHER
    rows = [
        ("20260603", "0200", "20260603", "0500", "SKY", None, 1),
        ("20260603", "0200", "20260603", "0500", "SKY", "3", 2),
        ("20260603", "0200", "20260603", "0500", "SKY", "4", 3),
        ("20260603", "0200", "20260603", "0500", "PTY", "1", 4),
        ("20260603", "0200", "20260603", "0500", "PCP", "강수없음", 5),
        ("20260603", "0200", "20260603", "0500", "TMP", "21.5", 6),
        ("20260603", "0200", "20260603", "0500", "POP", "강수없음", 7),
        (None, "0200", "20260603", "0600", "SKY", "1", 8),
        ("20260603", "0200", "20260603", "0600", "PCP", "1", 9),
    ]
    w = CL.transform_weather(spark.createDataFrame(rows, S)).collect()
    assert len(w) == 1
    r = w[0]
    assert (r.sky_status, r.sky_status_name, r.precipitation_type_name, r.temperature) == (3.0, "cloudy", "rain", 21.5)
    assert r.precipitation_probability is None and r.humidity is None and r.wind_speed is None
    ctx = CL.context_catalog(CL.transform_weather(spark.createDataFrame(rows, S))).first()
    assert ctx.context_id == "20260603_500" and ctx.fcst_time == 500


def test_catalog_dedupe_first(spark):
    ev = CL.transform_events(_raw_events(spark, [(None, None, None, "2026-06-01", None, None)] * 3))
    tour_rows = [{"contentid": "7", "contenttypeid": "39", "title": "first", "ordinal": 0},
                 {"contentid": "7.0", "contenttypeid": "12", "title": "second", "ordinal": 1}]
    tr = CL.transform_tour(spark.createDataFrame(tour_rows, schema=schemas.RAW_TOUR))
    cat = CL.creative_catalog(ev, tr).orderBy("creative_id").collect()
    assert [r.creative_id for r in cat] == ["event_000000", "event_000001", "event_000002", "tour_7"]
    assert cat[-1].title == "first" and cat[-1].category == "음식점"
    assert cat.__len__() == 4 and [c.name for c in schemas.CREATIVE.fields] == list(cat[0].asDict())


def test_issue_slot(spark):
    # KST wall clock → UTC input
    cases = [("02:39", "20260602", "2300"), ("02:40", "20260603", "0200"), ("00:10", "20260602", "2300"),
             ("23:39", "20260603", "2000"), ("23:40", "20260603", "2300")]
    rows = [(dt.datetime(2026, 6, 3, int(t[:2]), int(t[3:])) - dt.timedelta(hours=9),) for t, _, _ in cases]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = [(r.s.base_date, r.s.base_time) for r in df.select(forecast_issue_slot(F.col("ts")).alias("s")).collect()]
    assert got == [(d, t) for _, d, t in cases]


def test_column_date_functions_agree_with_transform(spark):
    from situate.functions.dates import resolve_start_end
    from situate.sources import adapters as A
    from conftest import SF001

    raw = A.v_raw_event(spark, SF001)
    d = resolve_start_end(F.col("START_DATE"), F.col("STRTDATE"), F.col("END_DATE"), F.col("ENDDATE"), F.col("DATE"))
    by_fn = raw.select("ordinal", d["start"].alias("start_date"), d["end"].alias("end_date"))
    by_plan = CL.transform_events(raw).select("ordinal", "start_date", "end_date")
    assert by_fn.exceptAll(by_plan).count() == 0 and by_plan.exceptAll(by_fn).count() == 0


def test_numeric_coercion_like_to_numeric(spark):
    from situate.functions.text import coerce_double, coerce_int

    vals = [" 12 ", "1e3", "-0.5", ".5", "inf", "1,000", "n/a", "", None, "7.9", "3000000000"]
    rows = spark.createDataFrame([(v,) for v in vals], "v string").select(
        coerce_double(F.col("v")).alias("d"), coerce_int(F.col("v")).alias("i")).collect()
    assert [r.d for r in rows] == [12.0, 1000.0, -0.5, 0.5, float("inf"), None, None, None, None, 7.9, 3e9]
    assert [r.i for r in rows] == [12, 1000, 0, 0, None, None, None, None, None, 7, None]


def test_event_numbers_with_null_and_repeated_ordinals(spark):
    """Every event keeps its row and gets a number of its own; null ordinals come last."""
    rows = [(f"e{i}", o) for i, o in enumerate([5, None, 3, 5, None, 1])]
    raw = spark.createDataFrame(rows, "TITLE string, ordinal long")
    got = {r["title"]: r["creative_id"] for r in CL.event_creatives(CL.transform_events(raw)).collect()}
    assert sorted(got.values()) == [f"event_{i:06d}" for i in range(6)]
    assert got["e5"] == "event_000000" and got["e2"] == "event_000001" and {got["e1"], got["e4"]} == {"event_000004", "event_000005"}
