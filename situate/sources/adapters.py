"""Adapters: the driver's TPC-H-like tables re-shaped into the reference's data model.

Each adapter is a plain projection/join, written so that DuckDB can express the
same rows (see ``situate/oracle.py``). None of them caps, samples or filters rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from situate.functions.context import encode_context
from situate.sources.tables import read_table

# part.p_type → content category (fixed values of the adapter)
CATEGORY_BY_PART_TYPE = {
    "PROMO": "축제",
    "LARGE": "관광지",
    "SMALL": "전시",
    "MEDIUM": "음식점",
    "STANDARD": "문화시설",
    "ECONOMY": "기타",
}


def _case(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr.otherwise(default) if default is not None else expr


def v_creative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part → creative catalog (creative_id, creative_type, title, category, has_image, is_free)."""
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("creative_id"),
        F.when(F.col("p_size") % 2 == 0, "event").otherwise("tour").alias("creative_type"),
        F.col("p_name").alias("title"),
        _case(F.col("p_type"), CATEGORY_BY_PART_TYPE).alias("category"),
        (F.col("p_retailprice") >= 1500).alias("has_image"),
        (F.col("p_size") % 5 == 0).alias("is_free"),
    )


def _sky(col_code: Column) -> Column:
    return F.when(col_code == 0, "clear").when(col_code == 1, "cloudy").otherwise("overcast")


def _log_columns(impression_id, user_id, ts, creative_id, sky, precip, temp, clicked, converted):
    """Log columns. The context is kept typed (``context`` struct, what a columnar store holds)
    and as the reference's JSON text (``context_features``); Catalyst drops whichever is unused."""
    weekend = F.when(F.weekday(ts) >= 5, 1).otherwise(0)
    return [
        impression_id.alias("impression_id"),
        user_id.alias("user_id"),
        ts.alias("timestamp"),
        F.lit("").alias("user_segment"),
        encode_context(sky, temp, precip, weekend).alias("context_features"),
        F.struct(sky.alias("sky"), temp.cast("double").alias("temp"), precip.alias("precip"),
                 weekend.cast("int").alias("weekend")).alias("context"),
        creative_id.alias("creative_id"),
        F.when(clicked, 1).otherwise(0).alias("clicked"),
        F.when(converted, 1).otherwise(0).alias("converted"),
    ]


def v_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → impression log (10 000 rows at sf0.01)."""
    e = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    v = F.col("value")
    precip = F.when(v < 20, "none").when(v < 60, "rain").when(v < 100, "snow").otherwise("shower")
    return e.select(*_log_columns(
        F.col("event_id"), F.col("user_id"), F.col("ts"), k, _sky(k % 3), precip, v / 10.0,
        F.col("event_type").isin("click", "purchase"), F.col("event_type") == "purchase",
    ))


def v_log_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders → large impression log (the bench log; 600 000 rows at sf0.1)."""
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    tax, qty = F.col("l_tax"), F.col("l_quantity")
    sky = F.when(tax < 0.03, "clear").when(tax < 0.06, "cloudy").otherwise("overcast")
    precip = F.when(qty <= 20, "none").when(qty <= 35, "rain").when(qty <= 45, "snow").otherwise("shower")
    return j.select(*_log_columns(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")),
        F.col("o_custkey"), F.col("l_shipdate"), F.col("l_partkey"), sky, precip,
        F.col("l_discount") * 100.0, F.col("l_returnflag") != "N", F.col("l_returnflag") == "R",
    ))


def v_raw_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders → raw cultural-event rows (all strings, several date spellings) + ``ordinal``."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    d = F.to_date("o_orderdate")
    d2 = F.date_add(d, (k % 10).cast("int"))
    iso = lambda x: F.date_format(x, "yyyy-MM-dd")
    date_text = (
        F.when((k % 5 == 0) & (k % 10 == 5), F.concat(iso(d2), F.lit("~"), iso(d)))
        .when(k % 5 == 0, F.concat(iso(d), F.lit("~"), iso(d2)))
        .when(k % 5 == 1, F.concat(F.date_format(d, "yyyy.M.d"), F.lit(" ~ "), F.date_format(d2, "yyyy.M.d")))
        .when(k % 5 == 2, F.date_format(d, "yyyy/MM/dd"))
        .when(k % 5 == 3, F.lit(""))
        .when(k % 3 == 0, F.lit("2026-13-01"))
        .otherwise(F.lit("TBD"))
    )
    codename = _case(F.col("o_orderpriority"), {"1-URGENT": "축제", "2-HIGH": "전시", "3-MEDIUM": "콘서트",
                                                 "4-NOT SPECIFIED": "교육"}, "기타")
    guname = _case(F.col("o_orderstatus"), {"F": "종로구", "O": "중구"}, "마포구")
    ks = k.cast("string")
    return o.select(
        F.concat(F.lit("event "), ks).alias("TITLE"),
        codename.alias("CODENAME"),
        guname.alias("GUNAME"),
        F.concat(F.lit("hall "), (k % 50).cast("string")).alias("PLACE"),
        date_text.alias("DATE"),
        F.when(k % 4 == 0, "무료").when(k % 4 == 1, "10,000원").when(k % 4 == 3, "Free entry").alias("USE_FEE"),
        F.col("o_orderpriority").alias("ORG_NAME"),
        F.col("o_orderstatus").alias("PROGRAM"),
        F.when(k % 3 == 0, F.concat(F.lit("http://example.org/"), ks)).alias("HMPG_ADDR"),
        F.when(k % 3 == 0, "").when(k % 3 == 1, " ").otherwise(F.concat(F.lit("http://img.example.org/"), ks)).alias("MAIN_IMG"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(".5")).alias("LOT"),
        F.when(k % 11 == 0, "n/a").otherwise(F.concat((k % 90).cast("string"), F.lit(".25"))).alias("LAT"),
        F.when(k % 7 == 0, F.date_format(d, "yyyyMMdd")).when(k % 7 == 1, "").alias("START_DATE"),
        F.when(k % 7 == 1, F.concat(iso(d), F.lit(" 00:00:00.0"))).alias("STRTDATE"),
        F.when(k % 7 == 0, F.date_format(d2, "yyyyMMdd")).alias("END_DATE"),
        F.when(k % 14 == 1, iso(d2)).alias("ENDDATE"),
        k.alias("ordinal"),
    )


def v_raw_tour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer ⋈ nation → raw tourist-spot rows (all strings) + ``ordinal``."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    k = F.col("c_custkey")
    code = (F.col("c_nationkey") + 1).cast("string")
    typeid = _case(F.col("c_mktsegment"), {"HOUSEHOLD": "12", "FURNITURE": " 14 ", "MACHINERY": "39.0",
                                           "BUILDING": "38"}, "99")
    return j.select(
        k.cast("string").alias("contentid"),
        typeid.alias("contenttypeid"),
        F.col("c_name").alias("title"),
        F.when(k % 17 != 0, F.col("n_name")).alias("addr1"),
        F.when(k % 3 == 0, " ").when(k % 3 == 1, F.concat(F.lit(" Apt "), k.cast("string"))).alias("addr2"),
        F.lit("1").alias("areacode"),
        F.when(k % 4 == 0, code).when(k % 4 == 1, F.concat(code, F.lit(".0"))).when(k % 4 == 2, "")
        .otherwise("x").alias("sigungucode"),
        F.concat(F.lit("A0"), (F.col("c_nationkey") % 3).cast("string")).alias("cat1"),
        F.concat(F.lit("A02"), (F.col("c_nationkey") % 5).cast("string")).alias("cat2"),
        F.concat(F.lit("A020"), (F.col("c_nationkey") % 7).cast("string")).alias("cat3"),
        F.when(k % 10 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string")).alias("mapx"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit(".5")).alias("mapy"),
        F.when(k % 2 == 0, F.concat(F.lit("http://img.example.org/c"), k.cast("string"))).otherwise("").alias("firstimage"),
        F.lit(None).cast("string").alias("firstimage2"),
        F.lit("20240101000000").alias("createdtime"),
        F.lit("20240102000000").alias("modifiedtime"),
        k.alias("ordinal"),
    )


def v_raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → long forecast rows (baseDate, baseTime, fcstDate, fcstTime, category, fcstValue) + ordinal."""
    e = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    iv = F.floor("value").cast("bigint")
    cat = _case(F.col("event_type"), {"view": "TMP", "click": "SKY", "purchase": "PTY", "signup": "POP"}, "PCP")
    value = (
        F.when(eid % 13 == 0, F.lit(None).cast("string"))
        .when(cat == "TMP", F.concat((iv % 35).cast("string"), F.lit(".5")))
        .when(cat == "SKY", (iv % 4 + 1).cast("string"))
        .when(cat == "PTY", (iv % 5).cast("string"))
        .when(cat == "POP", (iv % 100).cast("string"))
        .otherwise(F.lit("강수없음"))
    )
    day = F.date_format("ts", "yyyyMMdd")
    return e.select(
        day.alias("baseDate"),
        F.lit("0200").alias("baseTime"),
        day.alias("fcstDate"),
        F.when(eid % 97 != 0, F.concat(F.date_format("ts", "HH"), F.lit("00"))).alias("fcstTime"),
        cat.alias("category"),
        value.alias("fcstValue"),
        eid.alias("ordinal"),
    )


def v_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels → evaluation trials (case_id, trial, passed, critic_approved)."""
    lb = read_table(spark, sf_dir, "labels")
    return lb.select(
        F.format_string("case_%03d", F.col("doc_id") % 97).alias("case_id"),
        (F.floor(F.col("doc_id") / 97) + 1).cast("int").alias("trial"),
        ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("passed"),
        (F.col("quality") == 1).alias("critic_approved"),
    )


# required / forbidden keywords per language for the graded texts (adapter values)
REQUIRED_KEYWORDS = {"en": ["the", "and"], "fr": ["le", "de"], "de": ["der", "und"], "es": ["el", "de"]}
FORBIDDEN_KEYWORDS = {"en": ["secret", "password"], "fr": ["secret"], "de": ["Passwort"], "es": ["secreto"]}


def _ids(n: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), n.cast("int")), lambda i: F.format_string("strategy_%03d", i))


def _kw(mapping: dict, lang: Column) -> Column:
    expr = None
    for k, words in mapping.items():
        arr = F.array(*[F.lit(w) for w in words])
        expr = F.when(lang == k, arr) if expr is None else expr.when(lang == k, arr)
    return expr.otherwise(F.array().cast("array<string>"))


def v_golden_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents → golden cases: case_id, expected_approved, expected_ids, required/forbidden keywords."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("case_id"),
        (F.col("doc_id") % 3 != 0).alias("expected_approved"),
        _ids(F.col("doc_id") % 3 + 1).alias("expected_ids"),
        _kw(REQUIRED_KEYWORDS, F.col("lang")).alias("required_keywords"),
        _kw(FORBIDDEN_KEYWORDS, F.col("lang")).alias("forbidden_keywords"),
    )


def v_run_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents ⟕ labels → run results: case_id, approved, actual_ids, overall, report, operational reasons."""
    d = read_table(spark, sf_dir, "documents")
    lb = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = d.join(lb, "doc_id", "left")
    return j.select(
        F.col("doc_id").alias("case_id"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).alias("approved"),
        _ids(F.col("n_chars") % 3 + 1).alias("actual_ids"),
        F.col("source").alias("overall_recommendation"),
        F.col("text").alias("report"),
        F.array(F.col("lang")).alias("operational_reasons"),
    )


METRIC_NAMES = ("expected_ctr_gain", "expected_cvr_gain", "support", "confidence", "lift", "strategy_score")


def v_metrics_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-supplier lineitem aggregates shaped as strategy records (ground truth)."""
    li = read_table(spark, sf_dir, "lineitem")
    g = li.groupBy("l_suppkey").agg(
        F.avg("l_discount").alias("expected_ctr_gain"),
        F.avg("l_tax").alias("expected_cvr_gain"),
        F.avg(F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)).alias("support"),
        F.avg(F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.0)).alias("confidence"),
        (F.avg("l_quantity") / 25.5).alias("lift"),
        (F.avg("l_extendedprice") / 100000.0).alias("strategy_score"),
    )
    return g.select(
        F.format_string("strategy_%03d", F.col("l_suppkey")).alias("strategy_id"),
        F.col("l_suppkey").alias("ordinal"),
        F.format_string("supplier %d", F.col("l_suppkey")).alias("reason"),
        *METRIC_NAMES,
    )


def v_metrics_reported(truth: DataFrame) -> DataFrame:
    """Reported strategies: drift on every 7th supplier's CTR gain, every 11th lift; unknown ids for every 13th."""
    s = F.col("ordinal")
    return truth.select(
        F.when(s % 13 == 0, F.format_string("strategy_x%03d", s)).otherwise(F.col("strategy_id")).alias("strategy_id"),
        F.col("ordinal"),
        F.when(s % 7 == 0, F.col("expected_ctr_gain") + 0.5).otherwise(F.col("expected_ctr_gain")).alias("expected_ctr_gain"),
        F.col("expected_cvr_gain"),
        F.col("support"),
        F.col("confidence"),
        F.when(s % 11 == 0, F.col("lift") * 1.1).otherwise(F.col("lift")).alias("lift"),
        F.col("strategy_score"),
    )


def v_narratives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations → narrative rows (strategy_id, operational_reason, ordinal); duplicates per id."""
    c = read_table(spark, sf_dir, "conversations")
    return c.select(
        F.format_string("strategy_%03d", F.col("conv_id") % 150).alias("strategy_id"),
        F.col("text").alias("operational_reason"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("ordinal"),
    )


PAGE_SIZE = 100
FEEDS = ("cultural_event", "tour", "weather")


def v_pages_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events grouped into pages of 100 and wrapped into the three API envelopes as JSON text.

    Page p belongs to feed p % 3; every 17th page carries an error code, every 13th a single
    object instead of a list, every 19th no item at all. Groups are bounded by the page size.
    """
    e = read_table(spark, sf_dir, "events")
    item = F.struct("event_id", "user_id", "event_type", "value")
    pages = e.groupBy((F.col("event_id") / PAGE_SIZE).cast("bigint").alias("page_id")).agg(
        F.array_sort(F.collect_list(item)).alias("items"), F.count("*").alias("n_rows"))
    p = F.col("page_id")
    feed_no = p % 3
    payload = (
        F.when(p % 19 == 0, F.lit(None))
        .when(p % 13 == 0, F.to_json(F.element_at("items", 1)))
        .otherwise(F.to_json("items"))
    )
    ok = p % 17 != 0
    cultural = F.format_string('{"culturalEventInfo":{"list_total_count":%d,"RESULT":{"CODE":"%s"},"row":%s}}',
                            F.col("n_rows"), F.when(ok, "INFO-000").otherwise("ERROR-300"),
                            F.coalesce(payload, F.lit("null")))
    body = F.format_string('{"response":{"header":{"resultCode":"%s"},"body":{"totalCount":%d,"items":%s}}}',
                           F.when(ok, F.when(feed_no == 1, "0000").otherwise("00")).otherwise("99"),
                           F.col("n_rows"),
                           F.when(payload.isNull(), F.lit('""')).otherwise(F.concat(F.lit('{"item":'), payload, F.lit("}"))))
    return pages.select(
        p.alias("page_id"),
        F.when(feed_no == 0, FEEDS[0]).when(feed_no == 1, FEEDS[1]).otherwise(FEEDS[2]).alias("feed"),
        ((F.floor(p / 3)) * PAGE_SIZE + 1).cast("bigint").alias("start_index"),
        F.col("n_rows").alias("declared_rows"),
        F.when(feed_no == 0, cultural).otherwise(body).alias("body"),
    )
