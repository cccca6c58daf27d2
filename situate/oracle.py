"""DuckDB oracle: for each registered query, SQL over the raw parquet views that must give
the same rows. Written independently of the Spark code path (plain SQL, CUBE, windows).

Only the fixed reference values (keyword lists, label tables) are shared.
"""

from __future__ import annotations

from situate.functions import lookups as LK
from situate.sources.adapters import CATEGORY_BY_PART_TYPE, FORBIDDEN_KEYWORDS, REQUIRED_KEYWORDS

ORACLE_SQL: dict[str, str] = {}
NL = "chr(10)"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _any(col: str, words) -> str:
    return "coalesce(" + " OR ".join(f"contains({col}, {_q(w)})" for w in words) + ", false)"


def _case(col: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {_q(str(k)) if isinstance(k, str) else k} THEN {_q(v)}" for k, v in mapping.items())
    return f"(CASE {col} {whens} ELSE {default} END)"


def _r(x: str) -> str:
    return f"round({x}, 6)"


def _fixed(x: str, d: int) -> str:
    return f"printf('%.{d}f', {x})"


def _pct(x: str, d: int = 2) -> str:
    return f"(printf('%.{d}f', ({x}) * 100) || '%')"


def _thousands(x: str) -> str:
    return f"format('{{:,}}', {x})"


OUTDOOR = lambda c: _any(c, LK.OUTDOOR_KEYWORDS)
INDOOR = lambda c: _any(c, LK.INDOOR_KEYWORDS)

V_CREATIVE = f"""v_creative AS (
  SELECT p_partkey AS creative_id,
         CASE WHEN p_size % 2 = 0 THEN 'event' ELSE 'tour' END AS creative_type,
         p_name AS title,
         {_case('p_type', CATEGORY_BY_PART_TYPE)} AS category,
         p_retailprice >= 1500 AS has_image,
         p_size % 5 = 0 AS is_free
  FROM part)"""

V_LOG = """v_log AS (
  SELECT event_id AS impression_id, user_id, ts AS "timestamp", value / 10.0 AS temp,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS creative_id,
         CASE CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 WHEN 0 THEN 'clear' WHEN 1 THEN 'cloudy' ELSE 'overcast' END AS sky,
         CASE WHEN value < 20 THEN 'none' WHEN value < 60 THEN 'rain' WHEN value < 100 THEN 'snow' ELSE 'shower' END AS precip,
         CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS weekend,
         CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 0 END AS clicked,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS converted
  FROM events)"""

V_LOG_BIG = """v_log AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS impression_id,
         o_custkey AS user_id, l_shipdate AS "timestamp", l_partkey AS creative_id,
         CASE WHEN l_tax < 0.03 THEN 'clear' WHEN l_tax < 0.06 THEN 'cloudy' ELSE 'overcast' END AS sky,
         CASE WHEN l_quantity <= 20 THEN 'none' WHEN l_quantity <= 35 THEN 'rain' WHEN l_quantity <= 45 THEN 'snow' ELSE 'shower' END AS precip,
         CASE WHEN isodow(l_shipdate) >= 6 THEN 1 ELSE 0 END AS weekend,
         CASE WHEN l_returnflag <> 'N' THEN 1 ELSE 0 END AS clicked,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS converted
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

ENRICHED = f"""enr AS (
  SELECT l.*, c.creative_type, c.category, l.weekend AS is_weekend,
         {OUTDOOR('c.category')} AS is_outdoor,
         {INDOOR('c.category')} AS is_indoor,
         coalesce(l.precip NOT IN ('none', ''), false) AS is_rainy,
         coalesce(l.sky = 'clear', false) AND NOT coalesce(l.precip NOT IN ('none', ''), false) AS is_clear,
         CASE WHEN {OUTDOOR('c.category')} THEN 'outdoor' WHEN {INDOOR('c.category')} THEN 'indoor' ELSE 'other' END AS category_group
  FROM v_log l LEFT JOIN v_creative c ON l.creative_id = c.creative_id)"""

CUBE = """tx AS (
  SELECT coalesce(sky, 'nan') AS sky, coalesce(precip, 'nan') AS precip, CAST(coalesce(is_weekend, 0) AS VARCHAR) AS weekend,
         coalesce(creative_type, 'nan') AS type, category_group, clicked, converted
  FROM enr),
cube AS MATERIALIZED (
  SELECT sky, precip, weekend, type, category_group,
         CAST(GROUPING(sky, precip, weekend, type, category_group) AS INTEGER) AS gid,
         count(*) AS n, sum(clicked) AS clk_sum, count(clicked) AS clk_cnt,
         count(CASE WHEN clicked = 1 THEN converted END) AS c1_cnt,
         sum(CASE WHEN clicked = 1 THEN converted END) AS c1_sum
  FROM tx GROUP BY CUBE (sky, precip, weekend, type, category_group)),
tot AS MATERIALIZED (
  SELECT *, CASE WHEN clk_cnt > 0 THEN CAST(clk_sum AS DOUBLE) / clk_cnt ELSE 0.0 END AS ctr,
         CASE WHEN c1_cnt > 0 THEN CAST(c1_sum AS DOUBLE) / c1_cnt ELSE 0.0 END AS cvr
  FROM cube WHERE gid = 31),
its AS MATERIALIZED (
  SELECT *, string_split(names, ',') AS items FROM (
    SELECT c.*, CAST(c.n AS DOUBLE) / (SELECT n FROM tot) AS support, CAST(5 - bit_count(c.gid) AS INTEGER) AS size,
           concat_ws(',', CASE WHEN c.gid & 1 = 0 THEN 'category_group_' || c.category_group END,
                     CASE WHEN c.gid & 8 = 0 THEN 'precip_' || c.precip END,
                     CASE WHEN c.gid & 16 = 0 THEN 'sky_' || c.sky END,
                     CASE WHEN c.gid & 2 = 0 THEN 'type_' || c.type END,
                     CASE WHEN c.gid & 4 = 0 THEN 'weekend_' || c.weekend END) AS names,
           CASE WHEN c.clk_cnt > 0 THEN CAST(c.clk_sum AS DOUBLE) / c.clk_cnt ELSE 0.0 END AS ctr,
           CASE WHEN c.c1_cnt > 0 THEN CAST(c.c1_sum AS DOUBLE) / c.c1_cnt ELSE 0.0 END AS cvr,
           (SELECT ctr FROM tot) AS base_ctr, (SELECT cvr FROM tot) AS base_cvr
    FROM cube c WHERE c.gid <> 31)
  WHERE support >= 0.01)"""

RULES = """rules0 AS (
  SELECT r.*, a.support AS antecedent_support, c.support AS consequent_support,
         r.support / a.support AS confidence, (r.support / a.support) / c.support AS lift
  FROM its r
  JOIN its a ON a.gid = (r.gid | 3) AND a.sky IS NOT DISTINCT FROM r.sky AND a.precip IS NOT DISTINCT FROM r.precip
            AND a.weekend IS NOT DISTINCT FROM r.weekend
  JOIN its c ON c.gid = (r.gid | 28) AND c.type IS NOT DISTINCT FROM r.type
            AND c.category_group IS NOT DISTINCT FROM r.category_group
  WHERE (r.gid & 28) <> 28 AND (r.gid & 3) <> 3),
rules AS (
  SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY size, items) AS INTEGER) AS rule_no,
         array_to_string(list_filter([CASE WHEN gid & 8 = 0 THEN 'precip_' || precip END,
                                      CASE WHEN gid & 16 = 0 THEN 'sky_' || sky END,
                                      CASE WHEN gid & 4 = 0 THEN 'weekend_' || weekend END], lambda x: x IS NOT NULL), ',') AS antecedents,
         array_to_string(list_filter([CASE WHEN gid & 1 = 0 THEN 'category_group_' || category_group END,
                                      CASE WHEN gid & 2 = 0 THEN 'type_' || type END], lambda x: x IS NOT NULL), ',') AS consequents
  FROM rules0 WHERE confidence >= 0.15 AND lift >= 1.02)"""

SKY_NAT = _case("sky", LK.SKY_LABELS, "'하늘 ' || sky")
PRECIP_NAT = _case("precip", LK.PRECIP_LABELS, "'강수 ' || precip")
WEEKEND_NAT = _case("weekend", LK.WEEKEND_LABELS, "weekend")
GROUP_NAT = _case("category_group", LK.CATEGORY_GROUP_LABELS, "category_group")
TYPE_NAT = _case("type", LK.TYPE_LABELS, "type")

STRAT = f"""strat AS (
  SELECT printf('strategy_%03d', rule_no) AS strategy_id,
         concat_ws(' & ', CASE WHEN gid & 8 = 0 THEN 'precip=' || precip END, CASE WHEN gid & 16 = 0 THEN 'sky=' || sky END,
                   CASE WHEN gid & 4 = 0 THEN 'weekend=' || weekend END) AS target_condition,
         concat_ws(' & ', CASE WHEN gid & 1 = 0 THEN 'category_group=' || category_group END,
                   CASE WHEN gid & 2 = 0 THEN 'type=' || type END) AS recommended_action,
         concat_ws(', ', CASE WHEN gid & 8 = 0 THEN {PRECIP_NAT} END, CASE WHEN gid & 16 = 0 THEN {SKY_NAT} END,
                   CASE WHEN gid & 4 = 0 THEN {WEEKEND_NAT} END) AS condition_text,
         concat_ws(' · ', CASE WHEN gid & 1 = 0 THEN {GROUP_NAT} || ' 노출' END,
                   CASE WHEN gid & 2 = 0 THEN {TYPE_NAT} || ' 노출' END) AS action_text,
         ctr - base_ctr AS expected_ctr_gain, cvr - base_cvr AS expected_cvr_gain, support, confidence, lift,
         0.35 * (ctr - base_ctr) + 0.35 * (cvr - base_cvr)
           + 0.15 * (CASE WHEN max(lift) OVER () > 0 THEN lift / max(lift) OVER () ELSE 0.0 END) + 0.15 * confidence AS strategy_score,
         printf('support=%.3f, confidence=%.3f, lift=%.3f', support, confidence, lift) AS reason, rule_no
  FROM rules),
strat2 AS (SELECT *, target_condition || ' → ' || recommended_action AS strategy_name,
                  condition_text || ' → ' || action_text AS strategy_line FROM strat),
tiered AS (
  SELECT *, CASE WHEN expected_ctr_gain > 0 AND expected_cvr_gain > 0.01 AND lift >= 1.02 AND confidence >= 0.5 THEN 1
                 WHEN expected_ctr_gain > 0 AND expected_cvr_gain > 0.01 AND lift >= 1.02 AND confidence >= 0.45 THEN 2
                 WHEN expected_ctr_gain > 0 AND expected_cvr_gain > 0.01 THEN 3 END AS tier
  FROM strat2),
tiered2 AS (SELECT *, min(tier) OVER () AS best FROM tiered WHERE tier IS NOT NULL),
top AS (
  SELECT * FROM (
    SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY tier, strategy_score DESC, strategy_id) AS INTEGER) AS rank
    FROM tiered2 WHERE (best <= 2 AND tier <= 2) OR best = 3) WHERE rank <= 5)"""

STRATEGY_COLS = ("strategy_id, strategy_name, target_condition, recommended_action, "
                 + ", ".join(_r(c) + f" AS {c}" for c in ("expected_ctr_gain", "expected_cvr_gain", "support",
                                                        "confidence", "lift", "strategy_score"))
                 + ", reason")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


FLAGSHIP = with_(V_CREATIVE, V_LOG, ENRICHED, CUBE, RULES, STRAT)
FLAGSHIP_BIG = with_(V_CREATIVE, V_LOG_BIG, ENRICHED, CUBE, RULES, STRAT)
BASE = with_(V_CREATIVE, V_LOG, ENRICHED)

KPI_AGGS = """coalesce(avg(clicked), 0.0) AS ctr,
  coalesce(avg(CASE WHEN clicked = 1 THEN converted END), 0.0) AS cvr,
  coalesce(avg(converted), 0.0) AS ctcvr"""

ORACLE_SQL["kpi_metrics"] = with_(V_LOG) + f"SELECT {_r('ctr')} AS ctr, {_r('cvr')} AS cvr, {_r('ctcvr')} AS ctcvr FROM (SELECT {KPI_AGGS} FROM v_log)"
ORACLE_SQL["log_counts"] = with_(V_LOG) + "SELECT count(*) AS impression_count, count(DISTINCT user_id) AS user_count FROM v_log"
ORACLE_SQL["kpi_by_creative_type"] = BASE + f"""SELECT creative_type, count(*) AS impression_count, count(DISTINCT user_id) AS user_count,
  {_r('coalesce(avg(clicked), 0.0)')} AS ctr, {_r('coalesce(avg(CASE WHEN clicked = 1 THEN converted END), 0.0)')} AS cvr,
  {_r('coalesce(avg(converted), 0.0)')} AS ctcvr FROM enr GROUP BY creative_type"""
ORACLE_SQL["kpi_sentence"] = with_(V_LOG) + f"""SELECT day, impression_count, user_count, {_r('ctr')} AS ctr, {_r('cvr')} AS cvr, {_r('ctcvr')} AS ctcvr,
  '노출 ' || {_thousands('impression_count')} || '건, 유저 ' || {_thousands('user_count')} || '명 기준 CTR ' || {_pct('ctr')}
  || ', CVR ' || {_pct('cvr')} || ', CTCVR ' || {_pct('ctcvr')} || ' 입니다.' AS summary
FROM (SELECT CAST("timestamp" AS DATE) AS day, count(*) AS impression_count, count(DISTINCT user_id) AS user_count, {KPI_AGGS}
      FROM v_log GROUP BY 1)"""
ORACLE_SQL["per_user_load"] = with_(V_LOG) + f"""SELECT {_r('avg(n)')} AS mean_impressions_per_user, count(*) AS user_count
FROM (SELECT user_id, count(*) AS n FROM v_log GROUP BY user_id)"""
ORACLE_SQL["scenario_ctr"] = BASE + f"""SELECT scenario, category_group, count(*) AS impressions, {_r('coalesce(avg(clicked), 0.0)')} AS ctr
FROM (SELECT *, CASE WHEN is_rainy AND is_weekend = 0 THEN 'rain_weekday'
                     WHEN is_clear AND is_weekend = 1 THEN 'clear_weekend'
                     WHEN coalesce(sky IN ('overcast', 'cloudy'), false) AND NOT is_rainy AND is_weekend = 0 THEN 'overcast_weekday'
                     ELSE 'other' END AS scenario FROM enr)
GROUP BY scenario, category_group"""
ORACLE_SQL["enrich_log"] = BASE + """SELECT impression_id, user_id, creative_id, clicked, converted, creative_type, category, sky, precip,
  is_weekend, is_outdoor, is_indoor, is_clear, is_rainy, category_group FROM enr"""
ORACLE_SQL["impression_items"] = BASE + """SELECT impression_id,
  'sky_' || coalesce(sky, 'nan') || ',precip_' || coalesce(precip, 'nan') || ',weekend_' || CAST(is_weekend AS VARCHAR)
  || ',type_' || coalesce(creative_type, 'nan') || ',category_group_' || category_group AS items FROM enr"""

_ITEMS = {
    "category_group_indoor": "category_group = 'indoor'", "category_group_other": "category_group = 'other'",
    "category_group_outdoor": "category_group = 'outdoor'", "precip_none": "precip = 'none'",
    "precip_rain": "precip = 'rain'", "precip_shower": "precip = 'shower'", "precip_snow": "precip = 'snow'",
    "sky_clear": "sky = 'clear'", "sky_cloudy": "sky = 'cloudy'", "sky_overcast": "sky = 'overcast'",
    "type_event": "creative_type = 'event'", "type_tour": "creative_type = 'tour'",
    "weekend_0": "is_weekend = 0", "weekend_1": "is_weekend = 1",
}
ORACLE_SQL["transaction_matrix"] = BASE + "SELECT impression_id, " + ", ".join(
    f"coalesce({cond}, false) AS {name}" for name, cond in _ITEMS.items()) + " FROM enr"

ORACLE_SQL["frequent_itemsets"] = with_(V_CREATIVE, V_LOG, ENRICHED, CUBE) + f"""SELECT names AS items, size, n,
  {_r('support')} AS support, {_r('ctr')} AS ctr, {_r('cvr')} AS cvr FROM its"""
ORACLE_SQL["frequent_itemsets_general"] = with_(V_CREATIVE, V_LOG, ENRICHED, CUBE) + f"""SELECT names AS items, n,
  {_r('support')} AS support FROM its"""
ORACLE_SQL["association_rules"] = with_(V_CREATIVE, V_LOG, ENRICHED, CUBE, RULES) + f"""SELECT rule_no, antecedents, consequents,
  {_r('antecedent_support')} AS antecedent_support, {_r('consequent_support')} AS consequent_support,
  {_r('support')} AS support, {_r('confidence')} AS confidence, {_r('lift')} AS lift FROM rules"""
ORACLE_SQL["association_rules_big"] = with_(V_CREATIVE, V_LOG_BIG, ENRICHED, CUBE, RULES) + f"""SELECT rule_no, antecedents, consequents,
  {_r('support')} AS support, {_r('confidence')} AS confidence, {_r('lift')} AS lift FROM rules"""
ORACLE_SQL["rule_measures"] = with_(V_CREATIVE, V_LOG, ENRICHED, CUBE, RULES) + f"""SELECT rule_no,
  {_r('support - antecedent_support * consequent_support')} AS leverage,
  {_r('CASE WHEN confidence < 1 THEN (1 - consequent_support) / (1 - confidence) END')} AS conviction,
  {_r('(support - antecedent_support * consequent_support) / greatest(support * (1 - antecedent_support), antecedent_support * (consequent_support - support))')} AS zhangs_metric,
  {_r('support / (antecedent_support + consequent_support - support)')} AS jaccard,
  {_r('(confidence - consequent_support) / (1 - consequent_support)')} AS certainty,
  {_r('(support / antecedent_support + support / consequent_support) / 2')} AS kulczynski
FROM rules"""
ORACLE_SQL["rule_gain"] = with_(V_CREATIVE, V_LOG, ENRICHED, CUBE, RULES) + f"""SELECT rule_no, n AS n_matched, {_r('ctr')} AS ctr,
  {_r('cvr')} AS cvr, {_r('ctr - base_ctr')} AS ctr_gain, {_r('cvr - base_cvr')} AS cvr_gain FROM rules"""
ORACLE_SQL["rule_match"] = with_(V_CREATIVE, V_LOG, ENRICHED, CUBE, RULES) + f"""SELECT rule_no, n AS n_matched, {_r('ctr')} AS ctr,
  {_r('cvr')} AS cvr FROM rules"""
ORACLE_SQL["rule_match_arrays"] = with_(V_CREATIVE, V_LOG, ENRICHED, CUBE, RULES) + f"""SELECT rule_no, n AS n_matched, {_r('ctr')} AS ctr,
  {_r('cvr')} AS cvr, {_r('ctr - base_ctr')} AS ctr_gain, {_r('cvr - base_cvr')} AS cvr_gain FROM rules
UNION ALL SELECT 1000000 AS rule_no, n AS n_matched, {_r('ctr')} AS ctr, {_r('cvr')} AS cvr, 0.0 AS ctr_gain, 0.0 AS cvr_gain FROM tot
UNION ALL SELECT 1000001 AS rule_no, 0 AS n_matched, 0.0 AS ctr, 0.0 AS cvr, 0.0 AS ctr_gain, 0.0 AS cvr_gain"""
ORACLE_SQL["rules_general"] = with_(V_CREATIVE, V_LOG, ENRICHED, CUBE, RULES) + f"""SELECT rule_no, antecedents, consequents, n AS n_matched,
  {_r('support')} AS support, {_r('confidence')} AS confidence, {_r('lift')} AS lift,
  {_r('(support / antecedent_support + support / consequent_support) / 2')} AS kulczynski FROM rules"""
# every split: the antecedent rolls up more dimensions than the itemset, the consequent those that the antecedent keeps
_SIDE = lambda side, gid: " AND ".join(f"({gid} & {bit} <> 0 OR {side}.{d} = r.{d})" for d, bit in (("sky", 16), ("precip", 8), ("weekend", 4), ("type", 2), ("category_group", 1)))
ORACLE_SQL["rules_lattice"] = with_(V_CREATIVE, V_LOG, ENRICHED, CUBE) + f"""SELECT antecedents, consequents, n_matched, {_r('support')} AS support,
  {_r('confidence')} AS confidence, {_r('lift')} AS lift
FROM (SELECT a.names AS antecedents, c.names AS consequents, r.n AS n_matched, r.support, r.support / a.support AS confidence,
             (r.support / a.support) / c.support AS lift
      FROM its r JOIN its a ON (a.gid | r.gid) = a.gid AND a.gid <> r.gid AND {_SIDE('a', 'a.gid')}
      JOIN its c ON c.gid = r.gid + 31 - a.gid AND {_SIDE('c', 'c.gid')})
WHERE confidence >= 0.15 AND lift >= 1.02"""
ORACLE_SQL["strategy_score"] = FLAGSHIP + f"SELECT {STRATEGY_COLS} FROM strat2"
ORACLE_SQL["top_strategies"] = FLAGSHIP + f"SELECT {STRATEGY_COLS}, rank FROM top"
ORACLE_SQL["top_strategies_big"] = FLAGSHIP_BIG + f"SELECT {STRATEGY_COLS}, rank FROM top"
ORACLE_SQL["clause_natural"] = FLAGSHIP + "SELECT strategy_id, condition_text, action_text, strategy_line FROM strat2"
ORACLE_SQL["strategy_display"] = FLAGSHIP + f"""SELECT strategy_line AS "전략", {_fixed('strategy_score', 3)} AS "전략 점수",
  {_pct('expected_ctr_gain')} AS "CTR 개선", {_pct('expected_cvr_gain')} AS "CVR 개선", {_fixed('support', 3)} AS "Support",
  {_fixed('confidence', 3)} AS "Confidence", {_fixed('lift', 3)} AS "Lift", condition_text AS "상황 조건",
  action_text AS "추천 액션" FROM top"""

KPI_ROW = f"""kpi AS (SELECT count(*) AS impression_count, count(DISTINCT user_id) AS user_count, {KPI_AGGS} FROM v_log)"""
ORACLE_SQL["snapshot"] = with_(V_CREATIVE, V_LOG, ENRICHED, CUBE, RULES, STRAT, KPI_ROW) + f"""SELECT impression_count, user_count,
  {_r('ctr')} AS ctr, {_r('cvr')} AS cvr, {_r('ctcvr')} AS ctcvr, CAST(count(*) OVER () AS INTEGER) AS n_strategies, rank, strategy_id,
  {_r('strategy_score')} AS strategy_score FROM kpi, top"""
ORACLE_SQL["sink_json"] = with_(V_CREATIVE, V_LOG, ENRICHED, CUBE, RULES, STRAT, KPI_ROW) + f"""SELECT impression_count, user_count,
  rank, strategy_id, {_r('lift')} AS lift FROM kpi, top"""

PATTERN_LINE = (f"CAST(rank AS VARCHAR) || '. ' || strategy_line || {NL} || '   (support ' || {_fixed('support', 3)}"
                f" || ' · confidence ' || {_fixed('confidence', 3)} || ' · lift ' || {_fixed('lift', 3)} || ')'")
ORACLE_SQL["pattern_summary"] = FLAGSHIP + f"""SELECT CAST(count(*) AS INTEGER) AS n_strategies,
  CASE WHEN count(*) > 0 THEN '연관규칙 기반 유효 대응 사례:' || {NL} || string_agg({PATTERN_LINE}, {NL} ORDER BY rank)
       ELSE '유효 대응 사례가 발굴되지 않았습니다.' END AS pattern_summary FROM top"""

# ---- cleaning adapters and transforms -------------------------------------------------

V_RAW_EVENT = """v_raw_event AS (
  SELECT 'event ' || CAST(k AS VARCHAR) AS TITLE,
    CASE o_orderpriority WHEN '1-URGENT' THEN '축제' WHEN '2-HIGH' THEN '전시' WHEN '3-MEDIUM' THEN '콘서트'
         WHEN '4-NOT SPECIFIED' THEN '교육' ELSE '기타' END AS CODENAME,
    CASE o_orderstatus WHEN 'F' THEN '종로구' WHEN 'O' THEN '중구' ELSE '마포구' END AS GUNAME,
    'hall ' || CAST(k % 50 AS VARCHAR) AS PLACE,
    CASE WHEN k % 5 = 0 AND k % 10 = 5 THEN strftime(d2, '%Y-%m-%d') || '~' || strftime(d, '%Y-%m-%d')
         WHEN k % 5 = 0 THEN strftime(d, '%Y-%m-%d') || '~' || strftime(d2, '%Y-%m-%d')
         WHEN k % 5 = 1 THEN strftime(d, '%Y.%-m.%-d') || ' ~ ' || strftime(d2, '%Y.%-m.%-d')
         WHEN k % 5 = 2 THEN strftime(d, '%Y/%m/%d')
         WHEN k % 5 = 3 THEN ''
         WHEN k % 3 = 0 THEN '2026-13-01' ELSE 'TBD' END AS DATE,
    CASE k % 4 WHEN 0 THEN '무료' WHEN 1 THEN '10,000원' WHEN 3 THEN 'Free entry' END AS USE_FEE,
    o_orderpriority AS ORG_NAME, o_orderstatus AS PROGRAM,
    CASE WHEN k % 3 = 0 THEN 'http://example.org/' || CAST(k AS VARCHAR) END AS HMPG_ADDR,
    CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN ' ' ELSE 'http://img.example.org/' || CAST(k AS VARCHAR) END AS MAIN_IMG,
    CAST(o_custkey AS VARCHAR) || '.5' AS LOT,
    CASE WHEN k % 11 = 0 THEN 'n/a' ELSE CAST(k % 90 AS VARCHAR) || '.25' END AS LAT,
    CASE WHEN k % 7 = 0 THEN strftime(d, '%Y%m%d') WHEN k % 7 = 1 THEN '' END AS START_DATE,
    CASE WHEN k % 7 = 1 THEN strftime(d, '%Y-%m-%d') || ' 00:00:00.0' END AS STRTDATE,
    CASE WHEN k % 7 = 0 THEN strftime(d2, '%Y%m%d') END AS END_DATE,
    CASE WHEN k % 14 = 1 THEN strftime(d2, '%Y-%m-%d') END AS ENDDATE,
    k AS ordinal
  FROM (SELECT *, o_orderkey AS k, CAST(o_orderdate AS DATE) AS d,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INTEGER) AS d2 FROM orders))"""


def _parse_date(x: str) -> str:
    """Loose date → DATE (trim, . and / → -, 8 digits → ISO, day prefix with optional time)."""
    s = f"replace(replace(trim({x}), '.', '-'), '/', '-')"
    s2 = (f"(CASE WHEN regexp_full_match({s}, '[0-9]{{8}}') THEN substr({s}, 1, 4) || '-' || substr({s}, 5, 2) || '-' "
          f"|| substr({s}, 7, 2) ELSE {s} END)")
    day = f"regexp_extract({s2}, '^([0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}})(?:[ T].*)?$', 1)"
    return f"CAST(try_strptime(nullif({day}, ''), '%Y-%m-%d') AS DATE)"


_TOK = r"[0-9]{4}[-./][0-9]{1,2}[-./][0-9]{1,2}"
_RANGE = rf"({_TOK})\s*[~\-–]\s*({_TOK})"
_SINGLE = rf"({_TOK})"

EVENT_CLEAN = f"""ev0 AS (
  SELECT *, {_parse_date("coalesce(nullif(START_DATE, ''), STRTDATE)")} AS s_exp,
            {_parse_date("coalesce(nullif(END_DATE, ''), ENDDATE)")} AS e_exp,
            coalesce(regexp_matches(DATE, '{_RANGE}'), false) AS is_range,
            coalesce(regexp_matches(DATE, '{_SINGLE}'), false) AS is_single,
            {_parse_date(f"regexp_extract(DATE, '{_RANGE}', 1)")} AS r1,
            {_parse_date(f"regexp_extract(DATE, '{_RANGE}', 2)")} AS r2,
            {_parse_date(f"regexp_extract(DATE, '{_SINGLE}', 1)")} AS one
  FROM v_raw_event),
ev1 AS (
  SELECT *, CASE WHEN s_exp IS NOT NULL OR e_exp IS NOT NULL THEN s_exp WHEN is_range THEN r1 WHEN is_single THEN one END AS sd,
            CASE WHEN s_exp IS NOT NULL OR e_exp IS NOT NULL THEN e_exp WHEN is_range THEN r2 WHEN is_single THEN one END AS ed,
            lower(trim(USE_FEE)) AS fee
  FROM ev0),
ev AS (
  SELECT TITLE AS title, CODENAME AS codename, GUNAME AS guname, PLACE AS place, DATE AS date_text, USE_FEE AS use_fee,
         ORG_NAME AS org_name, PROGRAM AS program, HMPG_ADDR AS hmpg_addr, MAIN_IMG AS main_img, LOT AS lot, LAT AS lat,
         sd AS start_date, ed AS end_date,
         CASE WHEN fee IS NULL OR fee = '' THEN NULL WHEN contains(fee, '무료') OR contains(fee, 'free') THEN true
              WHEN contains(fee, '유료') OR contains(fee, '원') THEN false END AS is_free,
         CAST(month(sd) AS INTEGER) AS month, lower(dayname(sd)) AS weekday,
         {_case('CAST(month(sd) AS INTEGER)', LK.SEASON_BY_MONTH)} AS season,
         CAST(date_diff('day', sd, ed) + 1 AS INTEGER) AS duration_days,
         coalesce(length(trim(MAIN_IMG)) > 0, false) AS has_image,
         coalesce(length(trim(HMPG_ADDR)) > 0, false) AS has_website, ordinal
  FROM ev1)"""

EVENT_COLS = ("title, codename, guname, place, date_text, use_fee, org_name, program, hmpg_addr, main_img, lot, lat, "
              "start_date, end_date, is_free, month, weekday, season, duration_days, has_image, has_website")
ORACLE_SQL["event_clean"] = with_(V_RAW_EVENT, EVENT_CLEAN) + f"SELECT {EVENT_COLS}, ordinal FROM ev"
ORACLE_SQL["stream_clean_events"] = ORACLE_SQL["event_clean"]
RAW_EVENT_COLS = ("TITLE, CODENAME, GUNAME, PLACE, DATE, USE_FEE, ORG_NAME, PROGRAM, HMPG_ADDR, MAIN_IMG, LOT, LAT, "
                  "START_DATE, STRTDATE, END_DATE, ENDDATE, ordinal")
ORACLE_SQL["scan_raw_json"] = with_(V_RAW_EVENT) + f"SELECT {RAW_EVENT_COLS} FROM v_raw_event"
_PLACE = """CAST((dense_rank() OVER (ORDER BY floor(ordinal / 500)) - 1) * 4294967296
  + row_number() OVER (PARTITION BY floor(ordinal / 500) ORDER BY ordinal) - 1 AS BIGINT) AS ordinal"""
ORACLE_SQL["scan_raw_array"] = with_(V_RAW_EVENT) + f"SELECT {RAW_EVENT_COLS.removesuffix('ordinal')}{_PLACE} FROM v_raw_event"
ORACLE_SQL["limit_rows"] = with_(V_RAW_EVENT) + "SELECT ordinal, TITLE, DATE FROM v_raw_event ORDER BY ordinal LIMIT 1000"

EVENT_CREATIVES = f"""evc AS (
  SELECT printf('event_%06d', ROW_NUMBER() OVER (ORDER BY ordinal) - 1) AS creative_id, 'event' AS creative_type, title,
         guname AS district, codename AS category, season, month, weekday, is_free, has_image, has_website,
         TRY_CAST(lat AS DOUBLE) AS latitude, TRY_CAST(lot AS DOUBLE) AS longitude, ordinal
  FROM ev)"""
CREATIVE_COLS = ("creative_id, creative_type, title, district, category, season, month, weekday, is_free, has_image, "
                 "has_website, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude")
ORACLE_SQL["event_creatives"] = with_(V_RAW_EVENT, EVENT_CLEAN, EVENT_CREATIVES) + f"SELECT {CREATIVE_COLS} FROM evc"

V_RAW_TOUR = """v_raw_tour AS (
  SELECT CAST(c_custkey AS VARCHAR) AS contentid,
    CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '12' WHEN 'FURNITURE' THEN ' 14 ' WHEN 'MACHINERY' THEN '39.0'
         WHEN 'BUILDING' THEN '38' ELSE '99' END AS contenttypeid,
    c_name AS title,
    CASE WHEN c_custkey % 17 <> 0 THEN n_name END AS addr1,
    CASE c_custkey % 3 WHEN 0 THEN ' ' WHEN 1 THEN ' Apt ' || CAST(c_custkey AS VARCHAR) END AS addr2,
    '1' AS areacode,
    CASE c_custkey % 4 WHEN 0 THEN CAST(c_nationkey + 1 AS VARCHAR) WHEN 1 THEN CAST(c_nationkey + 1 AS VARCHAR) || '.0'
         WHEN 2 THEN '' ELSE 'x' END AS sigungucode,
    'A0' || CAST(c_nationkey % 3 AS VARCHAR) AS cat1, 'A02' || CAST(c_nationkey % 5 AS VARCHAR) AS cat2,
    'A020' || CAST(c_nationkey % 7 AS VARCHAR) AS cat3,
    c_acctbal AS acct, c_custkey % 10 = 0 AS no_x,
    CAST(c_nationkey AS VARCHAR) || '.5' AS mapy,
    CASE WHEN c_custkey % 2 = 0 THEN 'http://img.example.org/c' || CAST(c_custkey AS VARCHAR) ELSE '' END AS firstimage,
    CAST(NULL AS VARCHAR) AS firstimage2, '20240101000000' AS createdtime, '20240102000000' AS modifiedtime,
    c_custkey AS ordinal
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

TOUR_CLEAN = f"""tr AS (
  SELECT contentid AS content_id, contenttypeid AS content_type_id, title,
         concat_ws(' ', nullif(trim(addr1), ''), nullif(trim(addr2), '')) AS address,
         areacode AS area_code, sigungucode AS sigungu_code, cat1 AS category_large, cat2 AS category_middle,
         cat3 AS category_small,
         CASE WHEN no_x THEN NULL ELSE acct END AS longitude, TRY_CAST(mapy AS DOUBLE) AS latitude,
         firstimage AS image_url, firstimage2 AS thumbnail_url, createdtime AS created_time, modifiedtime AS modified_time,
         coalesce(length(trim(firstimage)) > 0, false) AS has_image,
         {_case('trim(contenttypeid)', LK.CONTENT_TYPE_NAMES)} AS content_type_name,
         CASE WHEN trim(sigungucode) <> '' THEN
           {_case('CAST(trunc(TRY_CAST(sigungucode AS DOUBLE)) AS INTEGER)', LK.DISTRICT_NAMES)} END AS district,
         ordinal
  FROM v_raw_tour)"""
TOUR_COLS = ("content_id, content_type_id, title, address, area_code, sigungu_code, category_large, category_middle, "
             "category_small, round(longitude, 6) AS longitude, round(latitude, 6) AS latitude, image_url, thumbnail_url, "
             "created_time, modified_time, has_image, content_type_name, district")
ORACLE_SQL["tour_clean"] = with_(V_RAW_TOUR, TOUR_CLEAN) + f"SELECT {TOUR_COLS}, ordinal FROM tr"
TOUR_CREATIVES = """trc AS (
  SELECT 'tour_' || CAST(CAST(trunc(TRY_CAST(content_id AS DOUBLE)) AS BIGINT) AS VARCHAR) AS creative_id,
         'tour' AS creative_type, title, district, content_type_name AS category, CAST(NULL AS VARCHAR) AS season,
         CAST(NULL AS INTEGER) AS month, CAST(NULL AS VARCHAR) AS weekday, CAST(NULL AS BOOLEAN) AS is_free, has_image,
         CAST(NULL AS BOOLEAN) AS has_website, latitude, longitude, ordinal
  FROM tr)"""
ORACLE_SQL["tour_creatives"] = with_(V_RAW_TOUR, TOUR_CLEAN, TOUR_CREATIVES) + f"SELECT {CREATIVE_COLS} FROM trc"
ORACLE_SQL["creative_catalog"] = with_(V_RAW_EVENT, EVENT_CLEAN, EVENT_CREATIVES, V_RAW_TOUR, TOUR_CLEAN, TOUR_CREATIVES) + f"""
SELECT {CREATIVE_COLS} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY creative_id ORDER BY src, ordinal) AS rn
  FROM (SELECT *, 0 AS src FROM evc UNION ALL SELECT *, 1 AS src FROM trc)) WHERE rn = 1"""
ORACLE_SQL["conform_schema"] = with_(V_RAW_TOUR) + """SELECT contentid, CAST(NULL AS VARCHAR) AS contenttypeid, title,
  CAST(NULL AS VARCHAR) AS addr1, CAST(NULL AS VARCHAR) AS addr2, CAST(NULL AS VARCHAR) AS areacode,
  CAST(NULL AS VARCHAR) AS sigungucode, CAST(NULL AS VARCHAR) AS cat1, CAST(NULL AS VARCHAR) AS cat2,
  CAST(NULL AS VARCHAR) AS cat3, CASE WHEN no_x THEN 'n/a' ELSE CAST(acct AS VARCHAR) END AS mapx, CAST(NULL AS VARCHAR) AS mapy,
  CAST(NULL AS VARCHAR) AS firstimage, CAST(NULL AS VARCHAR) AS firstimage2, CAST(NULL AS VARCHAR) AS createdtime,
  CAST(NULL AS VARCHAR) AS modifiedtime, ordinal FROM v_raw_tour"""

V_RAW_WEATHER = """v_raw_weather AS (
  SELECT strftime(ts, '%Y%m%d') AS baseDate, '0200' AS baseTime, strftime(ts, '%Y%m%d') AS fcstDate,
    CASE WHEN event_id % 97 <> 0 THEN strftime(ts, '%H') || '00' END AS fcstTime,
    CASE event_type WHEN 'view' THEN 'TMP' WHEN 'click' THEN 'SKY' WHEN 'purchase' THEN 'PTY' WHEN 'signup' THEN 'POP'
         ELSE 'PCP' END AS category,
    CASE WHEN event_id % 13 = 0 THEN NULL
         WHEN event_type = 'view' THEN CAST(CAST(floor(value) AS BIGINT) % 35 AS VARCHAR) || '.5'
         WHEN event_type = 'click' THEN CAST(CAST(floor(value) AS BIGINT) % 4 + 1 AS VARCHAR)
         WHEN event_type = 'purchase' THEN CAST(CAST(floor(value) AS BIGINT) % 5 AS VARCHAR)
         WHEN event_type = 'signup' THEN CAST(CAST(floor(value) AS BIGINT) % 100 AS VARCHAR)
         ELSE '강수없음' END AS fcstValue,
    event_id AS ordinal
  FROM events)"""

_MEASURES = LK.FORECAST_CATEGORIES
WEATHER_PIVOT = ("""wp0 AS (
  SELECT baseDate AS base_date, baseTime AS base_time, fcstDate AS fcst_date, fcstTime AS fcst_time, """
                 + ", ".join(f"arg_min(fcstValue, ordinal) FILTER (WHERE category = '{c}' AND fcstValue IS NOT NULL) AS {n}"
                             for c, n in _MEASURES.items())
                 + """
  FROM v_raw_weather
  WHERE category IN ('TMP', 'SKY', 'PTY', 'POP', 'REH', 'WSD') AND baseDate IS NOT NULL AND baseTime IS NOT NULL
    AND fcstDate IS NOT NULL AND fcstTime IS NOT NULL
  GROUP BY ALL),
wp1 AS (
  SELECT base_date, base_time, fcst_date, fcst_time, """
                 + ", ".join(f"TRY_CAST({n} AS DOUBLE) AS {n}" for n in _MEASURES.values())
                 + " FROM wp0 WHERE " + " OR ".join(f"{n} IS NOT NULL" for n in _MEASURES.values()) + """),
wp AS (
  SELECT *, CASE WHEN sky_status = floor(sky_status) THEN """ + _case("CAST(sky_status AS INTEGER)", LK.SKY_STATUS_NAMES)
                 + """ END AS sky_status_name,
         CASE WHEN precipitation_type = floor(precipitation_type) THEN """
                 + _case("CAST(precipitation_type AS INTEGER)", LK.PRECIPITATION_TYPE_NAMES) + """ END AS precipitation_type_name
  FROM wp1)""")
ORACLE_SQL["weather_pivot"] = with_(V_RAW_WEATHER, WEATHER_PIVOT) + """SELECT base_date, base_time, fcst_date, fcst_time,
  round(temperature, 6) AS temperature, round(sky_status, 6) AS sky_status, round(precipitation_type, 6) AS precipitation_type,
  round(precipitation_probability, 6) AS precipitation_probability, round(humidity, 6) AS humidity,
  round(wind_speed, 6) AS wind_speed, sky_status_name, precipitation_type_name FROM wp"""

CONTEXT = """ctx AS (
  SELECT * FROM (
    SELECT CAST(CAST(trunc(TRY_CAST(fcst_date AS DOUBLE)) AS INTEGER) AS VARCHAR) || '_'
             || CAST(CAST(trunc(TRY_CAST(fcst_time AS DOUBLE)) AS INTEGER) AS VARCHAR) AS context_id,
           CAST(trunc(TRY_CAST(base_date AS DOUBLE)) AS INTEGER) AS base_date_i,
           CAST(trunc(TRY_CAST(base_time AS DOUBLE)) AS INTEGER) AS base_time_i,
           CAST(trunc(TRY_CAST(fcst_date AS DOUBLE)) AS INTEGER) AS fcst_date_i,
           CAST(trunc(TRY_CAST(fcst_time AS DOUBLE)) AS INTEGER) AS fcst_time_i, *,
           ROW_NUMBER() OVER (PARTITION BY fcst_date, fcst_time ORDER BY base_date, base_time, fcst_date, fcst_time) AS rn
    FROM wp) WHERE rn = 1)"""
ORACLE_SQL["context_catalog"] = with_(V_RAW_WEATHER, WEATHER_PIVOT, CONTEXT) + """SELECT context_id, base_date_i AS base_date,
  base_time_i AS base_time, fcst_date_i AS fcst_date, fcst_time_i AS fcst_time, round(temperature, 6) AS temperature,
  round(sky_status, 6) AS sky_status, sky_status_name, round(precipitation_probability, 6) AS precipitation_probability,
  round(precipitation_type, 6) AS precipitation_type, precipitation_type_name, round(humidity, 6) AS humidity,
  round(wind_speed, 6) AS wind_speed FROM ctx"""
ORACLE_SQL["context_flags"] = with_(V_RAW_WEATHER, WEATHER_PIVOT, CONTEXT) + """SELECT context_id, forecast_ts, is_weekend, rainy,
  clear, overcast
FROM (SELECT context_id, ts AS forecast_ts, coalesce(isodow(ts) >= 6, false) AS is_weekend,
             coalesce(precipitation_type_name NOT IN ('none', ''), false) AS rainy,
             coalesce(sky_status_name = 'clear', false) AND NOT coalesce(precipitation_type_name NOT IN ('none', ''), false) AS clear,
             coalesce(sky_status_name IN ('overcast', 'cloudy'), false)
               AND NOT coalesce(precipitation_type_name NOT IN ('none', ''), false) AS overcast
      FROM (SELECT *, try_strptime(CAST(fcst_date_i AS VARCHAR) || lpad(CAST(fcst_time_i AS VARCHAR), 4, '0'), '%Y%m%d%H%M') AS ts
            FROM ctx))"""

# ---- segments ---------------------------------------------------------------------------

def _sub_ctr(cond: str) -> str:
    return f"coalesce(avg(CASE WHEN {cond} THEN clicked END), 0.0)"


USER_FEATURES = f"""uf AS (
  SELECT user_id, count(*) AS impression_count, coalesce(avg(clicked), 0.0) AS overall_ctr,
         coalesce(avg(CASE WHEN clicked = 1 THEN converted END), 0.0) AS overall_cvr,
         {_sub_ctr('is_outdoor')} AS outdoor_ctr, {_sub_ctr('is_indoor')} AS indoor_ctr,
         avg(CAST(is_weekend AS DOUBLE)) AS weekend_ratio, {_sub_ctr('is_clear')} AS clear_weather_ctr,
         {_sub_ctr('is_rainy')} AS rainy_weather_ctr, {_sub_ctr("creative_type = 'event'")} AS event_ctr,
         {_sub_ctr("creative_type = 'tour'")} AS tour_ctr
  FROM enr GROUP BY user_id)"""
FEATURES = ["impression_count", "overall_ctr", "overall_cvr", "outdoor_ctr", "indoor_ctr", "weekend_ratio",
            "clear_weather_ctr", "rainy_weather_ctr", "event_ctr", "tour_ctr"]
ORACLE_SQL["user_features"] = with_(V_CREATIVE, V_LOG, ENRICHED, USER_FEATURES) + "SELECT user_id, impression_count, " + ", ".join(
    f"{_r(c)} AS {c}" for c in FEATURES[1:]) + " FROM uf"
ORACLE_SQL["zscore_features"] = with_(V_CREATIVE, V_LOG, ENRICHED, USER_FEATURES) + "SELECT user_id, " + ", ".join(
    f"{_r(f'CASE WHEN stddev_pop({c}) OVER () > 0 THEN ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () ELSE 0.0 END')} AS {c}"
    for c in FEATURES) + " FROM uf"

SILHOUETTE = """pe AS (
  SELECT vec_id, label, CAST(UNNEST(embedding) AS DOUBLE) AS x, UNNEST(range(len(embedding))) AS pos FROM embeddings),
nrm AS (SELECT vec_id, label, sum(x * x) AS nrm FROM pe GROUP BY vec_id, label),
cs AS (SELECT label AS c, pos, sum(x) AS s FROM pe GROUP BY label, pos),
csz AS (SELECT label AS c, count(*) AS n, sum(nrm) AS q FROM nrm GROUP BY label),
dots AS (SELECT pe.vec_id, cs.c, sum(pe.x * cs.s) AS dot FROM pe JOIN cs ON pe.pos = cs.pos GROUP BY pe.vec_id, cs.c),
dist AS (
  SELECT d.vec_id, n.label, d.c, z.n, n.nrm + z.q / z.n - 2 * d.dot / z.n AS d
  FROM dots d JOIN nrm n ON d.vec_id = n.vec_id JOIN csz z ON d.c = z.c),
ab AS (
  SELECT vec_id, label, max(CASE WHEN c = label THEN d * n / (n - 1) END) AS a, max(CASE WHEN c = label THEN n END) AS n_own,
         min(CASE WHEN c <> label THEN d END) AS b
  FROM dist GROUP BY vec_id, label),
sil AS (
  SELECT vec_id, label, CASE WHEN n_own <= 1 THEN 0.0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0.0 END AS silhouette
  FROM ab)"""
ORACLE_SQL["silhouette_points"] = with_(SILHOUETTE) + "SELECT vec_id, label, round(silhouette, 6) AS silhouette FROM sil"
ORACLE_SQL["silhouette"] = with_(SILHOUETTE) + """SELECT round(avg(silhouette), 6) AS silhouette, count(DISTINCT label) AS n_clusters,
  count(*) AS n_points FROM sil"""

# ---- evaluation ----------------------------------------------------------------------------

TRIALS = """tri AS (
  SELECT printf('case_%03d', doc_id % 97) AS case_id, CAST(floor(doc_id / 97) + 1 AS INTEGER) AS trial,
         (quality = 1 AND toxic = 0) AS passed FROM labels),
pos AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY case_id ORDER BY trial) AS p FROM tri),
cases AS (
  SELECT case_id, coalesce(bool_or(passed) FILTER (WHERE p <= 3), false) AS pass_at_k,
         (count(*) FILTER (WHERE p <= 3) >= 3 AND coalesce(bool_and(passed) FILTER (WHERE p <= 3), true)) AS pass_pow_k,
         coalesce(bool_or(passed) FILTER (WHERE p = 1), false) AS pass_at_1,
         string_agg(CASE WHEN passed THEN 'true' ELSE 'false' END, ',' ORDER BY p) FILTER (WHERE p <= 3) AS first_k
  FROM pos GROUP BY case_id)"""
ORACLE_SQL["pass_at_k"] = with_(TRIALS) + "SELECT case_id, pass_at_k, pass_pow_k, pass_at_1, first_k FROM cases"
ORACLE_SQL["eval_suite"] = with_(TRIALS) + """SELECT 3 AS k, 3 AS trials, count(*) AS case_count,
  round(coalesce(avg(CAST(pass_at_k AS DOUBLE)), 0.0), 6) AS pass_at_k, round(coalesce(avg(CAST(pass_pow_k AS DOUBLE)), 0.0), 6) AS pass_pow_k,
  round(coalesce(avg(CAST(pass_at_1 AS DOUBLE)), 0.0), 6) AS pass_at_1 FROM cases"""


def _kw_list(mapping: dict) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN [{', '.join(_q(w) for w in v)}]" for k, v in mapping.items())
    return f"(CASE lang {whens} ELSE CAST([] AS VARCHAR[]) END)"


def _ids(n: str) -> str:
    return f"list_transform(range(1, CAST({n} AS BIGINT) + 1), lambda i: printf('strategy_%03d', i))"


def _pylist(ids: str) -> str:
    return f"('[' || array_to_string(list_transform(list_sort(list_distinct({ids})), lambda x: '''' || x || ''''), ', ') || ']')"


GRADE = f"""gc AS (
  SELECT doc_id AS case_id, doc_id % 3 <> 0 AS expected_approved, {_ids('doc_id % 3 + 1')} AS expected_ids,
         {_kw_list(REQUIRED_KEYWORDS)} AS req, {_kw_list(FORBIDDEN_KEYWORDS)} AS forb FROM documents),
rr AS (
  SELECT d.doc_id AS case_id, coalesce(l.quality = 1, false) AS approved, {_ids('d.n_chars % 3 + 1')} AS actual_ids,
         concat_ws(' ', d.source, d.text, d.lang) AS blob
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
g AS (
  SELECT gc.case_id, list_concat(
      CASE WHEN approved <> expected_approved THEN ['critic 승인 불일치 (expected=' || CASE WHEN expected_approved THEN 'True' ELSE 'False' END
           || ', actual=' || CASE WHEN approved THEN 'True' ELSE 'False' END || ')'] ELSE CAST([] AS VARCHAR[]) END,
      CASE WHEN list_sort(list_distinct(expected_ids)) <> list_sort(list_distinct(actual_ids))
           THEN ['strategy_id 불일치 (expected=' || {_pylist('expected_ids')} || ', actual=' || {_pylist('actual_ids')} || ')']
           ELSE CAST([] AS VARCHAR[]) END,
      list_transform(list_filter(req, lambda k: NOT contains(blob, k)), lambda k: '필수 키워드 누락: ' || k),
      list_transform(list_filter(forb, lambda k: contains(blob, k)), lambda k: '금지 키워드 포함: ' || k)) AS reasons
  FROM gc JOIN rr ON gc.case_id = rr.case_id)"""
ORACLE_SQL["grade_cases"] = with_(GRADE) + """SELECT case_id, len(reasons) = 0 AS passed, CAST(len(reasons) AS INTEGER) AS n_reasons,
  array_to_string(reasons, ' | ') AS reasons FROM g"""
ORACLE_SQL["graded_suite"] = with_(GRADE.replace("SELECT d.doc_id AS case_id, coalesce(l.quality = 1, false) AS approved",
    "SELECT d.doc_id AS case_id, t.trial, (t.trial = 2) <> coalesce(l.quality = 1, false) AS approved").replace(
    "ON d.doc_id = l.doc_id)", "ON d.doc_id = l.doc_id, (SELECT unnest([1, 2, 3]) AS trial) t)").replace(
    "SELECT gc.case_id, list_concat(", "SELECT gc.case_id, rr.trial, list_concat(")) + """SELECT 3 AS k, 3 AS trials, count(*) AS case_count,
  round(avg(CAST(p1 OR p2 OR p3 AS DOUBLE)), 6) AS pass_at_k, round(avg(CAST(p1 AND p2 AND p3 AS DOUBLE)), 6) AS pass_pow_k,
  round(avg(CAST(p1 AS DOUBLE)), 6) AS pass_at_1
FROM (SELECT case_id, bool_or(trial = 1 AND len(reasons) = 0) AS p1, bool_or(trial = 2 AND len(reasons) = 0) AS p2,
             bool_or(trial = 3 AND len(reasons) = 0) AS p3 FROM g GROUP BY case_id)"""
ORACLE_SQL["case_trials"] = "SELECT doc_id AS case_id, CAST(UNNEST(range(1, 4)) AS INTEGER) AS trial FROM documents"
ORACLE_SQL["case_filter"] = """SELECT doc_id AS case_id, doc_id % 3 <> 0 AS expected_approved FROM documents
WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)"""

# ---- reconciliation -------------------------------------------------------------------------

TRUTH = """truth AS (
  SELECT l_suppkey AS ordinal, printf('strategy_%03d', l_suppkey) AS strategy_id, printf('supplier %d', l_suppkey) AS reason,
         avg(l_discount) AS expected_ctr_gain, avg(l_tax) AS expected_cvr_gain,
         avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS support,
         avg(CASE WHEN l_linestatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS confidence,
         avg(l_quantity) / 25.5 AS lift, avg(l_extendedprice) / 100000.0 AS strategy_score
  FROM lineitem GROUP BY l_suppkey),
reported AS (
  SELECT CASE WHEN ordinal % 13 = 0 THEN printf('strategy_x%03d', ordinal) ELSE strategy_id END AS strategy_id, ordinal,
         CASE WHEN ordinal % 7 = 0 THEN expected_ctr_gain + 0.5 ELSE expected_ctr_gain END AS expected_ctr_gain,
         expected_cvr_gain, support, confidence,
         CASE WHEN ordinal % 11 = 0 THEN lift * 1.1 ELSE lift END AS lift, strategy_score
  FROM truth),
checks AS (
""" + "\n  UNION ALL\n".join(
    f"  SELECT r.strategy_id, r.ordinal, {i} AS metric_pos, '{m}' AS metric, t.{m} AS expected, r.{m} AS actual "
    f"FROM reported r JOIN truth t ON r.strategy_id = t.strategy_id"
    for i, m in enumerate(["expected_ctr_gain", "expected_cvr_gain", "support", "confidence", "lift", "strategy_score"])) + """),
issues AS (
  SELECT strategy_id, ordinal, -1 AS metric_pos, CAST(NULL AS VARCHAR) AS metric, CAST(NULL AS DOUBLE) AS expected,
         CAST(NULL AS DOUBLE) AS actual
  FROM reported WHERE strategy_id NOT IN (SELECT strategy_id FROM truth)
  UNION ALL
  SELECT * FROM checks WHERE abs(actual - expected) > 1e-6)"""
ORACLE_SQL["reconcile_metrics"] = with_(TRUTH) + """SELECT strategy_id, CAST(metric_pos AS INTEGER) AS metric_pos, metric,
  round(expected, 6) AS expected, round(actual, 6) AS actual FROM issues"""
ORACLE_SQL["unknown_ids"] = with_(TRUTH) + """SELECT strategy_id, '하층 파이프라인에 없는 strategy_id' AS issue FROM issues
WHERE metric IS NULL"""
ORACLE_SQL["merge_issues"] = with_(TRUTH) + """SELECT strategy_id, 'python' AS source, count(*) AS n_issues FROM issues GROUP BY strategy_id
UNION ALL
SELECT strategy_id, 'model' AS source, count(*) AS n_issues FROM truth WHERE ordinal % 9 = 0 GROUP BY strategy_id"""
ORACLE_SQL["merge_narratives"] = with_(TRUTH) + """SELECT t.strategy_id, coalesce(n.narrative, t.reason) AS operational_reason
FROM truth t LEFT JOIN (SELECT printf('strategy_%03d', conv_id % 150) AS strategy_id, arg_max(text, conv_id * 1000 + turn) AS narrative
                        FROM conversations GROUP BY 1) n ON t.strategy_id = n.strategy_id"""

# ---- sampling ------------------------------------------------------------------------------

ORACLE_SQL["weighted_choice"] = """SELECT l_suppkey, l_orderkey, l_linenumber, round(w, 6) AS weight FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY -ln(u) / w, l_orderkey, l_linenumber) AS rn FROM (
    SELECT l_suppkey, l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS w,
           (CAST(('0x' || substr(md5('42|' || l_suppkey || '|' || l_orderkey || '|' || l_linenumber), 1, 13)) AS BIGINT) + 0.5)
             / 4503599627370496.0 AS u
    FROM lineitem) WHERE w > 0) WHERE rn = 1"""

# ---- row operators, ids, texts -----------------------------------------------------------

ORACLE_SQL["dedupe_first"] = with_(V_LOG) + """SELECT user_id, impression_id, "timestamp", creative_id FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY "timestamp", impression_id) AS rn FROM v_log) WHERE rn = 1"""
ORACLE_SQL["format_ids"] = """SELECT printf('imp_%06d', event_id) AS impression_key, printf('user_%04d', user_id + 1) AS user_key,
  printf('segment_%d', user_id % 4) AS segment_key FROM events"""
ORACLE_SQL["issue_slot"] = """SELECT event_id, strftime(CASE WHEN h < 2 THEN t - INTERVAL 1 DAY ELSE t END, '%Y%m%d') AS base_date,
  CASE WHEN h < 2 THEN '2300' ELSE lpad(CAST(CAST(2 + 3 * floor((h - 2) / 3) AS INTEGER) AS VARCHAR), 2, '0') || '00' END AS base_time
FROM (SELECT event_id, t, hour(t) AS h FROM (SELECT event_id, ts + INTERVAL 9 HOUR - INTERVAL 40 MINUTE AS t FROM events))"""
ORACLE_SQL["truncate_text"] = """SELECT doc_id, CASE WHEN length(text) > 180 THEN substr(text, 1, 177) || '...' ELSE text END AS short_text
FROM documents"""

# ---- sources and sinks ----------------------------------------------------------------------

ORACLE_SQL["scan_csv_roundtrip"] = BASE + """SELECT impression_id, user_id, creative_id, clicked, converted, sky, precip, is_weekend
FROM enr"""
ORACLE_SQL["scan_csv_ranges"] = "SELECT doc_id, nullif(text, '') AS text, lang, source, n_chars FROM documents"
ORACLE_SQL["scan_latest"] = with_(V_LOG) + "SELECT impression_id, user_id, clicked FROM v_log"
ORACLE_SQL["sink_snapshot"] = with_(V_CREATIVE) + "SELECT creative_id, creative_type, title, category, has_image, is_free FROM v_creative"

PAGES = """pg AS (
  SELECT CAST(floor(event_id / 100) AS BIGINT) AS page_id, * FROM events),
pgs AS (
  SELECT page_id, count(*) AS n_rows, min(event_id) AS first_id,
         CASE page_id % 3 WHEN 0 THEN 'cultural_event' WHEN 1 THEN 'tour' ELSE 'weather' END AS feed,
         page_id % 17 <> 0 AS ok
  FROM pg GROUP BY page_id)"""
ORACLE_SQL["decode_envelope"] = with_(PAGES) + """SELECT page_id, feed, item_pos, event_id, user_id, event_type, round(value, 6) AS value
FROM (SELECT p.page_id, s.feed, CAST(ROW_NUMBER() OVER (PARTITION BY p.page_id ORDER BY p.event_id) - 1 AS INTEGER) AS item_pos,
             p.event_id, p.user_id, p.event_type, p.value
      FROM pg p JOIN pgs s ON p.page_id = s.page_id
      WHERE s.ok AND p.page_id % 19 <> 0 AND (p.page_id % 13 <> 0 OR p.event_id = s.first_id))"""
ORACLE_SQL["landing_gaps"] = with_(PAGES) + """, tgt AS (SELECT feed, CAST(sum(n_rows) AS BIGINT) AS target FROM pgs GROUP BY feed),
plan AS (SELECT feed, target, UNNEST(range(1, target + 1, 100)) AS start_index FROM tgt),
plan2 AS (SELECT feed, start_index, least(start_index + 99, target) AS end_index FROM plan),
landed AS (
  SELECT feed, CAST(floor(page_id / 3) * 100 + 1 AS BIGINT) AS start_index,
         CASE WHEN page_id % 19 = 0 THEN 0 WHEN page_id % 13 = 0 THEN 1 ELSE n_rows END AS n_items
  FROM pgs WHERE ok)
SELECT p.feed, p.start_index, p.end_index, 'missing' AS status, 0 AS n_items
FROM plan2 p WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.feed = p.feed AND l.start_index = p.start_index)
UNION ALL
SELECT p.feed, p.start_index, p.end_index, 'short' AS status, CAST(l.n_items AS INTEGER) AS n_items
FROM plan2 p JOIN landed l ON l.feed = p.feed AND l.start_index = p.start_index
WHERE l.n_items < p.end_index - p.start_index + 1"""

_N_ITEMS = "CASE WHEN page_id % 19 = 0 THEN 0 WHEN page_id % 13 = 0 THEN 1 ELSE n_rows END"
ORACLE_SQL["landing_gaps_ranges"] = with_(PAGES) + f""", tgt AS (SELECT feed, CAST(sum(n_rows) AS BIGINT) AS target FROM pgs GROUP BY feed),
want AS (SELECT feed, unnest(range(1, target + 1)) AS p FROM tgt),
have AS (
  SELECT DISTINCT feed, unnest(range(a, a + n)) AS p
  FROM (SELECT feed, CAST(floor(page_id / 3) * 100 + 1 + CASE page_id % 5 WHEN 1 THEN 7 WHEN 2 THEN -13 ELSE 0 END AS BIGINT) AS a, {_N_ITEMS} AS n FROM pgs WHERE ok)),
miss AS (SELECT feed, p, p - row_number() OVER (PARTITION BY feed ORDER BY p) AS island FROM (SELECT * FROM want EXCEPT SELECT * FROM have))
SELECT feed, min(p) AS first, max(p) AS last, count(*) AS n_missing FROM miss GROUP BY feed, island"""
ORACLE_SQL["landing_quarantine"] = with_(PAGES) + """SELECT page_id, feed, item_pos, problem
FROM (SELECT p.page_id, s.feed, CAST(ROW_NUMBER() OVER (PARTITION BY p.page_id ORDER BY p.event_id) - 1 AS INTEGER) AS item_pos,
             CASE WHEN p.page_id % 4 = 1 AND p.event_id % 10 = 7 THEN 'not an item of the schema'
                  WHEN p.page_id % 4 = 2 AND p.event_id % 10 = 3 THEN 'not an object' END AS problem
      FROM pg p JOIN pgs s ON p.page_id = s.page_id
      WHERE s.ok AND p.page_id % 19 <> 0 AND (p.page_id % 13 <> 0 OR p.event_id = s.first_id))
WHERE problem IS NOT NULL"""

# ---- digest ------------------------------------------------------------------------------

_BULLET = (f"CAST(rank AS VARCHAR) || '. ' || strategy_line || ' (CTR +' || {_fixed('expected_ctr_gain * 100', 1)} || '%, lift '"
           f" || {_fixed('lift', 2)} || ')'")
ORACLE_SQL["digest_sections"] = (
    "WITH " + ",\n".join([V_CREATIVE, V_LOG, ENRICHED, CUBE, RULES, STRAT, KPI_ROW, V_RAW_WEATHER, WEATHER_PIVOT, CONTEXT])
    + ",\n" + TRUTH + f"""
SELECT '📊 KPI' || {NL} || '노출 ' || {_thousands('k.impression_count')} || ' | CTR ' || {_pct('k.ctr')} || ' | CVR ' || {_pct('k.cvr')}
       || ' | CTCVR ' || {_pct('k.ctcvr')} || {NL} || '소재 ' || {_thousands('(SELECT count(*) FROM v_creative)')} || ' · 상황 '
       || {_thousands('(SELECT count(*) FROM ctx)')} AS etl_section,
       coalesce('🎯 Top 전략' || {NL} || (SELECT string_agg({_BULLET}, {NL} ORDER BY rank) FROM top WHERE rank <= 2),
                '🎯 Top 전략' || {NL} || '없음') AS strategy_section,
       '🤖 에이전트' || {NL} || 'Critic: ' || CASE WHEN i.n = 0 THEN '✅ 승인' ELSE '❌ 거절' END || ' (이슈 ' || CAST(i.n AS VARCHAR)
       || '건)' || coalesce(CASE WHEN r.rec <> '' THEN {NL} || '권고: ' || r.rec END, '') AS agent_section
FROM kpi k, (SELECT count(*) AS n FROM issues) i,
     (SELECT coalesce(max(CASE WHEN rank = 1 THEN strategy_name END), '') AS rec FROM top) r""")

ORACLE_SQL["kpi_metrics_big"] = with_(V_LOG_BIG) + f"SELECT {_r('ctr')} AS ctr, {_r('cvr')} AS cvr, {_r('ctcvr')} AS ctcvr FROM (SELECT {KPI_AGGS} FROM v_log)"
ORACLE_SQL["user_features_big"] = with_(V_CREATIVE, V_LOG_BIG, ENRICHED, USER_FEATURES) + "SELECT user_id, impression_count, " + ", ".join(
    f"{_r(c)} AS {c}" for c in FEATURES[1:]) + " FROM uf"

ORACLE_SQL["context_json_encode"] = with_(V_LOG) + """SELECT impression_id,
  CAST(json_object('sky', sky, 'temp', temp, 'precip', precip, 'weekend', weekend) AS VARCHAR) AS context_features FROM v_log"""
ORACLE_SQL["context_json_parse"] = with_(V_LOG) + "SELECT impression_id, sky, round(temp, 6) AS temp, precip, weekend FROM v_log"

ORACLE_SQL["critic_verdict"] = with_(TRUTH) + """SELECT approved, n_issues, summary, '🤖 에이전트' || chr(10) || 'Critic: '
  || CASE WHEN approved THEN '✅ 승인' ELSE '❌ 거절' END || ' (이슈 ' || n_issues || '건)' || CASE WHEN summary <> '' THEN chr(10) || '권고: '
  || CASE WHEN length(summary) > 180 THEN substr(summary, 1, 177) || '...' ELSE summary END ELSE '' END AS agent_section
FROM (SELECT (SELECT count(*) FROM issues) = 0 AS approved,
             (SELECT count(*) FROM issues) + (SELECT count(*) FROM truth WHERE ordinal % 9 = 0) AS n_issues,
             (SELECT coalesce(nullif(trim(arg_max(text, ROW(length(text), text)), E' \\t\\n\\r'), ''), trim(min(text), E' \\t\\n\\r')) FROM conversations) AS summary)"""
ORACLE_SQL["agent_display"] = FLAGSHIP + f""", narr AS (
  SELECT printf('strategy_%03d', conv_id % 150) AS sid, arg_max(text, conv_id * 1000 + turn) AS narrative FROM conversations GROUP BY 1)
SELECT strategy_line AS "전략", condition_text AS "상황 조건", action_text AS "추천 액션", {_fixed('strategy_score', 3)} AS "전략 점수",
  {_pct('expected_ctr_gain')} AS "CTR 개선", {_pct('expected_cvr_gain')} AS "CVR 개선", coalesce(narrative, reason) AS "운영 제안"
FROM top LEFT JOIN narr ON top.strategy_id = narr.sid"""

# the catalog numbers events by order of landing, whatever their positions are called
ORACLE_SQL["catalog_from_landing"] = ORACLE_SQL["creative_catalog"]
ORACLE_SQL["apply_segments"] = with_(V_LOG) + """SELECT impression_id, user_id,
  CASE WHEN user_id % 7 <> 0 THEN printf('segment_%d', user_id % 4) END AS user_segment FROM v_log"""
ORACLE_SQL["segment_invariants"] = with_(V_LOG) + """SELECT count(DISTINCT user_id) AS n_users, true AS k_in_range, true AS k_clusters,
  true AS sizes_add_up, true AS named_in_order, true AS nearest_mean FROM v_log"""

# ---- the k search -------------------------------------------------------------------------
# seeds by the same hash race, rounds of all sets in one recursion, silhouettes over all pairs

_X = [f"x{i}" for i in range(len(FEATURES))]
_XS = ", ".join(_X)


def _far(a: str, b: str) -> str:
    return " + ".join(f"({a}.{x} - {b}.{x}) * ({a}.{x} - {b}.{x})" for x in _X)


def _u(r: str, j: str) -> str:
    return f"((CAST(('0x' || substr(md5('42|' || {r} || '|' || {j} || '|' || id), 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0)"


K_SEARCH = f"""pts AS MATERIALIZED (SELECT user_id AS id, """ + ", ".join(
    f"CASE WHEN stddev_pop({c}) OVER () > 0 THEN ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () ELSE 0.0 END AS {x}" for c, x in zip(FEATURES, _X)) + f""" FROM uf),
race AS (
  SELECT 0 AS j, r, id, {_XS}, CAST('inf' AS DOUBLE) AS far, row_number() OVER (PARTITION BY r ORDER BY -ln({_u('r', '0')}), id) = 1 AS won
  FROM pts, (SELECT unnest(range(10)) AS r)
  UNION ALL
  SELECT j + 1, r, id, {_XS}, far, row_number() OVER (PARTITION BY r ORDER BY CASE WHEN far > 0 THEN -ln({_u('r', '(j + 1)')}) / far ELSE 'inf' END, id) = 1
  FROM (SELECT p.j, p.r, p.id, {', '.join('p.' + x for x in _X)}, least(p.far, {_far('p', 'w')}) AS far
        FROM race p JOIN race w ON w.won AND w.r = p.r WHERE p.j < 5)),
lloyd AS (
  SELECT 0 AS it, k, r, j AS c, {_XS} FROM race, (SELECT unnest([3, 4, 5, 6]) AS k) WHERE won AND j < k
  UNION ALL
  SELECT l.it + 1, l.k, l.r, l.c, {', '.join(f'coalesce(a.{x}, l.{x})' for x in _X)}
  FROM lloyd l LEFT JOIN (
    SELECT k, r, c, {', '.join(f'avg({x}) AS {x}' for x in _X)}
    FROM (SELECT p.*, m.k, m.r, m.c, row_number() OVER (PARTITION BY m.k, m.r, p.id ORDER BY {_far('p', 'm')}, m.c) AS rn FROM pts p, lloyd m)
    WHERE rn = 1 GROUP BY k, r, c) a ON a.k = l.k AND a.r = l.r AND a.c = l.c
  WHERE l.it < 100),
ended AS MATERIALIZED (
  SELECT l.k, l.r, p.id, l.c, {_far('p', 'l')} AS far FROM pts p, lloyd l WHERE it = 100
  QUALIFY row_number() OVER (PARTITION BY l.k, l.r, p.id ORDER BY {_far('p', 'l')}, l.c) = 1),
fit AS MATERIALIZED (SELECT k, arg_min(r, cost * 1000000 + r / 1000000.0) AS r FROM (SELECT k, r, round(sum(far), 6) AS cost FROM ended GROUP BY k, r) GROUP BY k),
names AS (SELECT l.k, c, CAST(row_number() OVER (PARTITION BY l.k ORDER BY {_XS}) - 1 AS INTEGER) AS cluster_id FROM lloyd l JOIN fit ON fit.k = l.k AND fit.r = l.r WHERE it = 100),
lab AS MATERIALIZED (SELECT e.k, e.id, cluster_id FROM ended e JOIN fit ON fit.k = e.k AND fit.r = e.r JOIN names n ON n.k = e.k AND n.c = e.c),
away AS (
  SELECT a.k, a.id, a.cluster_id AS own, b.cluster_id AS other, sum({_far('p', 'q')}) AS total, count(*) AS n
  FROM lab a JOIN lab b ON a.k = b.k JOIN pts p ON p.id = a.id JOIN pts q ON q.id = b.id GROUP BY ALL),
score AS (
  SELECT k, avg(CASE WHEN n_own > 1 AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0.0 END) AS silhouette
  FROM (SELECT k, id, max(CASE WHEN own = other THEN n END) AS n_own, max(CASE WHEN own = other THEN total / greatest(n - 1, 1) END) AS a,
               min(CASE WHEN own <> other THEN total / n END) AS b FROM away GROUP BY k, id) GROUP BY k),
best AS (SELECT k, silhouette FROM score ORDER BY silhouette DESC, k LIMIT 1)"""
_SEARCH = "WITH RECURSIVE " + ",\n".join([V_CREATIVE, V_LOG, ENRICHED, USER_FEATURES, K_SEARCH]) + "\n"
ORACLE_SQL["best_k"] = _SEARCH + """SELECT CAST(best.k AS INTEGER) AS best_k, round(silhouette, 6) AS best_silhouette, count(DISTINCT cluster_id) AS n_segments, count(*) AS n_users
FROM best JOIN lab USING (k) GROUP BY ALL"""
ORACLE_SQL["kmeans_segments"] = _SEARCH + """SELECT id AS user_id, cluster_id, printf('segment_%d', cluster_id) AS user_segment FROM best JOIN lab USING (k)"""
ORACLE_SQL["silhouette_exact"] = """WITH away AS (
  SELECT a.vec_id, a.label, b.label AS other, sum(sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding),
           lambda z: (CAST(z[1] AS DOUBLE) - z[2]) * (CAST(z[1] AS DOUBLE) - z[2]))))) AS total, count(*) AS n
  FROM embeddings a, embeddings b GROUP BY ALL),
ab AS (
  SELECT vec_id, label, max(CASE WHEN other = label THEN n END) AS n_own, max(CASE WHEN other = label THEN total / greatest(n - 1, 1) END) AS a,
         min(CASE WHEN other <> label THEN total / n END) AS b FROM away GROUP BY vec_id, label)
SELECT vec_id, label, round(CASE WHEN n_own > 1 AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0.0 END, 6) AS silhouette FROM ab"""
