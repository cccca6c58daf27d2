"""Registered queries: one per operator family of the inventory, each over whole tables.

Every query takes (spark, sf_dir) and returns a DataFrame whose column names match the
DuckDB oracle in ``situate/oracle.py``. Doubles are rounded to 6 decimals for comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from situate import schemas
from situate.functions import dates as D
from situate.functions.context import CONTENT_PREFIXES, CONTEXT_PREFIXES, context_flags, impression_items
from situate.functions.text import truncate_text
from situate.operators import evaluation as EV
from situate.operators import itemsets as IS
from situate.operators import kmeans as KM
from situate.operators import reconcile as RC
from situate.operators import segments as SG
from situate.operators import strategies as ST
from situate.operators import wide_itemsets as WI
from situate.operators.enrich import apply_user_segments, enrich_log
from situate.operators.metrics import kpi_metrics, kpi_summary, log_counts, per_user_load, scenario_ctr
from situate.operators.rows import conform_schema, dedupe_first, limit_rows
from situate.operators.sampling import weighted_choice
from situate.plans import cleaning as CL
from situate.plans import reports as RP
from situate.plans.pipeline import load_pipeline_data
from situate.session import materialize, scratch_path
from situate.sources import adapters as A
from situate.sources import files as FS
from situate.sources import landing as LD
from situate.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ROUND_DIGITS = 6
#: rows a landed file holds in the array round trip, and files a folder holds (their names count up from c000)
RAW_FILE_ROWS, RAW_FOLDER_FILES = 500, 100


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


def rounded(df: DataFrame, digits: int = ROUND_DIGITS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


# ---- shared building blocks --------------------------------------------------

def enriched_log(spark, sf, big: bool = False) -> DataFrame:
    log = A.v_log_big(spark, sf) if big else A.v_log(spark, sf)
    return enrich_log(log, A.v_creative(spark, sf))


def scored_rules(spark, sf, big: bool = False) -> DataFrame:
    return IS.mine_rules(enriched_log(spark, sf, big))


def _items_text(c):
    return F.array_join(c, ",")


# ---- KPIs ---------------------------------------------------------------------

@query("kpi_metrics")
def q_kpi_metrics(spark, sf):
    return rounded(kpi_metrics(A.v_log(spark, sf)))


@query("log_counts")
def q_log_counts(spark, sf):
    return log_counts(A.v_log(spark, sf))


@query("kpi_metrics_big")
def q_kpi_metrics_big(spark, sf):
    return rounded(kpi_metrics(A.v_log_big(spark, sf)))


@query("user_features_big")
def q_user_features_big(spark, sf):
    return rounded(SG.user_features(enriched_log(spark, sf, big=True)))


@query("kpi_by_creative_type")
def q_kpi_by_type(spark, sf):
    en = enriched_log(spark, sf)
    return rounded(attach_kpis(en, ["creative_type"]))


def attach_kpis(df, keys):
    return kpi_summary(df, keys)


@query("kpi_sentence")
def q_kpi_sentence(spark, sf):
    log = A.v_log(spark, sf).withColumn("day", F.to_date("timestamp"))
    return rounded(RP.kpi_sentence(attach_kpis(log, ["day"])))


@query("per_user_load")
def q_per_user_load(spark, sf):
    return rounded(per_user_load(A.v_log(spark, sf)))


@query("scenario_ctr")
def q_scenario_ctr(spark, sf):
    return rounded(scenario_ctr(enriched_log(spark, sf)))


# ---- enrichment, flags, items ----------------------------------------------------

@query("enrich_log")
def q_enrich_log(spark, sf):
    en = enriched_log(spark, sf)
    return en.select("impression_id", "user_id", "creative_id", "clicked", "converted", "creative_type", "category",
                     "sky", "precip", "is_weekend", "is_outdoor", "is_indoor", "is_clear", "is_rainy",
                     "category_group")


@query("impression_items")
def q_impression_items(spark, sf):
    en = enriched_log(spark, sf)
    items = impression_items(F.col("sky"), F.col("precip"), F.col("is_weekend"), F.col("creative_type"),
                             F.col("category"))
    return en.select("impression_id", _items_text(items).alias("items"))


@query("context_json_encode")
def q_context_json_encode(spark, sf):
    log = A.v_log(spark, sf)
    return log.select("impression_id", "context_features")


@query("context_json_parse")
def q_context_json_parse(spark, sf):
    from situate.functions.context import clean_temp, parse_context

    log = A.v_log(spark, sf).drop("context")
    c = parse_context(F.col("context_features"))
    return rounded(log.select("impression_id", c["sky"].alias("sky"), clean_temp(c["temp"]).alias("temp"),
                              c["precip"].alias("precip"), c["weekend"].alias("weekend")))


@query("transaction_matrix")
def q_transaction_matrix(spark, sf):
    return IS.transaction_matrix(enriched_log(spark, sf), keep=("impression_id",))


# ---- itemsets and rules ---------------------------------------------------------

@query("frequent_itemsets")
def q_frequent_itemsets(spark, sf):
    its = IS.frequent_itemsets(enriched_log(spark, sf))
    return rounded(its.select(_items_text(F.col("items")).alias("items"), "size", "n", "support", "ctr", "cvr"))


@query("frequent_itemsets_general")
def q_frequent_itemsets_general(spark, sf):
    its = IS.frequent_itemsets_general(enriched_log(spark, sf))
    return rounded(its.select(_items_text(F.col("items")).alias("items"), "n", "support"))


@query("association_rules")
def q_association_rules(spark, sf):
    r = scored_rules(spark, sf)
    return rounded(r.select("rule_no", _items_text(F.col("antecedents")).alias("antecedents"),
                            _items_text(F.col("consequents")).alias("consequents"), "antecedent_support",
                            "consequent_support", "support", "confidence", "lift"))


@query("association_rules_big")
def q_association_rules_big(spark, sf):
    r = scored_rules(spark, sf, big=True)
    return rounded(r.select("rule_no", _items_text(F.col("antecedents")).alias("antecedents"),
                            _items_text(F.col("consequents")).alias("consequents"), "support", "confidence", "lift"))


@query("rule_measures")
def q_rule_measures(spark, sf):
    r = scored_rules(spark, sf)
    return rounded(r.select("rule_no", "leverage", F.when(F.col("confidence") < 1, F.col("conviction")).alias("conviction"),
                            "zhangs_metric", "jaccard", "certainty", "kulczynski"))


@query("rule_gain")
def q_rule_gain(spark, sf):
    r = scored_rules(spark, sf)
    return rounded(r.select("rule_no", "n_matched", "ctr", "cvr", "ctr_gain", "cvr_gain"))


@query("rule_match")
def q_rule_match(spark, sf):
    en = enriched_log(spark, sf)
    rules = IS.mine_rules(en)
    return rounded(IS.rule_match_counts(en, rules))


def item_arrays(enriched: DataFrame, prefix: str = "") -> DataFrame:
    """Transactions as item arrays: items, clicked, converted."""
    items = impression_items(F.col("sky"), F.col("precip"), F.col("is_weekend"), F.col("creative_type"), F.col("category"))
    return enriched.select(F.transform(items, lambda x: F.concat(F.lit(prefix), x)).alias("items"), "clicked", "converted")


@query("rule_match_arrays")
def q_rule_match_arrays(spark, sf):
    """Rules that are nothing but arrays of items of other names; one has no items, one an item that never occurs."""
    en = enriched_log(spark, sf)
    rules = IS.mine_rules(en).select("rule_no", F.transform(F.concat("consequents", "antecedents"), lambda x: F.concat(F.lit("it's "), x)).alias("items"))
    rules = rules.unionByName(spark.createDataFrame([(1_000_000, []), (1_000_001, ["it's sky_clear", "no such item"])], "rule_no int, items array<string>"))
    return rounded(WI.rule_match_arrays(item_arrays(en, "it's "), rules))


@query("rules_general")
def q_rules_general(spark, sf):
    """Context → content rules from item arrays alone: bitmap itemsets, then the splits that keep to the sides."""
    itemsets = materialize(WI.mine_itemsets(item_arrays(enriched_log(spark, sf))))
    rules = WI.numbered(WI.lattice_rules(itemsets, WI.starts_with_any(CONTEXT_PREFIXES), WI.starts_with_any(CONTENT_PREFIXES)))
    return rounded(rules.select("rule_no", _items_text(F.col("antecedents")).alias("antecedents"), _items_text(F.col("consequents")).alias("consequents"),
                                "n_matched", "support", "confidence", "lift", "kulczynski"))


@query("rules_lattice")
def q_rules_lattice(spark, sf):
    """All rules, whatever the sides."""
    rules = WI.lattice_rules(materialize(WI.mine_itemsets(item_arrays(enriched_log(spark, sf)))))
    return rounded(rules.select(_items_text(F.col("antecedents")).alias("antecedents"), _items_text(F.col("consequents")).alias("consequents"), "n_matched",
                                "support", "confidence", "lift"))


# ---- strategies ----------------------------------------------------------------

@query("strategy_score")
def q_strategy_score(spark, sf):
    s = ST.dedupe_strategies(ST.score_rules(scored_rules(spark, sf)))
    return rounded(s.select(*ST.STRATEGY_COLUMNS))


@query("top_strategies")
def q_top_strategies(spark, sf):
    return rounded(ST.top_strategies(enriched_log(spark, sf)))


@query("top_strategies_big")
def q_top_strategies_big(spark, sf):
    return rounded(ST.top_strategies(enriched_log(spark, sf, big=True)))


@query("clause_natural")
def q_clause_natural(spark, sf):
    s = ST.score_rules(scored_rules(spark, sf))
    nat = RP.natural_labels(s)
    return nat.select("strategy_id", F.col("target_condition").alias("condition_text"),
                      F.col("recommended_action").alias("action_text"), F.col("strategy_name").alias("strategy_line"))


@query("strategy_display")
def q_strategy_display(spark, sf):
    return RP.strategy_display(ST.top_strategies(enriched_log(spark, sf)))


def _pipeline(spark, sf):
    data = load_pipeline_data(A.v_log(spark, sf), A.v_creative(spark, sf))
    return data.enriched, data.kpis, data.strategies


@query("snapshot")
def q_snapshot(spark, sf):
    _, kpis, strategies = _pipeline(spark, sf)
    snap = RP.snapshot(kpis, strategies, f"{sf}/events.parquet")
    flat = snap.select("impression_count", "user_count", "ctr", "cvr", "ctcvr",
                       F.size("strategies").alias("n_strategies"),
                       F.posexplode_outer("strategies").alias("pos", "s"))
    return rounded(flat.select("impression_count", "user_count", "ctr", "cvr", "ctcvr", "n_strategies",
                               (F.col("pos") + 1).alias("rank"), F.col("s.strategy_id").alias("strategy_id"),
                               F.col("s.strategy_score").alias("strategy_score")))


@query("pattern_summary")
def q_pattern_summary(spark, sf):
    return RP.pattern_summary(ST.top_strategies(enriched_log(spark, sf)))


@query("digest_sections")
def q_digest(spark, sf):
    _, kpis, strategies = _pipeline(spark, sf)
    contexts = CL.context_catalog(CL.transform_weather(A.v_raw_weather(spark, sf)))
    truth = A.v_metrics_truth(spark, sf)
    issues = materialize(RC.metric_issues(truth, A.v_metrics_reported(truth)).select("strategy_id", "issue"))
    decision = strategies.agg(F.lit(True).alias("approved"), F.lit("  ").alias("revised_summary"),
                              F.max(F.when(F.col("rank") == 1, F.col("strategy_name"))).alias("recommendation"))
    verdict = RP.critic_verdict(issues, issues, decision)
    return RP.digest_sections(kpis, A.v_creative(spark, sf), contexts, strategies, verdict)


@query("critic_verdict")
def q_critic_verdict(spark, sf):
    """A model that approves every report, with its own issues; the longest revision (of equal ones the last) counts."""
    truth = A.v_metrics_truth(spark, sf)
    found = materialize(RC.metric_issues(truth, A.v_metrics_reported(truth)).select("strategy_id", "issue"))
    model = truth.where(F.col("ordinal") % 9 == 0).select("strategy_id", F.lit("근거 부족").alias("issue"))
    talk = read_table(spark, sf, "conversations")
    longest = F.max(F.struct(F.length("text").alias("n"), "text"))["text"]
    decision = talk.agg(F.lit(True).alias("approved"), longest.alias("revised_summary"), F.min("text").alias("recommendation"))
    verdict = RP.critic_verdict(found, RC.merge_issues(found, model), decision)
    return verdict.withColumn("agent_section", RP.agent_section(F.col("approved"), F.col("n_issues"), F.col("summary")))


@query("agent_display")
def q_agent_display(spark, sf):
    strategies = RC.merge_narratives(ST.top_strategies(enriched_log(spark, sf)), A.v_narratives(spark, sf))
    return RP.strategy_display(strategies, RP.AGENT_DISPLAY_COLUMNS)


# ---- cleaning and catalogs ------------------------------------------------------

@query("event_clean")
def q_event_clean(spark, sf):
    return CL.transform_events(A.v_raw_event(spark, sf))


@query("tour_clean")
def q_tour_clean(spark, sf):
    return rounded(CL.transform_tour(A.v_raw_tour(spark, sf)))


@query("weather_pivot")
def q_weather_pivot(spark, sf):
    return rounded(CL.transform_weather(A.v_raw_weather(spark, sf)))


@query("event_creatives")
def q_event_creatives(spark, sf):
    return rounded(CL.event_creatives(CL.transform_events(A.v_raw_event(spark, sf))).drop("ordinal"))


@query("tour_creatives")
def q_tour_creatives(spark, sf):
    return rounded(CL.tour_creatives(CL.transform_tour(A.v_raw_tour(spark, sf))).drop("ordinal"))


@query("creative_catalog")
def q_creative_catalog(spark, sf):
    ev = CL.transform_events(A.v_raw_event(spark, sf))
    tr = CL.transform_tour(A.v_raw_tour(spark, sf))
    return rounded(CL.creative_catalog(ev, tr))


@query("context_catalog")
def q_context_catalog(spark, sf):
    return rounded(CL.context_catalog(CL.transform_weather(A.v_raw_weather(spark, sf))))


@query("context_flags")
def q_context_flags(spark, sf):
    ctx = CL.context_catalog(CL.transform_weather(A.v_raw_weather(spark, sf)))
    ts = D.forecast_timestamp(F.col("fcst_date"), F.col("fcst_time"))
    wk = D.is_weekend(ts)
    flags = context_flags(F.col("sky_status_name"), F.col("precipitation_type_name"), wk)
    return ctx.select("context_id", ts.alias("forecast_ts"), flags.alias("f")).select(
        "context_id", "forecast_ts", "f.*")


@query("dedupe_first")
def q_dedupe_first(spark, sf):
    log = A.v_log(spark, sf).select("user_id", "impression_id", "timestamp", "creative_id")
    return dedupe_first(log, ["user_id"], ["timestamp", "impression_id"])


@query("conform_schema")
def q_conform_schema(spark, sf):
    raw = A.v_raw_tour(spark, sf).select("contentid", "title", "mapx", "ordinal")
    return conform_schema(raw, schemas.RAW_TOUR)


@query("limit_rows")
def q_limit_rows(spark, sf):
    return limit_rows(A.v_raw_event(spark, sf), 1000, ["ordinal"]).select("ordinal", "TITLE", "DATE")


@query("format_ids")
def q_format_ids(spark, sf):
    log = A.v_log(spark, sf)
    return log.select(F.format_string("imp_%06d", F.col("impression_id")).alias("impression_key"),
                      F.format_string("user_%04d", F.col("user_id") + 1).alias("user_key"),
                      F.format_string("segment_%d", F.col("user_id") % 4).alias("segment_key"))


@query("issue_slot")
def q_issue_slot(spark, sf):
    e = read_table(spark, sf, "events")
    return e.select("event_id", D.forecast_issue_slot(F.col("ts")).alias("s")).select("event_id", "s.*")


@query("truncate_text")
def q_truncate_text(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", truncate_text(F.col("text")).alias("short_text"))


# ---- segments -----------------------------------------------------------------

@query("user_features")
def q_user_features(spark, sf):
    return rounded(SG.user_features(enriched_log(spark, sf)))


@query("zscore_features")
def q_zscore(spark, sf):
    # the feature table is read twice (global stats, then scaling): materialise it once in the
    # checkpoint folder instead of aggregating the log twice
    feats = materialize(SG.user_features(enriched_log(spark, sf)))
    return rounded(SG.zscore(feats))


@query("silhouette")
def q_silhouette(spark, sf):
    emb = read_table(spark, sf, "embeddings")
    return rounded(SG.silhouette_score(emb, "embedding", "label", "vec_id"))


@query("silhouette_points")
def q_silhouette_points(spark, sf):
    emb = read_table(spark, sf, "embeddings")
    return rounded(SG.squared_silhouette(emb, "embedding", "label", "vec_id"))


@query("silhouette_exact")
def q_silhouette_exact(spark, sf):
    return rounded(KM.silhouette_exact(read_table(spark, sf, "embeddings"), "embedding", "label", "vec_id"))


@query("kmeans_segments")
def q_kmeans_segments(spark, sf):
    res = SG.cluster_users(enriched_log(spark, sf))
    return res.user_segments.select("user_id", "cluster_id", "user_segment")


@query("best_k")
def q_best_k(spark, sf):
    res = SG.cluster_users(enriched_log(spark, sf))
    seg = res.user_segments.agg(F.countDistinct("user_segment").alias("n_segments"), F.count("*").alias("n_users"))
    return seg.select(F.lit(res.best_k).alias("best_k"), F.lit(round(res.best_silhouette, 6)).alias("best_silhouette"),
                      "n_segments", "n_users")


@query("apply_segments")
def q_apply_segments(spark, sf):
    """J2 over a fixed labelling: users by their id, every seventh without a segment."""
    log = A.v_log(spark, sf)
    users = log.select("user_id").distinct().where(F.col("user_id") % 7 != 0)
    users = users.select("user_id", F.format_string("segment_%d", F.col("user_id") % 4).alias("user_segment"))
    return apply_user_segments(log, users).select("impression_id", "user_id", "user_segment")


@query("segment_invariants")
def q_segment_invariants(spark, sf):
    """What must hold of any converged segmentation, whatever the seeds found."""
    res = SG.cluster_users(enriched_log(spark, sf))
    return SG.segmentation_checks(res)


# ---- evaluation ------------------------------------------------------------------

@query("pass_at_k")
def q_pass_at_k(spark, sf):
    c = EV.case_results(A.v_trials(spark, sf), 3)
    return c.select("case_id", "pass_at_k", "pass_pow_k", "pass_at_1",
                    F.array_join(F.transform("first_k_passes", lambda b: b.cast("string")), ",").alias("first_k"))


@query("eval_suite")
def q_eval_suite(spark, sf):
    return rounded(EV.eval_suite(A.v_trials(spark, sf), k=3, n_trials=3))


@query("grade_cases")
def q_grade_cases(spark, sf):
    g = EV.grade_cases(A.v_golden_cases(spark, sf), A.v_run_results(spark, sf))
    return g.select("case_id", "passed", F.size("reasons").alias("n_reasons"),
                    F.array_join("reasons", " | ").alias("reasons"))


@query("graded_suite")
def q_graded_suite(spark, sf):
    """Three trials of each case (the second with the opposite approval), graded, then pass@k."""
    runs = EV.case_trials(A.v_run_results(spark, sf), 3)
    runs = runs.withColumn("approved", (F.col("trial") == 2) != F.col("approved"))
    return rounded(EV.eval_suite(EV.grade_cases(A.v_golden_cases(spark, sf), runs), k=3, n_trials=3))


@query("case_trials")
def q_case_trials(spark, sf):
    return EV.case_trials(A.v_golden_cases(spark, sf).select("case_id"), 3)


@query("case_filter")
def q_case_filter(spark, sf):
    ids = read_table(spark, sf, "labels").where(F.col("quality") == 1).select(F.col("doc_id").alias("case_id"))
    return EV.filter_cases(A.v_golden_cases(spark, sf).select("case_id", "expected_approved"), ids)


# ---- reconciliation ------------------------------------------------------------

@query("merge_narratives")
def q_merge_narratives(spark, sf):
    truth = A.v_metrics_truth(spark, sf)
    return RC.merge_narratives(truth, A.v_narratives(spark, sf)).select("strategy_id", "operational_reason")


@query("reconcile_metrics")
def q_reconcile_metrics(spark, sf):
    truth = A.v_metrics_truth(spark, sf)
    iss = RC.metric_issues(truth, A.v_metrics_reported(truth))
    return rounded(iss.select("strategy_id", "metric_pos", "metric", "expected", "actual"))


@query("unknown_ids")
def q_unknown_ids(spark, sf):
    truth = A.v_metrics_truth(spark, sf)
    iss = RC.metric_issues(truth, A.v_metrics_reported(truth))
    return iss.where(F.col("metric").isNull()).select("strategy_id", "issue")


@query("merge_issues")
def q_merge_issues(spark, sf):
    truth = A.v_metrics_truth(spark, sf)
    py = materialize(RC.metric_issues(truth, A.v_metrics_reported(truth)).select("strategy_id", "ordinal", "issue"))
    # model issues: repeats of every python issue on even suppliers plus one new issue per 9th supplier
    model = py.where(F.col("ordinal") % 2 == 0).select("strategy_id", "issue").unionByName(
        truth.where(F.col("ordinal") % 9 == 0).select("strategy_id", F.lit("근거 부족").alias("issue")))
    merged = RC.merge_issues(py, model)
    return merged.groupBy("strategy_id", "source").agg(F.count("*").alias("n_issues"))


# ---- sampling -------------------------------------------------------------------------

@query("weighted_choice")
def q_weighted_choice(spark, sf):
    lines = read_table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("weight"))
    pick = weighted_choice(lines, ["l_suppkey"], F.col("weight"), ["l_orderkey", "l_linenumber"], seed=42)
    return rounded(pick.select("l_suppkey", "l_orderkey", "l_linenumber", "weight"))


# ---- sources and sinks ---------------------------------------------------------------

@query("scan_raw_json")
def q_scan_raw_json(spark, sf):
    path = scratch_path(spark, "raw_event")
    FS.sink_json(A.v_raw_event(spark, sf), path)
    return FS.scan_raw_json(spark, path, schemas.RAW_EVENT, layout="lines")


@query("scan_raw_array")
def q_scan_raw_array(spark, sf):
    """The landing layout: files of one JSON array each, rows without a position; the scan numbers them."""
    path = scratch_path(spark, "raw_event_array")
    raw = A.v_raw_event(spark, sf)
    block = F.floor(F.col("ordinal") / RAW_FILE_ROWS)
    raw = raw.withColumn("block", block).withColumn("folder", F.floor(F.col("block") / RAW_FOLDER_FILES)).repartition("folder")
    rows = F.sort_array(F.collect_list(F.struct("ordinal", *[c for c in raw.columns if c not in ("ordinal", "block", "folder")])))
    lists = raw.groupBy("folder", "block").agg(rows.alias("rows"))
    name = lambda c: F.format_string("%09d", c).alias(c)
    text = F.to_json(F.transform("rows", lambda r: r.dropFields("ordinal")))
    # a task writes whole folders, a file for each row in the order of the blocks
    lists = lists.select(name("folder"), name("block"), text.alias("value")).sortWithinPartitions("folder", "block").drop("block")
    lists.write.partitionBy("folder").option("maxRecordsPerFile", 1).text(path)
    return FS.scan_raw_json(spark, f"{path}/folder=*", schemas.RAW_EVENT)


@query("catalog_from_landing")
def q_catalog_from_landing(spark, sf):
    """Landed arrays without positions → cleaned events and tours → the creative catalog."""
    return rounded(CL.creative_catalog(CL.transform_events(q_scan_raw_array(spark, sf)), CL.transform_tour(A.v_raw_tour(spark, sf))))


@query("scan_csv_roundtrip")
def q_scan_csv(spark, sf):
    path = scratch_path(spark, "log_csv")
    log = A.v_log(spark, sf).drop("context")  # CSV holds the JSON text; it is parsed on the way back
    FS.write_csv(log, path)
    back = FS.scan_csv(spark, path, log.schema)
    return rounded(enrich_log(back, A.v_creative(spark, sf)).select(
        "impression_id", "user_id", "creative_id", "clicked", "converted", "sky", "precip", "is_weekend"))


@query("scan_csv_ranges")
def q_scan_csv_ranges(spark, sf):
    """Whole texts with line breaks and quotes through CSV, read back in byte ranges."""
    docs = read_table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = FS.write_csv(docs, scratch_path(spark, "documents_csv"))
    return FS.scan_csv_parallel(spark, path, docs.schema)


@query("scan_latest")
def q_scan_latest(spark, sf):
    folder = scratch_path(spark, "snapshots")
    FS.sink_snapshot(A.v_log(spark, sf).select("impression_id", "user_id", "clicked"), folder, "synthetic_log")
    FS.sink_snapshot(A.v_creative(spark, sf).select("creative_id", "category"), folder, "creatives")
    latest = FS.latest_snapshot(spark, folder, "synthetic_log")
    return spark.read.parquet(latest)


@query("sink_snapshot")
def q_sink_snapshot(spark, sf):
    folder = scratch_path(spark, "catalog")
    path = FS.sink_snapshot(A.v_creative(spark, sf), folder, "creatives", fmt="csv")
    return FS.scan_csv(spark, path, A.v_creative(spark, sf).schema)


@query("sink_json")
def q_sink_json(spark, sf):
    _, kpis, strategies = _pipeline(spark, sf)
    snap = RP.snapshot(kpis, strategies, f"{sf}/events.parquet")
    path = scratch_path(spark, "agent_input")
    FS.sink_json(snap, path)
    back = FS.scan_json(spark, path, snap.schema)
    flat = back.select("impression_count", "user_count", F.posexplode_outer("strategies").alias("pos", "s"))
    return rounded(flat.select("impression_count", "user_count", (F.col("pos") + 1).alias("rank"),
                               F.col("s.strategy_id").alias("strategy_id"), F.col("s.lift").alias("lift")))


ITEM_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                            T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])


@query("decode_envelope")
def q_decode_envelope(spark, sf):
    dec = LD.decode_pages(A.v_pages_landed(spark, sf), ITEM_SCHEMA)
    return rounded(LD.landed_rows(dec))


@query("landing_gaps")
def q_landing_gaps(spark, sf):
    pages = A.v_pages_landed(spark, sf)
    dec = LD.decode_pages(pages, ITEM_SCHEMA)
    targets = pages.groupBy("feed").agg(F.sum("declared_rows").alias("target"))
    return LD.landing_gaps(dec, A.PAGE_SIZE, targets)


def shifted_pages(spark, sf) -> DataFrame:
    """Landed pages that don't keep to the plan: some start late, some early (and overlap), some came twice."""
    pages = A.v_pages_landed(spark, sf)
    page = F.col("page_id")
    shift = F.when(page % 5 == 1, 7).when(page % 5 == 2, -13).otherwise(0)
    pages = pages.withColumn("start_index", F.col("start_index") + shift)
    return pages.unionByName(pages.where(page % 11 == 0).withColumn("declared_rows", F.lit(0).cast("long")))


@query("landing_gaps_ranges")
def q_landing_gaps_ranges(spark, sf):
    return LD.landing_gaps_ranges(LD.decode_pages(shifted_pages(spark, sf), ITEM_SCHEMA))


@query("landing_quarantine")
def q_landing_quarantine(spark, sf):
    """Pages in which an item is damaged: a text instead of an object, a mistyped id, a null."""
    pages, page = A.v_pages_landed(spark, sf), F.col("page_id")
    damaged = (F.when(page % 4 == 1, F.regexp_replace("body", r'"event_id":(\d*7),', r'"event_id":"x$1",'))
               .when(page % 4 == 2, F.regexp_replace("body", r'\{"event_id":\d*3,[^}]*\}', r'"oops"')).otherwise(F.col("body")))
    bad = LD.quarantined_items(LD.decode_pages(pages.withColumn("body", damaged), ITEM_SCHEMA))
    return bad.select("page_id", "feed", "item_pos", "problem")


@query("stream_clean_events")
def q_stream_clean_events(spark, sf):
    from situate.streaming.ingest import start_clean_stream

    landing = scratch_path(spark, "landing_event")
    FS.sink_json(A.v_raw_event(spark, sf), landing)
    out, ckpt = scratch_path(spark, "clean_event"), scratch_path(spark, "clean_event_ckpt")
    q = start_clean_stream(spark, "cultural_event", landing, out, ckpt)
    q.awaitTermination()
    return spark.read.parquet(out)
