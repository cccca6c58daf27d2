"""Report tables: display table (P9, P10, X27), snapshot (P11), KPI sentence (X33),
pattern summary (X34), digest sections (X35)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from situate.functions.formatting import fixed, percent, thousands
from situate.functions.labels import clause_natural, strategy_line, strategy_natural
from situate.functions.text import py_strip, truncate_text
from situate.operators.joins import attach_row, merge_rows

# ---- fixed values: display labels -------------------------------------------
DISPLAY_COLUMN_LABELS = {
    "strategy_name": "전략",
    "strategy_score": "전략 점수",
    "expected_ctr_gain": "CTR 개선",
    "expected_cvr_gain": "CVR 개선",
    "support": "Support",
    "confidence": "Confidence",
    "lift": "Lift",
    "target_condition": "상황 조건",
    "recommended_action": "추천 액션",
    "operational_reason": "운영 제안",
}
ANALYSIS_DISPLAY_COLUMNS = ["strategy_name", "strategy_score", "expected_ctr_gain", "expected_cvr_gain",
                            "support", "confidence", "lift", "target_condition", "recommended_action"]
AGENT_DISPLAY_COLUMNS = ["strategy_name", "target_condition", "recommended_action", "strategy_score",
                         "expected_ctr_gain", "expected_cvr_gain", "operational_reason"]
PERCENT_COLUMNS = ("expected_ctr_gain", "expected_cvr_gain")
RATIO_COLUMNS = ("support", "confidence", "strategy_score", "lift")
NO_PATTERN_TEXT = "유효 대응 사례가 발굴되지 않았습니다."
PATTERN_HEADER = "연관규칙 기반 유효 대응 사례:\n"
TOP_STRATEGY_COUNT = 2
KPI_HEADER = "📊 KPI"
STRATEGY_HEADER = "🎯 Top 전략"
NO_STRATEGY = "없음"
AGENT_HEADER = "🤖 에이전트"
APPROVED, REJECTED = "✅ 승인", "❌ 거절"
# ------------------------------------------------------------------------------


def natural_labels(strategies: DataFrame) -> DataFrame:
    """P10: natural-language condition, action and name."""
    return strategies.select(
        *[c for c in strategies.columns if c not in ("target_condition", "recommended_action", "strategy_name")],
        clause_natural(F.col("target_condition"), False).alias("target_condition"),
        clause_natural(F.col("recommended_action"), True).alias("recommended_action"),
        strategy_line(F.col("target_condition"), F.col("recommended_action")).alias("strategy_name"),
    )


def strategy_display(strategies: DataFrame, display_columns: Sequence[str] = ANALYSIS_DISPLAY_COLUMNS,
                     labels: dict | None = None) -> DataFrame:
    """Chosen columns, percent/ratio formats, columns renamed to display labels."""
    labels = labels or DISPLAY_COLUMN_LABELS
    nat = natural_labels(strategies)
    cols = []
    for c in display_columns:
        col = F.col(c)
        if c in PERCENT_COLUMNS:
            col = percent(col, 2)
        elif c in RATIO_COLUMNS:
            col = fixed(col, 3)
        cols.append(col.alias(labels.get(c, c)))
    return nat.select(*cols)


def kpi_sentence(table: DataFrame) -> DataFrame:
    """X33 ``build_analyst_summary`` for every row of a (grouped) KPI table."""
    sentence = F.concat(
        F.lit("노출 "), thousands(F.col("impression_count")), F.lit("건, 유저 "), thousands(F.col("user_count")),
        F.lit("명 기준 CTR "), percent(F.col("ctr")), F.lit(", CVR "), percent(F.col("cvr")),
        F.lit(", CTCVR "), percent(F.col("ctcvr")), F.lit(" 입니다."),
    )
    return table.withColumn("summary", sentence)


def snapshot(kpis_and_counts: DataFrame, strategies: DataFrame, log_path: str) -> DataFrame:
    """P11 ``build_pipeline_snapshot``: one row of KPIs with the ranked strategies as array<struct>.

    The strategy list is the Top-N (bounded by ``top_n``), gathered by one aggregate.
    """
    fields = [c for c in strategies.columns if c != "rank"]
    packed = strategies.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", F.struct(*fields).alias("s")))),
                    lambda e: e["s"]).alias("strategies"))
    return attach_row(kpis_and_counts.withColumn("log_path", F.lit(log_path)), packed)


def pattern_summary(strategies: DataFrame) -> DataFrame:
    """X34 ``build_pattern_summary``: numbered natural lines, or a fixed text when there is none."""
    line = F.concat(F.col("rank").cast("string"), F.lit(". "),
                    strategy_natural(F.col("target_condition"), F.col("recommended_action"), F.col("support"),
                                     F.col("confidence"), F.col("lift")))
    agg = strategies.agg(F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))).alias("__l"))
    text = F.when(F.size("__l") > 0, F.concat(F.lit(PATTERN_HEADER),
                                              F.array_join(F.transform("__l", lambda e: e["line"]), "\n"))
                  ).otherwise(F.lit(NO_PATTERN_TEXT))
    return agg.select(F.size("__l").alias("n_strategies"), text.alias("pattern_summary"))


def critic_verdict(metric_issues: DataFrame, merged_issues: DataFrame, decision: DataFrame) -> DataFrame:
    """The verdict row: approved only if the model approves and no metric issue was found; the number of
    merged issues; the revised summary, or else the recommendation (both trimmed).

    ``decision``: one row of ``approved``, ``revised_summary``, ``recommendation``; a null approval
    doesn't approve, null texts are empty."""
    row = merge_rows(decision, metric_issues.agg(F.count("*").alias("__found")), merged_issues.agg(F.count("*").alias("n_issues")))
    text = lambda c: F.coalesce(py_strip(F.col(c)), F.lit(""))
    return row.select((F.coalesce("approved", F.lit(False)) & (F.col("__found") == 0)).alias("approved"), "n_issues",
                      F.coalesce(F.nullif(text("revised_summary"), F.lit("")), text("recommendation")).alias("summary"))


def agent_section(approved, n_issues, summary):
    """The verdict's text section."""
    short = truncate_text(summary)
    return F.concat(F.lit(AGENT_HEADER + "\nCritic: "), F.when(approved, APPROVED).otherwise(REJECTED),
                    F.lit(" (이슈 "), n_issues.cast("string"), F.lit("건)"),
                    F.when(short != "", F.concat(F.lit("\n권고: "), short)).otherwise(F.lit("")))


def digest_sections(kpis_and_counts: DataFrame, creatives: DataFrame, contexts: DataFrame,
                    strategies: DataFrame, verdict: DataFrame) -> DataFrame:
    """KPI, Top-2 strategy and verdict sections as one report row.

    Inputs: one-row KPI table, the two catalogs (counted), ranked strategies, and the row of
    :func:`critic_verdict`.
    """
    top = strategies.where(F.col("rank") <= TOP_STRATEGY_COUNT)
    bullet = F.concat(F.col("rank").cast("string"), F.lit(". "),
                      strategy_line(F.col("target_condition"), F.col("recommended_action")),
                      F.lit(" (CTR +"), fixed(F.col("expected_ctr_gain") * 100, 1), F.lit("%, lift "),
                      fixed(F.col("lift"), 2), F.lit(")"))
    bullets = top.agg(F.array_sort(F.collect_list(F.struct("rank", bullet.alias("b")))).alias("__b"))
    row = merge_rows(kpis_and_counts, creatives.agg(F.count("*").alias("n_creatives")), contexts.agg(F.count("*").alias("n_contexts")), bullets, verdict)
    etl = F.concat(
        F.lit(KPI_HEADER + "\n노출 "), thousands(F.col("impression_count")), F.lit(" | CTR "), percent(F.col("ctr")),
        F.lit(" | CVR "), percent(F.col("cvr")), F.lit(" | CTCVR "), percent(F.col("ctcvr")),
        F.lit("\n소재 "), thousands(F.col("n_creatives")), F.lit(" · 상황 "), thousands(F.col("n_contexts")),
    )
    strat = F.when(F.size("__b") > 0, F.concat(F.lit(STRATEGY_HEADER + "\n"),
                                               F.array_join(F.transform("__b", lambda e: e["b"]), "\n"))
                   ).otherwise(F.lit(STRATEGY_HEADER + "\n" + NO_STRATEGY))
    agent = agent_section(F.col("approved"), F.col("n_issues"), F.col("summary"))
    return row.select(etl.alias("etl_section"), strat.alias("strategy_section"), agent.alias("agent_section"))
