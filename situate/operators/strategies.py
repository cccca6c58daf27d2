"""Strategy scoring, texts, dedupe and tiered Top-N."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from situate.functions.formatting import fixed
from situate.functions.labels import format_itemset
from situate.functions.scoring import strategy_score
from situate.operators.itemsets import MIN_CONFIDENCE, MIN_LIFT, MIN_SUPPORT, mine_rules

# ---- fixed values: selection thresholds ----------------------------------------
TOP_N_DEFAULT = 5
MIN_EXPECTED_CTR_GAIN = 0.0
MIN_EXPECTED_CVR_GAIN = 0.01
MIN_STRATEGY_CONFIDENCE = 0.5
MIN_STRATEGY_CONFIDENCE_FALLBACK = 0.45
MIN_STRATEGY_LIFT = 1.02
# ------------------------------------------------------------------------------

STRATEGY_SCHEMA = T.StructType([
    T.StructField("strategy_id", T.StringType()),
    T.StructField("strategy_name", T.StringType()),
    T.StructField("target_condition", T.StringType()),
    T.StructField("recommended_action", T.StringType()),
    T.StructField("expected_ctr_gain", T.DoubleType()),
    T.StructField("expected_cvr_gain", T.DoubleType()),
    T.StructField("support", T.DoubleType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("lift", T.DoubleType()),
    T.StructField("strategy_score", T.DoubleType()),
    T.StructField("reason", T.StringType()),
])
STRATEGY_COLUMNS = [f.name for f in STRATEGY_SCHEMA.fields]


def score_rules(rules: DataFrame) -> DataFrame:
    """Every rule → a strategy row (before selection); ``max_lift`` over all rules.

    The rule table is bounded by the dimension cardinalities, so the global window is cheap.
    """
    max_lift = F.max("lift").over(Window.partitionBy())
    target = format_itemset(F.col("antecedents"))
    action = format_itemset(F.col("consequents"))
    return rules.select(
        F.format_string("strategy_%03d", F.col("rule_no")).alias("strategy_id"),
        F.concat(target, F.lit(" → "), action).alias("strategy_name"),
        target.alias("target_condition"),
        action.alias("recommended_action"),
        F.col("ctr_gain").alias("expected_ctr_gain"),
        F.col("cvr_gain").alias("expected_cvr_gain"),
        "support", "confidence", "lift",
        strategy_score(F.col("ctr_gain"), F.col("cvr_gain"), F.col("lift"), F.col("confidence"),
                       max_lift).alias("strategy_score"),
        F.concat(F.lit("support="), fixed(F.col("support"), 3), F.lit(", confidence="),
                 fixed(F.col("confidence"), 3), F.lit(", lift="), fixed(F.col("lift"), 3)).alias("reason"),
        F.col("rule_no"),
    )


def dedupe_strategies(strategies: DataFrame) -> DataFrame:
    """Keep the first strategy per (condition, action) by rule number."""
    w = Window.partitionBy("target_condition", "recommended_action").orderBy("rule_no")
    return strategies.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def select_tiered(strategies: DataFrame, top_n: int = TOP_N_DEFAULT) -> DataFrame:
    """Tier 1 (confidence >= .5) then tier 2 (>= .45) fill the Top-N, each by score;
    only when neither tier has a row, fall back to positive gains alone. Ties: strategy id.
    Adds ``rank`` (1-based selection order)."""
    gains = (F.col("expected_ctr_gain") > MIN_EXPECTED_CTR_GAIN) & (F.col("expected_cvr_gain") > MIN_EXPECTED_CVR_GAIN)
    elig = gains & (F.col("lift") >= MIN_STRATEGY_LIFT)
    tier = (
        F.when(elig & (F.col("confidence") >= MIN_STRATEGY_CONFIDENCE), 1)
        .when(elig & (F.col("confidence") >= MIN_STRATEGY_CONFIDENCE_FALLBACK), 2)
        .when(gains, 3)
    )
    t = strategies.withColumn("__tier", tier).where(F.col("__tier").isNotNull())
    t = t.withColumn("__best", F.min("__tier").over(Window.partitionBy()))
    t = t.where(F.when(F.col("__best") <= 2, F.col("__tier") <= 2).otherwise(F.lit(True)))
    w = Window.orderBy("__tier", F.col("strategy_score").desc(), "strategy_id")
    return t.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n).drop("__tier", "__best")


def build_strategies(rules: DataFrame, top_n: int = TOP_N_DEFAULT) -> DataFrame:
    """Rules with gains → scored, deduped, tiered Top-N strategies (empty rules → empty table)."""
    return select_tiered(dedupe_strategies(score_rules(rules)), top_n).select(*STRATEGY_COLUMNS, "rank")


def top_strategies(enriched: DataFrame, top_n: int = TOP_N_DEFAULT, min_support: float = MIN_SUPPORT,
                   min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT) -> DataFrame:
    """A14 ``generate_top_strategies`` on an enriched log: one cube pass, then small-table work."""
    return build_strategies(mine_rules(enriched, min_support, min_confidence, min_lift), top_n)
