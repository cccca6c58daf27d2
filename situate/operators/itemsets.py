"""Frequent itemsets and context → content association rules in one cube pass.

Every impression has exactly five single-valued dimensions, so its itemsets are the
non-empty subsets of those five columns: ``CUBE`` over them counts every itemset
exactly, and the same pass carries the click/conversion sums for the rule gains.
The log is first pre-aggregated on the five columns (map-side combine → a table
bounded by the product of the dimension cardinalities), and only that small table
is cubed, so the ×32 expansion never touches input-sized data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from situate.functions.context import ITEM_PREFIXES, item_values
from situate.operators.joins import attach_row

DIMENSIONS = ("sky", "precip", "weekend", "type", "category_group")  # grouping_id bit order (MSB first)
N_DIMS = len(DIMENSIONS)
ALL_ROLLED = (1 << N_DIMS) - 1                       # 31: grand total
CONTEXT_BITS = 0b11100                               # sky, precip, weekend
CONTENT_BITS = 0b00011                               # type, category_group
# sorted order of the item prefixes (category_group_ < precip_ < sky_ < type_ < weekend_)
SORTED_DIMS = tuple(sorted(DIMENSIONS, key=lambda d: ITEM_PREFIXES[DIMENSIONS.index(d)]))

# ---- fixed values: default mining thresholds ------------------------------------
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.15
MIN_LIFT = 1.02
# ------------------------------------------------------------------------------

SUMS = ("n", "clk_sum", "clk_cnt", "c1_cnt", "c1_sum", "conv_sum", "conv_cnt")


def _bit(dim: str) -> int:
    return 1 << (N_DIMS - 1 - DIMENSIONS.index(dim))


def transactions(enriched: DataFrame) -> DataFrame:
    """X21 as columns: the five item values (nulls spelled 'nan') with clicked/converted."""
    vals = item_values(F.col("sky"), F.col("precip"), F.col("is_weekend"), F.col("creative_type"),
                       F.col("category"))
    return enriched.select(*[v.alias(d) for v, d in zip(vals, DIMENSIONS)], "clicked", "converted")


def _partial_sums(df: DataFrame) -> list[Column]:
    clicked, converted = F.col("clicked"), F.col("converted")
    return [
        F.count("*").alias("n"),
        F.sum(clicked).alias("clk_sum"),
        F.count(clicked).alias("clk_cnt"),
        F.count(F.when(clicked == 1, converted)).alias("c1_cnt"),
        F.sum(F.when(clicked == 1, converted)).alias("c1_sum"),
        F.sum(converted).alias("conv_sum"),
        F.count(converted).alias("conv_cnt"),
    ]


def itemset_cube(enriched: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """The grouping sets of the five dimensions with support >= ``min_support``: counts, click/conversion sums, and
    the grand total's count and rates.

    Rolled-up dimensions are null; ``gid`` is Spark's grouping_id (bit set = rolled up). The total is one row over the same
    pre-aggregated table (its exchange is reused), so infrequent rows are gone before the single partition that
    later windows use: at most 31 / min_support rows reach it, whatever the vocabulary of the log.
    """
    pre = transactions(enriched).groupBy(*DIMENSIONS).agg(*_partial_sums(enriched))
    total = pre.agg(*[F.sum(c).alias(c) for c in SUMS])
    total = total.select(F.col("n").alias("n_total"), _ctr().alias("base_ctr"), _cvr().alias("base_cvr"))
    cube = pre.cube(*DIMENSIONS).agg(*[F.sum(c).alias(c) for c in SUMS], F.grouping_id().alias("gid")).where(F.col("gid") != ALL_ROLLED)
    frequent = attach_row(cube.withColumn("gid", F.col("gid").cast("int")), total).where(F.col("n") / F.col("n_total") >= F.lit(min_support))
    return frequent.repartition(1)


def _present(dim: str) -> Column:
    return (F.col("gid").bitwiseAND(_bit(dim))) == 0


def items_array(prefix_values: bool = True) -> Column:
    """Sorted item names of a cube row (present dimensions only)."""
    parts = [F.when(_present(d), F.concat(F.lit(ITEM_PREFIXES[DIMENSIONS.index(d)]), F.col(d))) for d in SORTED_DIMS]
    return F.filter(F.array(*parts), lambda x: x.isNotNull())


def _ctr(prefix: str = "") -> Column:
    return F.when(F.col(f"{prefix}clk_cnt") > 0, F.col(f"{prefix}clk_sum") / F.col(f"{prefix}clk_cnt")).otherwise(0.0)


def _cvr(prefix: str = "") -> Column:
    return F.when(F.col(f"{prefix}c1_cnt") > 0, F.col(f"{prefix}c1_sum") / F.col(f"{prefix}c1_cnt")).otherwise(0.0)


def itemset_table(cube: DataFrame) -> DataFrame:
    """Cube rows with support, size, items, CTR/CVR and the supports of each row's context part and
    content part (frequent too, by downward closure).

    All of it is window arithmetic on the frequent rows of the cube, so the log is aggregated exactly once: the context part of
    a row is the row with ``gid | CONTENT_BITS`` and the same context values, i.e. the row of its
    window partition (gid | CONTENT_BITS, sky, precip, weekend) whose content bits are all set;
    likewise for the content part. No self-join, hence no second pass over the log.
    """
    ctx_dims = [d for d in DIMENSIONS if _bit(d) & CONTEXT_BITS]
    cnt_dims = [d for d in DIMENSIONS if _bit(d) & CONTENT_BITS]
    ante_n = F.max(F.when((F.col("gid").bitwiseAND(CONTENT_BITS)) == CONTENT_BITS, F.col("n"))).over(
        Window.partitionBy(F.col("gid").bitwiseOR(CONTENT_BITS), *ctx_dims))
    cons_n = F.max(F.when((F.col("gid").bitwiseAND(CONTEXT_BITS)) == CONTEXT_BITS, F.col("n"))).over(
        Window.partitionBy(F.col("gid").bitwiseOR(CONTEXT_BITS), *cnt_dims))
    t = cube.select("*", ante_n.alias("n_antecedent"), cons_n.alias("n_consequent"))
    return (
        t.withColumn("support", F.col("n") / F.col("n_total"))
        .withColumn("antecedent_support", F.col("n_antecedent") / F.col("n_total"))
        .withColumn("consequent_support", F.col("n_consequent") / F.col("n_total"))
        .withColumn("size", F.lit(N_DIMS) - F.bit_count(F.col("gid")))
        .withColumn("items", items_array())
        .withColumn("ctr", _ctr())
        .withColumn("cvr", _cvr())
    )


def frequent_itemsets(enriched: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """Itemsets with support >= min_support (inclusive), with size, items and CTR/CVR."""
    return itemset_table(itemset_cube(enriched, min_support))


def rule_measures(sup: Column, sa: Column, sc: Column, confidence: Column) -> list[Column]:
    """Further measures of a rule from the supports of itself, its antecedent and its consequent."""
    leverage = sup - sa * sc
    return [
        leverage.alias("leverage"),
        F.when(confidence < 1, (1 - sc) / (1 - confidence)).otherwise(F.lit(float("inf"))).alias("conviction"),
        F.coalesce(F.try_divide(leverage, F.greatest(sup * (1 - sa), sa * (sc - sup))), F.lit(0.0)).alias("zhangs_metric"),
        (sup / (sa + sc - sup)).alias("jaccard"),
        F.coalesce(F.try_divide(confidence - sc, 1 - sc), F.lit(0.0)).alias("certainty"),
        ((sup / sa + sup / sc) / 2).alias("kulczynski"),
    ]


def association_rules(itemsets: DataFrame, min_confidence: float = MIN_CONFIDENCE,
                      min_lift: float = MIN_LIFT) -> DataFrame:
    """Context → content rules of the frequent itemsets.

    Each itemset with >= 1 context and >= 1 content item yields exactly one rule:
    antecedent = its context part, consequent = its content part (both frequent by downward
    closure; their supports come from :func:`itemset_table`). confidence = s / s(antecedent),
    lift = confidence / s(consequent). Rule ordinal: itemset size, then sorted item names
    (the order the Apriori output is enumerated in). Where a constant dimension makes Zhang's metric
    or the certainty 0/0, it is 0.
    """
    rules = itemsets.where(((F.col("gid").bitwiseAND(CONTEXT_BITS)) != CONTEXT_BITS)
                           & ((F.col("gid").bitwiseAND(CONTENT_BITS)) != CONTENT_BITS))
    sup, sa, sc = F.col("support"), F.col("antecedent_support"), F.col("consequent_support")
    j = rules.withColumn("confidence", sup / sa).withColumn("lift", F.col("confidence") / sc)
    j = j.where((F.col("confidence") >= F.lit(min_confidence)) & (F.col("lift") >= F.lit(min_lift)))
    ante_items = F.filter(F.col("items"), lambda x: x.startswith("precip_") | x.startswith("sky_") | x.startswith("weekend_"))
    cons_items = F.filter(F.col("items"), lambda x: x.startswith("type_") | x.startswith("category_group_"))
    out = j.select(
        "gid", *DIMENSIONS, "items", "size",
        ante_items.alias("antecedents"),
        cons_items.alias("consequents"),
        "antecedent_support", "consequent_support", "support", "confidence", "lift",
        *rule_measures(sup, sa, sc, F.col("confidence")),
        F.col("n").alias("n_matched"), "ctr", "cvr", "base_ctr", "base_cvr",
        (F.col("ctr") - F.col("base_ctr")).alias("ctr_gain"),
        (F.col("cvr") - F.col("base_cvr")).alias("cvr_gain"),
    )
    # rule table is bounded by the dimension cardinalities: a global ordinal is cheap
    return out.withColumn("rule_no", F.row_number().over(Window.orderBy("size", "items")))


def mine_rules(enriched: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               min_lift: float = MIN_LIFT) -> DataFrame:
    """``mine_patterns``: enriched log → context → content rules with gains."""
    return association_rules(frequent_itemsets(enriched, min_support), min_confidence, min_lift)


def frequent_itemsets_general(enriched: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """General path for wide item sets: ``FPGrowth.freqItemsets`` on the item arrays.

    Same itemsets as the cube (used as a cross-check); ``items`` sorted.
    """
    from pyspark.ml.fpm import FPGrowth

    vals = item_values(F.col("sky"), F.col("precip"), F.col("is_weekend"), F.col("creative_type"), F.col("category"))
    tx = enriched.select(F.array(*[F.concat(F.lit(p), v) for p, v in zip(ITEM_PREFIXES, vals)]).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=1.0).fit(tx)
    n = enriched.count()
    return model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").alias("n"),
                                     (F.col("freq") / F.lit(n)).alias("support"))


def transaction_matrix(enriched: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One boolean column per distinct item (the one-hot export), plus the ``keep`` columns.

    The list of distinct items is bounded by the dimension cardinalities; only that list
    reaches the driver to name the columns.
    """
    vals = item_values(F.col("sky"), F.col("precip"), F.col("is_weekend"), F.col("creative_type"), F.col("category"))
    items = F.array(*[F.concat(F.lit(p), v) for p, v in zip(ITEM_PREFIXES, vals)])
    tx = enriched.select(*keep, items.alias("items"))
    # names come from the distinct combinations of the five dimensions, not from an exploded log
    names = sorted(r[0] for r in tx.select("items").distinct().select(F.explode("items")).distinct().collect())
    return tx.select(*keep, *[F.array_contains("items", n).alias(n) for n in names])


def rule_match_counts(enriched: DataFrame, rules: DataFrame) -> DataFrame:
    """F9/J6 generic path: per rule, the impressions whose items contain the rule's items.

    No nested-loop join: the log is pre-aggregated on the five dimensions (map-side combine),
    each combination is expanded over the (bounded) set of rule patterns ``gid`` and masked on
    the rolled-up dimensions, then equi-joined to the rules and summed per rule.
    """
    pre = transactions(enriched).groupBy(*DIMENSIONS).agg(*_partial_sums(enriched))
    # every pattern with a context and a content item: fixed by the five dimensions, so no job at build time
    gids = [g for g in range(1 << N_DIMS) if g & CONTEXT_BITS != CONTEXT_BITS and g & CONTENT_BITS != CONTENT_BITS]
    pattern = F.explode(F.array(*[F.lit(g) for g in gids]))
    ex = pre.select("*", pattern.alias("gid"))
    masked = ex.select(
        "gid", *SUMS,
        *[F.when((F.col("gid").bitwiseAND(_bit(d))) == 0, F.col(d)).alias(d) for d in DIMENSIONS],
    )
    keys = rules.select("rule_no", "gid", *DIMENSIONS)
    cond = [masked.gid == keys.gid] + [masked[d].eqNullSafe(keys[d]) for d in DIMENSIONS]
    j = masked.join(keys, cond, "inner")
    per_rule = j.groupBy("rule_no").agg(*[F.sum(c).alias(c) for c in SUMS])
    return per_rule.select("rule_no", F.col("n").alias("n_matched"), _ctr().alias("ctr"), _cvr().alias("cvr"))
