"""Mixing sources to target weights: hierarchical token budgets and seeded epochs.

The tree is given by level columns (domain, language, source by default). A total budget is split top
down: at each node the children share its budget by weight, a child that has less than its share gives
the rest to its siblings, and only a node whose whole subtree is short gives to its own siblings. What a
leaf can give is its tokens times ``max_epochs``. All in exact integers; the remainders of the divisions
(fewer tokens than nodes) stay unspent.

A leaf's budget buys whole epochs, then a token-prefix of one more: its documents in the order of
md5(seed:epoch:id), as long as the running total of tokens stays within the budget.

Scale: totals, md5 buckets (4096 a leaf) and the one bucket that holds a leaf's cut are aggregated before
any window runs, so a leaf with a third of all rows is never sorted in one task. Documents are selected
by comparing their md5 with their leaf's cut: texts aren't shuffled while the leaf table is within
``LEAVES`` rows (it is counted, then broadcast); beyond, it is joined by shuffle.

Budgets are whole numbers of up to 38 digits until a node's share is known, so no product of tokens and weights
overflows. Internal columns carry the rows of ``docs`` as one struct: any column name may occur. Columns named like the two
marks (``mix_tokens``, ``copies`` unless renamed) are replaced by them.

Null level values are the empty name; null text has no tokens; documents without tokens come with their
place in the order; repeated rows (equal id) are taken together or not at all. Weights must be whole
numbers >= 0; names without one weigh 1. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from situate.session import materialize

LEVELS = ("domain", "lang", "source")
LEAVES = 50_000
WHOLE = "decimal(38,0)"


def word_count(text: str) -> Column:
    """Words ([^\\x20\\x09-\\x0D]+) of a text column; null: 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(level: str, table: dict[str, int]) -> Column:
    cases = reduce(lambda c, kv: c.when(F.col(level) == kv[0], kv[1]), sorted(table.items()), F.when(F.lit(False), 0))
    return (cases.otherwise(1) if table else F.lit(1)).cast("long")


def _share(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Adds ``given`` to nodes (parent columns, have, weight, budget: the parent's)."""
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    df = nodes.withColumns({c: F.col(c).cast(WHOLE) for c in ("have", "weight", "budget")})
    # have / weight in order: its whole part is exact, its fraction has the weight's few digits
    ratio = [F.expr("CASE WHEN weight > 0 THEN have div weight END").asc_nulls_last(), F.expr("CASE WHEN weight > 0 THEN CAST(have % weight AS DOUBLE) / CAST(weight AS DOUBLE) END")]
    order = by.orderBy(*ratio, "name")
    df = df.withColumn("before", F.sum("have").over(order.rowsBetween(Window.unboundedPreceding, -1)).cast(WHOLE))
    df = df.withColumn("before", F.coalesce("before", F.lit(0).cast(WHOLE)))
    df = df.withColumn("rest", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).cast(WHOLE))
    full = (F.col("weight") > 0) & (F.col("have") * F.col("rest") <= F.col("weight") * (F.col("budget") - F.col("before")))
    df = df.withColumn("full", F.min(full).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("have"))).over(by), F.lit(0).cast(WHOLE))
    df = df.withColumn("left", (F.col("budget") - taken).cast(WHOLE))
    df = df.withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight"))).over(by).cast(WHOLE))
    given = F.when(F.col("full"), F.col("have").cast("long")).when(F.col("weight") > 0, F.expr("weight * left div open")).otherwise(0)
    return df.withColumn("given", given).drop("before", "rest", "full", "left", "open")


def budgets(leaves: DataFrame, total: Column | int, weights: dict[str, dict[str, int]], levels=LEVELS, max_epochs: int = 1) -> DataFrame:
    """Level columns, tokens, budget per leaf, from (levels, tokens). ``total`` may be an expression over
    ``supply``, the tokens of all leaves."""
    leaves = leaves.groupBy(*levels).agg(F.sum("tokens").alias("tokens"))
    above = None
    for depth, level in enumerate(levels):
        keys = list(levels[:depth + 1])
        nodes = leaves.groupBy(*keys).agg(F.sum(F.col("tokens") * max_epochs).alias("have"))
        nodes = nodes.withColumn("name", F.col(level)).withColumn("weight", _weight(level, weights.get(level, {})))
        if above is None:
            supply = F.sum("have").over(Window.partitionBy(F.lit(0)))
            want = total if isinstance(total, Column) else F.lit(total)
            nodes = nodes.withColumn("supply", supply).withColumn("supply", F.expr(f"supply div {max_epochs}")).withColumn("budget", want.cast("long")).drop("supply")
        else:
            nodes = nodes.join(above, keys[:-1])
        above = _share(nodes, keys[:-1]).select(*keys, F.col("given").alias("budget"))
    return leaves.join(above, list(levels))


def select_mixture(docs: DataFrame, total: Column | int, weights: dict[str, dict[str, int]], seed: int = 0, max_epochs: int = 1,
                   levels: dict[str, Column] | None = None, tokens: Column | None = None, id_col: str = "doc_id",
                   text_col: str = "text", marks: tuple[str, str] = ("mix_tokens", "copies")) -> DataFrame:
    """The rows of ``docs`` that are selected, with all their columns, then the ``marks``: tokens and copies
    (in how many epochs a row is taken). ``levels``: an expression for each level of the tree."""
    levels = levels or {k: F.col(k) for k in LEVELS}
    names = [f"__level_{k}" for k in levels]
    own = [c for c in docs.columns if c not in marks]
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("__row"), F.col(id_col).alias("__id"), *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in zip(names, levels.values())],
                        (word_count(text_col) if tokens is None else tokens).cast("long").alias("tokens"))
    named = {n: weights.get(k, {}) for n, k in zip(names, levels)}
    narrow = materialize(keyed.select("__id", *names, "tokens"))
    leaf = budgets(narrow.select(*names, "tokens"), total, named, tuple(names), max_epochs)
    leaf = leaf.withColumn("epochs", F.when(F.col("tokens") > 0, F.least(F.lit(max_epochs), F.expr("budget div tokens"))).otherwise(max_epochs))
    leaf = leaf.withColumn("want", F.when(F.col("epochs") < max_epochs, F.col("budget") - F.col("epochs") * F.col("tokens")).otherwise(-1))
    leaf = materialize(leaf.select(*names, "epochs", "want"))
    few = leaf.count() <= LEAVES
    near = (lambda d: F.broadcast(d)) if few else (lambda d: d)

    def order(ident: str) -> Column:
        return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.coalesce(F.col(ident).cast("string"), F.lit(""))))

    placed = narrow.join(near(leaf.where("want >= 0")), names).withColumn("__md5", order("__id")).withColumn("__bucket", F.substring("__md5", 1, 3))
    sums = placed.groupBy(*names, "want", "__bucket").agg(F.sum("tokens").alias("t"))
    w = Window.partitionBy(*names).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)
    cum = sums.withColumn("upto", F.sum("t").over(w))
    edge = materialize(cum.where("upto > want").groupBy(*names).agg(F.min(F.struct("__bucket", (F.col("upto") - F.col("t")).alias("before"))).alias("m"))
                       .select(*names, F.col("m.__bucket").alias("__bucket"), F.col("m.before").alias("before")))
    run = Window.partitionBy(*names).orderBy("__md5")  # the default range frame takes ties together
    inside = placed.join(near(edge), [*names, "__bucket"]).withColumn("upto", F.col("before") + F.sum("tokens").over(run)).where("upto <= want")
    last = inside.groupBy(*names).agg(F.max("__md5").alias("last"))
    cuts = edge.select(*names, "__bucket").join(last, names, "left").select(*names, F.coalesce("last", "__bucket").alias("cut"))
    plan = materialize(leaf.join(cuts, names, "left").select(*names, "epochs", F.when(F.col("want") >= 0, F.coalesce("cut", F.lit("g"))).otherwise("").alias("cut")))
    out = keyed.join(near(plan), names).withColumn("copies", F.col("epochs").cast("int") + (order("__id") <= F.col("cut")).cast("int"))
    return out.where("copies > 0").select(*[F.col(f"__row.`{c}`").alias(c) for c in own], F.col("tokens").alias(marks[0]), F.col("copies").alias(marks[1]))
