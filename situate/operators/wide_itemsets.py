"""Itemsets, rules and rule matching for item arrays of any names and width.

The five-dimension path (:mod:`situate.operators.itemsets`) needs single-valued columns; here a transaction is
an array of items. Null items are ignored, items count once in a transaction.

Mining is level-wise over bitmaps: the transactions are cut into shards, each shard keeps one bitmap an item
(bit = transaction). A level's candidates form a prefix trie; a shard counts them by ANDing the
trie's path once and taking the bit counts of all leaves below it. Only frequent items get bitmaps (at most mean
width / min_support), only counts leave a shard. The frequent itemsets are the result and the next level's trie; they pass through the
driver, ``MOST_ITEMSETS`` at most (beyond: an error that asks for a higher support).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from situate.operators.itemsets import MIN_CONFIDENCE, MIN_LIFT, MIN_SUPPORT, SUMS, _ctr, _cvr, _partial_sums, rule_measures
from situate.operators.joins import attach_row
from situate.session import materialize, scratch_path

MOST_ITEMSETS = 2_000_000
#: candidates counted in one job, bytes of one shard's bitmaps
CANDIDATES, SHARD_BYTES = 200_000, 16 << 20


def item_set(items: Column) -> Column:
    """Sorted distinct non-null items; a null array is empty."""
    return F.coalesce(F.array_sort(F.array_distinct(F.filter(items, lambda x: x.isNotNull()))), F.array().cast("array<string>"))


# ---- mining ----------------------------------------------------------------------------------------

def _bitmaps(names: list[str]):
    """Rows (size, bits): for each shard one bitmap an item, in the order of ``names``."""
    place = {n: i for i, n in enumerate(names)}
    most = max(8, SHARD_BYTES * 8 // max(len(names), 1))

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, most):
                part = batch.column("items").slice(i, most)
                flat = part.flatten().dictionary_encode()
                known = np.array([place.get(n, -1) for n in flat.dictionary.to_pylist()], np.int64)
                item = known[np.asarray(flat.indices)] if len(flat) else np.empty(0, np.int64)
                row = np.repeat(np.arange(len(part)), np.diff(np.asarray(part.offsets)))
                grid = np.zeros((len(names), len(part)), bool)
                grid[item[item >= 0], row[item >= 0]] = True
                yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int64()), pa.array([np.packbits(grid, axis=1).tobytes()], pa.binary())], names=["size", "bits"])
    return run


def _count(candidates: np.ndarray, n_items: int):
    """Rows (candidate, n) of a partition's shards; ``candidates`` [count, k] in order, so equal prefixes stand together."""
    k = candidates.shape[1]
    new = np.ones(len(candidates), bool)
    new[1:] = (candidates[1:, :-1] != candidates[:-1, :-1]).any(axis=1)
    cut = np.append(np.flatnonzero(new), len(candidates)).tolist()

    def run(batches):
        total = np.zeros(len(candidates), np.int64)
        for batch in batches:
            for bits in batch.column("bits").to_pylist():
                rows = np.frombuffer(bits, np.uint8).reshape(n_items, -1)
                path: list[np.ndarray] = []  # ANDed bitmaps along the trie's current path
                held: list[int] = []
                for a, b in zip(cut[:-1], cut[1:]):
                    prefix = candidates[a, :k - 1].tolist()
                    same = 0
                    while same < len(held) and held[same] == prefix[same]:
                        same += 1
                    del path[same:]
                    for item in prefix[same:]:
                        path.append(rows[item] & path[-1] if path else rows[item])
                    held = prefix
                    if path[-1].any():
                        total[a:b] += np.bitwise_count(rows[candidates[a:b, -1]] & path[-1]).sum(axis=1, dtype=np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["candidate", "n"])
    return run


def _next_level(level: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """Itemsets one item larger all of whose parts are in ``level`` (ordered)."""
    known, out, i = set(level), [], 0
    while i < len(level):
        j = i
        while j < len(level) and level[j][:-1] == level[i][:-1]:
            j += 1
        for x, y in combinations(level[i:j], 2):
            new = (*x, y[-1])
            if all(new[:p] + new[p + 1:] in known for p in range(len(new) - 2)):
                out.append(new)
        i = j
    return out


def mine_itemsets(tx: DataFrame, items: str = "items", min_support: float = MIN_SUPPORT, longest: int | None = None) -> DataFrame:
    """(items sorted, n, n_total, support): all itemsets with support >= ``min_support``, of ``longest`` items at most."""
    spark = tx.sparkSession
    sets = tx.select(item_set(F.col(items)).alias("items"))
    total = sets.count()
    least = max(1, int(np.ceil(min_support * total - 1e-9)))
    single = sets.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    found = sorted((r["item"], r["n"]) for r in single.collect())
    names = [n for n, _ in found]
    result = [((i,), n) for i, (_, n) in enumerate(found)]
    level = [s for s, _ in result]
    path = scratch_path(spark, "item-bitmaps")
    if names:
        sets.mapInArrow(_bitmaps(names), "size long, bits binary").write.parquet(path)
    while level and (longest is None or len(level[0]) < longest):
        level, counted = _next_level(level), []
        for i in range(0, len(level), CANDIDATES):
            part = level[i:i + CANDIDATES]
            shards = spark.read.parquet(path).select("bits")
            n = shards.mapInArrow(_count(np.array(part, np.int32), len(names)), "candidate long, n long").groupBy("candidate").agg(F.sum("n").alias("n"))
            counted += sorted((part[r["candidate"]], r["n"]) for r in n.where(F.col("n") >= least).collect())
        result += counted
        if len(result) > MOST_ITEMSETS:
            raise ValueError(f"more than {MOST_ITEMSETS} frequent itemsets: raise min_support above {min_support}")
        level = [s for s, _ in counted]
    rows = [([names[i] for i in s], n) for s, n in result]
    return spark.createDataFrame(rows, "items array<string>, n long").select(
        "items", "n", F.lit(total).cast("long").alias("n_total"), (F.col("n") / F.lit(max(total, 1))).alias("support"))


# ---- rules -----------------------------------------------------------------------------------------

def lattice_rules(itemsets: DataFrame, antecedent: Callable[[Column], Column] | None = None, consequent: Callable[[Column], Column] | None = None,
                  min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT) -> DataFrame:
    """Every split of every itemset into two non-empty sides with its measures: consequents of several items included.

    ``antecedent`` / ``consequent``: a test that each item of the side must pass. By downward closure both sides are
    itemsets of the table, so their supports are two equi-joins on the item array."""
    # bits of 1 .. 2^m - 2: the non-empty proper subsets
    split = itemsets.where(F.size("items") > 1).withColumn("mask", F.explode(F.expr("sequence(1L, shiftleft(1L, size(items)) - 2L)")))
    side = lambda bit: F.filter("items", lambda x, i: F.getbit("mask", i) == bit)
    rules = split.withColumn("antecedents", side(1)).withColumn("consequents", side(0))
    for name, test in (("antecedents", antecedent), ("consequents", consequent)):
        if test is not None:
            rules = rules.where(F.forall(name, test))
    part = itemsets.select("items", "support")
    rules = rules.join(part.select(F.col("items").alias("antecedents"), F.col("support").alias("antecedent_support")), "antecedents")
    rules = rules.join(part.select(F.col("items").alias("consequents"), F.col("support").alias("consequent_support")), "consequents")
    sup, sa, sc = F.col("support"), F.col("antecedent_support"), F.col("consequent_support")
    rules = rules.withColumn("confidence", sup / sa).withColumn("lift", F.col("confidence") / sc)
    rules = rules.where((F.col("confidence") >= F.lit(min_confidence)) & (F.col("lift") >= F.lit(min_lift)))
    return rules.select("antecedents", "consequents", "items", F.size("items").alias("size"), F.col("n").alias("n_matched"), "antecedent_support", "consequent_support",
                        "support", "confidence", "lift", *rule_measures(sup, sa, sc, F.col("confidence")))


def numbered(rules: DataFrame) -> DataFrame:
    """``rule_no`` by itemset size, items, then antecedents."""
    return rules.withColumn("rule_no", F.row_number().over(Window.orderBy("size", "items", "antecedents")))


# ---- matching --------------------------------------------------------------------------------------

def rule_match_arrays(tx: DataFrame, rules: DataFrame, rule_id: str = "rule_no", rule_items: str = "items", items: str = "items") -> DataFrame:
    """For each rule the transactions that hold all its items, with CTR, CVR and their gains.

    ``tx``: an item array, clicked, converted; ``rules``: an id and an item array, names as they come. An inverted
    index on each rule's rarest item: a transaction meets only the rules whose rarest item it holds, then all items
    are compared. Transactions with equal item sets are added up first. A rule that matches nothing has zeros (gains too), a rule
    without items matches everything; rules that repeat an id count as one with the union of their items."""
    # read by the index, the match and the total: written once instead of scanning the log three times
    grouped = materialize(tx.select(item_set(F.col(items)).alias("items"), "clicked", "converted").groupBy("items").agg(*_partial_sums(tx)))
    wanted = rules.select(F.col(rule_id).alias("rule"), F.col(rule_items).alias("wanted"))
    wanted = materialize(wanted.groupBy("rule").agg(item_set(F.flatten(F.collect_set(F.coalesce("wanted", F.array().cast("array<string>"))))).alias("wanted")))
    single = wanted.select("rule", "wanted", F.explode("wanted").alias("item"))
    seen = grouped.select(F.explode("items").alias("item"), "n").join(single.select("item").distinct(), "item", "left_semi").groupBy("item").agg(F.sum("n").alias("seen"))
    rare = single.join(seen, "item", "left").groupBy("rule").agg(F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "item")).alias("rare"), F.first("wanted").alias("wanted"))
    index = rare.where("rare.seen > 0").select("rule", "wanted", F.col("rare.item").alias("item"))
    met = grouped.withColumn("item", F.explode("items")).join(index, "item").where(F.size(F.array_except("wanted", "items")) == 0)
    matched = met.groupBy("rule").agg(*[F.sum(c).alias(c) for c in SUMS])
    total = grouped.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS])
    everything = attach_row(wanted.where(F.size("wanted") == 0).select("rule"), total)
    sums = wanted.select("rule").join(matched.unionByName(everything.select("rule", *SUMS)), "rule", "left")
    base = total.select(_ctr().alias("base_ctr"), _cvr().alias("base_cvr"))
    out = attach_row(sums.fillna(0, list(SUMS)), base)
    gain = lambda value, base_: F.when(F.col("n") > 0, value - F.col(base_)).otherwise(0.0)
    return out.select(F.col("rule").alias(rule_id), F.col("n").alias("n_matched"), _ctr().alias("ctr"), _cvr().alias("cvr"),
                      gain(_ctr(), "base_ctr").alias("ctr_gain"), gain(_cvr(), "base_cvr").alias("cvr_gain"))


def starts_with_any(prefixes: Sequence[str]) -> Callable[[Column], Column]:
    """A test of one item: its name begins with one of ``prefixes``."""
    def test(x: Column) -> Column:
        out = F.lit(False)
        for p in prefixes:
            out = out | x.startswith(p)
        return out
    return test
