"""Deterministic weighted choice of one row per key (exponential race)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from situate.functions.scoring import hash_uniform
from situate.operators.rows import first_rows


def race_key(weight: Column, seed: int, *row_id: Column) -> Column:
    """``-ln(u) / w`` with u a hash-uniform of (seed, row id): the smallest key wins with
    probability proportional to ``w`` (Efraimidis & Spirakis 2006). Non-positive weights never win."""
    u = hash_uniform(F.lit(seed), *row_id)
    return F.when(weight > 0, -F.log(u) / weight)


def weighted_choice(df: DataFrame, keys: Sequence[str], weight: Column, row_id: Sequence[str],
                    seed: int = 42) -> DataFrame:
    """One row per key, chosen with probability ∝ weight; same pick on retry or repartition.

    Each task keeps one candidate a key before the shuffle. Equal race keys are decided by the row id; a key
    without a positive weight has a null pick.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    race = race_key(weight, seed, *[F.col(k) for k in keys], *[F.col(r) for r in row_id])
    picked = first_rows(df.withColumn("race_key", race), keys, [F.col("race_key").asc_nulls_last(), *row_id])
    return picked.select(*keys, *[F.when(F.col("race_key").isNotNull(), F.col(c)).alias(c) for c in others], "race_key")
