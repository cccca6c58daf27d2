"""The analysis pipeline (3.3): KPIs, counts and Top-N strategies from one enriched log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from situate.operators.enrich import enrich_log
from situate.operators.metrics import kpi_summary
from situate.operators.strategies import TOP_N_DEFAULT, top_strategies


@dataclass(frozen=True)
class PipelineData:
    enriched: DataFrame
    kpis: DataFrame          # one row: impression_count, user_count, ctr, cvr, ctcvr
    strategies: DataFrame    # ranked Top-N


def load_pipeline_data(log: DataFrame, creative_catalog: DataFrame, top_n: int = TOP_N_DEFAULT) -> PipelineData:
    """``load_pipeline_data``: enrich once and derive everything from it (the reference enriches twice)."""
    enriched = enrich_log(log, creative_catalog)
    kpis = kpi_summary(log)
    return PipelineData(enriched, kpis, top_strategies(enriched, top_n))
