"""All registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattlane.plans import model_queries, panel_queries, registry_queries
from wattlane.plans.registry import Catalog


def catalog() -> Catalog:
    out = Catalog()
    for module in (panel_queries, model_queries, registry_queries):
        out.include(module.CATALOG)
    return out


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature strategy on both splits, ranked by validation error."""
    return model_queries.strategy_leaderboard(spark, sf_dir)
