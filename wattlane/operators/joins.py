"""Key joins, unions and projections of feature frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.schema import KEYS, VALUE, require_columns

HELPERS = ["value", "value_kwh", "year_month", "pos"]


def select_strategy(df: DataFrame, names: list[str], target: str = VALUE) -> DataFrame:
    """Keys, the features of a strategy and the target; fails on missing columns."""
    require_columns(df, [*names, target])
    keys = [k for k in [*KEYS, "part"] if k in df.columns]
    return df.select(*keys, *names, target)


def features_and_target(df: DataFrame, target: str = VALUE, on: list[str] = KEYS) -> tuple[DataFrame, DataFrame]:
    """Split a feature frame in two tables on the same key."""
    require_columns(df, [*on, target])
    return df.drop(*{*HELPERS, target}.difference(on)), df.select(*on, target)


def join_features_target(features: DataFrame, target_table: DataFrame, target: str, on: list[str] = KEYS) -> DataFrame:
    """Inner equi-join on series and timestamp; the pair is unique, so no key is hot.

    Two frames that still are in the blocks of one panel can be joined ``on`` BLOCK_KEYS instead: a pair of rows is in one
    task and in order, so neither side is shuffled or sorted again (see ``plans.registry.placed``).
    """
    require_columns(features, on)
    require_columns(target_table, [*on, target])
    return features.join(target_table.select(*on, target).hint("merge"), on)


def rejoin_target(features: DataFrame, target_table: DataFrame, on: list[str] = KEYS) -> DataFrame:
    """Both sides can be panels, which unfold from little, so neither is broadcast on an estimate of its size."""
    return features.join(target_table.hint("merge"), on, "left")


def union_parts(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def union_with_group_key(tables: dict[str, DataFrame], name: str) -> DataFrame:
    return union_parts(
        *[df.select(F.lit(label).alias(name), *df.columns) for label, df in tables.items()]
    )


def run_labels(runs: DataFrame, strategy: str, split: str) -> DataFrame:
    """Strategy and split of each run under their usual names, and both as one label."""
    return runs.select(
        "run_id",
        F.col(strategy).alias("strategy"),
        F.col(split).alias("split"),
        F.concat_ws(" | ", F.col(strategy), F.col(split)).alias("label"),
    )
