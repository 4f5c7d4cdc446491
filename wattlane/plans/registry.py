"""Named queries over the warehouse tables, each with the SQL that defines its result."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]


# Queries that join frames by series and block, as these were dealt out, and a position.
IN_BLOCKS = {"join_features_target", "rejoin_target"}


def placed(name: str, query: Query) -> Query:
    """The query, with the session's setting on whether a join may leave rows where some of its keys put them.

    Blocks are of bounded size, so there it may. Other joins are dealt out by all their keys, since some alone can be hot.
    The results are the same either way.
    """

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", str(name not in IN_BLOCKS).lower())
        return query(spark, sf_dir)

    return run


class Catalog:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, query: Query, sql: str | None = None) -> None:
        if name in self.queries:
            raise ValueError(f"query {name} is registered twice")
        self.queries[name] = query
        if sql is not None:
            self.oracles[name] = sql

    def include(self, other: Catalog) -> None:
        for name, query in other.queries.items():
            self.add(name, query, other.oracles.get(name))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round the floating columns, so results do not depend on summation order."""
    out = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            out.append(F.round(F.col(field.name).cast("double"), digits).alias(field.name))
        else:
            out.append(F.col(field.name))
    return df.select(*out)
