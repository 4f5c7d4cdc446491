"""Batch scoring of requests and tables."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.functions.columns import floor_hour, floor_minute
from wattlane.operators.governance import alias_current
from wattlane.operators.linear import model_from_table
from wattlane.schema import KEYS, SERIES, TS, require_columns


class Model(Protocol):
    """What can be scored: a linear model or trees, fitted just now or read from a table."""

    features: tuple[str, ...]

    def prediction(self) -> Column: ...


_FLOOR = {"minute": floor_minute, "hour": floor_hour}


def asked_keys(requests: DataFrame, unit: str = "minute") -> DataFrame:
    """The keys of the feature rows that the requests ask for."""
    return requests.select(SERIES, _FLOOR[unit](TS).alias(TS)).distinct()


def lookup_features(
    requests: DataFrame, features: DataFrame, names: list[str], unit: str = "minute"
) -> DataFrame:
    """Features of each request at its timestamp cut to the minute (or hour).

    A request without a row, or with a feature missing, gets an ``error`` and null features;
    the others are unaffected. Feature keys are unique, so a much requested key only makes
    the request side uneven, which adaptive execution splits. Features can unfold from little, so of a batch
    they are not broadcast on an estimate of their size.
    """
    require_columns(features, [*KEYS, *names])
    table = features.select(*KEYS, *names, F.lit(True).alias("_found")).withColumnRenamed(
        TS, "_key"
    )
    keyed = requests.withColumn("_key", _FLOOR[unit](TS))
    joined = keyed.join(table if requests.isStreaming else table.hint("merge"), [SERIES, "_key"], "left")
    missing = F.concat_ws(", ", *[F.when(F.col(n).isNull(), F.lit(n)) for n in names])
    at = F.concat(
        F.col(SERIES).cast("string"), F.lit(" at "), F.date_format("_key", "yyyy-MM-dd'T'HH:mm")
    )
    error = F.when(
        F.col("_found").isNull(), F.concat(F.lit("no features for "), at)
    ).when(missing != "", F.concat(F.lit("features missing for "), at, F.lit(": "), missing))
    out = joined.withColumn("error", error)
    return out.select(
        *requests.columns,
        *[F.when(F.col("error").isNull(), F.col(n)).alias(n) for n in names],
        "error",
    )


def score_requests(
    requests: DataFrame, features: DataFrame, model: Model, unit: str = "minute"
) -> DataFrame:
    """Prediction and features, or an error text, for every request; an empty batch is an error.

    Only the features of the requested series and of the time they span are looked at.
    """
    if not requests.isStreaming:
        require_requests(requests)
        features = asked_features(requests, features, unit)
    names = list(model.features)
    found = lookup_features(requests, features, names, unit)
    good = F.col("error").isNull()
    return found.select(
        *requests.columns,
        F.when(good, model.prediction()).alias("prediction"),
        F.when(good, F.struct(*names)).alias("features"),
        "error",
    )


def asked_features(requests: DataFrame, features: DataFrame, unit: str = "minute") -> DataFrame:
    """Feature rows between the first and last time asked for, of the series asked for."""
    key = _FLOOR[unit](TS)
    span = requests.agg(F.struct(F.min(key).alias("lo"), F.max(key).alias("hi"))).scalar()
    series = requests.select(SERIES).distinct()
    return features.where(F.col(TS).between(span["lo"], span["hi"])).join(series, SERIES, "left_semi")


def require_requests(requests: DataFrame) -> None:
    if requests.isEmpty():
        raise ValueError("a batch needs at least one request")


def score_table(df: DataFrame, model: Model) -> DataFrame:
    """Prediction from the features the model was fitted on, whatever else the table holds."""
    require_columns(df, model.features)
    return df.withColumn("prediction", model.prediction())


def model_at_alias(
    table: DataFrame,
    events: DataFrame,
    model_name: str,
    alias: str = "champion",
    load: Callable[[DataFrame, str], Model] = model_from_table,
) -> Model:
    """The model an alias points at; ``table`` (coefficients or nodes of trees) is keyed by model name and version."""
    row = alias_current(
        events.where((F.col("model_name") == model_name) & (F.col("alias") == alias))
    ).first()
    if row is None:
        raise KeyError(f"{model_name} has no alias {alias!r}")
    own = table.where(
        (F.col("model_name") == model_name) & (F.col("version") == row["version"])
    ).withColumn("model_id", F.lit(model_name))
    return load(own, model_name)


def score_with_champion(
    df: DataFrame,
    table: DataFrame,
    events: DataFrame,
    model_name: str,
    load: Callable[[DataFrame, str], Model] = model_from_table,
) -> DataFrame:
    return score_table(df, model_at_alias(table, events, model_name, load=load))
