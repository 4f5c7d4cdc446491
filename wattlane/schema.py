"""Column names of the panel and checks on a frame's schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SERIES = "series_id"
TS = "ts"
VALUE = "value"
KEYS = [SERIES, TS]
BLOCK = "_block"
BLOCK_KEYS = [SERIES, BLOCK, "pos"]  # the same rows of a panel as KEYS, where it still is in blocks
PART = "part"

# Named feature sets.
FEATURES = ["lag_1d", "lag_7d", "lag_30d", "lag_365d", "rolling_mean_7d", "rolling_mean_30d"]
STRATEGIES: dict[str, list[str]] = {
    "minimal": ["lag_1d"],
    "weekly": ["lag_1d", "lag_7d"],
    "rolling": ["lag_1d", "lag_7d", "rolling_mean_7d", "rolling_mean_30d"],
    "full": FEATURES,
}
MEMORY_STRATEGIES: dict[str, list[str]] = {
    "short_memory": ["lag_1d"],
    "seasonality": ["lag_7d", "lag_30d"],
    "tendency": ["rolling_mean_7d", "rolling_mean_30d"],
    "mixed": ["lag_1d", "lag_7d", "lag_30d", "rolling_mean_30d"],
    "all": FEATURES,
}
RIDGE_ALPHAS = [0.0, 1.0, 1e3, 1e9]
WEEKDAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """Fail before any job starts when a column is missing."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, T.NumericType) and field.name not in skip
    ]
