"""Lag and rolling-mean features.

Windows are not partitioned by series alone: a series is cut into blocks of consecutive
positions, and each block is given the rows before it that its features look back on. A
series of any length is thus spread over many tasks, every group has a bounded size, and
the result equals that of one window over the whole series.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattlane.functions.columns import finite
from wattlane.functions.ranking import series_positions
from wattlane.operators.panel import dense_blocks
from wattlane.schema import BLOCK, KEYS, SERIES, TS, VALUE, require_columns

# Smallest block, so that short look-backs do not make tiny groups.
MIN_BLOCK_ROWS = 8192

DEFAULT_LAG_DAYS = (1, 7, 30, 365)
DEFAULT_WINDOW_DAYS = (7, 30)


def step_label(steps: int, steps_per_day: int) -> str:
    """Whole days as ``7d``, whole hours as ``3h``, else plain steps as ``2s``."""
    if steps % steps_per_day == 0:
        return f"{steps // steps_per_day}d"
    if steps * 24 % steps_per_day == 0:
        return f"{steps * 24 // steps_per_day}h"
    return f"{steps}s"


def in_blocks(panel: DataFrame, lookback: int, min_block: int = MIN_BLOCK_ROWS) -> DataFrame:
    """Give each row its block, and the last ``lookback`` rows of a block to the next one too.

    With blocks of at least four look-backs at most a quarter of the rows is doubled.
    """
    size = max(4 * lookback, min_block)
    own = F.floor(F.col("pos") / F.lit(size)).cast("bigint")
    shared = F.pmod(F.col("pos"), F.lit(size)) >= size - lookback
    owners = F.when(shared, F.array(own, own + 1)).otherwise(F.array(own))
    return panel.select("*", F.explode(owners).alias("_block")).withColumn(
        "_lead_in", F.col("_block") != own
    )


def block_window():
    return W.partitionBy(SERIES, "_block").orderBy("pos")


def leave_blocks(blocked: DataFrame, columns: list[str]) -> DataFrame:
    return blocked.where(~F.col("_lead_in")).select(*columns)


def with_positions(panel: DataFrame) -> DataFrame:
    """Dense panels carry ``pos`` already; others are counted."""
    return panel if "pos" in panel.columns else series_positions(panel)


def build_features(
    panel: DataFrame,
    steps_per_day: int,
    lags: dict[str, int] | None = None,
    windows: dict[str, int] | None = None,
    inclusive: bool = False,
    value: str = VALUE,
    min_block: int = MIN_BLOCK_ROWS,
) -> DataFrame:
    """Positional lags and rolling means per series.

    ``lags`` and ``windows`` map a column name to a number of steps; by default they are
    the lags of 1, 7, 30 and 365 days and the windows of 7 and 30 days. A rolling mean
    covers the rows before the current one, or ends at it when ``inclusive``; it is null
    until the window is full or when a value in it is missing. Means come from running
    sums, so their cost does not grow with the window. Sums of floating values start anew at
    every multiple of the window, so a mean is free of what lies outside two windows.
    """
    require_columns(panel, [SERIES, value])
    lags, windows = _defaults(lags, windows, steps_per_day)
    panel = with_positions(panel)
    blocked = in_blocks(panel, _lookback(lags, windows, inclusive), min_block)
    return _block_features(blocked, panel.columns, lags, windows, inclusive, value)


def features_of_facts(
    facts: DataFrame,
    step_seconds: int,
    steps_per_day: int,
    lags: dict[str, int] | None = None,
    windows: dict[str, int] | None = None,
    inclusive: bool = False,
    min_block: int = MIN_BLOCK_ROWS,
    change: Callable[[DataFrame], DataFrame] | None = None,
    start: str | None = None,
    end: str | None = None,
    within: Callable[[str | None, str | None], DataFrame] | None = None,
    asked: DataFrame | None = None,
    blocks: bool = False,
) -> DataFrame:
    """What ``build_features`` gives for the dense panel of ``facts``, unfolded inside the blocks.

    ``change`` can compute the values anew, row by row. With ``start`` and ``end`` only the rows from ``start``
    until before ``end`` are given, as they are in the whole panel; only the steps that these look back on are made
    besides. ``within`` can give the facts of such a period, with the range put on the raw time column.
    With ``asked``, some (series, timestamp), only the rows with one of these keys are given. With ``blocks``, the block
    of each row stays, so that what is made of the same facts can be joined by ``BLOCK_KEYS`` where it is.
    """
    lags, windows = _defaults(lags, windows, steps_per_day)
    lookback = _lookback(lags, windows, inclusive)
    early = start and (datetime.fromisoformat(start) - timedelta(seconds=lookback * step_seconds)).isoformat()
    inside = within(early, end) if within else None
    blocked = dense_blocks(facts, step_seconds, max(4 * lookback, min_block), lookback, early, end, inside, asked)
    blocked = change(blocked) if change else blocked
    columns = [*KEYS, VALUE, "pos", *([BLOCK] if blocks else []), *([] if asked is None else ["_asked"])]
    rows = _block_features(blocked, columns, lags, windows, inclusive, VALUE)
    rows = rows if asked is None else rows.where("_asked").drop("_asked")
    return rows if start is None else rows.where(F.col(TS) >= F.lit(start).cast("timestamp_ntz"))


def _defaults(
    lags: dict[str, int] | None, windows: dict[str, int] | None, steps_per_day: int
) -> tuple[dict[str, int], dict[str, int]]:
    if lags is None:
        lags = {f"lag_{d}d": d * steps_per_day for d in DEFAULT_LAG_DAYS}
    if windows is None:
        windows = {f"rolling_mean_{d}d": d * steps_per_day for d in DEFAULT_WINDOW_DAYS}
    return lags, windows


def _lookback(lags: dict[str, int], windows: dict[str, int], inclusive: bool) -> int:
    return max([*lags.values(), *[w + (not inclusive) for w in windows.values()], 1])


def _block_features(
    blocked: DataFrame, columns: list[str], lags: dict[str, int], windows: dict[str, int], inclusive: bool, value: str
) -> DataFrame:
    past = 0 if inclusive else 1
    w = block_window()
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)

    if windows:
        exact = blocked.schema[value].dataType.typeName() not in ("float", "double")
        number = F.col(value) if exact else finite(value)
        blocked = blocked.withColumn("_cnt", F.count(number).over(upto))
        if exact:
            blocked = blocked.withColumn("_sum", F.sum(number).over(upto))
        else:
            for steps in sorted(set(windows.values())):
                blocked = _with_piece_sums(blocked, number, steps)
    added = {name: F.lag(value, steps).over(w) for name, steps in lags.items()}
    for name, steps in windows.items():
        total = _running_total(w, "_sum", steps, past) if exact else _piece_total(w, steps, past)
        full = _running_total(w, "_cnt", steps, past) == steps
        added[name] = F.when(full, total.cast("double") / F.lit(float(steps)))
    return leave_blocks(blocked.withColumns(added), [*columns, *added])


def _running_total(w, column: str, steps: int, past: int) -> Column:
    newest = F.lag(column, past).over(w) if past else F.col(column)
    return newest - F.coalesce(F.lag(column, steps + past).over(w), F.lit(0))


def _with_piece_sums(blocked: DataFrame, number: Column, steps: int) -> DataFrame:
    """Sums from the start of a row's piece of ``steps`` positions, and on to the piece's end."""
    piece = F.floor(F.col("pos") / F.lit(steps))
    inside = W.partitionBy(SERIES, "_block", piece).orderBy("pos")
    known = F.coalesce(number, F.lit(0.0))
    to_here = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    from_here = inside.rowsBetween(W.currentRow, W.unboundedFollowing)
    return blocked.select(
        "*",
        F.sum(known).over(to_here).alias(f"_head_{steps}"),
        F.sum(known).over(from_here).alias(f"_tail_{steps}"),
    )


def _piece_total(w, steps: int, past: int) -> Column:
    """A window is the head of one piece and, unless it is all of it, the tail of the one before."""
    head, oldest = f"_head_{steps}", F.lag(f"_tail_{steps}", steps - 1 + past).over(w)
    newest = F.lag(head, past).over(w) if past else F.col(head)
    whole = F.pmod(F.col("pos") - past, F.lit(steps)) == steps - 1
    return newest + F.when(whole, F.lit(0.0)).otherwise(oldest)


def sub_day_lags(panel: DataFrame, steps_per_day: int) -> DataFrame:
    """One step, one hour, one day and one week back, under names of their own."""
    lags = {
        "lag_1_step": 1,
        "lag_1h": max(1, steps_per_day // 24),
        "lag_24h": steps_per_day,
        "lag_7d": 7 * steps_per_day,
    }
    return build_features(panel, steps_per_day, lags=lags, windows={})


def persistence_errors(
    panel: DataFrame, lags: dict[str, int], start: str, end: str, by: list[str] | None = None
) -> DataFrame:
    """RMSE and MAE of "the same time ``lag`` ago" over rows in [start, end), in long form.

    The lag is taken on the whole panel and only then is the period cut out.
    """
    by = by or []
    lagged = build_features(panel, 1, lags=lags, windows={}).where(
        (F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
        & (F.col("ts") < F.lit(end).cast("timestamp_ntz"))
    )
    parts = []
    for name in lags:
        error = F.col(VALUE).cast("double") - F.col(name).cast("double")
        parts += [F.count(error), F.sum(error * error), F.sum(F.abs(error))]
    parts = [part.alias(f"_p{i}") for i, part in enumerate(parts)]
    wide = lagged.groupBy(*by).agg(*parts)
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("baseline"),
                F.lit(steps).cast("bigint").alias("lag_steps"),
                F.col(f"_p{3 * i}").alias("n"),
                F.sqrt(F.col(f"_p{3 * i + 1}") / F.col(f"_p{3 * i}")).alias("rmse"),
                (F.col(f"_p{3 * i + 2}") / F.col(f"_p{3 * i}")).alias("mae"),
            )
            for i, (name, steps) in enumerate(lags.items())
        ]
    )
    return (
        wide.select(*by, F.explode(rows).alias("r")).select(*by, "r.*").where(F.col("n") > 0)
    )
