"""Pieces of the defining SQL shared by the queries."""

from __future__ import annotations

from wattlane.schema import FEATURES


def r(expression: str, digits: int = 6) -> str:
    """Rounded double without a negative zero."""
    return f"(round(CAST({expression} AS DOUBLE), {digits}) + 0.0)"


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)


DAY_FACTS = """facts AS (
  SELECT l_suppkey AS series_id, CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS ts,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS value
  FROM lineitem GROUP BY 1, 2)"""

NATION_FACTS = """facts AS (
  SELECT n_name AS series_id, CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS ts,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS value
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)"""

HOUR_FACTS = """facts AS (
  SELECT user_id AS series_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts,
         sum(CAST(value AS DECIMAL(18, 2))) AS value
  FROM events GROUP BY 1, 2)"""


def _dense(unit: str, kind: str) -> str:
    return f"""edge AS (SELECT min(ts) AS lo, max(ts) AS hi FROM facts),
grid AS (
  SELECT s.series_id, t.ts, date_diff('{unit}', t.lo, t.ts) AS pos
  FROM (SELECT DISTINCT series_id FROM facts) s,
       (SELECT lo, CAST(unnest(generate_series(lo, hi, INTERVAL 1 {unit})) AS TIMESTAMP) AS ts
        FROM edge) t),
panel AS (
  SELECT g.series_id, g.ts, CAST(coalesce(f.value, 0) AS {kind}) AS value, g.pos
  FROM grid g LEFT JOIN facts f ON g.series_id = f.series_id AND g.ts = f.ts)"""


P_DAY = DAY_FACTS + ",\n" + _dense("DAY", "BIGINT")
P_NATION = NATION_FACTS + ",\n" + _dense("DAY", "BIGINT")
P_HOUR = HOUR_FACTS + ",\n" + _dense("HOUR", "DOUBLE")

FLEET = "fleet AS (SELECT ts, avg(CAST(value AS DOUBLE)) AS fleet_mean FROM panel GROUP BY ts)"
DAILY = """daily AS (
  SELECT CAST(ts AS DATE) AS day, avg(fleet_mean) AS fleet_mean FROM fleet GROUP BY 1)"""


def lag_sql(steps: int, value: str = "value") -> str:
    return f"lag({value}, {steps}) OVER (PARTITION BY series_id ORDER BY ts)"


def window_sql(steps: int, inclusive: bool = False, value: str = "value") -> str:
    frame = (
        f"ROWS BETWEEN {steps - 1} PRECEDING AND CURRENT ROW"
        if inclusive
        else f"ROWS BETWEEN {steps} PRECEDING AND 1 PRECEDING"
    )
    over = f"OVER (PARTITION BY series_id ORDER BY ts {frame})"
    return (
        f"CASE WHEN count({value}) {over} = {steps}"
        f" THEN CAST(sum({value}) {over} AS DOUBLE) / {steps} END"
    )


def features_cte(source: str = "panel", inclusive: bool = False, per_day: int = 1) -> str:
    parts = []
    for name in FEATURES:
        days = int(name.rsplit("_", 1)[1].removesuffix("d"))
        steps = days * per_day
        body = lag_sql(steps) if name.startswith("lag") else window_sql(steps, inclusive)
        parts.append(f"{body} AS {name}")
    return f"feats AS (SELECT series_id, ts, value, pos, {', '.join(parts)} FROM {source})"


F_DAY = P_DAY + ",\n" + features_cte()

CLEAN = f"clean AS MATERIALIZED (SELECT * FROM feats WHERE {' AND '.join(f'{f} IS NOT NULL' for f in FEATURES)})"


def part_sql(train: tuple[int, ...], validation: int, test: int) -> str:
    """Part of a row under a split by calendar years."""
    years = ", ".join(str(y) for y in train)
    return (
        f"CASE WHEN year(ts) IN ({years}) THEN 'train' WHEN year(ts) = {validation}"
        f" THEN 'validation' WHEN year(ts) = {test} THEN 'test' END"
    )


PART_V1 = part_sql((1998, 1999), 2000, 2001)
PART_V2 = (
    "CASE WHEN year(ts) = 2000 THEN 'train'"
    " WHEN ts >= TIMESTAMP '2001-01-01' AND ts < TIMESTAMP '2001-07-01' THEN 'validation'"
    " WHEN ts >= TIMESTAMP '2001-07-01' THEN 'test' END"
)
