"""SQL for ridge fits: moments, then elimination written out column by column."""

from __future__ import annotations

from wattlane.plans.oracle import r


def solve_ctes(
    name: str,
    source: str,
    features: list[str],
    alpha: float = 0.0,
    where: str = "true",
    target: str = "value",
    standardize: bool = False,
) -> str:
    """CTEs ending in one row ``name`` with columns w0.., and b (intercept)."""
    p = len(features)
    columns = [f"CAST({c} AS DOUBLE)" for c in [*features, target]]
    first = ["count(*) AS n"]
    first += [f"avg({c}) AS m{i}" for i, c in enumerate(columns)]
    for i in range(p):
        for j in range(i, p + 1):
            first.append(f"covar_pop({columns[i]}, {columns[j]}) * count(*) AS c{i}_{j}")
    ctes = [f"{name}_g AS MATERIALIZED (SELECT {', '.join(first)} FROM {source} WHERE {where})"]
    means = ", ".join(f"m{i}" for i in range(p + 1))
    entries = []
    for i in range(p):
        for j in range(p + 1):
            cell = f"c{min(i, j)}_{max(i, j)}"
            if i == j and alpha:
                cell += f" + {alpha!r} * " + (f"(c{i}_{i} / n)" if standardize else "1")
            entries.append(f"{cell} AS a{i}_{j}")
    ctes.append(f"{name}_e AS MATERIALIZED (SELECT {means}, {', '.join(entries)} FROM {name}_g)")
    last = f"{name}_e"
    for k in range(p):
        entries = []
        for i in range(p):
            for j in range(p + 1):
                cell = f"a{i}_{j}"
                if i != k:
                    cell = f"a{i}_{j} - a{i}_{k} / a{k}_{k} * a{k}_{j}"
                entries.append(f"{cell} AS a{i}_{j}")
        ctes.append(f"{name}_s{k} AS (SELECT {means}, {', '.join(entries)} FROM {last})")
        last = f"{name}_s{k}"
    weights = ", ".join(f"a{i}_{p} / a{i}_{i} AS w{i}" for i in range(p))
    slope = "".join(f" - a{i}_{p} / a{i}_{i} * m{i}" for i in range(p))
    ctes.append(f"{name} AS (SELECT {weights}, m{p}{slope} AS b FROM {last})")
    return ",\n".join(ctes)


def predict_sql(model: str, features: list[str]) -> str:
    return f"{model}.b" + "".join(f" + {model}.w{i} * {c}" for i, c in enumerate(features))


def significant_sql(x: str, digits: int = 9) -> str:
    """``x`` (not negative) to so many significant digits."""
    return f"CASE WHEN {x} > 0 THEN round({x}, CAST({digits - 1} - floor(log10({x})) AS INTEGER)) ELSE {x} END"


def metrics_sql(
    model: str, features: list[str], source: str, where: str, head: str = "", key: bool = False
) -> str:
    """Metrics to six digits, with ``key`` also the RMSE that decides ranks, as ``rank_key``."""
    e = f"(CAST(value AS DOUBLE) - ({predict_sql(model, features)}))"
    y = "CAST(value AS DOUBLE)"
    return (
        f"SELECT {head}{significant_sql(f'sqrt(avg({e} * {e}))') + ' AS rank_key, ' if key else ''}"
        f"{r(f'sqrt(avg({e} * {e}))')} AS rmse, {r(f'avg(abs({e}))')} AS mae,"
        f" {r(f'1 - avg({e} * {e}) / var_pop({y})')} AS r2 FROM {source}, {model} WHERE {where}"
    )
