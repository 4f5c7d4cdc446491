"""Queries on samples, splits, model fits, evaluation and drift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.operators import boosting, deeptree, drift, evaluate, features, filters, linear, panel, profiles
from wattlane.operators import sampling, scoring, splits, trees
from wattlane.plans import panels as P
from wattlane.plans.oracle import (
    CLEAN, F_DAY, P_DAY, P_HOUR, PART_V1, PART_V2, lag_sql, r, with_ctes,
)
from wattlane.plans.oracle_linear import metrics_sql, predict_sql, significant_sql, solve_ctes
from wattlane.plans.panel_queries import HASH_SQL, bin_sql
from wattlane.plans.registry import Catalog, rounded
from wattlane.schema import (
    FEATURES, KEYS, MEMORY_STRATEGIES, PART, RIDGE_ALPHAS, SERIES, STRATEGIES, TS, VALUE,
)
from wattlane.session import materialize

CATALOG = Catalog()
add = CATALOG.add

YEARS = (1998, 1999, 2000, 2001)
# Days that the splits can hold: from the first, until before the second.
V1_DAYS, V2_DAYS = ("1998-01-01", "2002-01-01"), ("2000-01-01", "2002-01-01")
DAY, FEAT = with_ctes(P_DAY), with_ctes(F_DAY)
CLEAN_V1 = CLEAN + f",\nparts AS MATERIALIZED (SELECT *, {PART_V1} AS part FROM clean)"
CLEAN_V2 = CLEAN + f",\nparts AS MATERIALIZED (SELECT *, {PART_V2} AS part FROM clean)"
V1 = with_ctes(F_DAY, CLEAN_V1)
V2 = with_ctes(F_DAY, CLEAN_V2)


def split_v1(df: DataFrame) -> DataFrame:
    return splits.split_v1(df, YEARS)


def split_v2(df: DataFrame) -> DataFrame:
    return splits.split_v2(df, train_year=2000, cutoff="2001-07-01")


def prepared(spark, sf, split=split_v1, days=V1_DAYS) -> DataFrame:
    """Complete feature rows of the days with their part, written once because fits and scores read it."""
    df = filters.drop_incomplete(P.daily_features(spark, sf, *days), FEATURES)
    return materialize(split(df).drop("pos"), "features")


# ---- sorting and sampling

add(
    "top_k",
    lambda s, d: P.daily_panel(s, d).orderBy(F.desc(VALUE), *KEYS).limit(20),
    f"{DAY} SELECT series_id, ts, value, pos FROM panel ORDER BY value DESC, series_id, ts LIMIT 20",
)
add(
    "sample_n",
    lambda s, d: sampling.sample_n(P.daily_panel(s, d), 5000, seed=42),
    f"{DAY} SELECT series_id, ts, value, pos FROM panel ORDER BY {HASH_SQL.format(seed=42)} LIMIT 5000",
)
add(
    "sample_fraction",
    lambda s, d: sampling.sample_fraction(P.daily_panel(s, d), 0.01, seed=0),
    f"""{DAY} SELECT series_id, ts, value, pos FROM panel
    WHERE CAST('0x' || substr({HASH_SQL.format(seed=0)}, 1, 8) AS BIGINT) < {int(0.01 * 2**32)}""",
)

# ---- temporal splits


def part_digest(df: DataFrame) -> DataFrame:
    return df.groupBy(PART, SERIES).agg(
        F.count("*").alias("rows"), F.sum(VALUE).alias("total"),
        F.min(TS).alias("first_ts"), F.max(TS).alias("last_ts"),
    )


def part_digest_sql(part: str, ctes: str = DAY, source: str = "panel") -> str:
    return f"""{ctes} SELECT part, series_id, count(*) AS "rows", CAST(sum(value) AS BIGINT) AS total,
    min(ts) AS first_ts, max(ts) AS last_ts FROM (SELECT *, {part} AS part FROM {source})
    WHERE part IS NOT NULL GROUP BY 1, 2"""


add("split_v1", lambda s, d: part_digest(split_v1(P.daily_panel(s, d, *V1_DAYS))), part_digest_sql(PART_V1))
add("split_v2", lambda s, d: part_digest(split_v2(P.daily_panel(s, d, *V2_DAYS))), part_digest_sql(PART_V2))
RECENT = {
    "train": ("2000-01-01", "2000-12-31"),
    "validation": ("2001-01-01", "2001-05-31"),
    "test": ("2001-06-01", "2001-12-31"),
}
add(
    "split_by_ranges",
    lambda s, d: part_digest(splits.split_by_ranges(P.daily_panel(s, d, *V2_DAYS), RECENT)),
    part_digest_sql(
        "CASE "
        + " ".join(
            f"WHEN CAST(ts AS DATE) BETWEEN DATE '{a}' AND DATE '{b}' THEN '{n}'"
            for n, (a, b) in RECENT.items()
        )
        + " END"
    ),
)
add(
    "split_years_2way",
    lambda s, d: part_digest(
        splits.split_by_years(P.daily_panel(s, d, *V1_DAYS), [1998, 1999], [], [2000, 2001])
    ),
    part_digest_sql(
        "CASE WHEN year(ts) IN (1998, 1999) THEN 'train'"
        " WHEN year(ts) IN (2000, 2001) THEN 'test' END"
    ),
)
add(
    "split_years_3way",
    lambda s, d: part_digest(splits.split_by_years(
        P.daily_panel(s, d, "1999-01-01", "2002-01-01"), [1999], [2000], [2001]
    )),
    part_digest_sql(
        "CASE year(ts) WHEN 1999 THEN 'train' WHEN 2000 THEN 'validation' WHEN 2001 THEN 'test' END"
    ),
)
TIMES = """times AS (SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS spot, count(*) OVER () AS n
  FROM (SELECT DISTINCT ts FROM panel))"""
add(
    "split_chronological",
    lambda s, d: part_digest(splits.split_chronological(P.daily_panel(s, d), 0.8)),
    part_digest_sql(
        "CASE WHEN ts <= (SELECT ts FROM times WHERE spot = CAST(floor(n * 0.8) AS BIGINT) - 1)"
        " THEN 'train' ELSE 'test' END",
        with_ctes(P_DAY, TIMES),
    ),
)


def fold_digest(df: DataFrame, folds) -> DataFrame:
    """Rows lie in one segment each, so the digests of the segments are added up for every fold."""
    segment, train, validation = splits.fold_segment(folds)
    pieces = df.groupBy(segment.alias("_segment")).agg(
        F.count("*").alias("rows"), F.sum(VALUE).alias("total"), F.min(TS).alias("first_ts"), F.max(TS).alias("last_ts")
    )
    return splits.segment_roles(pieces, folds, train, validation).groupBy("fold", "role").agg(
        F.sum("rows").alias("rows"), F.sum("total").alias("total"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
    )


def fold_digest_sql(folds: str) -> str:
    return f"""{with_ctes(P_DAY, TIMES)}, folds AS ({folds})
    SELECT fold, role, count(*) AS "rows", CAST(sum(value) AS BIGINT) AS total,
    min(ts) AS first_ts, max(ts) AS last_ts
    FROM (SELECT f.fold, p.ts, p.value, CASE WHEN t.spot <= f.train_to THEN 'train'
            WHEN t.spot BETWEEN f.val_from AND f.val_to THEN 'validation' END AS role
          FROM panel p JOIN times t ON p.ts = t.ts, folds f)
    WHERE role IS NOT NULL GROUP BY 1, 2"""


WARMUP_FOLDS = """SELECT k.range AS fold, 365 + k.range * block - 1 AS train_to,
  365 + k.range * block AS val_from,
  CASE WHEN k.range < 3 THEN 365 + (k.range + 1) * block - 1 ELSE n - 1 END AS val_to
  FROM range(1, 4) k, (SELECT n, (n - 365) // 4 AS block FROM times LIMIT 1)"""


def series_folds(k: int, gap: int) -> str:
    return f"""SELECT k.range AS fold, n - ({k} - k.range + 1) * len - {gap} - 1 AS train_to,
    n - ({k} - k.range + 1) * len AS val_from, n - ({k} - k.range) * len - 1 AS val_to
    FROM range(1, {k + 1}) k, (SELECT n, n // {k + 1} AS len FROM times LIMIT 1)"""


def _warmup_folds(s, d):
    df = P.daily_panel(s, d)
    return fold_digest(df, splits.expanding_cv_warmup(df, 3, splits.warmup_steps(FEATURES[:4], 1)))


def _series_folds(s, d):
    df = P.daily_panel(s, d)
    return fold_digest(df, splits.expanding_cv_timeseries(df, 3, gap=30))


add("expanding_cv_warmup", _warmup_folds, fold_digest_sql(WARMUP_FOLDS))
add("expanding_cv_timeseries", _series_folds, fold_digest_sql(series_folds(3, 30)))
add(
    "random_split",
    lambda s, d: part_digest(sampling.random_split(P.daily_panel(s, d), 0.2, seed=42)),
    part_digest_sql(
        f"CASE WHEN CAST('0x' || substr({HASH_SQL.format(seed=42)}, 1, 8) AS BIGINT)"
        f" < {int(0.2 * 2**32)} THEN 'test' ELSE 'train' END"
    ),
)
add(
    "split_summary",
    lambda s, d: splits.split_summary(
        split_v1(filters.drop_incomplete(P.daily_features(s, d), FEATURES))
    ),
    f"""{V1} SELECT part, count(*) AS "rows", min(ts) AS first_ts, max(ts) AS last_ts
    FROM parts WHERE part IS NOT NULL GROUP BY 1""",
)

# ---- model fits


def weights_sql(model: str, names: list[str], label: str) -> str:
    rows = [("intercept", "b"), *[(f, f"w{i}") for i, f in enumerate(names)]]
    return " UNION ALL ".join(
        f"SELECT '{label}' AS model_id, '{f}' AS feature, {r(w)} AS weight FROM {model}"
        for f, w in rows
    )


def _fit(alpha: float, label: str, standardize: bool = False):
    def query(s, d):
        rows = split_v1(P.daily_features(s, d)).where(F.col(PART) == "train")
        if alpha:
            model = linear.moments(rows, FEATURES)[None].fit(alpha, standardize=standardize)
        else:
            model = linear.fit_least_squares(rows, FEATURES).model
        return rounded(linear.coefficient_table(s, {label: model}))

    sql = (
        V1 + ", " + solve_ctes("m", "parts", FEATURES, alpha, "part = 'train'", "value", standardize)
        + " " + weights_sql("m", FEATURES, label)
    )
    return query, sql


add("fit_ridge", *_fit(1.0, "ridge_1"))
add("fit_ols", *_fit(0.0, "ols"))
add("fit_ridge_standardized", *_fit(1e3, "ridge_1000_standardized", True))
add(
    "fit_mean",
    lambda s, d: rounded(
        linear.coefficient_table(
            s,
            {
                "dummy_mean": linear.moments(
                    split_v1(P.daily_panel(s, d)).where(F.col(PART) == "train"), []
                )[None].fit()
            },
        )
    ),
    f"{DAY} SELECT 'dummy_mean' AS model_id, 'intercept' AS feature, {r('avg(value)')} AS weight"
    " FROM panel WHERE year(ts) IN (1998, 1999)",
)


def _bayesian(s, d):
    rows = split_v1(P.daily_features(s, d)).where(F.col(PART) == "train")
    model = linear.moments(rows, FEATURES)[None].fit_bayesian()
    return rounded(linear.coefficient_table(s, {"bayesian_ridge": model}))


add("fit_bayesian_ridge", _bayesian)
add(
    "coefficients",
    lambda s, d: rounded(
        linear.coefficient_table(
            s,
            linear.fit_strategies(linear.part_moments(prepared(s, d), FEATURES)["train"], STRATEGIES),
        ).orderBy("model_id", "weight")
    ),
    V1
    + "".join(
        ", " + solve_ctes(f"m_{n}", "parts", fs, 0.0, "part = 'train'")
        for n, fs in STRATEGIES.items()
    )
    + " "
    + " UNION ALL ".join(weights_sql(f"m_{n}", fs, n) for n, fs in STRATEGIES.items()),
)


def _alpha_grid(standardize: tuple[bool, ...]):
    def query(s, d):
        rows = linear.alpha_grid(prepared(s, d), FEATURES, RIDGE_ALPHAS, standardize)
        schema = "alpha double, standardize boolean, rmse double, mae double, r2 double, rank long"
        return rounded(linear.results_frame(s, rows, schema))

    cases = [(i, sc, a) for i, (sc, a) in enumerate((x, y) for x in standardize for y in RIDGE_ALPHAS)]
    ctes = "".join(
        ", " + solve_ctes(f"m{i}", "parts", FEATURES, a, "part = 'train'", "value", sc)
        for i, sc, a in cases
    )
    body = " UNION ALL ".join(
        metrics_sql(
            f"m{i}", FEATURES, "parts", "part = 'validation'",
            f"{i} AS seq, CAST({a!r} AS DOUBLE) AS alpha, {str(sc).lower()} AS standardize, ", key=True,
        )
        for i, sc, a in cases
    )
    sql = f"""{V1}{ctes} SELECT alpha, standardize, rmse, mae, r2,
    row_number() OVER (ORDER BY rank_key, seq) AS rank FROM ({body})"""
    return query, sql


add("alpha_grid", *_alpha_grid((False,)))
add("alpha_by_standardize_grid", *_alpha_grid((False, True)))


def strategy_leaderboard(spark, sf, strategies=STRATEGIES) -> DataFrame:
    """Every strategy on both splits, ranked by validation error."""
    # From the first day that a split holds; the second one is open-ended.
    rows = filters.drop_incomplete(P.daily_features(spark, sf, V1_DAYS[0]), FEATURES)
    rows = materialize(rows.drop("pos"), "features")
    first, second, third, fourth = YEARS
    parts = {
        "v1": splits.part_of(splits.year_parts([first, second], [third], [fourth])),
        "v2": splits.part_of(splits.cutoff_parts(third, f"{fourth}-07-01")),
    }
    ranked = linear.strategy_sweep(rows, strategies, parts)
    schema = "strategy string, split string, rmse double, mae double, r2 double, rank long"
    table = linear.results_frame(spark, ranked, schema)
    return rounded(table.withColumn("label", F.concat_ws(" | ", "strategy", "split")))


def sweep_sql(strategies: dict[str, list[str]]) -> str:
    ctes = with_ctes(
        F_DAY, CLEAN,
        f"parts_v1 AS MATERIALIZED (SELECT *, {PART_V1} AS part FROM clean)",
        f"parts_v2 AS MATERIALIZED (SELECT *, {PART_V2} AS part FROM clean)",
    )
    bodies = []
    for seq, (split, (name, fs)) in enumerate(
        (v, item) for v in ("v1", "v2") for item in strategies.items()
    ):
        ctes += ", " + solve_ctes(f"m{seq}", f"parts_{split}", fs, 0.0, "part = 'train'")
        bodies.append(
            metrics_sql(
                f"m{seq}", fs, f"parts_{split}", "part = 'validation'",
                f"{seq} AS seq, '{name}' AS strategy, '{split}' AS split, ", key=True,
            )
        )
    return f"""{ctes} SELECT strategy, split, rmse, mae, r2,
    row_number() OVER (ORDER BY rank_key, seq) AS rank, strategy || ' | ' || split AS label
    FROM ({' UNION ALL '.join(bodies)})"""


add("strategy_sweep", strategy_leaderboard, sweep_sql(STRATEGIES))
add(
    "memory_strategy_sweep",
    lambda s, d: strategy_leaderboard(s, d, MEMORY_STRATEGIES),
    sweep_sql(MEMORY_STRATEGIES),
)
CURVE = [0.0, 1e2, 1e4, 1e6, 1e7, 3e7, 1e8, 3e8, 1e9]
add(
    "regularisation_curve",
    lambda s, d: rounded(
        linear.results_frame(
            s,
            linear.regularisation_curve(
                split_v1(filters.drop_incomplete(P.daily_features(s, d), FEATURES)), FEATURES, CURVE
            ),
            "alpha double, train_rmse double, test_rmse double",
        )
    ),
    V1
    + "".join(
        ", " + solve_ctes(f"m{i}", "parts", FEATURES, a, "part = 'train'")
        for i, a in enumerate(CURVE)
    )
    + " "
    + " UNION ALL ".join(
        f"SELECT CAST({a!r} AS DOUBLE) AS alpha, "
        + ", ".join(
            r(f"sqrt(avg(pow(value - ({predict_sql(f'm{i}', FEATURES)}), 2)) FILTER (part = '{p}'))")
            + f" AS {p}_rmse"
            for p in ("train", "test")
        )
        + f" FROM parts, m{i}"
        for i, a in enumerate(CURVE)
    ),
)


def _refit(s, d):
    _, scores = linear.refit_and_test(prepared(s, d), FEATURES, 1.0)
    return rounded(linear.results_frame(s, [scores], "rmse double, mae double, r2 double"))


add(
    "refit_and_test",
    _refit,
    V1 + ", " + solve_ctes("m", "parts", FEATURES, 1.0, "part IN ('train', 'validation')") + " "
    + metrics_sql("m", FEATURES, "parts", "part = 'test'"),
)


def _fit_and_score(s, d):
    rows = prepared(s, d)
    model = linear.part_moments(rows, FEATURES)["train"].fit(10.0)
    scored = scoring.score_table(rows.where(F.col(PART) == "validation"), model)
    return rounded(evaluate.regression_metrics(scored).select("rmse", "mae", "r2"))


add(
    "fit_and_score",
    _fit_and_score,
    V1 + ", " + solve_ctes("m", "parts", FEATURES, 10.0, "part = 'train'") + " "
    + metrics_sql("m", FEATURES, "parts", "part = 'validation'"),
)
CV_ALPHAS = [0.1, 1.0, 10.0]


def _alpha_cv(s, d):
    # The panel is dense, so its times need no row of it, and the features are read once only.
    folds = splits.expanding_cv_warmup(P.daily_times(s, d), 3, splits.warmup_steps(FEATURES, 1))
    _, rows = linear.alpha_cv(P.daily_features(s, d), folds, FEATURES, CV_ALPHAS)
    return rounded(linear.results_frame(s, rows, "alpha double, rmse double, rank long"))


def cv_sql(
    folds: str, candidates: list[tuple[str, float | None]], source_filter: str = "true", row_filter: str = "true"
) -> str:
    """Fold scores of ridge candidates (penalty None is the mean), as ``scores``."""
    ctes = with_ctes(
        F_DAY, CLEAN,
        f"""times AS (SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS spot, count(*) OVER () AS n
        FROM (SELECT DISTINCT ts FROM feats WHERE {source_filter}))""",
        f"folds AS ({folds})",
        f"cvrows AS MATERIALIZED (SELECT c.*, t.spot FROM (SELECT * FROM clean WHERE {row_filter}) c JOIN times t ON c.ts = t.ts)",
    )
    bodies = []
    for fold in (1, 2, 3):
        train = f"spot <= (SELECT train_to FROM folds WHERE fold = {fold})"
        check = (
            f"spot BETWEEN (SELECT val_from FROM folds WHERE fold = {fold})"
            f" AND (SELECT val_to FROM folds WHERE fold = {fold})"
        )
        for i, (name, alpha) in enumerate(candidates):
            model = f"f{fold}_m{i}"
            names = [] if alpha is None else FEATURES
            if alpha is None:
                ctes += f", {model} AS (SELECT avg(value) AS b FROM cvrows WHERE {train})"
            else:
                ctes += ", " + solve_ctes(model, "cvrows", FEATURES, alpha, train)
            e = f"(value - ({predict_sql(model, names)}))"
            bodies.append(
                f"SELECT {i} AS seq, '{name}' AS name, sqrt(avg({e} * {e})) AS rmse,"
                f" avg(abs({e})) AS mae, 1 - avg({e} * {e}) / var_pop(value) AS r2"
                f" FROM cvrows, {model} WHERE {check}"
            )
    return f"{ctes}, scores AS ({' UNION ALL '.join(bodies)})"


add(
    "alpha_cv",
    _alpha_cv,
    cv_sql(WARMUP_FOLDS, [(repr(a), a) for a in CV_ALPHAS])
    + f""" SELECT CAST(name AS DOUBLE) AS alpha, {r('avg(rmse)')} AS rmse,
    row_number() OVER (ORDER BY {significant_sql('avg(rmse)')}, seq) AS rank FROM scores GROUP BY name, seq""",
)


def _model_cv(s, d):
    df = split_v1(filters.drop_incomplete(P.daily_features(s, d), FEATURES).drop("pos"))
    df = materialize(df.where(F.col(PART) == "train"), "features")
    folds = splits.expanding_cv_timeseries(df, 3)
    rows = linear.model_cv(df, folds, FEATURES)
    return rounded(
        linear.results_frame(s, rows, "name string, rmse double, mae double, r2 double, rank long")
    )


add(
    "model_cv",
    _model_cv,
    cv_sql(
        series_folds(3, 0),
        list(linear.CANDIDATES.items()),
        f"lag_365d IS NOT NULL AND ({PART_V1}) = 'train'",
        f"({PART_V1}) = 'train'",
    )
    + f""" SELECT name, {r('avg(rmse)')} AS rmse, {r('avg(mae)')} AS mae, {r('avg(r2)')} AS r2,
    row_number() OVER (ORDER BY {significant_sql('avg(rmse)')}, seq) AS rank FROM scores GROUP BY name, seq""",
)
CROSS = {f"x{i}": f"2000-01-{i + 4:02d} 00:00:00" for i in range(1, 6)}
CROSS_COLUMNS = {**CROSS, "y": "2000-01-04 00:00:00"}


def _cross_series(s, d):
    wide = panel.timestamp_slice_transpose(P.daily_panel(s, d, "2000-01-04", "2000-01-10"), CROSS_COLUMNS)
    model = linear.fit_least_squares(wide, list(CROSS), "y").model
    return rounded(linear.coefficient_table(s, {"cross_series": model}))


add(
    "cross_series_regression",
    _cross_series,
    f"{DAY}, wide AS (SELECT series_id, "
    + ", ".join(f"max(value) FILTER (ts = TIMESTAMP '{t}') AS {n}" for n, t in CROSS_COLUMNS.items())
    + " FROM panel GROUP BY 1), "
    + solve_ctes("m", "wide", list(CROSS), 0.0, "true", "y")
    + " " + weights_sql("m", list(CROSS), "cross_series"),
)


def _tree_query(fit, exact_leaves: bool, averages: bool, score=trees.score):
    """A model of all supplier rows of the train part, and what must hold of it.

    Per part: its rows, and whether predictions stay within the targets of the train part (what
    averages of them do). On the train part: whether the error is below that of the mean, and for
    a single tree whether each predicted value is the mean of the targets it is predicted for.
    """

    def query(s, d):
        rows = prepared(s, d)
        train = rows.where(F.col(PART) == "train")
        scored = materialize(
            score(fit(train), rows, FEATURES).select(PART, VALUE, "prediction"), "scored"
        )
        y, p = F.col(VALUE).cast("double"), F.col("prediction")
        train = scored.where(F.col(PART) == "train")
        edge = train.agg(F.struct(F.min(y).alias("lo"), F.max(y).alias("hi"))).scalar()
        leaf = train.groupBy("prediction").agg(F.max(F.abs(p)).alias("_p"), F.avg(y).alias("_m"))
        leaves = leaf.agg(F.max(F.abs(F.col("prediction") - F.col("_m"))) < 1e-6).scalar()
        own = F.col(PART) == "train"
        return scored.groupBy(PART).agg(
            F.count("*").alias("n"),
            F.every(p.between(edge["lo"] - 1e-9, edge["hi"] + 1e-9)).alias("_inside"),
            (F.avg((y - p) * (y - p)) < F.var_pop(y)).alias("_below"),
        ).select(
            PART,
            "n",
            (F.col("_inside") if averages else F.lit(None).cast("boolean")).alias("within_targets"),
            F.when(own, F.col("_below")).alias("below_mean_model"),
            (F.when(own, leaves) if exact_leaves else F.lit(None).cast("boolean")).alias("leaves_are_means"),
        )

    flags = "true" if averages else "CAST(NULL AS BOOLEAN)"
    leaves = "CASE WHEN part = 'train' THEN true END" if exact_leaves else "CAST(NULL AS BOOLEAN)"
    sql = f"""{V1} SELECT part, count(*) AS n, {flags} AS within_targets,
    CASE WHEN part = 'train' THEN true END AS below_mean_model, {leaves} AS leaves_are_means
    FROM parts WHERE part IS NOT NULL GROUP BY part"""
    return query, sql


def _forest(count: int, depth: int, leaf: int):
    return lambda rows: trees.fit_forest(rows, FEATURES, count, depth, leaf)


add("fit_tree", *_tree_query(lambda rows: trees.fit_tree(rows, FEATURES, 6), True, True))
add(
    "fit_tree_unbounded",
    *_tree_query(
        lambda rows: deeptree.fit_deep_tree(rows, FEATURES), True, True, lambda model, rows, names: model.score(rows)
    ),
)
add("fit_forest", *_tree_query(_forest(40, 10, 20), False, True))
add("fit_forest_deep", *_tree_query(_forest(60, 16, 10), False, True))
add(
    "fit_gbt",
    *_tree_query(lambda rows: trees.fit_gbt(rows, FEATURES, 0.08, 150, 5), False, False),
)


def _score_nodes(model, rows, names):
    """Scored by a model that went through a table of nodes."""
    stored = materialize(boosting.tree_table(rows.sparkSession, {"m": model}), "nodes")
    return scoring.score_table(rows.na.drop(subset=names), boosting.tree_model_from_table(stored, "m"))


add(
    "fit_gbt_leafwise",
    *_tree_query(lambda rows: boosting.fit_leafwise(rows, FEATURES, rounds=5), False, False, _score_nodes),
)
add(
    "fit_forest_from_nodes",
    *_tree_query(lambda rows: boosting.from_spark(_forest(40, 10, 20)(rows), FEATURES), False, True, _score_nodes),
)


def stump_ctes(name: str, features: list[str], min_leaf: int = 20) -> str:
    """One row ``name``: the best of all cuts of all features, by exhaustion, and the means of both sides."""
    cuts = " UNION ALL ".join(
        f"""SELECT {i} AS k, '{f}' AS feature, CAST({f} AS DOUBLE) AS x, count(*) AS n,
        sum(CAST(value AS DOUBLE) - m) AS s FROM train, base GROUP BY ALL"""
        for i, f in enumerate(features)
    )
    return f"""train AS MATERIALIZED (SELECT * FROM parts WHERE part = 'train'),
    base AS MATERIALIZED (SELECT avg(CAST(value AS DOUBLE)) AS m, count(*) AS n FROM train),
    {name}_c AS MATERIALIZED ({cuts}),
    {name}_u AS MATERIALIZED (SELECT k, feature, x, lead(x) OVER w AS next,
      sum(n) OVER u AS nl, sum(s) OVER u AS sl, sum(n) OVER a AS nt, sum(s) OVER a AS st FROM {name}_c
      WINDOW w AS (PARTITION BY k ORDER BY x), a AS (PARTITION BY k),
      u AS (PARTITION BY k ORDER BY x ROWS UNBOUNDED PRECEDING)),
    {name} AS MATERIALIZED (SELECT feature, x + (next - x) / 2 AS threshold, nl AS n_left, nt - nl AS n_right,
      m + sl / nl AS left_value, m + (st - sl) / (nt - nl) AS right_value
      FROM {name}_u, base WHERE nl >= {min_leaf} AND nt - nl >= {min_leaf}
      ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC, k, x LIMIT 1)"""


LAGS = ["lag_1d", "lag_7d", "lag_30d"]


def stump(train: DataFrame, names: list[str]) -> boosting.TreeModel:
    """One tree of two leaves, which are the means of their rows."""
    return boosting.fit_leafwise(train, names, learning_rate=1.0, rounds=1, max_leaves=2)


def _first_split(s, d):
    rows = prepared(s, d)
    train = rows.where(F.col(PART) == "train")
    model = stump(train, LAGS)
    left = F.col("x") <= model.threshold[0]
    x = train.select(F.col(LAGS[model.feature[0]]).cast("double").alias("x"))
    return rounded(
        x.agg(
            F.lit(LAGS[model.feature[0]]).alias("feature"),
            F.lit(model.threshold[0]).alias("threshold"),
            F.count_if(left).alias("n_left"),
            F.count_if(~left).alias("n_right"),
            F.lit(model.base + model.value[model.left[0]]).alias("left_value"),
            F.lit(model.base + model.value[model.right[0]]).alias("right_value"),
        )
    )


add(
    "tree_first_split",
    _first_split,
    f"""{V1}, {stump_ctes("m", LAGS)} SELECT feature, {r('threshold')} AS threshold, CAST(n_left AS BIGINT) AS n_left,
    CAST(n_right AS BIGINT) AS n_right, {r('left_value')} AS left_value, {r('right_value')} AS right_value FROM m""",
)


def _overfit(s, d):
    """Train and test error of three models on a 1 % sample cut by time."""
    feats = filters.drop_incomplete(P.daily_features(s, d), FEATURES).drop("pos")
    # Written before it is cut, as the cut reads it twice; the panel's features are then made once.
    cut = splits.split_chronological(materialize(sampling.sample_fraction(feats, 0.01, seed=0), "sample"), 0.8)
    train = cut.where(F.col(PART) == "train")
    ridge = linear.moments(train, FEATURES)[None].fit(1.0)
    scored = {
        "ridge_1": scoring.score_table(cut, ridge),
        "tree_depth_6": trees.score(trees.fit_tree(train, FEATURES, 6), cut, FEATURES),
        "tree_unbounded": deeptree.fit_deep_tree(train, FEATURES).score(cut),
    }
    tables = [
        evaluate.regression_metrics(df, [PART]).select(F.lit(name).alias("model"), PART, "n", "rmse")
        for name, df in scored.items()
    ]
    return rounded(tables[0].unionByName(tables[1]).unionByName(tables[2]))


add("overfit_table", _overfit)

# ---- evaluation on scored rows

PAIR = ["lag_1d", "lag_7d"]


def scored_test(spark, sf) -> DataFrame:
    """Test year of the daily panel scored by least squares on two lags."""
    rows = materialize(
        filters.drop_incomplete(split_v1(P.daily_features(spark, sf)), PAIR)
        .select(*KEYS, VALUE, PART, *PAIR),
        "features",
    )
    model = linear.moments(rows.where(F.col(PART) == "train"), PAIR)[None].fit()
    return scoring.score_table(rows.where(F.col(PART) == "test"), model)


SCORED = with_ctes(
    F_DAY,
    "pairs AS MATERIALIZED (SELECT * FROM feats WHERE lag_1d IS NOT NULL AND lag_7d IS NOT NULL)",
    solve_ctes("m", "pairs", PAIR, 0.0, "year(ts) IN (1998, 1999)"),
    f"""scored AS MATERIALIZED (SELECT series_id, ts, value, lag_1d, {predict_sql('m', PAIR)} AS prediction,
      value - ({predict_sql('m', PAIR)}) AS residual FROM pairs, m WHERE year(ts) = 2001)""",
)
RMSE = "sqrt(avg(residual * residual))"


def scored_hours(spark, sf) -> DataFrame:
    """Hourly panel scored by the value a day before."""
    return P.hourly_features(spark, sf).where("lag_1d is not null").withColumn(
        "prediction", F.col("lag_1d").cast("double")
    )


SCORED_HOUR = with_ctes(
    P_HOUR,
    f"""lagged AS (SELECT series_id, ts, value, {lag_sql(24)} AS prediction FROM panel),
    scored AS (SELECT *, value - prediction AS residual FROM lagged WHERE prediction IS NOT NULL)""",
)
add(
    "regression_metrics",
    lambda s, d: rounded(evaluate.regression_metrics(scored_test(s, d))),
    f"""{SCORED} SELECT count(*) AS n, {r(RMSE)} AS rmse, {r('avg(abs(residual))')} AS mae,
    {r('1 - avg(residual * residual) / var_pop(value)')} AS r2, {r('avg(residual)')} AS bias
    FROM scored""",
)
add(
    "residual_mae_by_hour",
    lambda s, d: rounded(evaluate.residual_mae_by_hour(scored_hours(s, d))),
    f"""{SCORED_HOUR} SELECT CAST(hour(ts) AS BIGINT) AS hour, {r('avg(abs(residual))')} AS mae
    FROM scored GROUP BY 1""",
)
add(
    "residual_mae_by_weekday",
    lambda s, d: rounded(evaluate.residual_mae_by_weekday(scored_hours(s, d))),
    f"""{SCORED_HOUR}, found AS (SELECT isodow(ts) - 1 AS d, avg(abs(residual)) AS e FROM scored
      GROUP BY 1)
    SELECT w.range AS weekday, {r('e')} AS mae,
    ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][CAST(w.range AS INT) + 1] AS weekday_name
    FROM range(7) w LEFT JOIN found ON d = w.range""",
)
add(
    "residual_mae_by_month",
    lambda s, d: rounded(evaluate.residual_mae_by_month(scored_test(s, d))),
    f"""{SCORED} SELECT CAST(month(ts) AS BIGINT) AS month, {r('avg(abs(residual))')} AS mae
    FROM scored GROUP BY 1""",
)
add(
    "residual_mae_by_client",
    lambda s, d: rounded(evaluate.residual_mae_by_series(scored_test(s, d))),
    f"""{SCORED} SELECT series_id, {r('e')} AS mae FROM (
    SELECT series_id, avg(abs(residual)) AS e FROM scored GROUP BY 1)
    ORDER BY e DESC, series_id LIMIT 25""",
)
add(
    "residual_rmse_by_weekday",
    lambda s, d: rounded(evaluate.residual_rmse_by_weekday(scored_test(s, d))),
    f"""{SCORED} SELECT CAST(isodow(ts) - 1 AS BIGINT) AS weekday, {r(RMSE)} AS rmse
    FROM scored GROUP BY 1""",
)
add(
    "residual_rmse_by_hour",
    lambda s, d: rounded(evaluate.residual_rmse_by_hour(scored_hours(s, d))),
    f"""{SCORED_HOUR} SELECT CAST(hour(ts) AS BIGINT) AS hour, {r(RMSE)} AS rmse
    FROM scored GROUP BY 1""",
)
RES_LIMITS = "lim AS (SELECT min(residual) AS lo, max(residual) AS hi FROM scored)"
add(
    "residual_distribution",
    lambda s, d: rounded(evaluate.residual_distribution(scored_test(s, d))),
    f"""{SCORED}, {RES_LIMITS}, c AS (
      SELECT {bin_sql('residual', 'lo', 'hi', 80)} AS b, count(*) AS n FROM scored, lim GROUP BY 1)
    SELECT range AS bin, {r('lo + range * ((hi - lo) / 80)')} AS left_edge, coalesce(n, 0) AS n
    FROM range(80) CROSS JOIN lim LEFT JOIN c ON b = range""",
)
add(
    "histogram_2d",
    lambda s, d: rounded(evaluate.residual_density_2d(scored_test(s, d))),
    f"""{SCORED}, lim AS (SELECT min(prediction) AS xl, max(prediction) AS xh,
      min(residual) AS yl, max(residual) AS yh FROM scored)
    SELECT x_bin, y_bin, n, {r('log10(n + 1)')} AS log_n FROM (
      SELECT {bin_sql('prediction', 'xl', 'xh', 120)} AS x_bin,
      {bin_sql('residual', 'yl', 'yh', 120)} AS y_bin, count(*) AS n FROM scored, lim
      GROUP BY 1, 2)""",
)
BUCKET_SQL = """edges AS (SELECT list_sort(list_distinct(quantile_cont(value,
    [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) AS e FROM {source}),
  bucketed AS (SELECT t.*, CAST(len(list_filter(e[2:len(e) - 1], lambda x: x < value)) AS BIGINT)
    AS bucket FROM {source} t, edges)"""
add(
    "quantile_bins",
    lambda s, d: profiles.quantile_bins(P.daily_panel(s, d), VALUE)
    .groupBy("bucket")
    .agg(F.count("*").alias("n"), F.min(VALUE).alias("lo"), F.max(VALUE).alias("hi")),
    f"""{DAY}, {BUCKET_SQL.format(source='panel')}
    SELECT bucket, count(*) AS n, min(value) AS lo, max(value) AS hi FROM bucketed GROUP BY 1""",
)
add(
    "error_by_level",
    lambda s, d: rounded(evaluate.error_by_level(scored_test(s, d)), 4),
    f"""{SCORED}, {BUCKET_SQL.format(source='scored')}
    SELECT bucket, {r('avg(value)', 4)} AS mean_actual, {r(RMSE, 4)} AS rmse,
    {r(f'100 * {RMSE} / greatest(avg(value), 1e-9)', 4)} AS rmse_pct_of_level
    FROM bucketed GROUP BY 1""",
)
add(
    "rmse_per_series_summary",
    lambda s, d: rounded(evaluate.rmse_per_series_summary(scored_test(s, d))),
    f"""{SCORED} SELECT {r(f'(SELECT {RMSE} FROM scored)')} AS pooled, {r('max(e)')} AS worst,
    {r('median(e)')} AS median, {r('min(e)')} AS best
    FROM (SELECT {RMSE} AS e FROM scored GROUP BY series_id)""",
)
CURVES = ", ".join(
    f"{r(f'avg({c})')} AS {n}"
    for n, c in (("actual", "value"), ("predicted", "prediction"), ("baseline", "lag_1d"))
)
add(
    "day_curves",
    lambda s, d: rounded(evaluate.day_curves(scored_test(s, d), "2001-06-13", [1, 7])),
    f"""{SCORED}, one AS (SELECT * FROM scored WHERE CAST(ts AS DATE) = DATE '2001-06-13')
    SELECT 'all' AS panel, ts, {CURVES} FROM one GROUP BY ts UNION ALL
    SELECT CAST(series_id AS VARCHAR), ts, {CURVES} FROM one WHERE series_id IN (1, 7)
    GROUP BY series_id, ts""",
)
add(
    "observed_vs_predicted",
    lambda s, d: rounded(evaluate.observed_vs_predicted(scored_test(s, d))),
    f"""{SCORED} SELECT series_id, ts, {r('value')} AS actual, {r('prediction')} AS predicted,
    {r('(SELECT least(min(value), min(prediction)) FROM scored)')} AS axis_low,
    {r('(SELECT greatest(max(value), max(prediction)) FROM scored)')} AS axis_high FROM scored""",
)
add(
    "metric_comparison",
    lambda s, d: rounded(
        evaluate.metric_comparison(
            evaluate.rmse_per_series(scored_test(s, d)), SERIES, "rmse"
        )
    ),
    f"{SCORED} SELECT series_id, {r(RMSE)} AS rmse FROM scored GROUP BY 1",
)
NAIVE = {"lag_1d": 1, "lag_7d": 7}
add(
    "beats_naive",
    lambda s, d: rounded(
        evaluate.beats_naive(
            scored_test(s, d), P.daily_panel(s, d, "2000-12-25", "2002-01-01"), NAIVE, "2001-01-01", "2002-01-01"
        )
    ),
    f"{SCORED}, model AS (SELECT {RMSE} AS e FROM scored) "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS baseline, {r('x')} AS naive_rmse, {r('e')} AS model_rmse,"
        f" e <= 1.01 * x AS beats FROM model, (SELECT sqrt(avg(pow(value - {n}, 2))) AS x"
        " FROM feats WHERE year(ts) = 2001)"
        for n in NAIVE
    ),
)
DRIFT_COLUMNS = [VALUE, "lag_7d"]


DRIFT_YEARS = [1998, 2001]


def _year_rows(s, d) -> DataFrame:
    """The columns in the years that are compared, written once because every column's statistics read them."""
    feats = P.daily_features(s, d, *V1_DAYS, lags={"lag_7d": 7}, windows={})
    return materialize(feats.where(filters.in_years(DRIFT_YEARS)).select(TS, *DRIFT_COLUMNS), "years")


def _drift_stats(s, d):
    return rounded(evaluate.year_drift_stats(_year_rows(s, d), DRIFT_COLUMNS, DRIFT_YEARS))


def _drift_shapes(s, d):
    return rounded(evaluate.year_drift_densities(_year_rows(s, d), DRIFT_COLUMNS, DRIFT_YEARS))


add(
    "drift_by_year",
    _drift_stats,
    f"{FEAT} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(year(ts) AS BIGINT) AS year, {r(f'avg({c})')} AS mean,"
        f" {r(f'stddev_samp({c})')} AS std, {r(f'min({c})')} AS \"min\", {r(f'max({c})')} AS \"max\","
        f" {r(f'median({c})')} AS median FROM feats WHERE year(ts) IN (1998, 2001) GROUP BY 2"
        for c in DRIFT_COLUMNS
    ),
)
add(
    "drift_by_year_density",
    _drift_shapes,
    f"{FEAT}, cut AS (SELECT *, CAST(year(ts) AS BIGINT) AS y FROM feats"
    " WHERE year(ts) IN (1998, 2001)) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", y AS year, bin, n,
        {r('n / (sum(n) OVER (PARTITION BY y) * w)')} AS density FROM (
          SELECT y, {bin_sql(c, 'lo', 'hi', 20)} AS bin, count(*) AS n, any_value((hi - lo) / 20) AS w
          FROM cut, (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM cut)
          WHERE {c} IS NOT NULL GROUP BY 1, 2)"""
        for c in DRIFT_COLUMNS
    ),
)


def drift_sql(name: str) -> str:
    ref, cur = "part = 'train'", "part = 'test'"
    return f"""(WITH x AS (SELECT part, CAST({name} AS DOUBLE) AS x FROM parts
        WHERE part IN ('train', 'test') AND {name} IS NOT NULL),
      l AS (SELECT min(x) AS lo, max(x) AS hi, count(*) FILTER ({ref}) AS nr,
        count(*) FILTER ({cur}) AS nc, stddev_pop(x) FILTER ({ref}) AS s,
        quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) FILTER ({ref}) AS q FROM x),
      b AS (SELECT {bin_sql('x', 'lo', 'hi', 1000)} AS bin, part FROM x, l),
      g AS (SELECT range AS bin, abs(
          sum(count(part) FILTER ({ref})) OVER (ORDER BY range) / any_value(nr)
          - sum(count(part) FILTER ({cur})) OVER (ORDER BY range) / any_value(nc)) AS gap
        FROM range(1000) CROSS JOIN l LEFT JOIN b ON bin = range GROUP BY range),
      k AS (SELECT len(list_filter(q, lambda e: e < x)) AS k, part FROM x, l),
      p AS (SELECT range, (count(part) FILTER ({ref}) + 0.5) / (any_value(nr) + 5.0) AS pr,
          (count(part) FILTER ({cur}) + 0.5) / (any_value(nc) + 5.0) AS pc
        FROM range(10) CROSS JOIN l LEFT JOIN k ON k = range GROUP BY range)
      SELECT '{name}' AS feature, (SELECT max(gap) FROM g) AS ks,
        (SELECT sum(gap) FROM g) * (hi - lo) / 1000 / s AS wasserstein,
        (SELECT sum((pc - pr) * ln(pc / pr)) FROM p) AS psi FROM l)"""


add(
    "drift_report",
    lambda s, d: rounded(drift.drift_report(prepared(s, d), FEATURES)),
    f"""{V1}, d AS ({' UNION ALL '.join(f'SELECT * FROM {drift_sql(n)}' for n in FEATURES)})
    SELECT feature, {r('ks')} AS ks, {r('wasserstein')} AS wasserstein, {r('psi')} AS psi,
    wasserstein >= 0.1 AS drifted,
    {r('avg(CAST(wasserstein >= 0.1 AS INT)) OVER ()')} AS drift_share,
    avg(CAST(wasserstein >= 0.1 AS INT)) OVER () >= 0.5 AS dataset_drift FROM d""",
)
