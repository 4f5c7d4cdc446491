"""Queries on run tables, governance, scoring, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlane.functions.columns import floor_minute
from wattlane.operators import boosting, filters, governance, joins, linear, panel, profiles, scoring
from wattlane.operators.features import build_features
from wattlane.operators.panel import aggregate_facts
from wattlane.plans import candidates as C
from wattlane.plans import panels as P
from wattlane.plans.model_queries import V1, V1_DAYS, part_digest, prepared, split_v1, stump, stump_ctes
from wattlane.plans.oracle import (
    F_DAY, NATION_FACTS, P_DAY, P_HOUR, PART_V1, lag_sql, r, window_sql, with_ctes,
)
from wattlane.plans.oracle_linear import predict_sql, solve_ctes
from wattlane.plans.panel_queries import HASH_SQL, nation_wide
from wattlane.plans.registry import Catalog, rounded
from wattlane.schema import FEATURES, KEYS, PART, SERIES, TS, VALUE
from wattlane.session import materialize, scratch_path
from wattlane.sources import readings, sinks
from wattlane.streaming import daily

CATALOG = Catalog()
add = CATALOG.add

DAY = with_ctes(P_DAY)
FEAT = with_ctes(F_DAY)
RUNS = with_ctes(C.RUNS_SQL)
VERSIONS = with_ctes(C.VERSIONS_SQL, C.EVENTS_SQL)

# ---- run tables and governance

add(
    "run_leaderboard",
    lambda s, d: governance.run_leaderboard(C.runs(s, d), parent="model_name").select(
        "model_name", "run_id", "validation_rmse", "validation_mae", "rank"
    ),
    f"""{RUNS} SELECT model_name, run_id, validation_rmse, validation_mae, row_number() OVER (
    PARTITION BY model_name ORDER BY validation_rmse, validation_mae, start_time, run_id) AS rank
    FROM runs""",
)
add(
    "arg_best",
    lambda s, d: C.runs(s, d)
    .groupBy("model_name")
    .agg(F.min(F.struct("validation_rmse", "start_time", "run_id")).alias("b"))
    .select("model_name", F.col("b.run_id").alias("run_id"), "b.validation_rmse"),
    f"""{RUNS} SELECT model_name, run_id, validation_rmse FROM runs QUALIFY row_number() OVER (
    PARTITION BY model_name ORDER BY validation_rmse, start_time) = 1""",
)
add(
    "label_columns",
    lambda s, d: joins.run_labels(C.runs(s, d), "model_name", "version"),
    f"""{RUNS} SELECT run_id, model_name AS strategy, version AS split,
    model_name || ' | ' || version AS label FROM runs""",
)
add(
    "comparable_runs",
    lambda s, d: governance.comparable_runs(C.runs(s, d), "run_1_1").select(
        "run_id", "test_rmse", "test_mae"
    ),
    f"""{RUNS} SELECT a.run_id, a.test_rmse, a.test_mae FROM runs a JOIN runs b
    ON a.train_digest = b.train_digest AND a.validation_digest = b.validation_digest
    WHERE b.run_id = 'run_1_1'""",
)
add(
    "cycle_decision",
    lambda s, d: governance.cycle_decision(C.runs(s, d)),
    f"""{RUNS}, b AS (SELECT *, count(*) OVER g AS n_candidates, row_number() OVER (
        PARTITION BY train_digest, validation_digest ORDER BY test_rmse, test_mae,
        validation_rmse, validation_mae, start_time, run_id) AS k
      FROM runs WHERE validation_digest IS NOT NULL
      WINDOW g AS (PARTITION BY train_digest, validation_digest))
    SELECT a.run_id, a.train_digest, a.validation_digest, b.run_id AS best_run_id,
    b.test_rmse AS best_test_rmse, b.test_mae AS best_test_mae,
    a.run_id = b.run_id AS same_run_selected, b.n_candidates
    FROM runs a JOIN b ON k = 1 AND a.train_digest = b.train_digest
      AND a.validation_digest = b.validation_digest""",
)
add(
    "validated_versions",
    lambda s, d: governance.validated_versions(C.versions(s, d)).drop("tags"),
    f"{VERSIONS} SELECT model_name, version, rmse, mae FROM versions WHERE ok",
)
add(
    "govern_rank",
    lambda s, d: governance.govern_rank(C.versions(s, d), C.alias_events(s, d)).drop("tags"),
    f"""{VERSIONS} SELECT v.model_name, v.version, rmse, mae, k AS rank, k = 1 AS is_best,
    coalesce(a.version = v.version, false) AS is_current_champion
    FROM (SELECT *, row_number() OVER (PARTITION BY model_name
            ORDER BY rmse, mae, CAST(version AS INT)) AS k FROM versions WHERE ok) v
    LEFT JOIN aliases a ON a.model_name = v.model_name AND a.alias = 'champion'""",
)
DECISION_SQL = f"""{VERSIONS}, best AS (SELECT * FROM versions WHERE ok QUALIFY row_number() OVER (
    PARTITION BY model_name ORDER BY rmse, mae, CAST(version AS INT)) = 1),
  pairs AS (SELECT m.model_name, c.version AS cv, c.rmse AS cr, c.mae AS cm, b.version AS bv,
    b.rmse AS br, b.mae AS bm, (c.rmse - b.rmse) / c.rmse AS gain, (c.mae - b.mae) / c.mae AS mgain
    FROM (SELECT DISTINCT model_name FROM versions) m
    LEFT JOIN best b ON b.model_name = m.model_name
    LEFT JOIN aliases a ON a.model_name = m.model_name AND a.alias = 'champion'
    LEFT JOIN versions c ON c.model_name = a.model_name AND c.version = a.version),
  judged AS (SELECT *, coalesce(cv <> bv AND gain >= 0.02, false) AS yes FROM pairs),
  decisions AS (SELECT *, CASE WHEN cv IS NULL OR bv IS NULL THEN 'none' WHEN yes THEN 'accepted'
      ELSE 'rejected' END AS decision,
    CASE WHEN cv IS NULL THEN 'no champion' WHEN bv IS NULL THEN 'no validated version'
      WHEN yes THEN printf('gain %.2f%% >= 2.00%%', gain * 100)
      WHEN cv = bv THEN 'best is the champion'
      ELSE printf('gain %.2f%% < 2.00%%', gain * 100) END AS reason FROM judged)"""
add(
    "govern_decision",
    lambda s, d: rounded(governance.govern_decision(C.versions(s, d), C.alias_events(s, d))),
    f"""{DECISION_SQL} SELECT model_name, cv AS champion_version, cr AS champion_rmse,
    cm AS champion_mae, bv AS best_version, br AS best_rmse, bm AS best_mae,
    {r('gain')} AS rmse_gain, {r('mgain')} AS mae_gain,
    decision, reason FROM decisions""",
)


def _alias_changes(s, d):
    events = C.alias_events(s, d)
    return governance.alias_changes(governance.govern_decision(C.versions(s, d), events), events)


add(
    "alias_changes",
    _alias_changes,
    f"""{DECISION_SQL}, w AS (SELECT model_name, 'challenger' AS alias, bv AS version FROM decisions WHERE decision <> 'none'
      UNION ALL SELECT model_name, 'champion', bv FROM decisions WHERE yes)
    SELECT w.* FROM w LEFT JOIN aliases a ON a.model_name = w.model_name AND a.alias = w.alias
    WHERE a.version IS DISTINCT FROM w.version""",
)
def _gate_sql(status_counts: bool) -> str:
    """The gate as ``gated``, from the flags of the challenger's tags."""
    also = " OR h.status" if status_counts else ""
    return f"""{VERSIONS}, p AS (SELECT m.model_name, c.version AS cv, h.version AS hv,
      h.validated{also} AS v, h.passed{also} AS p,
      (c.rmse - h.rmse) / c.rmse AS gain, (c.mae - h.mae) / c.mae AS mgain
      FROM (SELECT DISTINCT model_name FROM versions) m
      LEFT JOIN aliases a ON a.model_name = m.model_name AND a.alias = 'champion'
      LEFT JOIN versions c ON c.model_name = a.model_name AND c.version = a.version
      LEFT JOIN aliases x ON x.model_name = m.model_name AND x.alias = 'challenger'
      LEFT JOIN versions h ON h.model_name = x.model_name AND h.version = x.version),
    gated AS (SELECT model_name, cv AS champion_version, hv AS challenger_version,
      {r('gain')} AS rmse_gain, {r('mgain')} AS mae_gain,
      CASE WHEN cv IS NULL OR hv IS NULL THEN 'none' WHEN v AND p AND gain >= 0.02 THEN 'accepted'
        ELSE 'rejected' END AS promotion_status,
      concat_ws(' ; ', CASE WHEN cv IS NULL THEN 'no champion' END,
        CASE WHEN hv IS NULL THEN 'no challenger' END,
        CASE WHEN cv IS NOT NULL AND NOT v THEN 'validated is not true' END,
        CASE WHEN cv IS NOT NULL AND NOT p THEN 'passed_validation is not true' END,
        CASE WHEN gain < 0.02 THEN printf('gain %.2f%% < 2.00%%', gain * 100) END) AS reasons
      FROM p)"""


def _gate(s, d, status_counts=False):
    return governance.promotion_gate(C.versions(s, d), C.alias_events(s, d), status_counts=status_counts)


add("promotion_gate", lambda s, d: rounded(_gate(s, d)), _gate_sql(False) + " SELECT * FROM gated")
add(
    "promotion_gate_by_status",
    lambda s, d: rounded(_gate(s, d, True)),
    _gate_sql(True) + " SELECT * FROM gated",
)
add(
    "promotion_events",
    lambda s, d: governance.promotion_events(_gate(s, d)),
    _gate_sql(False)
    + """ SELECT model_name, alias, CASE WHEN alias = 'rollback' THEN champion_version
      ELSE challenger_version END AS version, CAST(seq AS BIGINT) AS seq
    FROM gated, (VALUES ('rollback', 1), ('champion', 2), ('development', 3), ('staging', 4),
      ('production', 5)) w(alias, seq) WHERE promotion_status = 'accepted'""",
)


add(
    "promotion_tags",
    lambda s, d: governance.promotion_tags(_gate(s, d)),
    _gate_sql(False)
    + """, w AS (SELECT g.model_name, g.challenger_version AS version, t.key, CAST(t.seq AS BIGINT) AS seq, CASE t.seq
      WHEN 1 THEN promotion_status
      WHEN 2 THEN CASE promotion_status WHEN 'accepted' THEN 'promoted_to_champion' ELSE 'held_as_challenger' END
      WHEN 3 THEN promotion_status || ': ' || CASE promotion_status WHEN 'accepted'
        THEN printf('gain %.2f%% >= 2.00%%', p.gain * 100) ELSE reasons END
      WHEN 4 THEN CASE WHEN promotion_status <> 'accepted' THEN reasons END
      WHEN 5 THEN printf('%.6f', p.gain) WHEN 6 THEN printf('%.6f', p.mgain)
      WHEN 7 THEN '0.020000' ELSE 'champion_vs_challenger' END AS value
    FROM gated g JOIN p ON p.model_name = g.model_name,
      (VALUES ('promotion_status', 1), ('governance_decision', 2), ('decision_note', 3), ('rejected_reason', 4),
       ('rmse_gain', 5), ('mae_gain', 6), ('promotion_threshold', 7), ('comparison_basis', 8)) t(key, seq)
    WHERE promotion_status <> 'none') SELECT * FROM w WHERE value IS NOT NULL""",
)


def _governance_tags(s, d):
    versions, events = C.versions(s, d), C.alias_events(s, d)
    ranks = governance.govern_rank(versions, events)
    return governance.governance_tags(ranks, governance.govern_decision(versions, events))


add(
    "governance_tags",
    _governance_tags,
    DECISION_SQL
    + """, k AS (SELECT model_name, version, row_number() OVER (PARTITION BY model_name
      ORDER BY rmse, mae, CAST(version AS INT)) AS k FROM versions WHERE ok),
    w AS (SELECT k.model_name, k.version, t.key, CAST(t.seq AS BIGINT) AS seq, CASE t.seq
      WHEN 1 THEN CAST(k.k AS VARCHAR) WHEN 2 THEN CAST(k.k = 1 AS VARCHAR)
      WHEN 3 THEN CASE WHEN k.k = 1 THEN decision END WHEN 4 THEN CASE WHEN k.k = 1 THEN reason END
      WHEN 5 THEN CASE WHEN k.k = 1 AND gain IS NOT NULL THEN printf('%.6f', gain) END
      WHEN 6 THEN CASE WHEN k.k = 1 AND mgain IS NOT NULL THEN printf('%.6f', mgain) END
      WHEN 7 THEN CASE WHEN k.k = 1 THEN cv END ELSE 'true' END AS value
    FROM k JOIN decisions d ON d.model_name = k.model_name,
      (VALUES ('governance_rank', 1), ('governance_selected', 2), ('governance_decision', 3),
       ('governance_reason', 4), ('governance_rmse_gain', 5), ('governance_mae_gain', 6),
       ('governance_compared_with', 7), ('governance_validated', 8)) t(key, seq))
    SELECT * FROM w WHERE value IS NOT NULL""",
)
add(
    "alias_current",
    lambda s, d: governance.alias_current(C.alias_events(s, d)),
    f"{with_ctes(C.EVENTS_SQL)} SELECT * FROM aliases",
)
add(
    "alias_history",
    lambda s, d: governance.alias_history(C.alias_events(s, d)),
    f"""{with_ctes(C.EVENTS_SQL)} SELECT model_name, alias, version, seq,
    row_number() OVER w AS step, lag(version) OVER w AS previous_version
    FROM events_log WINDOW w AS (PARTITION BY model_name, alias ORDER BY seq)""",
)
add(
    "version_tags",
    lambda s, d: governance.version_tags(C.tag_events(s, d)),
    f"""{RUNS} SELECT model_name, version, 'status' AS key, 'scored' AS value FROM runs
    UNION ALL SELECT model_name, version, 'train_digest', train_digest FROM runs
    UNION ALL SELECT model_name, version, 'validation_digest', validation_digest FROM runs""",
)
add(
    "latest_version",
    lambda s, d: governance.latest_version(C.runs(s, d)),
    f"{RUNS} SELECT model_name, max(CAST(version AS INT)) AS latest_version FROM runs GROUP BY 1",
)
add(
    "dataset_digest",
    lambda s, d: governance.dataset_digest(
        split_v1(P.daily_panel(s, d, *V1_DAYS)), [SERIES, TS, VALUE], [PART]
    ),
    f"""{DAY} SELECT part, count(*) AS "rows", CAST(sum(CAST('0x' || substr(md5(
    length(CAST(series_id AS VARCHAR)) || ':' || series_id || '19:' || strftime(ts, '%Y-%m-%d %H:%M:%S')
    || length(CAST(value AS VARCHAR)) || ':' || value), 1, 8) AS BIGINT)) AS BIGINT) AS digest
    FROM (SELECT *, {PART_V1} AS part FROM panel) WHERE part IS NOT NULL GROUP BY 1""",
)

# ---- scoring

NAMES = ["lag_1d", "lag_7d", "rolling_mean_7d"]


def requests(spark, sf):
    """Requests at event times; those of error events ask for an unknown series."""
    user = F.col("user_id")
    return P.table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", -user - 1).otherwise(user).alias(SERIES),
        TS,
    )


def hour_model(spark, sf):
    feats = materialize(P.hourly_features(spark, sf).drop("pos"), "features")
    return feats, linear.moments(feats, NAMES)[None].fit(1.0)


REQUESTS_SQL = with_ctes(
    P_HOUR,
    f"""feats AS MATERIALIZED (SELECT series_id, ts, value, {lag_sql(24)} AS lag_1d,
      {lag_sql(168)} AS lag_7d, {window_sql(168)} AS rolling_mean_7d FROM panel)""",
    f"""asked AS (SELECT event_id, ts, date_trunc('hour', ts) AS hour_ts,
      CASE WHEN event_type = 'error' THEN -user_id - 1 ELSE user_id END AS series_id FROM events)""",
    """found AS (SELECT a.event_id, a.series_id, a.ts, lag_1d, lag_7d, rolling_mean_7d,
      CASE WHEN f.ts IS NULL
        THEN 'no features for ' || a.series_id || ' at ' || strftime(hour_ts, '%Y-%m-%dT%H:%M')
      WHEN lag_1d IS NULL OR lag_7d IS NULL OR rolling_mean_7d IS NULL
        THEN 'features missing for ' || a.series_id || ' at '
          || strftime(hour_ts, '%Y-%m-%dT%H:%M') || ': ' || concat_ws(', ',
          CASE WHEN lag_1d IS NULL THEN 'lag_1d' END, CASE WHEN lag_7d IS NULL THEN 'lag_7d' END,
          CASE WHEN rolling_mean_7d IS NULL THEN 'rolling_mean_7d' END) END AS error
      FROM asked a LEFT JOIN feats f ON f.series_id = a.series_id AND f.ts = hour_ts)""",
)
CHECKED = ", ".join(f"CASE WHEN error IS NULL THEN {r(n)} END AS {n}" for n in NAMES)


def _lookup(s, d):
    """Only the rows that are asked for leave the blocks in which features are made."""
    asked = requests(s, d)
    feats = P.hourly_features(s, d, scoring.asked_keys(asked, "hour"))
    return rounded(scoring.lookup_features(asked, feats, NAMES, "hour"))


add(
    "lookup_features",
    _lookup,
    f"{REQUESTS_SQL} SELECT event_id, series_id, ts, {CHECKED}, error FROM found",
)


def _score_requests(s, d):
    feats, model = hour_model(s, d)
    scored = scoring.score_requests(requests(s, d), feats, model, "hour")
    return rounded(
        scored.select("event_id", SERIES, TS, "prediction", "features.*", "error"), 5
    )


HOUR_FIT = solve_ctes(
    "m", "feats", NAMES, 1.0, " AND ".join(f"{n} IS NOT NULL" for n in NAMES)
)
add(
    "score_requests",
    _score_requests,
    f"""{REQUESTS_SQL}, {HOUR_FIT} SELECT event_id, series_id, ts,
    CASE WHEN error IS NULL THEN {r(predict_sql('m', NAMES), 5)} END AS prediction, """
    + ", ".join(f"CASE WHEN error IS NULL THEN {r(n, 5)} END AS {n}" for n in NAMES)
    + ", error FROM found, m",
)


MINUTE_NAMES = ["lag_1", "lag_2"]


def minute_features(spark, sf):
    """Keyed by the minute: the two readings before, of series whose readings have gaps."""
    facts = P.table(spark, sf, "events").select(
        F.col("user_id").alias(SERIES), floor_minute(TS).alias(TS), F.col("value").cast("decimal(18,2)").alias("value")
    )
    return build_features(aggregate_facts(facts), 1, lags={"lag_1": 1, "lag_2": 2}, windows={})


MINUTE_SQL = with_ctes(
    """facts AS (SELECT user_id AS series_id, date_trunc('minute', ts) AS ts,
      sum(CAST(value AS DECIMAL(18,2))) AS value FROM events GROUP BY 1, 2)""",
    """feats AS MATERIALIZED (SELECT series_id, ts, value, lag(value) OVER w AS lag_1,
      lag(value, 2) OVER w AS lag_2 FROM facts WINDOW w AS (PARTITION BY series_id ORDER BY ts))""",
    """asked AS (SELECT event_id, ts, date_trunc('minute', ts) AS key_ts,
      CASE WHEN event_type = 'error' THEN -user_id - 1 ELSE user_id END AS series_id FROM events)""",
    """found AS (SELECT a.event_id, a.series_id, a.ts, lag_1, lag_2, CASE WHEN f.ts IS NULL
        THEN 'no features for ' || a.series_id || ' at ' || strftime(key_ts, '%Y-%m-%dT%H:%M')
      WHEN lag_1 IS NULL OR lag_2 IS NULL
        THEN 'features missing for ' || a.series_id || ' at ' || strftime(key_ts, '%Y-%m-%dT%H:%M')
          || ': ' || concat_ws(', ', CASE WHEN lag_1 IS NULL THEN 'lag_1' END,
          CASE WHEN lag_2 IS NULL THEN 'lag_2' END) END AS error
      FROM asked a LEFT JOIN feats f ON f.series_id = a.series_id AND f.ts = key_ts)""",
)
add(
    "lookup_features_by_minute",
    lambda s, d: rounded(
        scoring.lookup_features(requests(s, d), minute_features(s, d), MINUTE_NAMES, "minute")
    ),
    MINUTE_SQL + " SELECT event_id, series_id, ts, "
    + ", ".join(f"CASE WHEN error IS NULL THEN {r(n)} END AS {n}" for n in MINUTE_NAMES)
    + ", error FROM found",
)


def _score_by_minute(s, d):
    """Scored with coefficients that were written and read back by model and version."""
    feats = materialize(minute_features(s, d), "features")
    model = linear.moments(feats, MINUTE_NAMES)[None].fit(1.0)
    stored = materialize(linear.coefficient_table(s, {"minute_1": model}), "coefficients")
    model = linear.model_from_table(stored, "minute_1")
    scored = scoring.score_requests(requests(s, d), feats, model, "minute")
    return rounded(scored.select("event_id", SERIES, TS, "prediction", "features.*", "error"), 5)


add(
    "score_requests_by_minute",
    _score_by_minute,
    MINUTE_SQL + ", "
    + solve_ctes("m", "feats", MINUTE_NAMES, 1.0, " AND ".join(f"{n} IS NOT NULL" for n in MINUTE_NAMES))
    + f""" SELECT event_id, series_id, ts,
    CASE WHEN error IS NULL THEN {r(predict_sql('m', MINUTE_NAMES), 5)} END AS prediction, """
    + ", ".join(f"CASE WHEN error IS NULL THEN {r(n, 5)} END AS {n}" for n in MINUTE_NAMES)
    + ", error FROM found, m",
)


def _score_table(s, d):
    rows = prepared(s, d)
    model = linear.part_moments(rows, FEATURES)["train"].fit(1.0)
    scored = scoring.score_table(rows.where(F.col(PART) == "test"), model)
    return rounded(scored.select(*KEYS, "prediction"))


add(
    "score_table",
    _score_table,
    V1 + ", " + solve_ctes("m", "parts", FEATURES, 1.0, "part = 'train'")
    + f" SELECT series_id, ts, {r(predict_sql('m', FEATURES))} AS prediction"
    " FROM parts, m WHERE part = 'test'",
)
CHAMPION = "supplier_1"
VERSION_FEATURES = {"2": ["lag_7d"], "4": ["lag_1d", "lag_7d"]}


def _score_champion(s, d):
    """Versions of one model differ in their features; its alias log names the champion."""
    rows = prepared(s, d)
    train = linear.part_moments(rows, FEATURES)["train"]
    models = {v: train.fit(0.0, names) for v, names in VERSION_FEATURES.items()}
    table = linear.coefficient_table(s, models).select(
        F.lit(CHAMPION).alias("model_name"), F.col("model_id").alias("version"), "feature", "weight"
    )
    stored = materialize(table, "coefficients")
    scored = scoring.score_with_champion(
        rows.where(F.col(PART) == "test"), stored, C.alias_events(s, d), CHAMPION
    )
    return rounded(scored.select(*KEYS, "prediction"))


add(
    "score_with_champion",
    _score_champion,
    V1 + ", " + solve_ctes("m", "parts", VERSION_FEATURES["4"], 0.0, "part = 'train'")
    + f" SELECT series_id, ts, {r(predict_sql('m', VERSION_FEATURES['4']))} AS prediction"
    " FROM parts, m WHERE part = 'test'",
)

TREE_VERSIONS = {"2": ["lag_7d"], "4": ["lag_1d", "lag_30d"]}


def _score_champion_tree(s, d):
    """Versions are trees, stored as nodes; the champion's is read back by its alias."""
    rows = prepared(s, d)
    train = rows.where(F.col(PART) == "train")
    nodes = boosting.tree_table(s, {v: stump(train, names) for v, names in TREE_VERSIONS.items()})
    nodes = nodes.select(F.lit(CHAMPION).alias("model_name"), F.col("model_id").alias("version"), *nodes.columns[1:])
    scored = scoring.score_with_champion(
        rows.where(F.col(PART) == "test"), materialize(nodes, "nodes"), C.alias_events(s, d), CHAMPION, boosting.tree_model_from_table
    )
    return rounded(scored.select(*KEYS, "prediction"))


add(
    "score_with_champion_tree",
    _score_champion_tree,
    f"""{V1}, {stump_ctes("m", TREE_VERSIONS["4"])}
    SELECT series_id, ts, {r("CASE WHEN (CASE feature WHEN 'lag_1d' THEN lag_1d ELSE lag_30d END) <= threshold THEN left_value ELSE right_value END")}
    AS prediction FROM parts, m WHERE part = 'test'""",
)

# ---- streaming: all files of a table, then what has been appended


def _stream_day_sums(s, d):
    events = daily.stream_of_table(s, f"{d}/events.parquet")
    rows = events.select(F.col("user_id").alias(SERIES), TS, F.col(VALUE).cast("decimal(18,2)").alias(VALUE))
    output = scratch_path(s, "day-sums")
    daily.write_day_sums(rows, output, scratch_path(s, "stream-state"), "2 days").awaitTermination()
    return rounded(s.read.parquet(output).select("day", F.col("total").cast("double").alias("total"), "readings"))


add(
    "stream_day_sums",
    _stream_day_sums,
    f"""SELECT CAST(ts AS DATE) AS day, {r('sum(CAST(value AS DECIMAL(18, 2)))')} AS total, count(value) AS readings FROM events
    GROUP BY 1 HAVING CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY
      <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 DAY FROM events)""",
)

# ---- sources and sinks: written below the shared folder, then read back


def _readings(s, d):
    path = scratch_path(s, "readings")
    sinks.write_readings_csv(nation_wide(s, d), path)
    wide = readings.read_readings_csv(s, path)
    return rounded(panel.wide_to_long_dropna(wide).select(SERIES, TS, VALUE))


READINGS_SQL = f"{with_ctes(NATION_FACTS)} SELECT series_id, ts, {r('value / 4.0')} AS value FROM facts"
add("read_readings_csv", _readings, READINGS_SQL)


def _convert(s, d):
    source, output = scratch_path(s, "readings"), scratch_path(s, "wide")
    sinks.write_readings_csv(nation_wide(s, d), source)
    return sinks.convert_to_parquet(s, source, output)


add(
    "convert_to_parquet",
    _convert,
    f"""{with_ctes(NATION_FACTS)} SELECT count(DISTINCT ts) AS "rows",
    (SELECT count(DISTINCT n_name) FROM nation) AS clients FROM facts""",
)


def _read_panel(s, d):
    path = scratch_path(s, "wide") + ".parquet"
    nation_wide(s, d).withColumnRenamed(TS, "timestamp").write.parquet(path)
    wide = readings.read_panel(s, path)
    return panel.wide_to_long_dropna(wide).select(SERIES, TS, VALUE)


add("read_panel", _read_panel, f"{with_ctes(NATION_FACTS)} SELECT series_id, ts, value FROM facts")


def _read_panel_csv(s, d):
    """The first 1000 timestamps of a readings file, told by its suffix."""
    path = scratch_path(s, "readings") + ".csv"
    sinks.write_readings_csv(nation_wide(s, d), path)
    return rounded(panel.wide_to_long_dropna(readings.read_panel(s, path, nrows=1000)).select(SERIES, TS, VALUE))


add(
    "read_panel_csv",
    _read_panel_csv,
    READINGS_SQL + " WHERE ts IN (SELECT DISTINCT ts FROM facts ORDER BY ts LIMIT 1000)",
)


def _pruned(s, d):
    path = scratch_path(s, "features")
    P.daily_features(s, d).write.parquet(path)
    scan = readings.pruned_scan(s, path, ["lag_1d", "rolling_mean_7d"])
    return rounded(scan, 3)


add(
    "pruned_scan",
    _pruned,
    f"{FEAT} SELECT series_id, ts, {r('CAST(lag_1d AS FLOAT)', 3)} AS lag_1d,"
    f" {r('CAST(rolling_mean_7d AS FLOAT)', 3)} AS rolling_mean_7d FROM feats",
)


def _allow_list(s, d):
    path = scratch_path(s, "allowed")
    kept = P.table(s, d, "supplier").where("s_acctbal > 0")
    kept.select(F.col("s_suppkey").alias("individual")).write.csv(path, header=True)
    allowed = readings.read_allow_list(s, path).select(F.col(SERIES).cast("bigint").alias(SERIES))
    return profiles.series_totals(filters.keep_series(P.daily_facts(s, d), allowed))


add(
    "read_allow_list",
    _allow_list,
    """SELECT l_suppkey AS series_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total
    FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
    GROUP BY 1""",
)


def _write_splits(s, d):
    path = scratch_path(s, "splits")
    sinks.write_splits(split_v1(P.daily_panel(s, d, *V1_DAYS)), path)
    return part_digest(s.read.parquet(path))


add(
    "write_splits",
    _write_splits,
    f"""{DAY} SELECT part, series_id, count(*) AS "rows", CAST(sum(value) AS BIGINT) AS total,
    min(ts) AS first_ts, max(ts) AS last_ts FROM (SELECT *, {PART_V1} AS part FROM panel)
    WHERE part IS NOT NULL GROUP BY 1, 2""",
)
SPLIT_TEXT = "train=1998-1999 | validation=2000 | test=2001"


def _materialize_split(s, d):
    return sinks.materialize_split(
        split_v1(P.daily_panel(s, d, *V1_DAYS)), "v1", SPLIT_TEXT, scratch_path(s, "split")
    )


add(
    "materialize_split",
    _materialize_split,
    f"""{DAY} SELECT 'v1' AS split, part, count(*) AS "rows", '{SPLIT_TEXT}' AS description,
    'series_id,ts,value,pos' AS columns FROM (SELECT *, {PART_V1} AS part FROM panel)
    WHERE part IS NOT NULL GROUP BY part""",
)


def _features_target(s, d):
    left, right = scratch_path(s, "features"), scratch_path(s, "target")
    sinks.write_features_target(P.daily_features(s, d), left, right)
    frame = joins.join_features_target(s.read.parquet(left), s.read.parquet(right), VALUE)
    sums = [F.sum(c).alias(c) for c in [*FEATURES, VALUE]]
    return rounded(frame.groupBy(SERIES).agg(*sums))


add(
    "write_features_target",
    _features_target,
    f"{FEAT} SELECT series_id, "
    + ", ".join(
        f"CAST(sum({c}) AS BIGINT) AS {c}" if not c.startswith("rolling") else f"{r(f'sum({c})')} AS {c}"
        for c in [*FEATURES, VALUE]
    )
    + " FROM feats GROUP BY 1",
)


def _head_csv(s, d):
    path = scratch_path(s, "head")
    sinks.write_head_csv(P.daily_panel(s, d).select(*KEYS, VALUE), path)
    return s.read.csv(path, header=True, schema="series_id long, ts timestamp_ntz, value long")


add(
    "write_head_csv",
    _head_csv,
    f"{DAY} SELECT series_id, ts, value FROM panel ORDER BY {HASH_SQL.format(seed=56)} LIMIT 1000",
)


def _ranked_csv(s, d):
    path = scratch_path(s, "ranked")
    table = governance.run_leaderboard(C.runs(s, d), parent="model_name").select(
        "model_name", "run_id", "validation_rmse", "rank"
    )
    sinks.write_ranked_csv(table, ["model_name", "rank"], path)
    schema = "model_name string, run_id string, validation_rmse double, rank long"
    return s.read.csv(path, header=True, schema=schema)


add(
    "write_ranked_csv",
    _ranked_csv,
    f"""{RUNS} SELECT model_name, run_id, validation_rmse, row_number() OVER (
    PARTITION BY model_name ORDER BY validation_rmse, validation_mae, start_time, run_id) AS rank
    FROM runs""",
)


def _decision_json(s, d):
    path = scratch_path(s, "decisions")
    decisions = governance.govern_decision(C.versions(s, d), C.alias_events(s, d))
    sinks.write_decision_json(rounded(decisions), path)
    schema = "model_name string, champion_version string, best_version string, decision string, rmse_gain double"
    return s.read.json(path, schema=schema)


add(
    "write_decision_json",
    _decision_json,
    f"""{DECISION_SQL} SELECT model_name, cv AS champion_version, bv AS best_version,
    decision, {r('gain')} AS rmse_gain FROM decisions""",
)


def _metadata(s, d):
    """Each run recorded twice; the later record says it was scored."""
    table = C.runs(s, d).select(
        "run_id", F.col("model_name").alias("strategy_name"), "version",
        "validation_rmse", "validation_mae", "train_digest",
    )
    first = table.withColumns({"state": F.lit("new"), "seq": F.lit(1)})
    later = table.withColumns({"state": F.lit("scored"), "seq": F.lit(2)})
    out = sinks.metadata_table(
        first.unionByName(later), ["version"], ["validation_rmse", "validation_mae"],
        ["train_digest"], "seq",
    )
    path = scratch_path(s, "metadata")
    sinks.write_metadata_table(out, path)
    return s.read.parquet(path)


add(
    "metadata_table",
    _metadata,
    f"""{RUNS} SELECT run_id, model_name AS strategy_name, 'scored' AS state,
    '{{"version":"' || version || '"}}' AS feature_names_json,
    '{{"validation_rmse":' || validation_rmse || ',"validation_mae":' || validation_mae || '}}'
      AS metrics_json,
    '{{"train_digest":"' || train_digest || '"}}' AS extra_params_json FROM runs""",
)
REPORT = {
    "run": ["model_name", "version"],
    "metrics": ["validation_rmse", "test_rmse"],
    "params": ["train_digest"],
}
add(
    "run_report",
    lambda s, d: sinks.run_report(C.runs(s, d), REPORT),
    f"{RUNS} "
    + " UNION ALL ".join(
        f"SELECT run_id, '{g}' AS \"group\", '{k}' AS key, CAST({k} AS VARCHAR) AS value FROM runs"
        for g, ks in REPORT.items()
        for k in ks
    ),
)
