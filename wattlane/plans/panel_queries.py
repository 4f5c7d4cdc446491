"""Queries on reshaping, filters, quality, profiles and window features."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlane.functions.columns import calendar_fields, to_kwh
from wattlane.operators import features, filters, joins, panel, profiles, quality
from wattlane.plans import panels as P
from wattlane.plans.oracle import (
    CLEAN, DAILY, DAY_FACTS, F_DAY, FLEET, HOUR_FACTS, NATION_FACTS, P_DAY, P_HOUR, P_NATION,
    lag_sql, r, window_sql, with_ctes,
)
from wattlane.plans.registry import Catalog, rounded
from wattlane.schema import BLOCK, BLOCK_KEYS, FEATURES, KEYS, SERIES, STRATEGIES, TS, VALUE

CATALOG = Catalog()
add = CATALOG.add

DAY, NATION, HOUR = with_ctes(P_DAY), with_ctes(P_NATION), with_ctes(P_HOUR)
FEAT = with_ctes(F_DAY)
DAY_FLEET = with_ctes(P_DAY, FLEET)
HOUR_FLEET = with_ctes(P_HOUR, FLEET)
TRAIN_YEARS = [1998, 1999]
HASH_SQL = "md5('{seed}|' || series_id || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S'))"


def nation_wide(spark, sf):
    """The nation panel with one column per nation, as a meter export looks."""
    names = [
        row.n_name
        for row in P.table(spark, sf, "nation").select("n_name").distinct().orderBy("n_name").collect()
    ]
    return P.nation_facts(spark, sf).groupBy(TS).pivot(SERIES, names).agg(F.sum(VALUE))


# ---- reshape and projection

add(
    "wide_to_long",
    lambda s, d: rounded(panel.wide_to_long(nation_wide(s, d))),
    f"""{with_ctes(NATION_FACTS)}
    SELECT n.n_name AS series_id, t.ts, f.value, {r('f.value / 4.0')} AS value_kwh,
           strftime(t.ts, '%Y-%m') AS year_month
    FROM (SELECT DISTINCT ts FROM facts) t CROSS JOIN (SELECT DISTINCT n_name FROM nation) n
    LEFT JOIN facts f ON f.ts = t.ts AND f.series_id = n.n_name""",
)
add(
    "wide_to_long_dropna",
    lambda s, d: rounded(panel.wide_to_long_dropna(nation_wide(s, d))),
    f"""{with_ctes(NATION_FACTS)}
    SELECT series_id, ts, value, {r('value / 4.0')} AS value_kwh,
           strftime(ts, '%Y-%m') AS year_month FROM facts""",
)
add(
    "long_to_wide",
    lambda s, d: rounded(
        panel.weekday_hour_matrix(profiles.profile_weekday_hour(P.hourly_panel(s, d)))
    ),
    f"""{HOUR_FLEET}
    SELECT CAST(isodow(ts) - 1 AS BIGINT) AS weekday, """
    + ", ".join(
        r(f"avg(fleet_mean) FILTER (hour(ts) = {h})") + f" AS h{h:02d}" for h in range(24)
    )
    + " FROM fleet GROUP BY 1",
)
SLICE = {f"d{i:02d}": f"2000-01-{i:02d} 00:00:00" for i in range(1, 11)}
add(
    "timestamp_slice_transpose",
    lambda s, d: panel.timestamp_slice_transpose(
        P.daily_panel(s, d, "2000-01-01", "2000-01-11"), SLICE
    ),
    f"{DAY} SELECT series_id, "
    + ", ".join(f"max(value) FILTER (ts = TIMESTAMP '{t}') AS {n}" for n, t in SLICE.items())
    + " FROM panel GROUP BY 1",
)
add(
    "unit_convert",
    lambda s, d: rounded(
        P.daily_panel(s, d).select(*KEYS, to_kwh(VALUE).alias("value_kwh"))
    ),
    f"{DAY} SELECT series_id, ts, {r('value / 4.0')} AS value_kwh FROM panel",
)
add(
    "downcast",
    lambda s, d: rounded(
        panel.downcast(
            P.hourly_panel(s, d).select(*KEYS, F.col(VALUE).cast("double").alias(VALUE)), [VALUE]
        ), 4
    ),
    f"{HOUR} SELECT series_id, ts, {r('CAST(value AS FLOAT)', 4)} AS value FROM panel",
)
add(
    "select_strategy",
    lambda s, d: rounded(
        joins.select_strategy(P.daily_features(s, d), STRATEGIES["rolling"])
    ),
    f"""{FEAT} SELECT series_id, ts, lag_1d, lag_7d, {r('rolling_mean_7d')} AS rolling_mean_7d,
    {r('rolling_mean_30d')} AS rolling_mean_30d, value FROM feats""",
)
add(
    "calendar_fields",
    lambda s, d: rounded(
        P.table(s, d, "events").select(
            "event_id", *[c.alias(n) for n, c in calendar_fields("ts").items()]
        )
    ),
    f"""SELECT event_id, CAST(year(ts) AS BIGINT) AS year, CAST(month(ts) AS BIGINT) AS month,
    CAST(isodow(ts) - 1 AS BIGINT) AS weekday, CAST(hour(ts) AS BIGINT) AS hour,
    {r('hour(ts) + minute(ts) / 60.0')} AS hour_of_day,
    CAST(dayofyear(ts) AS BIGINT) AS day_of_year, CAST(ts AS DATE) AS day,
    strftime(ts, '%H:%M:%S') AS time_of_day FROM events""",
)

# ---- filters

add(
    "keep_individuals",
    lambda s, d: filters.keep_series(
        P.daily_panel(s, d),
        P.table(s, d, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias(SERIES)),
    ),
    f"{DAY} SELECT series_id, ts, value, pos FROM panel WHERE series_id IN"
    " (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)",
)
add(
    "drop_incomplete",
    lambda s, d: filters.drop_incomplete(P.daily_features(s, d), ["lag_7d", "lag_30d"]).select(
        *KEYS, "lag_7d", "lag_30d"
    ),
    f"{FEAT} SELECT series_id, ts, lag_7d, lag_30d FROM feats"
    " WHERE lag_7d IS NOT NULL AND lag_30d IS NOT NULL",
)
add(
    "date_range",
    lambda s, d: filters.date_range(
        P.daily_panel(s, d, "1999-03-01", "1999-07-01"), "1999-03-01", "1999-06-30"
    ),
    f"{DAY} SELECT series_id, ts, value, pos FROM panel"
    " WHERE ts >= TIMESTAMP '1999-03-01' AND ts < TIMESTAMP '1999-07-01'",
)
add(
    "year_in",
    lambda s, d: filters.year_in(P.daily_panel(s, d, "1998-01-01", "2000-01-01"), TRAIN_YEARS),
    f"{DAY} SELECT series_id, ts, value, pos FROM panel WHERE year(ts) IN (1998, 1999)",
)
add(
    "label_slice",
    lambda s, d: filters.label_slice(
        P.daily_panel(s, d, "1999-02-01", "2000-03-06"), "1999-02", "2000-03-05"
    ),
    f"{DAY} SELECT series_id, ts, value, pos FROM panel"
    " WHERE ts >= TIMESTAMP '1999-02-01' AND ts < TIMESTAMP '2000-03-06'",
)
add(
    "at_timestamp",
    lambda s, d: filters.at_timestamp(
        P.daily_panel(s, d, "2000-01-05", "2000-01-06"), "2000-01-05 00:00:00"
    ),
    f"{DAY} SELECT series_id, ts, value, pos FROM panel WHERE ts = TIMESTAMP '2000-01-05'",
)
add(
    "at_time_of_day",
    lambda s, d: rounded(filters.at_time_of_day(P.hourly_panel(s, d), "12:00:00")),
    f"{HOUR} SELECT series_id, ts, {r('value')} AS value, pos FROM panel WHERE hour(ts) = 12",
)
add(
    "existing_individuals",
    lambda s, d: filters.existing_series(
        P.daily_facts(s, d),
        P.table(s, d, "customer").select(F.col("c_custkey").alias(SERIES)),
    ),
    "SELECT DISTINCT c_custkey AS series_id FROM customer"
    " WHERE c_custkey IN (SELECT l_suppkey FROM lineitem)",
)
add(
    "complete_history",
    lambda s, d: filters.complete_history(P.user_days(s, d), 2024),
    """SELECT user_id AS series_id FROM events, (SELECT count(DISTINCT CAST(ts AS DATE)) AS n FROM events)
    GROUP BY 1 HAVING count(DISTINCT CASE WHEN value <> 0 THEN CAST(ts AS DATE) END) = any_value(n)""",
)

# ---- quality

QUALITY_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count(*) FILTER ({c} IS NULL) AS missing,"
    f" {r(f'100.0 * count(*) FILTER ({c} IS NULL) / count(*)', 3)} AS missing_pct FROM feats"
    for c, t in [
        ("series_id", "bigint"), ("ts", "timestamp_ntz"), ("value", "bigint"), ("pos", "bigint"),
        *[(f, "bigint" if f.startswith("lag") else "double") for f in FEATURES],
    ]
)
add(
    "column_quality",
    lambda s, d: quality.column_quality(P.daily_features(s, d)),
    f"{FEAT} {QUALITY_SQL}",
)
add(
    "negatives_and_zeros",
    lambda s, d: rounded(quality.negatives_and_zeros(P.daily_panel(s, d))),
    f"""{DAY} SELECT CAST(sum(neg) AS BIGINT) AS negatives, {r('avg(z)')} AS mean_zero_share
    FROM (SELECT count(*) FILTER (value < 0) AS neg, avg(CAST(value = 0 AS INT)) AS z
          FROM panel GROUP BY series_id)""",
)
add(
    "dataset_extent",
    lambda s, d: quality.dataset_extent(P.daily_panel(s, d)),
    f"""{DAY} SELECT count(*) AS "rows", count(DISTINCT ts) AS timestamps,
    count(DISTINCT series_id) AS series, min(ts) AS first_ts, max(ts) AS last_ts FROM panel""",
)
DESCRIBE = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}
DESCRIBE_SQL = (
    f"count(value) AS \"count\", {r('avg(value)')} AS mean, {r('stddev_samp(value)')} AS std, "
    f"{r('min(value)')} AS \"min\", {r('max(value)')} AS \"max\", "
    + ", ".join(f"{r(f'quantile_cont(value, {p})')} AS {n}" for n, p in DESCRIBE.items())
)
add(
    "describe",
    lambda s, d: rounded(quality.describe(P.daily_panel(s, d), percentiles=DESCRIBE)),
    f"{DAY} SELECT {DESCRIBE_SQL} FROM panel",
)
add(
    "describe_by_series",
    lambda s, d: rounded(
        quality.describe(P.hourly_panel(s, d), percentiles=DESCRIBE, by=[SERIES])
    ),
    f"{HOUR} SELECT series_id, {DESCRIBE_SQL} FROM panel GROUP BY series_id",
)
ZERO_SQL = "100.0 * avg(CAST(value = 0 AS INT))"
add(
    "zero_share_ranking",
    lambda s, d: rounded(quality.zero_share_ranking(P.daily_panel(s, d))),
    f"""{DAY} SELECT series_id, {r('z')} AS zero_pct FROM
    (SELECT series_id, {ZERO_SQL} AS z FROM panel GROUP BY 1) ORDER BY z DESC, series_id LIMIT 15""",
)
add(
    "zero_share_counts",
    lambda s, d: quality.zero_share_counts(P.daily_panel(s, d)),
    f"""{DAY} SELECT count(*) AS series, count(*) FILTER (z > 0) AS with_zero,
    count(*) FILTER (z > 50) AS mostly_zero
    FROM (SELECT series_id, {ZERO_SQL} AS z FROM panel GROUP BY 1)""",
)
FIRST_SQL = "coalesce(min(ts) FILTER (value <> 0), min(ts))"
add(
    "first_active",
    lambda s, d: quality.first_active(P.daily_panel(s, d)),
    f"{DAY} SELECT series_id, {FIRST_SQL} AS first_active FROM panel GROUP BY 1",
)
add(
    "first_active_by_year",
    lambda s, d: quality.first_active_by_year(P.daily_panel(s, d)),
    f"""{DAY} SELECT CAST(year(a) AS BIGINT) AS year, count(*) AS series
    FROM (SELECT {FIRST_SQL} AS a FROM panel GROUP BY series_id) GROUP BY 1""",
)
STEP_SQL = (
    "SELECT series_id, epoch(ts) - epoch(lag(ts) OVER (PARTITION BY series_id ORDER BY ts))"
    " AS step FROM facts"
)
add(
    "step_histogram",
    lambda s, d: quality.step_histogram(panel.aggregate_facts(P.hourly_facts(s, d))),
    f"""{with_ctes(HOUR_FACTS)} SELECT CAST(step AS BIGINT) AS step_seconds, count(*) AS n
    FROM ({STEP_SQL}) WHERE step IS NOT NULL GROUP BY 1""",
)
add(
    "assert_regular",
    lambda s, d: quality.irregular_steps(panel.aggregate_facts(P.hourly_facts(s, d)), P.HOUR),
    f"""{with_ctes(HOUR_FACTS)} SELECT series_id, count(*) AS violations
    FROM ({STEP_SQL}) WHERE step <> 3600 GROUP BY 1""",
)
add(
    "duplicate_keys",
    lambda s, d: quality.duplicate_keys(P.daily_facts(s, d)),
    """SELECT l_suppkey AS series_id, CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS ts,
    count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
add(
    "irregular_days",
    lambda s, d: quality.irregular_days(P.hourly_facts(s, d), 24),
    """SELECT CAST(ts AS DATE) AS day, count(DISTINCT date_trunc('hour', ts)) AS intervals
    FROM events GROUP BY 1 HAVING count(DISTINCT date_trunc('hour', ts)) <> 24""",
)
add(
    "irregular_days_by_series",
    # Every series has its own days; the hours of some are all there.
    lambda s, d: quality.irregular_days(P.hourly_facts(s, d, "event_type"), 24, [SERIES]),
    """SELECT event_type AS series_id, CAST(ts AS DATE) AS day,
    count(DISTINCT date_trunc('hour', ts)) AS intervals
    FROM events GROUP BY 1, 2 HAVING count(DISTINCT date_trunc('hour', ts)) <> 24""",
)
add(
    "keys_match",
    lambda s, d: quality.keys_match(
        filters.drop_incomplete(P.daily_features(s, d), ["lag_7d"]), P.daily_panel(s, d), P.DAY
    ),
    f"""{FEAT} SELECT CAST(0 AS BIGINT) AS only_left, n AS only_right, n = 0 AS matches
    FROM (SELECT count(*) FILTER (lag_7d IS NULL) AS n FROM feats)""",
)
DST_DAYS = ["1999-03-28", "1999-10-31", "2000-03-26"]
DST_IN = ", ".join(f"DATE '{x}'" for x in DST_DAYS)
add(
    "dst_profile",
    lambda s, d: rounded(quality.dst_profile(P.nation_panel(s, d), DST_DAYS)),
    f"""{with_ctes(P_NATION, FLEET)} SELECT CAST(a.ts AS DATE) AS day,
    {r('hour(a.ts) + minute(a.ts) / 60.0')} AS hour_of_day, {r('a.fleet_mean')} AS fleet_mean,
    {r('b.fleet_mean')} AS week_before_mean
    FROM fleet a LEFT JOIN fleet b ON b.ts = a.ts - INTERVAL 7 DAY
    WHERE CAST(a.ts AS DATE) IN ({DST_IN})""",
)
SUBSETS = {
    "one_lag": ["lag_1d"],
    "three_lags": ["lag_1d", "lag_7d", "lag_30d"],
    "four_lags": ["lag_1d", "lag_7d", "lag_30d", "lag_365d"],
}
add(
    "rows_after_dropna",
    lambda s, d: quality.rows_after_dropna(P.daily_features(s, d), SUBSETS),
    f"{FEAT} SELECT 'total_rows' AS subset, count(*) AS \"rows\" FROM feats"
    + "".join(
        f" UNION ALL SELECT '{n}', count(*) FROM feats WHERE "
        + " AND ".join(f"{c} IS NOT NULL" for c in cols)
        for n, cols in SUBSETS.items()
    ),
)
add(
    "rows_by_year",
    lambda s, d: quality.rows_by_year(filters.drop_incomplete(P.daily_features(s, d), FEATURES)),
    f"""{with_ctes(F_DAY, CLEAN)} SELECT CAST(year(ts) AS BIGINT) AS year, count(*) AS "rows"
    FROM clean GROUP BY 1""",
)
add(
    "kpi_summary",
    lambda s, d: rounded(
        quality.kpi_summary(P.daily_panel(s, d, "1999-01-01", "2000-07-01"), "1999-01", "2000-06")
    ),
    f"""{DAY}, cut AS (SELECT * FROM panel WHERE ts >= TIMESTAMP '1999-01-01'
      AND ts < TIMESTAMP '2000-07-01')
    SELECT min(lo) AS first_ts, max(hi) AS last_ts, count(*) AS series,
    {r('avg(m)')} AS mean_of_series, CAST(sum(s) AS BIGINT) AS total,
    (SELECT count(DISTINCT ts) FROM cut) AS timestamps
    FROM (SELECT min(ts) AS lo, max(ts) AS hi, avg(value) AS m, sum(value) AS s
          FROM cut GROUP BY series_id)""",
)

# ---- aggregations and profiles

add(
    "fleet_total",
    lambda s, d: profiles.fleet_total(P.daily_panel(s, d)),
    f"{DAY} SELECT ts, CAST(sum(value) AS BIGINT) AS total FROM panel GROUP BY 1",
)
add(
    "fleet_mean",
    lambda s, d: rounded(profiles.fleet_mean(P.daily_panel(s, d))),
    f"{DAY_FLEET} SELECT ts, {r('fleet_mean')} AS fleet_mean FROM fleet",
)
add(
    "resample_daily_sum",
    lambda s, d: rounded(profiles.resample_daily_sum(P.hourly_panel(s, d))),
    f"{HOUR} SELECT CAST(ts AS DATE) AS day, {r('sum(value)')} AS total FROM panel GROUP BY 1",
)
add(
    "resample_daily_sum_series",
    lambda s, d: profiles.resample_daily_sum(P.daily_facts(s, d), series=7),
    f"""{with_ctes(DAY_FACTS)}, one AS (SELECT * FROM facts WHERE series_id = 7),
    days AS (SELECT CAST(unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS DATE) AS day
             FROM one)
    SELECT day, CAST(coalesce(value, 0) AS BIGINT) AS total
    FROM days LEFT JOIN one ON CAST(one.ts AS DATE) = day""",
)
add(
    "resample_daily_mean",
    lambda s, d: rounded(profiles.resample_daily_mean(panel.aggregate_facts(P.daily_facts(s, d)))),
    f"""{with_ctes(DAY_FACTS)},
    days AS (SELECT CAST(unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS DATE) AS day
             FROM facts),
    means AS (SELECT CAST(ts AS DATE) AS day, avg(value) AS m FROM facts GROUP BY 1)
    SELECT days.day, {r('m')} AS fleet_mean FROM days LEFT JOIN means ON means.day = days.day""",
)
add(
    "resample_month_sum",
    lambda s, d: profiles.resample_month_sum(P.daily_panel(s, d)),
    f"""{DAY} SELECT CAST(year(ts) AS BIGINT) AS year, CAST(month(ts) AS BIGINT) AS month,
    CAST(sum(value) AS BIGINT) AS total FROM panel GROUP BY 1, 2""",
)
add(
    "profile_time_of_day",
    lambda s, d: rounded(profiles.profile_time_of_day(P.hourly_panel(s, d))),
    f"""{HOUR_FLEET} SELECT {r('hour(ts) + minute(ts) / 60.0')} AS hour_of_day,
    {r('avg(fleet_mean)')} AS mean_value FROM fleet GROUP BY 1""",
)
NAME_SQL = "['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][CAST(isodow(ts) AS INT)]"
add(
    "profile_weekday",
    lambda s, d: rounded(profiles.profile_weekday(P.daily_panel(s, d))),
    f"""{DAY_FLEET} SELECT CAST(isodow(ts) - 1 AS BIGINT) AS weekday,
    {r('avg(fleet_mean)')} AS mean_value, any_value({NAME_SQL}) AS weekday_name
    FROM fleet GROUP BY 1""",
)
add(
    "profile_weekday_hour",
    lambda s, d: rounded(profiles.profile_weekday_hour(P.hourly_panel(s, d))),
    f"""{HOUR_FLEET} SELECT CAST(isodow(ts) - 1 AS BIGINT) AS weekday,
    CAST(hour(ts) AS BIGINT) AS hour, {r('avg(fleet_mean)')} AS value FROM fleet GROUP BY 1, 2""",
)
add(
    "daily_cycle_summary",
    lambda s, d: rounded(profiles.daily_cycle_summary(P.hourly_panel(s, d))),
    f"""{HOUR_FLEET}, h AS (SELECT CAST(hour(ts) AS BIGINT) AS h, avg(fleet_mean) AS m
      FROM fleet GROUP BY 1),
    w AS (SELECT isodow(ts) - 1 AS d, avg(fleet_mean) AS m FROM fleet GROUP BY 1)
    SELECT arg_min(h, m) AS min_hour, {r('min(m)')} AS min_value, arg_max(h, m) AS max_hour,
    {r('max(m)')} AS max_value, {r('max(m) / min(m)')} AS peak_to_trough,
    {r('(SELECT avg(m) FILTER (d >= 5) / avg(m) FILTER (d < 5) FROM w)')} AS weekend_to_weekday
    FROM h""",
)
add(
    "series_stats",
    lambda s, d: rounded(profiles.series_stats(P.daily_panel(s, d))),
    f"""{DAY} SELECT series_id, {r('avg(value)')} AS mean, {r('median(value)')} AS median,
    {r('stddev_samp(value)')} AS std, {r('max(value)')} AS "max", {r(ZERO_SQL)} AS zero_pct
    FROM panel GROUP BY 1""",
)
add(
    "year_stats",
    lambda s, d: rounded(profiles.year_stats(P.daily_panel(s, d, "1998-01-01", "2002-01-01"), [1998, 2001])),
    f"""{DAY} SELECT CAST(year(ts) AS BIGINT) AS year, {r('avg(value)')} AS mean,
    {r('median(value)')} AS median, {r('stddev_samp(value)')} AS std, {r('min(value)')} AS "min",
    {r('max(value)')} AS "max" FROM panel WHERE year(ts) IN (1998, 2001) GROUP BY 1""",
)
TOTALS = "totals AS (SELECT series_id, CAST(sum(value) AS BIGINT) AS total FROM panel GROUP BY 1)"
add(
    "concentration",
    lambda s, d: rounded(profiles.concentration(P.daily_panel(s, d))),
    f"""{with_ctes(P_DAY, TOTALS)} SELECT series_id, total,
    row_number() OVER (ORDER BY total DESC, series_id) AS rank,
    CAST(sum(total) OVER o AS BIGINT) AS cum_total,
    {r('sum(total) OVER o / (SELECT sum(total) FROM totals)')} AS cum_share
    FROM totals WINDOW o AS (ORDER BY total DESC, series_id ROWS UNBOUNDED PRECEDING)""",
)
add(
    "concentration_summary",
    lambda s, d: rounded(profiles.concentration_summary(P.daily_panel(s, d))),
    f"""{with_ctes(P_DAY, TOTALS)}, ranks AS (
      SELECT total, row_number() OVER (ORDER BY total DESC, series_id) AS k FROM totals)
    SELECT min(total) AS smallest, max(total) AS largest, {r('median(total)')} AS median,
    {r('sum(total) FILTER (k <= 10) / sum(total)')} AS top_10_share,
    {r('sum(total) FILTER (k <= 50) / sum(total)')} AS top_50_share,
    {r('max(total) / median(total)')} AS largest_to_median FROM ranks""",
)
add(
    "lowest_days",
    lambda s, d: rounded(
        profiles.lowest_days(
            P.daily_panel(s, d), "2000-01-01", "2000-12-31", "2000-12-01", "2000-12-31"
        )
    ),
    f"""{with_ctes(P_DAY, FLEET, DAILY)} SELECT day, {r('fleet_mean')} AS fleet_mean,
    {r('''100 * fleet_mean / (SELECT median(fleet_mean) FROM daily
        WHERE day BETWEEN DATE '2000-12-01' AND DATE '2000-12-31')''')} AS pct_of_median
    FROM daily WHERE year(day) = 2000 ORDER BY daily.fleet_mean, day LIMIT 6""",
)
add(
    "composition_effect",
    lambda s, d: rounded(profiles.composition_effect(P.nation_panel(s, d), 1998)),
    f"""{NATION}, full_ids AS (SELECT series_id FROM panel WHERE year(ts) = 1998 GROUP BY 1
      HAVING bool_and(value <> 0)),
    a AS (SELECT y, avg(m) AS v FROM (SELECT year(ts) AS y, series_id, avg(value) AS m FROM panel
      GROUP BY 1, 2) GROUP BY 1),
    c AS (SELECT y, avg(m) AS v FROM (SELECT year(ts) AS y, series_id, avg(value) AS m FROM panel
      WHERE series_id IN (SELECT series_id FROM full_ids) GROUP BY 1, 2) GROUP BY 1)
    SELECT CAST(a.y AS BIGINT) AS year, {r('a.v')} AS all_series, {r('c.v')} AS complete_series,
    {r('100 * (a.v / lag(a.v) OVER (ORDER BY a.y) - 1)')} AS all_series_change_pct,
    {r('100 * (c.v / lag(c.v) OVER (ORDER BY a.y) - 1)')} AS complete_series_change_pct
    FROM a LEFT JOIN c ON a.y = c.y""",
)
add(
    "series_vs_fleet",
    lambda s, d: rounded(
        profiles.series_vs_fleet(
            P.daily_panel(s, d, "2000-12-01", "2001-01-01"), 7, "2000-12-01", "2000-12-31"
        )
    ),
    f"""{DAY} SELECT CAST(ts AS DATE) AS day,
    {r('sum(value) FILTER (series_id = 7)')} AS series_total, {r('avg(value)')} AS fleet_total
    FROM panel WHERE ts >= TIMESTAMP '2000-12-01' AND ts < TIMESTAMP '2001-01-01' GROUP BY 1""",
)
add(
    "compare_series",
    lambda s, d: rounded(
        profiles.compare_series(
            P.hourly_panel(s, d),
            P.table(s, d, "events").groupBy(F.col("user_id").alias(SERIES))
            .agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("t"))
            .orderBy(F.desc("t"), SERIES).limit(5),
        )
    ),
    f"""{HOUR} SELECT series_id, CAST(ts AS DATE) AS day, {r('sum(value)')} AS total
    FROM panel WHERE series_id IN (SELECT user_id FROM events GROUP BY 1
      ORDER BY sum(CAST(value AS DECIMAL(18, 2))) DESC, user_id LIMIT 5) GROUP BY 1, 2""",
)
add(
    "seasonal_overlay",
    lambda s, d: rounded(profiles.seasonal_overlay(P.daily_panel(s, d))),
    f"""{with_ctes(P_DAY, FLEET, DAILY)} SELECT CAST(year(day) AS BIGINT) AS year,
    CAST(dayofyear(day) AS BIGINT) AS day_of_year, {r('fleet_mean')} AS fleet_mean FROM daily""",
)


def bin_sql(x: str, lo: str, hi: str, bins: int) -> str:
    return f"CAST(least(floor(({x} - {lo}) / (({hi} - {lo}) / {bins}.0)), {bins - 1}) AS BIGINT)"


FLEET_LIMITS = (
    "lim AS (SELECT min(CAST(value AS DOUBLE)) AS lo, max(CAST(value AS DOUBLE)) AS hi FROM panel)"
)
add(
    "histogram",
    lambda s, d: rounded(profiles.histogram(P.daily_panel(s, d), bins=20)),
    f"""{with_ctes(P_DAY, FLEET_LIMITS)}, c AS (
      SELECT {bin_sql('value', 'lo', 'hi', 20)} AS b, count(*) AS n FROM panel, lim GROUP BY 1)
    SELECT range AS bin, {r('lo + range * ((hi - lo) / 20)')} AS left_edge, coalesce(n, 0) AS n
    FROM range(20) CROSS JOIN lim LEFT JOIN c ON b = range""",
)
add(
    "histogram_density",
    lambda s, d: rounded(
        profiles.histogram_density(
            filters.year_in(P.daily_panel(s, d, "1998-01-01", "2002-01-01"), [1998, 2001]).withColumn(
                "year", F.year(TS).cast("bigint")
            ),
            "year", bins=20,
        )
    ),
    f"""{DAY}, cut AS (SELECT *, CAST(year(ts) AS BIGINT) AS y FROM panel
      WHERE year(ts) IN (1998, 2001)),
    lim AS (SELECT min(CAST(value AS DOUBLE)) AS lo, max(CAST(value AS DOUBLE)) AS hi FROM cut),
    c AS (SELECT y, {bin_sql('value', 'lo', 'hi', 20)} AS bin, count(*) AS n FROM cut, lim
      GROUP BY 1, 2)
    SELECT y AS year, bin, n,
    {r('n / (sum(n) OVER (PARTITION BY y) * ((hi - lo) / 20))')} AS density FROM c, lim""",
)
add(
    "correlation_matrix",
    lambda s, d: rounded(
        profiles.correlation_matrix(P.daily_features(s, d), [VALUE, *FEATURES])
    ),
    f"{FEAT} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, "
        + r(f"corr(CAST({min(a, b)} AS DOUBLE), CAST({max(a, b)} AS DOUBLE))")
        + " AS correlation FROM feats"
        for a in [VALUE, *FEATURES]
        for b in [VALUE, *FEATURES]
    ),
)
add(
    "target_correlation_by_series",
    lambda s, d: rounded(
        profiles.target_correlation(P.daily_features(s, d), FEATURES, VALUE, [SERIES])
    ),
    f"{FEAT} "
    + " UNION ALL ".join(
        f"SELECT series_id, '{f}' AS feature, {r(f'corr({f}, value)')} AS correlation"
        " FROM feats GROUP BY 1"
        for f in FEATURES
    ),
)
ACF_LAGS = {"1 hour": 1, "3 h": 3, "6 h": 6, "12 h": 12, "1 day": 24, "1 week": 168}
add(
    "autocorrelation",
    lambda s, d: rounded(profiles.autocorrelation(P.hourly_panel(s, d), ACF_LAGS)),
    f"{HOUR_FLEET} "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS label, CAST({k} AS BIGINT) AS lag, {r('corr(x, y)')} AS autocorrelation"
        f" FROM (SELECT fleet_mean AS x, lag(fleet_mean, {k}) OVER (ORDER BY ts) AS y FROM fleet)"
        for n, k in ACF_LAGS.items()
    ),
)
add(
    "autocorrelation_profile",
    lambda s, d: rounded(profiles.autocorrelation_profile(P.daily_panel(s, d), 767)),
    f"""{DAY_FLEET}, p AS (SELECT fleet_mean AS v, row_number() OVER (ORDER BY ts) AS i FROM fleet)
    SELECT k.range AS lag, {r('corr(a.v, b.v)')} AS autocorrelation
    FROM range(1, 768) k JOIN p a ON true JOIN p b ON b.i = a.i - k.range GROUP BY 1""",
)
add(
    "distinct_series",
    lambda s, d: profiles.distinct_series(P.daily_facts(s, d)),
    "SELECT count(DISTINCT l_suppkey) AS series FROM lineitem",
)

# ---- window features

FEATURE_OUT = ", ".join(f if f.startswith("lag") else f"{r(f)} AS {f}" for f in FEATURES)
add(
    "lag_features",
    lambda s, d: features.build_features(P.daily_panel(s, d), 1, windows={}).select(
        *KEYS, *FEATURES[:4]
    ),
    f"{FEAT} SELECT series_id, ts, {', '.join(FEATURES[:4])} FROM feats",
)
add(
    "sub_day_lags",
    lambda s, d: rounded(features.sub_day_lags(P.hourly_panel(s, d), 24).drop("pos")),
    f"""{HOUR} SELECT series_id, ts, {r('value')} AS value, {r(lag_sql(1))} AS lag_1_step,
    {r(lag_sql(1))} AS lag_1h, {r(lag_sql(24))} AS lag_24h, {r(lag_sql(168))} AS lag_7d
    FROM panel""",
)
add(
    "rolling_mean_past",
    lambda s, d: rounded(P.daily_features(s, d).select(*KEYS, *FEATURES[4:])),
    f"""{DAY} SELECT series_id, ts, {r(window_sql(7))} AS rolling_mean_7d,
    {r(window_sql(30))} AS rolling_mean_30d FROM panel""",
)
add(
    "rolling_mean_inclusive",
    lambda s, d: rounded(
        features.build_features(P.daily_panel(s, d), 1, lags={}, inclusive=True).select(
            *KEYS, *FEATURES[4:]
        )
    ),
    f"""{DAY} SELECT series_id, ts, {r(window_sql(7, True))} AS rolling_mean_7d,
    {r(window_sql(30, True))} AS rolling_mean_30d FROM panel""",
)
add(
    "lag_features_counted_positions",
    lambda s, d: features.build_features(
        panel.aggregate_facts(P.daily_facts(s, d)), 1, lags={"lag_1d": 1, "lag_7d": 7}, windows={}
    ),
    f"""{with_ctes(DAY_FACTS)} SELECT series_id, ts, value,
    row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS pos,
    {lag_sql(1)} AS lag_1d, {lag_sql(7)} AS lag_7d FROM facts""",
)
NAIVE = {"yesterday, same time": 1, "last week, same time": 7}
NAIVE_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS baseline, CAST({k} AS BIGINT) AS lag_steps, count(e) AS n,"
    f" {r('sqrt(avg(e * e))')} AS rmse, {r('avg(abs(e))')} AS mae"
    f" FROM (SELECT CAST(value - {lag_sql(k)} AS DOUBLE) AS e, ts FROM panel)"
    " WHERE year(ts) = 2001"
    for n, k in NAIVE.items()
)
DOUBLE_WINDOWS = {"mean_7": 7, "mean_30": 30}


def _double_means(s, d):
    """Means of a panel of floating values whose size changes a lot."""
    scale = F.when(F.year(TS) == 1999, 1e6).otherwise(0.1)
    doubles = features.features_of_facts(
        P.daily_facts(s, d), P.DAY, 1, lags={}, windows=DOUBLE_WINDOWS,
        change=lambda rows: rows.withColumn(VALUE, F.col(VALUE).cast("double") * scale),
    )
    return rounded(doubles.select(*KEYS, *DOUBLE_WINDOWS))


def _double_mean_sql(name: str, k: int) -> str:
    """Whole quantities are summed apart for each scale, without a rounding error."""
    large = f"sum(CASE WHEN year(ts) = 1999 THEN value END) OVER w{k}"
    small = f"sum(CASE WHEN year(ts) <> 1999 THEN value END) OVER w{k}"
    mean = r(f"(1e6 * coalesce({large}, 0) + 0.1 * coalesce({small}, 0)) / {k}")
    return f"CASE WHEN count(*) OVER w{k} = {k} THEN {mean} END AS {name}"


add(
    "rolling_mean_of_doubles",
    _double_means,
    f"{DAY} SELECT series_id, ts, "
    + ", ".join(_double_mean_sql(n, k) for n, k in DOUBLE_WINDOWS.items())
    + " FROM panel WINDOW "
    + ", ".join(
        f"w{k} AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
        for k in DOUBLE_WINDOWS.values()
    ),
)
add(
    "persistence_baseline",
    lambda s, d: rounded(
        features.persistence_errors(
            # The year and the longest look-back, seven days, before it.
            P.daily_panel(s, d, "2000-12-25", "2002-01-01"), NAIVE, "2001-01-01", "2002-01-01"
        )
    ),
    f"{DAY} {NAIVE_SQL}",
)

# ---- joins

add(
    "join_features_target",
    lambda s, d: rounded(
        joins.join_features_target(
            *joins.features_and_target(P.daily_features(s, d, blocks=True), on=BLOCK_KEYS), target=VALUE, on=BLOCK_KEYS
        ).drop(BLOCK, "pos")
    ),
    f"{FEAT} SELECT series_id, ts, {FEATURE_OUT}, value FROM feats",
)
add(
    "rejoin_target",
    lambda s, d: joins.rejoin_target(
        P.daily_features(s, d, blocks=True).select(*BLOCK_KEYS, TS, "lag_7d"),
        P.daily_features(s, d, blocks=True).where(F.col(VALUE) > 0).select(*BLOCK_KEYS, VALUE),
        on=BLOCK_KEYS,
    ).drop(BLOCK, "pos"),
    f"""{FEAT} SELECT series_id, ts, lag_7d, CASE WHEN value > 0 THEN value END AS value
    FROM feats""",
)
add(
    "union_parts",
    lambda s, d: joins.union_parts(
        P.daily_panel(s, d, "1999-01-01", "2000-01-01"), P.daily_panel(s, d, "2000-01-01", "2001-01-01")
    ),
    f"{DAY} SELECT series_id, ts, value, pos FROM panel WHERE year(ts) IN (1999, 2000)",
)
add(
    "union_with_group_key",
    lambda s, d: joins.union_with_group_key(
        {
            "1999": profiles.series_totals(P.daily_panel(s, d, "1999-01-01", "2000-01-01")),
            "2000": profiles.series_totals(P.daily_panel(s, d, "2000-01-01", "2001-01-01")),
        },
        "period",
    ),
    f"""{DAY} SELECT CAST(year(ts) AS VARCHAR) AS period, series_id,
    CAST(sum(value) AS BIGINT) AS total FROM panel WHERE year(ts) IN (1999, 2000) GROUP BY 1, 2""",
)
