"""Model versions, runs and alias events derived from persistence forecasts.

Each series is a model with one version per lag, judged by its errors in a validation and a
test year.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.operators.features import persistence_errors
from wattlane.plans import panels as P
from wattlane.plans.oracle import P_DAY, lag_sql, r
from wattlane.schema import SERIES, TS
from wattlane.session import materialize

LAGS = {"1": 1, "2": 7, "3": 30, "4": 365}


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per series and lag."""
    panel = P.daily_panel(spark, sf_dir).withColumn("year", F.year(TS))
    by_year = persistence_errors(panel, LAGS, "2000-01-01", "2002-01-01", [SERIES, "year"])
    years = {"validation": 2000, "test": 2001}
    metrics = [
        F.max(F.when(F.col("year") == year, F.round(metric, 6))).alias(f"{name}_{metric}")
        for name, year in years.items()
        for metric in ("rmse", "mae")
    ]
    both = by_year.groupBy(
        SERIES, F.col("baseline").alias("version"), F.col("lag_steps").alias("start_time")
    ).agg(*metrics)
    number = F.col(SERIES).cast("string")
    table = both.na.drop(subset=["validation_rmse", "test_rmse"]).select(
        F.concat(F.lit("run_"), number, F.lit("_"), "version").alias("run_id"),
        F.concat(F.lit("supplier_"), number).alias("model_name"),
        "version",
        SERIES,
        "start_time",
        "validation_rmse",
        "validation_mae",
        "test_rmse",
        "test_mae",
        F.md5((F.col(SERIES) % 7).cast("string")).alias("train_digest"),
        F.when(F.col(SERIES) % 11 != 0, F.md5((F.col(SERIES) % 5).cast("string"))).alias(
            "validation_digest"
        ),
    )
    return materialize(table, "runs")


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions with the tags a validation against the first version gives them."""
    table = runs(spark, sf_dir)
    first = table.where("version = '1'").select(
        "model_name",
        F.col("validation_rmse").alias("_rmse"),
        F.col("validation_mae").alias("_mae"),
        F.col("test_rmse").alias("_test"),
    )

    def flag(condition: Column, yes: str, no: str) -> Column:
        return F.when(condition, yes).otherwise(no)

    tags = F.map_filter(
        F.create_map(
            F.lit("validated"),
            flag(F.col("validation_rmse") <= 1.01 * F.col("_rmse"), "TRUE", " false "),
            F.lit("passed_validation"),
            F.when(
                F.col(SERIES) % 3 != 0,
                flag(F.col("validation_mae") <= 1.01 * F.col("_mae"), "true", "False"),
            ),
            F.lit("validation_status"),
            flag(F.col("test_rmse") < F.col("_test"), "Passed", "pending"),
        ),
        lambda _, value: value.isNotNull(),
    )
    return table.join(first, "model_name").select(
        "model_name",
        "version",
        F.col("validation_rmse").alias("rmse"),
        F.col("validation_mae").alias("mae"),
        tags.alias("tags"),
    )


# Alias writes of each model: alias, version, order; the last two for even series only.
EVENTS = [
    ("champion", "4", 1), ("challenger", "2", 2), ("champion", "2", 3), ("champion", "4", 4),
    ("champion", "3", 5), ("challenger", "1", 6),
]


def alias_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = P.daily_facts(spark, sf_dir).select(SERIES).distinct()
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("alias"), F.lit(v).alias("version"), F.lit(q).alias("seq"))
            for a, v, q in EVENTS
        ]
    )
    return (
        models.select(SERIES, F.explode(rows).alias("e"))
        .select(SERIES, "e.*")
        .where((F.col("seq") <= 4) | (F.col(SERIES) % 2 == 0))
        .select(
            F.concat(F.lit("supplier_"), F.col(SERIES).cast("string")).alias("model_name"),
            "alias",
            "version",
            F.col("seq").cast("bigint").alias("seq"),
        )
    )


def tag_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag writes per version: every metric, then a status that is written twice."""
    table = runs(spark, sf_dir)
    writes = [
        ("status", F.lit("new")),
        ("train_digest", F.col("train_digest")),
        ("status", F.lit("scored")),
        ("validation_digest", F.col("validation_digest")),
    ]
    rows = F.array(
        *[
            F.struct(F.lit(key).alias("key"), value.alias("value"), F.lit(i).alias("seq"))
            for i, (key, value) in enumerate(writes)
        ]
    )
    return table.select("model_name", "version", F.explode(rows).alias("e")).select(
        "model_name", "version", "e.*"
    )


def _errors_sql(year: int, name: str) -> str:
    bodies = [
        f"SELECT series_id, '{v}' AS version, CAST({k} AS BIGINT) AS start_time,"
        f" {r('sqrt(avg(e * e))')} AS {name}_rmse, {r('avg(abs(e))')} AS {name}_mae FROM"
        f" (SELECT series_id, ts, CAST(value - {lag_sql(k)} AS DOUBLE) AS e FROM panel)"
        f" WHERE year(ts) = {year} AND e IS NOT NULL GROUP BY 1"
        for v, k in LAGS.items()
    ]
    return " UNION ALL ".join(bodies)


RUNS_SQL = f"""{P_DAY},
runs AS MATERIALIZED (
  SELECT 'run_' || v.series_id || '_' || v.version AS run_id,
    'supplier_' || v.series_id AS model_name, v.version, v.series_id, v.start_time,
    validation_rmse, validation_mae, test_rmse, test_mae,
    md5(CAST(v.series_id % 7 AS VARCHAR)) AS train_digest,
    CASE WHEN v.series_id % 11 <> 0 THEN md5(CAST(v.series_id % 5 AS VARCHAR)) END
      AS validation_digest
  FROM ({_errors_sql(2000, 'validation')}) v JOIN ({_errors_sql(2001, 'test')}) t
    ON v.series_id = t.series_id AND v.version = t.version)"""

VERSIONS_SQL = f"""{RUNS_SQL},
versions AS MATERIALIZED (
  SELECT *, validated AND passed OR status AS ok FROM (
    SELECT r.model_name, r.version, r.validation_rmse AS rmse, r.validation_mae AS mae, r.series_id,
      r.validation_rmse <= 1.01 * f.validation_rmse AS validated,
      r.series_id % 3 <> 0 AND r.validation_mae <= 1.01 * f.validation_mae AS passed,
      r.test_rmse < f.test_rmse AS status
    FROM runs r JOIN runs f ON r.model_name = f.model_name AND f.version = '1'))"""

EVENTS_SQL = f"""events_log AS (
  SELECT 'supplier_' || series_id AS model_name, alias, version, CAST(seq AS BIGINT) AS seq
  FROM (SELECT DISTINCT l_suppkey AS series_id FROM lineitem),
    (VALUES {', '.join(str(e) for e in EVENTS)}) e(alias, version, seq)
  WHERE seq <= 4 OR series_id % 2 = 0),
aliases AS (SELECT model_name, alias, arg_max(version, seq) AS version FROM events_log GROUP BY 1, 2)"""
