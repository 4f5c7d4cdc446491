"""Writers for panels, splits and result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.operators.joins import features_and_target
from wattlane.operators.sampling import sample_n
from wattlane.schema import KEYS, PART, TS
from wattlane.sources.readings import TIME_FORMAT, read_readings_csv

# Size and seed of the head files.
HEAD_ROWS = 1000
HEAD_SEED = 56


def convert_to_parquet(spark, source: str, output: str) -> DataFrame:
    """Readings file to Parquet; returns the rows and meters of the table written."""
    read_readings_csv(spark, source).write.mode("overwrite").parquet(output)
    written = spark.read.parquet(output)
    return written.agg(F.count("*").alias("rows")).withColumn(
        "clients", F.lit(len(written.columns) - 1).cast("bigint")
    )


def write_readings_csv(wide: DataFrame, path: str) -> None:
    """The inverse of the reader: unnamed time column, ``;`` and decimal commas."""
    meters = [c for c in wide.columns if c != TS]
    wide.select(
        F.date_format(TS, TIME_FORMAT).alias(" "),
        *[F.translate(F.col(m).cast("string"), ".", ",").alias(m) for m in meters],
    ).write.mode("overwrite").csv(path, sep=";", header=True)


def write_splits(df: DataFrame, path: str) -> None:
    """One Parquet directory per part, in one pass."""
    df.write.mode("overwrite").partitionBy(PART).parquet(path)


def materialize_split(df: DataFrame, name: str, description: str, path: str) -> DataFrame:
    """Compressed Parquet per split and part, and the manifest of what was written."""
    columns = [c for c in df.columns if c != PART]
    (
        df.withColumn("split", F.lit(name))
        .write.mode("overwrite")
        .option("compression", "zstd")
        .partitionBy("split", PART)
        .parquet(path)
    )
    manifest = (
        df.sparkSession.read.parquet(path)
        .groupBy("split", PART)
        .agg(F.count("*").alias("rows"))
        .withColumn("description", F.lit(description))
        .withColumn("columns", F.lit(",".join(columns)))
    )
    manifest.coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}_manifest")
    return manifest


def write_features_target(df: DataFrame, features_path: str, target_path: str) -> None:
    features, target = features_and_target(df)
    features.write.mode("overwrite").parquet(features_path)
    target.write.mode("overwrite").parquet(target_path)


def head_rows(df: DataFrame, rows: int = HEAD_ROWS, seed: int = HEAD_SEED) -> DataFrame:
    return sample_n(df, rows, seed).orderBy(*KEYS)


def write_head_csv(
    df: DataFrame, path: str, rows: int = HEAD_ROWS, seed: int = HEAD_SEED
) -> None:
    """A seeded sample of at most ``rows`` rows, in key order, as one file."""
    head_rows(df, rows, seed).coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_ranked_csv(table: DataFrame, order: list[str], path: str) -> None:
    """Comparison table in order; the range sort keeps large tables in several files."""
    table.orderBy(*order).write.mode("overwrite").csv(path, header=True)


def write_decision_json(decisions: DataFrame, path: str) -> None:
    decisions.write.mode("overwrite").json(path)


def metadata_table(
    records: DataFrame,
    features: list[str],
    metrics: list[str],
    params: list[str],
    order: str,
) -> DataFrame:
    """One row per ``run_id``, the later record winning, with JSON text columns."""
    used = {*features, *metrics, *params, order, "run_id"}
    text = [c for c in records.columns if c not in used]
    latest = records.groupBy("run_id").agg(
        F.max_by(F.struct(*[c for c in records.columns if c != "run_id"]), F.col(order)).alias("r")
    )

    def as_json(names: list[str]) -> Column:
        return F.to_json(F.struct(*[F.col(f"r.{n}").alias(n) for n in names]))

    return latest.select(
        "run_id",
        *[F.coalesce(F.col(f"r.{c}").cast("string"), F.lit("")).alias(c) for c in text],
        as_json(features).alias("feature_names_json"),
        as_json(metrics).alias("metrics_json"),
        as_json(params).alias("extra_params_json"),
    )


def write_metadata_table(table: DataFrame, path: str) -> None:
    """Full refresh of the metadata table."""
    table.write.mode("overwrite").parquet(path)


def run_report(runs: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """Long table (run_id, group, key, value) of the run, metric and parameter columns."""
    rows = [
        F.struct(
            F.lit(group).alias("group"),
            F.lit(key).alias("key"),
            F.col(key).cast("string").alias("value"),
        )
        for group, keys in groups.items()
        for key in keys
    ]
    return runs.select("run_id", F.explode(F.array(*rows)).alias("r")).select("run_id", "r.*")
