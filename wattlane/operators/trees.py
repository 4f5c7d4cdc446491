"""Tree regressors, fitted by Spark's own distributed trainers."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.session import shared_folder
from wattlane.schema import KEYS, VALUE

DEEPEST = 30  # the most levels Spark grows a tree
TASK_ROWS = 250_000  # rows of a task that trains


def _spread(rows: DataFrame) -> DataFrame:
    """At most about ``TASK_ROWS`` rows a task: the trainers cache them as objects, many times their size in a file."""
    width = -(-rows.count() // TASK_ROWS)
    if width <= rows.sparkSession.sparkContext.defaultParallelism:
        return rows
    return rows.repartition(width, *[c for c in KEYS if c in rows.columns])


def _fit(df: DataFrame, features: list[str], target: str, estimator) -> PipelineModel:
    columns = [F.col(c).cast("double").alias(c) for c in [*features, target]]
    rows = _spread(df.na.drop(subset=[*features, target])).select(*columns)
    assembler = VectorAssembler(inputCols=features, outputCol="_features")
    estimator = estimator.setFeaturesCol("_features").setLabelCol(target)
    return Pipeline(stages=[assembler, estimator.setPredictionCol("prediction")]).fit(rows)


def fit_tree(
    df: DataFrame, features: list[str], max_depth: int | None = 6, target: str = VALUE
) -> PipelineModel:
    depth = DEEPEST if max_depth is None else max_depth
    return _fit(df, features, target, DecisionTreeRegressor(maxDepth=depth, seed=0))


def fit_forest(
    df: DataFrame,
    features: list[str],
    trees: int = 40,
    max_depth: int = 10,
    min_leaf: int = 20,
    fraction: float = 0.3,
    target: str = VALUE,
) -> PipelineModel:
    return _fit(
        df,
        features,
        target,
        RandomForestRegressor(
            numTrees=trees,
            maxDepth=max_depth,
            minInstancesPerNode=min_leaf,
            subsamplingRate=fraction,
            featureSubsetStrategy="all",
            seed=42,
        ),
    )


def fit_gbt(
    df: DataFrame,
    features: list[str],
    learning_rate: float = 0.08,
    rounds: int = 150,
    max_depth: int = 5,
    max_bins: int = 256,
    target: str = VALUE,
) -> PipelineModel:
    """Boosted trees; depth 5 allows the 31 leaves and one more."""
    shared_folder(df.sparkSession)
    return _fit(
        df,
        features,
        target,
        GBTRegressor(
            stepSize=learning_rate,
            maxIter=rounds,
            maxDepth=max_depth,
            maxBins=max_bins,
            checkpointInterval=10,
            seed=42,
        ),
    )


def fit_ridge_library(
    df: DataFrame, features: list[str], alpha: float, target: str = VALUE
) -> PipelineModel:
    """Spark's linear regression with the penalty that equals ``alpha`` on summed errors."""
    sizes = df.na.drop(subset=[*features, target]).agg(
        F.count("*").alias("n"), F.stddev_pop(target).alias("s")
    ).first()
    penalty = alpha * (sizes["s"] or 0.0) / sizes["n"]
    return _fit(
        df,
        features,
        target,
        LinearRegression(
            regParam=penalty, elasticNetParam=0.0, standardization=False, solver="normal"
        ),
    )


def score(model: PipelineModel, df: DataFrame, features: list[str]) -> DataFrame:
    ready = df.na.drop(subset=features).withColumns(
        {name: F.col(name).cast("double") for name in features}
    )
    return model.transform(ready).drop("_features")
