"""Scoring of a request stream against the feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from wattlane.operators.linear import LinearModel
from wattlane.operators.scoring import score_requests


def score_stream(
    requests: DataFrame,
    features: DataFrame,
    model: LinearModel,
    output: str,
    checkpoint: str,
    unit: str = "minute",
) -> StreamingQuery:
    """Score all requests available now and stop; a restart goes on where it ended.

    The join is between a stream and a static table, so no state is kept.
    """
    return (
        score_requests(requests, features, model, unit)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
