"""Scoring of request files as they arrive."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from breachline.operators.features import RequestColumns
from breachline.operators.scoring import DEFAULT_THRESHOLD, score_requests
from breachline.sources.mappings import Fitted


def score_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    fitted: Fitted,
    model: Transformer,
    lookup: DataFrame,
    cols: RequestColumns,
    threshold: float = DEFAULT_THRESHOLD,
) -> StreamingQuery:
    """Score the Parquet files of ``source`` not scored before, then stop."""
    arriving = spark.readStream.schema(schema).parquet(source)
    scored = score_requests(arriving, fitted, model, lookup, cols, threshold)
    return (
        scored.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
