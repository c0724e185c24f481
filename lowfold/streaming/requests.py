"""The request rollup as a stream."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from lowfold.operators.requests import windowed_rollup

LOG_SCHEMA = (
    "ts TIMESTAMP, endpoint STRING, method STRING, status INT, latency_ms DOUBLE, bytes BIGINT, "
    "n_samples BIGINT, n_features INT, error_type STRING, critical BOOLEAN"
)


def stream_rollup(
    spark: SparkSession,
    log_path: str,
    out_path: str,
    window: str = "1 hour",
    watermark: str = "10 minutes",
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Append finished windows of a growing Parquet log to a Parquet table.

    State is one row per open window and endpoint; the watermark closes them.
    The checkpoint stands beside the output: one without the other would skip
    or repeat windows after a restart.
    """
    log = spark.readStream.schema(LOG_SCHEMA).parquet(log_path)
    rates = windowed_rollup(log, window, watermark)
    folder = checkpoint or f"{out_path.rstrip('/')}-checkpoint"
    return (
        rates.writeStream.outputMode("append")
        .format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", folder)
        .trigger(availableNow=True)
        .start()
    )
