"""Metrics over a request-log table.

The log has ``ts, endpoint, method, status, latency_ms, bytes, n_samples,
n_features, error_type, critical`` or the part of them an operator names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def succeeded(status: Column) -> Column:
    return (status < 400).cast("int")


def request_metrics(log: DataFrame) -> DataFrame:
    """One row per request with ``latency_ms`` and ``success`` (status below 400)."""
    return log.select("endpoint", "method", "status", "latency_ms", succeeded(F.col("status")).alias("success"))


def request_failures(log: DataFrame) -> DataFrame:
    """Failed requests with ``error = 1``; they carry no latency."""
    return log.filter(F.col("status") >= 400).select("endpoint", "method", F.lit(1).alias("error"))


def input_sizes(log: DataFrame) -> DataFrame:
    kb = (F.col("bytes") / 1024).alias("file_size_kb")
    return log.select("endpoint", kb, "n_samples", "n_features")


def typed_errors(log: DataFrame) -> DataFrame:
    """Errors counted by endpoint, type and whether they were critical."""
    errors = log.filter(F.col("error_type").isNotNull())
    critical = F.coalesce("critical", F.lit(False)).alias("critical")
    return errors.groupBy("endpoint", "error_type", critical).agg(F.count("*").alias("error_count"))


def store_use(models: DataFrame, max_models: int = 100) -> DataFrame:
    """Number of stored models and the share of the store they fill."""
    count = F.count("*")
    return models.agg(count.alias("cached_models"), (count / F.lit(max_models) * 100).alias("cache_utilization_pct"))


def timed_blocks(log: DataFrame) -> DataFrame:
    """Latency from ``started`` and ``ended``, with ``success`` and ``error`` flags."""
    micros = F.unix_micros("ended") - F.unix_micros("started")
    failed = F.col("error_type").isNotNull().cast("int")
    return log.select(
        "endpoint",
        "method",
        (micros / 1000.0).alias("latency_ms"),
        (1 - failed).alias("success"),
        failed.alias("error"),
    )


def _rates() -> list[Column]:
    success = succeeded(F.col("status"))
    return [
        F.count("*").alias("requests"),
        F.avg("latency_ms").alias("avg_latency_ms"),
        F.max("latency_ms").alias("max_latency_ms"),
        F.sum("bytes").alias("bytes"),
        F.sum(1 - success).alias("errors"),
        F.avg(1 - success).alias("error_rate"),
    ]


def endpoint_rollup(log: DataFrame) -> DataFrame:
    """Latency, size and error rate by endpoint and method, by endpoint, and overall."""
    return log.rollup("endpoint", "method").agg(*_rates())


def latency_quantiles(log: DataFrame, accuracy: int | None = 10_000) -> DataFrame:
    """Median, 95th and 99th percentile of latency by endpoint, from mergeable sketches.

    Without ``accuracy`` they are exact and interpolated; a task then holds the
    distinct latencies of an endpoint.
    """
    points = [0.5, 0.95, 0.99]
    exact = F.percentile("latency_ms", points)
    q = exact if accuracy is None else F.percentile_approx("latency_ms", points, accuracy)
    found = log.groupBy("endpoint").agg(q.alias("q"))
    return found.select("endpoint", *[F.col("q")[n].alias(name) for n, name in enumerate(("p50", "p95", "p99"))])


def windowed_rollup(log: DataFrame, window: str = "1 hour", watermark: str = "10 minutes") -> DataFrame:
    """The same rates per endpoint and time window; works on a stream or a table."""
    if log.isStreaming:
        log = log.withWatermark("ts", watermark)
    rates = log.groupBy(F.window("ts", window), "endpoint").agg(*_rates())
    return rates.select(F.col("window.start").alias("window_start"), *[c for c in rates.columns if c != "window"])
