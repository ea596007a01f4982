"""Usage and file states as streaming aggregates."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docvec.operators import usage


def usage_by_window(
    events: DataFrame, at: str = "ts", width: str = "1 hour", delay: str = "10 minutes", keys=("model",)
) -> DataFrame:
    """Usage per time window and model. On a stream, rows later than ``delay`` are dropped."""
    return (
        events.withWatermark(at, delay)
        .groupBy(F.window(at, width), *keys)
        .agg(
            F.count("*").alias("requests"),
            F.sum("total_tokens").alias("total_tokens"),
            F.avg("latency_ms").alias("latency_ms"),
        )
        .select(F.col("window.start").alias("window_start"), *keys, "requests", "total_tokens", "latency_ms")
    )


def status_by_file(log: DataFrame, **columns) -> DataFrame:
    """Latest status per file; on a stream, for output mode ``update`` or ``complete``."""
    return usage.latest_status(log, **columns)


def run_available(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is available to Parquet files and stop."""
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def run_each(
    rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update"
) -> StreamingQuery:
    """Hand each micro-batch of a changing aggregate to ``write`` and stop at the end."""
    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
