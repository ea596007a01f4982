"""Tokens, cost, quotas, file status and run reports."""

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docvec.functions import text as tx
from docvec.functions.numbers import whole_quotient

# How many of the latest requests the mean latency covers.
LATENCY_WINDOW = 5
# File states of a run.
PROCESSING, COMPLETED, FAILED = "processing", "completed", "failed"


def token_count(text: Column, tokenizer: Callable[[list[str]], list[int]] | None = None) -> Column:
    """Tokens of a text: words and punctuation marks, or by the caller's tokenizer."""
    if tokenizer is None:
        return tx.token_count(text)

    @F.arrow_udf("bigint")
    def run(batch: pa.Array) -> pa.Array:
        return pa.array(tokenizer([v or "" for v in batch.to_pylist()]), type=pa.int64())

    return run(text)


def batch_tokens(texts: DataFrame, keys: Sequence[str], content: str = "content") -> DataFrame:
    """Tokens and items per request batch."""
    return texts.groupBy(*keys).agg(
        F.sum(token_count(F.col(content))).alias("total_tokens"),
        F.count("*").alias("items"),
    )


def billed_tokens(counted: Column, reported: Column, token_calculation: bool | Column = True) -> Column:
    """Counted tokens where calculation is on, else the tokens the service reported."""
    use = token_calculation if isinstance(token_calculation, Column) else F.lit(token_calculation)
    return F.when(use, counted).otherwise(reported)


def with_cost(usage: DataFrame, known: DataFrame, tokens: str = "total_tokens") -> DataFrame:
    """Add ``cost`` and, for a model without a price, ``error``."""
    prices = known.select(F.col("model").alias("_model"), F.col("price").alias("_price"))
    rows = usage.join(prices, F.col("model") == F.col("_model"), "left")
    return rows.withColumn("cost", F.col("_price") * F.col(tokens)).withColumn(
        "error", F.when(F.col("_model").isNull(), "unknown model")
    ).drop("_model", "_price")


def usage_events(
    priced: DataFrame, user: str = "user_id", application: Column | None = None, platform: str = "docvec"
) -> DataFrame:
    """One usage row per request batch."""
    return priced.select(
        F.col(user).cast("string").alias("user_id"),
        F.col("model").alias("model_name"),
        F.lit(0).cast("bigint").alias("input_tokens"),
        F.col("total_tokens").alias("completion_tokens"),
        (application if application is not None else F.lit(None).cast("string")).alias("application"),
        F.lit(1).alias("requests"),
        "cost",
        F.uuid().alias("transaction_id"),
        F.lit(platform).alias("source_platform_application"),
    )


def usage_metrics(usage: DataFrame) -> DataFrame:
    """Tokens, items and response time per model and user."""
    return usage.groupBy("model", "user_id").agg(
        F.sum("total_tokens").alias("total_token_count"),
        F.sum("items").alias("input_item_count"),
        F.avg("response_time_ms").alias("response_time_ms"),
    )


def usage_totals(usage: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Prompt and total tokens over all batches."""
    return usage.groupBy(*keys).agg(
        F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("total_tokens").alias("total_tokens")
    )


def latency_mean(
    numbered: DataFrame, group: str, value: str, window: int = LATENCY_WINDOW, width: int = 10_000
) -> DataFrame:
    """Mean of the last ``window`` values per group.

    Rows carry ``row_number`` as given by ``embed.numbered``. A group is cut into blocks of
    ``width`` rows; each block also gets the ``window - 1`` rows before it, so blocks of one
    large group are averaged by different tasks.
    """
    block = whole_quotient(F.col("row_number") - 1, width)
    tail = (F.col("row_number") - 1) % width >= width - (window - 1)
    homes = F.when(tail, F.array(block, block + 1)).otherwise(F.array(block))
    rows = numbered.withColumn("_home", block).withColumn("_block", F.explode(homes))
    recent = W.partitionBy(group, "_block").orderBy("row_number").rowsBetween(-(window - 1), 0)
    return (
        rows.withColumn("mean_latency", F.avg(value).over(recent))
        .filter(F.col("_block") == F.col("_home"))
        .drop("_block", "_home")
    )


def file_report(results: DataFrame, keys: Sequence[str] = ("file_id",)) -> DataFrame:
    """Per file: chunks, vectors written, and its error if one was recorded."""
    return results.groupBy(*keys).agg(
        F.count("chunk_id").alias("chunks"),
        F.count_if(F.col("written")).alias("vectors"),
        F.max("error").alias("error"),
    )


def run_summary(report: DataFrame) -> DataFrame:
    """Files seen, files without an error, vectors written."""
    return report.agg(
        F.count("*").alias("files"),
        F.count_if(F.col("error").isNull()).alias("completed"),
        F.coalesce(F.sum("vectors"), F.lit(0)).alias("vectors"),
    )


def latest_status(
    log: DataFrame, file_id: str = "file_id", status: str = "status", at: str = "ts", tie: str | None = None
) -> DataFrame:
    """The last status of each file. Partial results per task keep busy files cheap."""
    order = F.struct(at, tie) if tie else F.col(at)
    return log.groupBy(file_id).agg(
        F.max_by(status, order).alias("status"), F.max(at).alias("timestamp")
    )


def file_states(files: DataFrame, report: DataFrame, keys: Sequence[str] = ("file_id",)) -> DataFrame:
    """Add the state of each listed file after a run to its row of ``file_report``.

    An error means failed, stored chunks mean completed; a file that gave no chunk is still
    processing.
    """
    state = (
        F.when(F.col("error").isNotNull(), FAILED)
        .when(F.col("chunks") > 0, COMPLETED)
        .otherwise(PROCESSING)
    )
    return files.join(report, list(keys), "left").withColumn("status", state)


def quota_ok() -> Column:
    """Whether a quota row has a hard cap and usage left."""
    return F.col("hard_cap").isNotNull() & F.coalesce(F.col("usage_available") > 0, F.lit(False))


def quota_gate(requests: DataFrame, quotas: DataFrame, key: str = "application") -> tuple[DataFrame, DataFrame]:
    """Requests whose application has usage left, and the rejected others."""
    open_ = quotas.filter(quota_ok()).select(key)
    return requests.join(open_, key, "left_semi"), requests.join(open_, key, "left_anti")
