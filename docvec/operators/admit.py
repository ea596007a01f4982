"""Which files a run takes, and which rows a user may see."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docvec.functions import text as tx

# Defaults of the limits.
FORMATS = ("txt", "pdf", "docx", "pdf2", "pptx", "adoc", "md")
SKIPPED = ("metadata",)
MAX_BYTES = 10 * 1024 * 1024
MAX_CHARACTERS = 1_000_000
MAX_FILES = 25


def refusal(
    files: DataFrame,
    formats: Sequence[str] | None = FORMATS,
    skipped: Sequence[str] = SKIPPED,
    max_bytes: int | None = MAX_BYTES,
    max_files: int | None = None,
) -> DataFrame:
    """A listing with ``refused``: why a file is not taken, null for one that is.

    Files of a skipped or not supported format and larger ones are refused first; of the others each
    source's first ``max_files`` in the order of ids are taken. Only the last of these is looked up
    per source, so a source of any number of files is not gathered in one task.
    """
    extension = tx.file_extension(F.col("path"))
    why = F.when(extension.isin(*skipped), "skipped format") if skipped else F.lit(None).cast("string")
    if formats is not None:
        why = F.coalesce(why, F.when(~extension.isin(*formats), "format not supported"))
    if max_bytes is not None:
        why = F.coalesce(why, F.when(F.col("size") > max_bytes, "too large"))
    told = files.withColumn("refused", why)
    if max_files is None:
        return told
    order = F.struct("id", "path")
    place = W.partitionBy("source_name").orderBy(order)
    # The filter on the rank lets each task keep no more than that many rows of a source before the shuffle.
    first = told.where("refused IS NULL").select("source_name", "id", "path", F.row_number().over(place).alias("n")).where(F.col("n") <= max_files)
    last = first.groupBy("source_name").agg(F.max(order).alias("_last"), F.count("*").alias("_n"))
    over = F.col("refused").isNull() & (F.col("_n") >= max_files) & (order > F.col("_last"))
    if max_files <= 0:
        return told.withColumn("refused", F.coalesce("refused", F.lit("too many files")))
    joined = told.withColumnRenamed("source_name", "_source").join(last, F.col("_source").eqNullSafe(F.col("source_name")), "left")
    return joined.withColumn("refused", F.when(over, "too many files").otherwise(F.col("refused"))).select(
        *[F.col("_source").alias("source_name") if c == "source_name" else c for c in told.columns]
    )


def admitted(files: DataFrame, **limits) -> DataFrame:
    """The files that ``refusal`` gives no reason against."""
    return refusal(files, **limits).where("refused IS NULL").drop("refused")


def too_long(text: Column, max_characters: int = MAX_CHARACTERS) -> Column:
    """Why a parsed text is not taken, null for one that is."""
    return F.when(F.length(text) > max_characters, "too long")


def visible(rows: DataFrame, protected: DataFrame, groups: Sequence[str], index: str = "index") -> DataFrame:
    """Rows of indexes that are free, or that ``protected(index, group)`` opens to one of the user's groups."""
    opened = F.max(F.col("group").isin(*groups)) if groups else F.lit(False)
    closed = protected.groupBy("index").agg(opened.alias("_open")).where("NOT _open").select(F.col("index").alias(index))
    return rows.join(closed, index, "left_anti")
