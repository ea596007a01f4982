"""Rows of a table or of CSV files as documents."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docvec.cluster import written
from docvec.functions import maps
from docvec.functions import text as tx

# Defaults of the CSV loader. The byte-order mark is always dropped.
ID_KEY = "id"
ENCODING = "UTF-8"


def row_content(columns: Sequence[str], to_embed: Sequence[str] = ()) -> Column:
    """``name: value`` lines in column order, or in the order of ``to_embed``."""
    chosen = [c for c in to_embed if c in columns] if to_embed else columns
    lines = []
    for name in chosen:
        value = F.coalesce(tx.strip(F.col(f"`{name}`").cast("string")), F.lit(""))
        lines.append(F.concat(F.lit(f"{name.strip()}: "), value))
    return F.concat_ws("\n", *lines)


def row_id(columns: Sequence[str], id_key: str = ID_KEY) -> Column:
    """``<value>.<key>``; without the column the value is empty and all rows share one id."""
    value = F.col(f"`{id_key}`").cast("string") if id_key in columns else F.lit("")
    return F.concat(F.coalesce(value, F.lit("")), F.lit(f".{id_key}"))


def row_docs(
    rows: DataFrame,
    id_key: str = ID_KEY,
    to_embed: Sequence[str] = (),
    to_metadata: Sequence[str] = (),
    source_column: str | None = None,
    path: Column | None = None,
    row: Column | None = None,
    unique_ids: bool = False,
) -> DataFrame:
    """One document per row: content lines, id, chosen columns and provenance as metadata.

    ``path`` and ``row`` give provenance that is not part of the row. ``unique_ids`` appends
    the row number to the id, so that rows that share an id do not replace each other.
    """
    own = [c for c in rows.columns if not c.startswith("_docvec_")]
    entries = {c: F.col(f"`{c}`") for c in to_metadata if c in own}
    if source_column:
        entries["source"] = F.col(f"`{source_column}`")
    elif path is not None:
        entries["source"] = path
    if row is not None:
        entries["row"] = row
    doc_id = row_id(own, id_key)
    if unique_ids:
        if row is None:
            raise ValueError("unique_ids needs row numbers")
        doc_id = F.concat_ws("_", doc_id, row)
    return rows.select(
        doc_id.alias("id"),
        row_content(own, to_embed).alias("content"),
        maps.from_columns(entries).alias("metadata"),
    )


def read_rows(spark: SparkSession, paths: str | Sequence[str], encoding: str = ENCODING, **options: str) -> DataFrame:
    """CSV files with one header layout, every value a string.

    ``options`` are reader options such as ``sep``, ``quote``, ``escape`` and ``multiLine``.
    A file with another header is an error instead of being read into wrong columns.
    """
    reader = spark.read.options(header="true", inferSchema="false", enforceSchema="false")
    return reader.options(encoding=encoding, **options).csv(paths)


def plain_path(path: Column) -> Column:
    """A file's path as listings spell it; the scan's own column is percent-encoded."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def with_row_numbers(rows: DataFrame) -> DataFrame:
    """Add ``_docvec_path`` and ``_docvec_row``, the 0-based position in the row's file.

    A scan keeps the rows of one file block together and in order, so a row's position is
    its distance from the first row of its block plus the rows of the earlier blocks. A
    first pass counts the rows per block, and only that table of one row per block is
    sorted; a file is never gathered into one task. Should the second pass cut the files
    differently, some row lies outside its block and the job fails.
    """
    at = rows.select(
        "*",
        F.col("_metadata.file_path").alias("_docvec_path"),
        F.col("_metadata.file_block_start").alias("_docvec_block"),
    ).withColumn("_docvec_at", F.monotonically_increasing_id())
    block = ["_docvec_path", "_docvec_block"]
    sizes = at.groupBy(*block).agg(F.min("_docvec_at").alias("_docvec_first"), F.count("*").alias("_docvec_n"))
    earlier = W.partitionBy("_docvec_path").orderBy("_docvec_block").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_docvec_n").over(earlier), F.lit(0)).alias("_docvec_before")
    blocks = written(sizes.select("*", before), "blocks")
    distance = F.col("_docvec_at") - F.col("_docvec_first")
    inside = (distance >= 0) & (distance < F.col("_docvec_n"))
    number = F.when(inside, distance + F.col("_docvec_before")).otherwise(
        F.raise_error(F.lit("files were cut into other blocks while they were read; read them again"))
    )
    path = plain_path(F.col("_docvec_path")).alias("_docvec_path")
    return at.join(blocks, block, "left").select(*rows.columns, path, number.alias("_docvec_row"))


def csv_docs(
    spark: SparkSession,
    paths: str | Sequence[str],
    id_key: str = ID_KEY,
    to_embed: Sequence[str] = (),
    to_metadata: Sequence[str] = (),
    source_column: str | None = None,
    encoding: str = ENCODING,
    unique_ids: bool = False,
    row_numbers: bool = True,
    **options: str,
) -> DataFrame:
    """Documents of CSV files. Without row numbers no second pass over the files is needed."""
    rows = read_rows(spark, paths, encoding, **options)
    if row_numbers or unique_ids:
        rows, path = with_row_numbers(rows), F.col("_docvec_path")
        row = F.col("_docvec_row")
    else:
        path, row = plain_path(F.col("_metadata.file_path")), None
    return row_docs(rows, id_key, to_embed, to_metadata, source_column, path, row, unique_ids)
