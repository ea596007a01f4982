"""A keyed table of vectors on Parquet: upsert, delete by file, count.

A table is a folder with ``data/version=<n>`` parts and a ``log`` of committed versions. A
call to ``store`` or ``delete_file`` writes only what changes, as a version of its own; a
reader sees committed versions only and lets the newest row of an id win; ``compact`` folds
everything into one version, which ``store`` does by itself every ``FOLD_AT`` versions. All
changes since then are one scan, so the plan of a read does not grow with their number. A version
that was written but not committed is never read and is overwritten by the next attempt, so a
failed or repeated write does no harm. One writer at a time is assumed, and two that committed the
same version are an error of the next read; a table format with ``MERGE INTO`` takes ``changes``
directly.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docvec.cluster import written
from docvec.sources.documents import FILE_KEY

LOG = (
    T.StructType().add("version", "long").add("kind", "string").add("batch_id", "string").add("stored", "long")
)
# A write that finds so many versions since the last fold folds them.
FOLD_AT = 64
ROW = "id string, vector array<float>, metadata map<string,string>, file_id string, content string"


def vector_rows(chunks: DataFrame, *more: Column) -> DataFrame:
    """Embedded chunks as rows to store, with the chunk text if there is a ``content`` column.

    The file id leaves the metadata map as a column of its own, so that a delete by file
    reaches the Parquet scan.
    """
    return chunks.select(
        "id",
        "vector",
        "metadata",
        (F.col("file_id") if "file_id" in chunks.columns else F.col("metadata")[FILE_KEY]).alias("file_id"),
        (F.col("content") if "content" in chunks.columns else F.lit(None).cast("string")).alias("content"),
        *more,
    )


def latest(rows: DataFrame, order: Column | str | None = None, key: str = "id") -> DataFrame:
    """One row per key, the one with the greatest ``order``, and ``writes``, the rows it had.

    Tasks reduce their own rows first, so a key with very many rows costs little. Without an
    order any one of a key's rows is kept.
    """
    rest = F.struct(*[c for c in rows.columns if c != key])
    kept = F.max_by(rest, order) if order is not None else F.any_value(rest)
    return rows.groupBy(key).agg(kept.alias("_row"), F.count("*").alias("writes")).select(
        key, "_row.*", "writes"
    )


def upsert(base: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """``base`` with ``changes`` put in; ``changes`` has each key once."""
    kept = base.join(changes.select(key), key, "left_anti")
    return kept.unionByName(changes.select(*base.columns))


def upsert_counts(base: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """Rows written, counting repeated ids each time, and how many ids are new or replaced."""
    known = base.select(F.col(key).alias("_known"))
    per_key = changes.groupBy(key).agg(F.count("*").alias("_n"))
    both = per_key.join(known, F.col(key) == F.col("_known"), "left")
    return both.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("stored"),
        F.count_if(F.col("_known").isNull()).alias("created"),
        F.count_if(F.col("_known").isNotNull()).alias("updated"),
    )


def delete_by_file(rows: DataFrame, file_id: str, column: Column | None = None) -> DataFrame:
    """Rows of all other files; rows without a file stay."""
    own = column if column is not None else F.col("metadata")[FILE_KEY]
    return rows.filter(~own.eqNullSafe(F.lit(file_id)))


def delete_by_files(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of files that are not in ``files(file_id)``."""
    return rows.join(files.select("file_id"), "file_id", "left_anti")


def info(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("number_vectors_stored"))


# ---------------------------------------------------------------- table


def _log(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(LOG).parquet(f"{path}/log")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def committed(spark: SparkSession, path: str) -> list:
    """Versions from the last folded one on, oldest first; folding keeps them few."""
    log = _log(spark, path)
    if log is None:
        return []
    folded = log.filter(F.col("kind") == "base").agg(F.max("version")).first()[0] or 0
    found = log.filter(F.col("version") >= folded).orderBy("version").collect()
    if len({v["version"] for v in found}) < len(found):
        raise RuntimeError(f"two writers committed the same version of {path}; one of them overwrote the other's rows")
    return found


def stored_before(spark: SparkSession, path: str, batch_id: str) -> int | None:
    """Rows an earlier call stored under this batch id; null if there was none."""
    log = _log(spark, path)
    row = None if log is None else log.filter(F.col("batch_id") == batch_id).first()
    return None if row is None else row["stored"]


def _data(path: str, version: int) -> str:
    return f"{path}/data/version={version}"


def _commit(rows: DataFrame, path: str, kind: str, batch_id: str | None, log: list) -> int:
    """Write one version, then make it visible; returns the number of rows it stands for.

    A change of nothing is not recorded.
    """
    spark = rows.sparkSession
    version = log[-1]["version"] + 1 if log else 1
    rows.write.mode("overwrite").parquet(_data(path, version))
    stored = spark.read.schema("writes bigint").parquet(_data(path, version)).agg(F.sum("writes")).first()[0] or 0
    if stored == 0 and kind == "change":
        return 0
    entry = {"version": version, "kind": kind, "batch_id": batch_id, "stored": stored}
    types = {f.name: f.dataType for f in LOG.fields}
    row = spark.range(0, 1, 1, 1).select(*[F.lit(v).cast(types[k]).alias(k) for k, v in entry.items()])
    row.write.mode("append").parquet(f"{path}/log")
    return stored


def _read(spark: SparkSession, path: str, versions: list) -> DataFrame:
    """Rows of some versions, which hold each id once, with their ``_version``, in one scan."""
    schema = f"{ROW}, deleted boolean"
    rows = spark.read.schema(schema).parquet(*[_data(path, v["version"]) for v in versions])
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/data/version=([0-9]+)/[^/]*$", 1)
    return rows.withColumn("_version", number.cast("long"))


def _fold(spark: SparkSession, path: str, log: list) -> DataFrame:
    """Rows that hold after all versions of ``log``; the first of them has each id once."""
    if not log:
        return spark.createDataFrame([], ROW)
    first, *newer = log
    oldest = _read(spark, path, [first]).filter(~F.col("deleted")).drop("deleted", "_version")
    if not newer:
        return oldest
    changes = _read(spark, path, newer)
    if len(newer) > 1:
        # The newest version of an id is found on two narrow columns; whole rows are only joined to it.
        last = changes.groupBy("id").agg(F.max("_version").alias("_version"))
        changes = changes.join(last, ["id", "_version"], "left_semi")
    kept = oldest.join(changes.select("id"), "id", "left_anti")
    return kept.unionByName(changes.filter(~F.col("deleted")).select(*oldest.columns))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table as it stands; a missing table is empty."""
    return _fold(spark, path, committed(spark, path))


def store(
    vectors: DataFrame,
    path: str,
    order: Column | str | None = None,
    batch_id: object = None,
    replace_files: bool = False,
) -> int:
    """Insert or replace rows by id, the greatest ``order`` of an id last.

    Returns the rows stored, repeated ids each counted. A ``batch_id`` that was stored
    before is not stored again. With ``replace_files`` the rows are all there is of their
    files: what the table holds of these files under other ids is deleted.
    """
    spark = vectors.sparkSession
    batch = None if batch_id is None else str(batch_id)
    done = None if batch is None else stored_before(spark, path, batch)
    if done is not None:
        return done
    if order is None:
        once = latest(vector_rows(vectors))
    else:
        by = F.col(order) if isinstance(order, str) else order
        once = latest(vector_rows(vectors, by.alias("_order")), "_order").drop("_order")
    changes = once.withColumn("deleted", F.lit(False))
    log = committed(spark, path)
    if replace_files and log:
        now = written(changes, "changes")
        old = _fold(spark, path, log).join(now.select("file_id").distinct(), "file_id", "left_semi")
        changes = now.unionByName(_marks(old.join(now.select("id"), "id", "left_anti"), 0))
    stored = _commit(changes, path, "change", batch, log)
    if len(log) + 1 >= FOLD_AT:
        compact(spark, path)
    return stored


def _marks(rows: DataFrame, writes: int) -> DataFrame:
    """Rows that delete the given ones."""
    return rows.select(
        "id",
        F.lit(None).cast("array<float>").alias("vector"),
        F.lit(None).cast("map<string,string>").alias("metadata"),
        "file_id",
        F.lit(None).cast("string").alias("content"),
        F.lit(writes).cast("bigint").alias("writes"),
        F.lit(True).alias("deleted"),
    )


def delete_file(spark: SparkSession, path: str, file_id: str) -> bool:
    """Delete the vectors of one file; whether there were any."""
    log = committed(spark, path)
    gone = _fold(spark, path, log).filter(F.col("file_id") == file_id)
    return _commit(_marks(gone, 1), path, "change", None, log) > 0


def compact(spark: SparkSession, path: str) -> int:
    """Fold all versions into one, so that readers need no join."""
    log = committed(spark, path)
    rows = _fold(spark, path, log)
    whole = rows.withColumns({"deleted": F.lit(False), "writes": F.lit(1).cast("bigint")})
    return _commit(whole, path, "base", None, log)
