"""The few things that depend on where the session runs."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for written tables and checkpoints.

    It is named by ``spark.checkpoint.dir``. A local session that names none gets a
    temporary folder; any other session must name one, because a folder of one machine
    is lost with that machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="docvec-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table below the shared folder, so that what made it never runs again.

    For results that are read more than once, cost much to make, or must not change between
    two readings.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing will read again."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reads no more than one row beyond."""
    return df.limit(max_rows + 1).count() <= max_rows


def spread(df: DataFrame) -> DataFrame:
    """``df`` on as many partitions as there are cores, if it has less than a quarter of them.

    A small table is often one file with one row group, which a single task would read and
    process. What is dealt out anew is at most a quarter of the cores' splits; other tables stay
    as the scan has cut them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 4 * df.rdd.getNumPartitions() < cores else df
