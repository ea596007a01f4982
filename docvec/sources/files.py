"""File listings: full, by prefix, incremental, over several sources."""

import re
from collections.abc import Iterator
from datetime import datetime, timezone
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docvec.cluster import scratch_path, written
from docvec.functions import maps
from docvec.functions import text as tx
from docvec.sources import objects

# Content types by extension, for stores that report none.
CONTENT_TYPES = {
    "csv": "text/csv",
    "html": "text/html",
    "htm": "text/html",
    "json": "application/json",
    "md": "application/octet-stream",
    "pdf": "application/pdf",
    "txt": "text/plain",
    "png": "image/png",
}
DEFAULT_TYPE = "binary/octet-stream"

# The two ways to extract.
EXTRACT_TYPES = ("full", "delta")


def content_type(path: Column) -> Column:
    ext = tx.file_extension(path)
    known = F.create_map(*[F.lit(x) for pair in CONTENT_TYPES.items() for x in pair])
    return F.coalesce(known[ext], F.lit(DEFAULT_TYPE))


def object_key(path: Column, root: str) -> Column:
    """The part of ``path`` below ``root``; the scheme's number of slashes does not matter."""
    base = re.sub(r"^[a-z0-9+.-]+:/*", "", root, flags=re.I).strip("/")
    bare = F.regexp_replace(path, r"(?i)^[a-z0-9+.-]+:/*|^/+", "")
    return F.when(bare.startswith(base + "/"), F.substring(bare, len(base) + 2, 1 << 30)).otherwise(bare)


# Bytes of files that a task hands over at once, unless one file alone has more, and
# bytes of files per task where there are many.
BATCH_BYTES, TASK_BYTES = 16_000_000, 128_000_000


def walk(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root``, with hidden names and without any bytes too: ``path``, ``modificationTime``, ``length``.

    Spark's own index leaves out names that begin with ``_`` or ``.`` and empty files. Here tasks
    list the folders, see ``objects.walk``. A root that does not exist has no files. In a store that
    only Hadoop knows the driver lists the files.
    """
    found = objects.walk(spark, root)
    return _hadoop_files(spark, root) if found is None else found


def _hadoop_files(spark: SparkSession, root: str) -> DataFrame:
    """A walk by Hadoop's file system, on the driver."""
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    rows = []
    if fs.exists(at):
        found = fs.listFiles(at, True)
        while found.hasNext():
            file = found.next()
            modified = datetime.fromtimestamp(file.getModificationTime() / 1000, timezone.utc)
            rows.append((file.getPath().toString(), modified, file.getLen()))
    return spark.createDataFrame(rows, "path string, modificationTime timestamp, length bigint")


def contents(files: DataFrame, root: str, partitions: int | None = None) -> DataFrame:
    """``files`` of a walk below ``root`` with the bytes of each file, read by the tasks; a stream too.

    From a store that only Hadoop knows, the driver copies the files to the shared folder, under
    names that Spark reads; so ``files`` should be only those that Spark leaves out.
    """
    spark = files.sparkSession
    store_of = objects.Store.of(spark, root)
    if store_of is None:
        return _copied(files)

    @F.arrow_udf("binary")
    def read(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        store = store_of()
        for paths, lengths in batches:
            found, size = [], 0
            for path, length in zip(paths.to_pylist(), lengths.to_pylist(), strict=True):
                if found and size + length > BATCH_BYTES:
                    yield pa.array(found, pa.binary())
                    found, size = [], 0
                if length:
                    with store.files.open_input_stream(path[len(store.scheme) :], compression=None) as file:
                        found.append(file.read())
                else:
                    found.append(b"")
                size += length
            yield pa.array(found, pa.binary())

    # A number of its own: few bytes of names would be put together in one task.
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(partitions, "path").withColumn("content", read("path", "length"))


def _copied(files: DataFrame) -> DataFrame:
    """``files`` with their bytes, by way of copies in the shared folder."""
    spark = files.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = scratch_path(spark, "copied")
    names = []
    for i, row in enumerate(files.where("length > 0").select("path").toLocalIterator()):
        old, new = (jvm.org.apache.hadoop.fs.Path(x) for x in (row["path"], f"{at}/{i}.copy"))
        jvm.org.apache.hadoop.fs.FileUtil.copy(old.getFileSystem(conf), old, new.getFileSystem(conf), new, False, conf)
        names.append((row["path"], f"{i}.copy"))
    if not names:
        return files.withColumn("content", F.lit(b""))
    copies = _binary(spark, at).select(F.regexp_extract("path", "[^/]*$", 0).alias("copy"), "content")
    copies = spark.createDataFrame(names, "path string, copy string").join(copies, "copy").drop("copy")
    return files.join(copies, "path", "left").withColumn("content", F.coalesce("content", F.lit(b"")))


def _binary(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(root)


def listing(
    files: DataFrame, root: str, source_name: str = "default", with_content: bool = False
) -> DataFrame:
    """Rows of a ``binaryFile`` frame as a listing; without content no file is opened."""
    key = object_key(F.col("path"), root)
    modified = F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    return files.select(
        key.alias("id"),
        key.alias("name"),
        "path",
        F.col("modificationTime").alias("last_modified"),
        F.col("length").alias("size"),
        maps.from_columns({"last_modified": modified}).alias("metadata"),
        content_type(F.col("path")).alias("type"),
        F.lit(source_name).alias("source_name"),
        *(["content"] if with_content else []),
    )


def list_full(
    spark: SparkSession, root: str, prefix: str = "", source_name: str = "default", glob: str | None = None
) -> DataFrame:
    """Every file below ``root`` whose key starts with ``prefix``, hidden and empty ones too.

    The folders of the prefix become part of the path to walk, so other folders are not listed;
    a folder that does not exist gives an empty listing.
    """
    files = walk(spark, _below(root, prefix))
    if glob:
        files = files.where(named(glob))
    return with_prefix(listing(files, root, source_name), prefix)


def named(glob: str) -> Column:
    """Whether the file's name fits ``glob``."""
    return F.regexp_extract("path", "[^/]*$", 0).rlike(_glob_pattern(glob))


def _glob_pattern(glob: str) -> str:
    """A glob of file names, as Hadoop reads it, as a regular expression: ``*``, ``?``, ``{a,b}``, ``[a-z]``, ``[!a]``, ``\\``."""
    found, braces, in_set, at = [], 0, False, 0
    while at < len(glob):
        c = glob[at]
        if c == "\\":
            at += 1
            if at == len(glob):
                raise ValueError(f"glob {glob!r} ends with a backslash")
            found.append(re.escape(glob[at]))
        elif in_set:
            if c == "[":
                raise ValueError(f"glob {glob!r} has an unclosed [")
            in_set = c != "]"
            found.append("^" if c in "!^" and glob[at - 1] == "[" else "\\&" if c == "&" else c)
        elif c == "[":
            in_set = True
            found.append(c)
        elif c == "{":
            braces += 1
            found.append("(?:")
        elif c in ",}" and braces:
            braces -= c == "}"
            found.append("|" if c == "," else ")")
        else:
            found.append({"*": ".*", "?": "."}.get(c) or re.escape(c))
        at += 1
    if braces or in_set:
        raise ValueError(f"glob {glob!r} has an unclosed {'[' if in_set else '{'}")
    return rf"\A{''.join(found)}\z"


def _existing(spark: SparkSession, root: str, glob: str | None) -> DataFrame:
    """Files with content by Spark's reader; none where the folder does not exist."""
    try:
        return _binary(spark, root, glob)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], "path string, modificationTime timestamp, length bigint, content binary")
        raise


def _below(root: str, prefix: str | None) -> str:
    folder = (prefix or "").rpartition("/")[0]
    return f"{root.rstrip('/')}/{folder}" if folder else root


def list_delta(
    spark: SparkSession,
    root: str,
    last_run: datetime | None,
    prefix: str = "",
    source_name: str = "default",
) -> DataFrame:
    """Files modified strictly later than ``last_run``; without one, every file."""
    return modified_after(list_full(spark, root, prefix, source_name), last_run)


def with_prefix(files: DataFrame, prefix: str | None, key: str = "id") -> DataFrame:
    return files.filter(F.col(key).startswith(prefix)) if prefix else files


def modified_after(files: DataFrame, last_run: datetime | None, column: str = "last_modified") -> DataFrame:
    return files if last_run is None else files.filter(F.col(column) > F.lit(last_run))


def merge_object_metadata(files: DataFrame, objects: DataFrame) -> DataFrame:
    """Add user metadata from ``objects(id, metadata)``; it wins over listed metadata."""
    extra = objects.select("id", F.col("metadata").alias("_extra"))
    merged = maps.merge(F.col("metadata"), F.col("_extra"))
    return files.join(extra, "id", "left").withColumn("metadata", merged).drop("_extra")


def file_attributes(spark: SparkSession, root: str, key: str | None = None) -> DataFrame:
    """Name, size, checksum and content type of each file, or of the one file ``key``.

    Files with hidden names and without bytes are left out, as Spark's reader has it.
    """
    files = _binary(spark, f"{root.rstrip('/')}/{key}" if key else root)
    return files.select(
        object_key(F.col("path"), root).alias("file_name"),
        F.col("length").alias("file_size"),
        F.md5("content").alias("file_checksum"),
        content_type(F.col("path")).alias("file_type"),
    )


def read_content(
    spark: SparkSession,
    root: str,
    source_name: str = "default",
    glob: str | None = None,
    prefix: str = "",
    empty: bool = False,
) -> DataFrame:
    """Listing plus the file bytes, which the executors read; with ``empty``, files without bytes too.

    One walk lists, and its tasks' files are read by tasks. In a store that only Hadoop knows,
    Spark's reader takes the files that its index has, and ``contents`` the others.
    """
    below = _below(root, prefix)
    files = walk(spark, below)
    if not empty:
        files = files.where("length > 0")
    if glob:
        files = files.where(named(glob))
    if objects.Store.of(spark, below) is None:
        key = object_key(F.col("path"), root)
        seen = _existing(spark, below, glob)
        left_out = written(files.withColumn("key", key).join(seen.select(key.alias("key")), "key", "left_anti").drop("key"), "left-out")
        files = seen.unionByName(contents(left_out, below))
    else:
        files = with_prefix(files.withColumn("key", object_key(F.col("path"), root)), prefix, "key").drop("key")
        size = files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
        files = contents(files, below, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES)))
    return with_prefix(listing(files, root, source_name, with_content=True), prefix)


def extract(
    listings: list[DataFrame], extract_type: str, last_run: datetime | None = None
) -> DataFrame:
    """All sources' files, full or incremental."""
    if extract_type not in EXTRACT_TYPES:
        raise ValueError(f"extract_type must be one of {EXTRACT_TYPES}, got {extract_type!r}")
    files = reduce(lambda a, b: a.unionByName(b), listings)
    return files if extract_type == "full" else modified_after(files, last_run)
