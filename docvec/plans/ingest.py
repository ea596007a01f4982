"""The whole flow: list, load, chunk, embed, store, report; and search over the result."""

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docvec.cluster import remove, scratch_path
from docvec.operators import chunk, embed, search, store, usage
from docvec.sources import documents, files

# How many hits a search returns unless told otherwise.
TOP_K = 5
FIRST = 10


@dataclass(frozen=True)
class Source:
    """A folder of files, with how they are read and, by id, the metadata a store keeps of its objects.

    An object's ``chunker_name`` and ``chunker_information`` choose the chunker of its file.
    """

    name: str
    root: str
    prefix: str = ""
    glob: str | None = None
    load: documents.Load = field(default_factory=documents.Load)
    objects: DataFrame | None = None


@dataclass(frozen=True)
class Config:
    """What to read, how to chunk and embed it, and the folder of the table.

    ``keep_content`` stores the text of chunks beside their vectors; ``replace_files`` lets a file
    that is read again replace all that is stored of it. ``model`` and ``user`` name what usage is
    recorded under; a model without a known price has usage without a cost. With ``empty_files`` a
    file without bytes has a row in the report too.
    """

    id: str
    name: str
    sources: tuple[Source, ...]
    sink: str
    embedder: Callable[[Column], Column] = field(default=embed.hash_embedder)
    chunker: Callable[[str], list[str]] | None = None
    keep_content: bool = False
    replace_files: bool = False
    model: str = "hash"
    user: str = ""
    empty_files: bool = False


def listed(spark: SparkSession, config: Config, extract_type: str = "full", last_run: datetime | None = None) -> DataFrame:
    """Listing and content of all sources' files; a delta lists only later files."""
    found = []
    for i, s in enumerate(config.sources):
        rows = files.read_content(spark, s.root, s.name, s.glob, s.prefix, config.empty_files).withColumn("source", F.lit(i))
        found.append(rows if s.objects is None else files.merge_object_metadata(rows, s.objects).select(*rows.columns))
    return files.extract(found, extract_type, last_run)


def loaded(found: DataFrame, sources: tuple[Source, ...] = ()) -> DataFrame:
    """Documents of all files by extension; a file that cannot be read gives a row with its error.

    Sources that are read alike are read together.
    """
    route = documents.route_by_extension(F.col("path"))
    keep = [c for c in ("source",) if c in found.columns]
    alike: list[tuple[documents.Load, list[int]]] = []
    for i, s in enumerate(sources):
        same = next((numbers for load, numbers in alike if load == s.load), None)
        if same is None:
            alike.append((s.load, [i]))
        else:
            same.append(i)
    if len(alike) < 2:
        return documents.auto_docs(found, by=route, strict=False, keep=keep, options=alike[0][0] if alike else None)
    parts = [documents.auto_docs(found.where(F.col("source").isin(n)), by=route, strict=False, keep=keep, options=o) for o, n in alike]
    return reduce(lambda a, b: a.unionByName(b), parts)


def vectors(
    found: DataFrame,
    embedder: Callable[[Column], Column] = embed.hash_embedder,
    sources: tuple[Source, ...] = (),
    chunker: Callable[[str], list[str]] | None = None,
) -> DataFrame:
    """Embedded chunks of all files, in one pass without a shuffle.

    A file that cannot be read, and a document that cannot be chunked, has one row with its error
    and no content. A chunk for which the embedder gave no vector has the error.
    """
    chunks = chunk.chunk_by_metadata(loaded(found, sources), chunker, strict=False)
    embedded = embed.embed(chunks, embedder(F.col("content")))
    missing = F.when(F.col("content").isNotNull() & F.col("vector").isNull(), "not embedded")
    return embedded.withColumn("error", F.coalesce("error", missing))


def to_store(embedded: DataFrame) -> DataFrame:
    return embedded.filter(F.col("error").isNull())


def run(
    spark: SparkSession,
    config: Config,
    extract_type: str = "full",
    last_run: datetime | None = None,
    batch_id: object = None,
) -> DataFrame:
    """Ingest the sources' files and report each file's state, chunks and error.

    Embedded chunks are written once and then stored and counted from there: a model may be
    slow or paid for, and must not be asked again when a later stage is repeated. A batch that
    was stored before is not read or embedded again; its report is read back. Of chunks that
    share an id the last one stays, in the order of sources, file ids and positions, and the
    report counts the rows that stay.
    """
    run_id = _folder(uuid.uuid4() if batch_id is None else batch_id)
    kept = f"{config.sink}/reports/run={run_id}"
    if batch_id is not None and store.stored_before(spark, config.sink, str(batch_id)) is not None:
        return spark.read.schema(REPORT).parquet(kept)
    found = listed(spark, config, extract_type, last_run)
    embedded = vectors(found, config.embedder, config.sources, config.chunker)
    scratch = scratch_path(spark, "embedded")
    embedded = embedded if config.keep_content else embedded.drop("content")
    embedded.write.parquet(scratch)
    embedded = spark.read.schema(embedded.schema).parquet(scratch)
    last = F.struct("source", "file_id", "position", "chunk_index")
    report(found, embedded).write.mode("overwrite").parquet(kept)
    record(spark, config, embedded, kept, run_id)
    store.store(to_store(embedded), config.sink, last, batch_id, config.replace_files)
    remove(spark, scratch)
    return spark.read.schema(REPORT).parquet(kept)


def record(spark: SparkSession, config: Config, embedded: DataFrame, report_path: str, run_id: str) -> None:
    """Write a run's usage, one event per file, and the states of its files; a repeated run writes them once."""
    asked = embedded.where(F.col("vector").isNotNull()).groupBy("source", "file_id")
    tokens = asked.agg(F.sum("total_tokens").alias("total_tokens")).withColumns(
        {"model": F.lit(config.model), "user_id": F.lit(config.user or config.id)}
    )
    events = usage.usage_events(usage.with_cost(tokens, embed.models(spark)), application=F.col("file_id"))
    events.write.mode("overwrite").parquet(f"{config.sink}/usage/run={run_id}")
    states = spark.read.schema(REPORT).parquet(report_path).select(
        "file_id", "source_name", "status", F.current_timestamp().alias("ts")
    )
    states.write.mode("overwrite").parquet(f"{config.sink}/states/run={run_id}")


def recorded_usage(spark: SparkSession, config: Config) -> DataFrame:
    """Usage events of all runs into the table; ``application`` is the file."""
    return spark.read.parquet(f"{config.sink}/usage").drop("run")


def recorded_states(spark: SparkSession, config: Config) -> DataFrame:
    """The latest state of each file over all runs into the table."""
    return usage.latest_status(spark.read.parquet(f"{config.sink}/states"))


REPORT = "file_id string, source_name string, status string, vectors bigint, error string"


def _folder(batch_id: object) -> str:
    return hashlib.sha256(str(batch_id).encode()).hexdigest()[:32]


def report(found: DataFrame, embedded: DataFrame) -> DataFrame:
    """State of each file: failed with its error, completed with its vectors, or still processing.

    A vector counts where it stays: for the last file, in the order of the run, that has its id.
    """
    file = ["source", "file_id"]
    good = embedded.where(F.col("error").isNull())
    last = good.groupBy("id").agg(F.max(F.struct("source", "file_id", "position", "chunk_index")).alias("last"))
    stays = last.select("id", "last.*", F.lit(True).alias("written"))
    per_chunk = embedded.select("id", *file, "position", "chunk_index", "error").join(
        stays, ["id", *file, "position", "chunk_index"], "left"
    )
    per_chunk = per_chunk.select(
        *file,
        F.when(F.col("error").isNull(), F.coalesce("id", F.lit(""))).alias("chunk_id"),
        F.coalesce("written", F.lit(False)).alias("written"),
        "error",
    )
    listed_files = found.select("source", F.col("id").alias("file_id"), "source_name")
    states = usage.file_states(listed_files, usage.file_report(per_chunk, file), file)
    return states.select("file_id", "source_name", "status", F.coalesce("vectors", F.lit(0)).alias("vectors"), "error")


def query_vector(spark: SparkSession, query: str, embedder: Callable[[Column], Column]) -> list[float]:
    """The vector of one query text, by the same embedder as the stored ones."""
    one = spark.createDataFrame([(query,)], "content string")
    return list(one.select(embedder(F.col("content"))).first()[0])


def search_text(
    spark: SparkSession, config: Config, query: str, top_k: int = TOP_K, filters: list[dict] | None = None
) -> DataFrame:
    """The stored chunks nearest to a query text."""
    vector = query_vector(spark, query, config.embedder)
    return search.search(store.read_table(spark, config.sink), vector, top_k, filters)


def stored_documents(spark: SparkSession, config: Config, size: int = FIRST) -> DataFrame:
    return search.first_documents(store.read_table(spark, config.sink), size)


def nearest_chunks(docs: DataFrame, queries: DataFrame, k: int = TOP_K, size: int = chunk.CHUNK_SIZE) -> DataFrame:
    """Chunk and embed documents, embed ``queries(query_id, content)``, rank chunks per query."""
    pieces = chunk.explode_chunks(docs, chunk.window_chunks(F.col("content"), size))
    stored = pieces.withColumn("vector", embed.hash_embedder(F.col("content")))
    asked = queries.withColumn("vector", embed.hash_embedder(F.col("content")))
    return search.search_batch(stored, asked, k)

