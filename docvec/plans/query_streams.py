"""Registered queries: streams run to the end of their input, and the whole flow."""

from pyarrow import fs
from pyspark.sql import functions as F

from docvec import cluster
from docvec.functions import maps
from docvec.operators import chunk, embed, store
from docvec.plans import ingest
from docvec.plans.query_accounts import TOKENS
from docvec.plans.query_chunks import WINDOWS
from docvec.plans.registry import query, table
from docvec.sources import documents, files, objects
from docvec.streaming import accounts, life
from docvec.streaming import ingest as streams


def stream_of(spark, sf, name):
    schema = table(spark, sf, name).schema
    return streams.table_stream(spark, sf, f"{name}.parquet", schema)


def kept_batches(spark, path, keys, value_columns):
    """The last written value per key of the batches below ``path``."""
    rows = spark.read.parquet(path)
    packed = rows.select(F.struct(*keys).alias("key"), *value_columns, "batch")
    last = store.latest(packed, "batch", key="key")
    return last.select("key.*", *value_columns)


def write_batch(path):
    def write(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/part={number}")

    return write


@query(
    f"""SELECT id, doc_id AS file_id,
               count(DISTINCT ('0x' || substr(md5(tok), 1, 8))::BIGINT % 64) AS positions
        FROM (SELECT id, doc_id, unnest(CASE WHEN len(ts) = 0 THEN [NULL] ELSE ts END) AS tok
              FROM (SELECT id, doc_id, regexp_extract_all(lower(content), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS ts
                    FROM ({WINDOWS.format(size=500, step=500)}))) GROUP BY ALL"""
)
def stream_ingest(spark, sf):
    """Documents as a stream of rows, chunked, embedded and stored batch by batch; run twice."""
    path = cluster.scratch_path(spark, "stream")

    def to_vectors(rows):
        docs = documents.string_docs(cluster.spread(rows.select("doc_id", "text")), "doc_id", "text")
        docs = documents.with_file_id(docs, F.col("id"))
        chunks = chunk.explode_chunks(docs, chunk.window_chunks(F.col("content"), 500))
        return chunks.withColumn("vector", embed.hash_embedder(F.col("content")))

    for _ in range(2):
        rows = stream_of(spark, sf, "documents")
        streams.ingest(rows, to_vectors, f"{path}/table", f"{path}/checkpoint", "chunk_index").awaitTermination()
    stored = store.read_table(spark, f"{path}/table")
    hits = F.size(F.filter("vector", lambda x: x > 0)).cast("bigint")
    return stored.select("id", "file_id", hits.alias("positions"))


@query(
    """SELECT event_id % (SELECT CAST(floor(avg(event_id)) AS BIGINT) + 1 FROM events) AS id, max(event_id) AS event_id
       FROM events GROUP BY 1"""
)
def stream_two_into_one(spark, sf):
    """Two streams of several micro-batches each write one table, one after the other; what the second writes replaces rows of the first."""
    path = cluster.scratch_path(spark, "two")
    events = table(spark, sf, "events").select("event_id")
    middle = events.agg(F.floor(F.avg("event_id"))).first()[0]
    for name, half in (("early", F.col("event_id") <= middle), ("late", F.col("event_id") > middle)):
        events.where(half).repartition(4).write.parquet(f"{path}/{name}")

    def to_vectors(rows):
        return rows.select(
            (F.col("event_id") % (middle + 1)).cast("string").alias("id"),
            F.array(F.col("event_id").cast("float")).alias("vector"),
            maps.from_columns({"event": F.col("event_id")}).alias("metadata"),
            F.lit("f").alias("file_id"),
            "event_id",
        )

    for name in ("early", "late"):
        files = streams.table_stream(spark, f"{path}/{name}", "*.parquet", "event_id bigint", max_files=1)
        streams.ingest(files, to_vectors, f"{path}/table", f"{path}/state-{name}", "event_id").awaitTermination()
    stored = store.read_table(spark, f"{path}/table")
    return stored.select(F.col("id").cast("bigint").alias("id"), F.col("metadata")["event"].cast("bigint").alias("event_id"))


def age(spark, folder, days):
    """Set the time of all files of a folder back."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(conf)
    for status in fs.listStatus(at):
        fs.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


@query("SELECT doc_id // 50 AS bucket, count(*) AS n FROM documents GROUP BY doc_id // 50")
def stream_old_files(spark, sf):
    """Files that arrive late and are years old are read like the others, over several micro-batches."""
    path = cluster.scratch_path(spark, "aged")
    docs = table(spark, sf, "documents").select(F.floor(F.col("doc_id") / 50).alias("bucket"), "doc_id")
    lines = F.to_json(F.struct("bucket", "doc_id")).alias("value")

    def count(batch, number):
        rows = batch.select(F.explode(F.split(F.col("content").cast("string"), "\n")).alias("line")).where("line <> ''")
        rows.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/out/part={number}")

    for turn, days in enumerate((0, 900)):
        part = docs.where(F.col("bucket") % 2 == turn).select("bucket", lines).repartition("bucket")
        part.select("value").write.mode("append").text(f"{path}/in/turn={turn}")
        age(spark, f"{path}/in/turn={turn}", days)
        files = streams.file_stream(spark, f"{path}/in", glob="*.txt", max_files=3)
        accounts.run_each(files, count, f"{path}/checkpoint", mode="append").awaitTermination()
    found = spark.read.parquet(f"{path}/out").select(F.get_json_object("line", "$.bucket").cast("bigint").alias("bucket"))
    return found.groupBy("bucket").agg(F.count("*").alias("n"))


@query(
    """SELECT date_trunc('hour', ts) AS window_start, event_type AS model, count(*) AS requests,
              SUM(length(props))::BIGINT AS total_tokens, round(avg(value), 9) AS latency_ms FROM events GROUP BY ALL"""
)
def usage_window(spark, sf):
    path = cluster.scratch_path(spark, "usage")
    events = stream_of(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("model"),
        F.length("props").alias("total_tokens"), F.col("value").alias("latency_ms"),
    )
    rows = accounts.usage_by_window(events)
    accounts.run_each(rows, write_batch(f"{path}/out"), f"{path}/checkpoint").awaitTermination()
    values = ["requests", "total_tokens", "latency_ms"]
    found = kept_batches(spark, f"{path}/out", ["window_start", "model"], values)
    return found.withColumns(
        {"window_start": F.col("window_start").cast("timestamp_ntz"), "latency_ms": F.round("latency_ms", 9)}
    )


@query(
    """SELECT date_trunc('hour', ts) AS window_start, event_type AS model, count(*) AS requests,
              SUM(length(props))::BIGINT AS total_tokens, round(avg(value), 9) AS latency_ms FROM events GROUP BY ALL"""
)
def usage_window_batches(spark, sf):
    """Six micro-batches that all hold rows of the same hours: each one adds to the state of those before."""
    path = cluster.scratch_path(spark, "usage6")
    rows = table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("model"),
        F.length("props").alias("total_tokens"), F.col("value").alias("latency_ms"),
    )
    rows.repartition(6).write.parquet(f"{path}/in")
    events = streams.table_stream(spark, f"{path}/in", "*.parquet", rows.schema, max_files=1)
    windows = accounts.usage_by_window(events, delay="400 days")
    accounts.run_each(windows, write_batch(f"{path}/out"), f"{path}/checkpoint").awaitTermination()
    found = kept_batches(spark, f"{path}/out", ["window_start", "model"], ["requests", "total_tokens", "latency_ms"])
    return found.withColumns(
        {"window_start": F.col("window_start").cast("timestamp_ntz"), "latency_ms": F.round("latency_ms", 9)}
    )


@query(
    f"""SELECT doc_id // 50 AS bucket, sum({TOKENS})::BIGINT AS tokens, round(sum({TOKENS}) * 0.00000002::DOUBLE, 10) AS cost,
               'completed' AS status
        FROM documents GROUP BY doc_id // 50"""
)
def run_usage(spark, sf):
    """What a run of the whole flow records: tokens and cost per file, and the files' states."""
    config = ingest.Config(
        "q", "texts", (ingest.Source("texts", f"{write_sources(spark, sf)}/texts", glob="*.txt"),),
        cluster.scratch_path(spark, "accounted"), model="text-embedding-3-small", user="u",
    )
    ingest.run(spark, config, batch_id="first")
    ingest.run(spark, config, batch_id="first")
    bucket = F.regexp_extract("file_id", "bucket=([0-9]+)/", 1).cast("bigint").alias("bucket")
    used = ingest.recorded_usage(spark, config).select(
        F.col("application").alias("file_id"), F.col("completion_tokens").alias("tokens"), F.round("cost", 10).alias("cost")
    )
    return used.join(ingest.recorded_states(spark, config), "file_id").select(bucket, "tokens", "cost", "status")


@query(
    """SELECT user_id AS file_id, arg_max(event_type, event_id) AS status, max(ts) AS timestamp
       FROM events GROUP BY user_id"""
)
def stream_status(spark, sf):
    path = cluster.scratch_path(spark, "status")
    log = stream_of(spark, sf, "events").select(
        F.col("user_id").alias("file_id"), F.col("event_type").alias("status"), "ts", "event_id"
    )
    rows = accounts.status_by_file(log, tie="event_id")
    accounts.run_each(rows, write_batch(f"{path}/out"), f"{path}/checkpoint").awaitTermination()
    return kept_batches(spark, f"{path}/out", ["file_id"], ["status", "timestamp"])


@query("SELECT event_id::VARCHAR AS id, ts FROM events")
def stream_once_per_id(spark, sf):
    """Every event arrives twice and is kept once."""
    path = cluster.scratch_path(spark, "once")
    rows = stream_of(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("id"), F.col("ts").cast("timestamp").alias("ts"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"),
    )
    once = streams.once_per_id(rows, "ts").drop("copy")
    accounts.run_available(once, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/out").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def write_sources(spark, sf):
    """Documents as text files of 50 each and events as JSON files of 500 each.

    Every seventh JSON file is split over two lines and so is not one JSON value.
    """
    path = cluster.scratch_path(spark, "sources")
    docs = table(spark, sf, "documents").select(
        F.floor(F.col("doc_id") / 50).alias("bucket"), "doc_id", F.col("text").alias("value")
    )
    docs.repartition("bucket").sortWithinPartitions("bucket", "doc_id").select("bucket", "value").write.partitionBy(
        "bucket"
    ).text(f"{path}/texts")
    events = table(spark, sf, "events").select(
        F.floor(F.col("event_id") / 500).alias("bucket"), "event_id", "event_type"
    )
    half = F.when(F.col("bucket") % 7 == 3, F.col("event_id") % 2).otherwise(0)
    rows = events.groupBy("bucket", half.alias("half")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind")))).alias("events")
    )
    rows.repartition("bucket").drop("half").write.partitionBy("bucket").json(f"{path}/events")
    return path


@query(
    """SELECT 'texts' AS source_name, doc_id // 50 AS bucket, 'completed' AS status, NULL::VARCHAR AS error, NULL::BIGINT AS n
       FROM documents GROUP BY doc_id // 50
       UNION ALL
       SELECT 'events', event_id // 500, CASE WHEN (event_id // 500) % 7 = 3 THEN 'failed' ELSE 'completed' END,
              CASE WHEN (event_id // 500) % 7 = 3 THEN 'not valid JSON' END,
              CASE WHEN (event_id // 500) % 7 = 3 THEN 0 ELSE 2 * count(*) END
       FROM events GROUP BY event_id // 500"""
)
def run_files(spark, sf):
    """List, load, chunk, embed and store files of two sources; report per file.

    Each event in a good JSON file has two leaves, its id and its kind.
    """
    path = write_sources(spark, sf)
    config = ingest.Config(
        "q",
        "files of two sources",
        (
            ingest.Source("texts", f"{path}/texts", glob="*.txt"),
            ingest.Source("events", f"{path}/events", glob="*.json"),
        ),
        f"{path}/table",
    )
    report = ingest.run(spark, config)
    bucket = F.regexp_extract("file_id", "bucket=([0-9]+)/", 1).cast("bigint")
    n = F.when(F.col("source_name") == "events", F.col("vectors"))
    return report.select("source_name", bucket.alias("bucket"), "status", "error", n.alias("n"))


HIDDEN = 50


def hidden_files(spark, sf, path=None, turn=None):
    """Names of customers as one file of each bucket, most of them hidden by their own or their folder's name, and empty files.

    The tasks write them, since Spark gives its files names of its own; of all files, or of those of
    even or odd buckets.
    """
    path = path or cluster.scratch_path(spark, "hidden")
    rows = table(spark, sf, "customer")
    if turn is not None:
        rows = rows.where(F.floor(F.col("c_custkey") / HIDDEN) % 2 == turn)
    # A number of its own: few bytes of names are many files, and would be put together in one task.
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("bucket", F.floor(F.col("c_custkey") / HIDDEN)).repartition(partitions, "bucket")
    rows = rows.groupBy("bucket").agg(F.array_join(F.sort_array(F.collect_list("c_name")), "\n").alias("text"))

    def write(batches):
        for batch in batches:
            for bucket, text in zip(*(batch.column(c).to_pylist() for c in ("bucket", "text")), strict=True):
                store, base = fs.FileSystem.from_uri(path)
                name = ("_x.txt", ".x.txt", "_d/x.txt", "x.txt")[bucket % 4]
                for file, content in ((name, text), (f"{'_' * (bucket % 2)}empty.txt", "")):
                    at = f"{base}/bucket={bucket}/{file}"
                    store.create_dir(at.rpartition("/")[0])
                    with store.open_output_stream(at, compression=None) as out:
                        out.write(content.encode())
            yield batch

    rows.mapInArrow(write, rows.schema).write.format("noop").mode("overwrite").save()
    return path


HIDDEN_NAME = "CASE bucket % 4 WHEN 0 THEN '_x.txt' WHEN 1 THEN '.x.txt' WHEN 2 THEN '_d/x.txt' ELSE 'x.txt' END"


@query(
    f"""WITH b AS (
            SELECT c_custkey // {HIDDEN} AS bucket, string_agg(c_name, chr(10) ORDER BY c_name) AS text FROM customer GROUP BY ALL
        )
        SELECT 'bucket=' || bucket || '/' || {HIDDEN_NAME} AS id, text AS content, (bucket % 2)::BIGINT AS turn FROM b
        UNION ALL
        SELECT 'bucket=' || bucket || CASE bucket % 2 WHEN 1 THEN '/_empty.txt' ELSE '/empty.txt' END, '', bucket % 2 FROM b"""
)
def stream_objects(spark, sf):
    """A stream over hidden, empty and late files: half of them come when two micro-batches are done, the second of them empty."""
    path = cluster.scratch_path(spark, "objects")

    def keep(batch, number):
        batch.select("id", F.col("content").cast("string").alias("content")).write.mode("overwrite").parquet(f"{path}/out/batch={number}")

    for turn in (0, 1):
        hidden_files(spark, sf, f"{path}/in", turn)
        for _ in range(2 - turn):  # a run with nothing new adds no row
            rows = streams.object_stream(spark, f"{path}/in", settle=0, empty=True)
            accounts.run_each(rows, keep, f"{path}/checkpoint", mode="append").awaitTermination()
    found = spark.read.parquet(f"{path}/out")
    return found.select("id", "content", (F.col("batch") > 0).cast("bigint").alias("turn"))


LIFE = "CASE WHEN event_type IN ('purchase', 'signup') THEN 'completed' ELSE 'processing' END"


@query(
    f"""WITH log AS (SELECT user_id::VARCHAR AS file_id, {LIFE} AS status, epoch_us(ts) // 1000 AS ms FROM events),
        newest AS (SELECT file_id, arg_max(status, (ms, status)) AS status, max(ms) AS ms FROM log GROUP BY file_id),
        due AS (SELECT *, status = 'processing' AND ms + 18000000 <= (SELECT max(ms) FROM log) - 600000 AS late FROM newest)
        SELECT file_id, CASE WHEN late THEN 'failed' ELSE status END AS status, CASE WHEN late THEN ms + 18000000 ELSE ms END AS ms,
               CASE WHEN late THEN 'no end within 300 minutes' END AS error FROM due"""
)
def stream_life(spark, sf):
    """The last state of each file, by timers on a stream in three micro-batches: what is overdue has failed."""
    path = cluster.scratch_path(spark, "life")
    completed = F.col("event_type").isin("purchase", "signup")
    log = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("file_id"), F.when(completed, "completed").otherwise("processing").alias("status"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    log.repartitionByRange(3, "timestamp").write.parquet(f"{path}/in")
    rows = streams.table_stream(spark, f"{path}/in", "*.parquet", log.schema, max_files=1)
    life.run(rows, write_batch(f"{path}/out"), f"{path}/checkpoint", delay="10 minutes", keep_minutes=1e6)
    told = spark.read.parquet(f"{path}/out")
    order = F.struct("timestamp", "batch")
    return told.groupBy("file_id").agg(*[F.max_by(c, order).alias(c) for c in ("status", "timestamp", "error")]).select(
        "file_id", "status", F.unix_millis("timestamp").alias("ms"), "error"
    )


@query(
    f"""WITH b AS (SELECT c_custkey // {HIDDEN} AS bucket, count(*) AS n FROM customer GROUP BY ALL)
        SELECT 'bucket=' || bucket || CASE bucket % 4 WHEN 0 THEN '/_x.txt' WHEN 1 THEN '/.x.txt' WHEN 2 THEN '/_d/x.txt'
               ELSE '/x.txt' END AS file_id, 'completed' AS status, n::BIGINT AS vectors FROM b
        UNION ALL
        SELECT 'bucket=' || bucket || CASE bucket % 2 WHEN 1 THEN '/_empty.txt' ELSE '/empty.txt' END, 'processing', 0 FROM b"""
)
def run_hidden(spark, sf):
    """Files with hidden names and in hidden folders go through the whole flow, a chunk per line; empty files are reported."""
    root = hidden_files(spark, sf)
    objects = files.list_full(spark, root).select("id", maps.from_columns({"chunker_name": F.lit(chunk.CUSTOM)}).alias("metadata"))
    source = ingest.Source("names", root, objects=objects)
    config = ingest.Config("q", "hidden", (source,), cluster.scratch_path(spark, "found"), chunker=str.splitlines, empty_files=True)
    return ingest.run(spark, config).select("file_id", "status", "vectors")


@query(
    f"""WITH b AS (
            SELECT c_custkey // {HIDDEN} AS bucket, sum(length(c_name) + 1)::BIGINT - 1 AS size FROM customer GROUP BY ALL
        ), f AS (
            SELECT bucket, {HIDDEN_NAME} AS name, size FROM b
            UNION ALL SELECT bucket, CASE bucket % 2 WHEN 1 THEN '_empty.txt' ELSE 'empty.txt' END, 0 FROM b
        )
        SELECT bucket::VARCHAR AS folder, name, size, k AS listing FROM f, (VALUES ('walk'), ('source')) AS v(k)"""
)
def list_hidden(spark, sf):
    """Names that begin with _ or . and files without bytes are listed like all others, in shares of folders and by the data source.

    A folder that does not exist has none.
    """
    root = hidden_files(spark, sf)
    walked = objects.walk(spark, root, budget=50, many=20, shares=4)
    walked = walked.unionByName(files.walk(spark, f"{root}/no/such/folder"))
    spark.dataSource.register(objects.Objects)
    loaded = spark.read.format(objects.FORMAT).option("many", "20").load(root)
    found = walked.withColumn("listing", F.lit("walk")).unionByName(loaded.withColumn("listing", F.lit("source")))
    key = files.object_key(F.col("path"), root)
    return found.select(
        F.regexp_extract(key, "^bucket=([0-9]+)/", 1).alias("folder"), F.regexp_extract(key, "^[^/]*/(.*)$", 1).alias("name"),
        F.col("length").alias("size"), "listing",
    )
