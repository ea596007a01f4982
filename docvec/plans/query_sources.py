"""Registered queries: listings and loaders."""

from datetime import datetime

from pyspark.sql import functions as F

from docvec import cluster
from docvec.functions import maps
from docvec.functions import text as tx
from docvec.operators import admit
from docvec.plans.registry import query, table
from docvec.sources import documents, files, jsondocs, quoted, tables



BUCKET = 500


def customers_by_bucket(spark, sf, *columns):
    """Customers in key order, those of one bucket of keys in one partition."""
    rows = table(spark, sf, "customer").select("c_custkey", *columns)
    rows = rows.withColumn("bucket", F.floor(F.col("c_custkey") / BUCKET))
    return rows.repartition("bucket").sortWithinPartitions("bucket", "c_custkey")


def name_files(spark, sf):
    """Customer names as text files of one bucket each, below the shared folder."""
    path = cluster.scratch_path(spark, "names")
    customers_by_bucket(spark, sf, "c_name").select("bucket", "c_name").write.partitionBy("bucket").text(path)
    return path


FOLDER = "^bucket=([0-9]+)/"


@query(
    f"""SELECT (c_custkey // {BUCKET})::VARCHAR AS folder, 1::BIGINT AS n_files,
               SUM(length(c_name) + 1)::BIGINT AS n_bytes, 'text/plain' AS type
        FROM customer GROUP BY c_custkey // {BUCKET}"""
)
def list_full(spark, sf):
    found = files.list_full(spark, name_files(spark, sf), glob="part-*")
    folder = F.regexp_extract("id", FOLDER, 1)
    return found.groupBy(folder.alias("folder")).agg(
        F.count("*").alias("n_files"), F.sum("size").alias("n_bytes"), F.max("type").alias("type")
    )


@query(
    """SELECT (doc_id // 50)::VARCHAR || '.id' AS id,
              'id: ' || (doc_id // 50)::VARCHAR || chr(10) || 'body: [' || string_agg(text, ' ' ORDER BY doc_id) || ']' AS content
       FROM documents GROUP BY doc_id // 50"""
)
def csv_wide_cells(spark, sf):
    """Cells of the texts of fifty documents each, far longer than a CSV parser's usual limit."""
    docs = table(spark, sf, "documents", "doc_id", "text").withColumn("bucket", F.floor(F.col("doc_id") / 50))
    texts = docs.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("doc_id", "text"))).alias("texts"))
    body = F.replace(F.array_join("texts.text", " "), F.lit('"'), F.lit('""'))
    rows = texts.select(
        F.col("bucket").cast("string").alias("id"), F.lit("r.csv").alias("path"), F.lit("csv").alias("type"), maps.empty_map().alias("metadata"),
        F.concat(F.lit("id,body\n"), "bucket", F.lit(',"['), body, F.lit(']"\n')).alias("content"),
    )
    return documents.auto_docs(rows, strict=False).where("error IS NULL").select("id", "content")


@query(
    f"""SELECT (c_custkey // {BUCKET})::VARCHAR AS folder, SUM(length(c_name) + 1)::BIGINT AS file_size,
               md5(string_agg(c_name || chr(10), '' ORDER BY c_custkey)) AS file_checksum,
               'text/plain' AS file_type
        FROM customer GROUP BY c_custkey // {BUCKET}"""
)
def file_attributes(spark, sf):
    found = files.file_attributes(spark, name_files(spark, sf))
    folder = F.regexp_extract("file_name", FOLDER, 1)
    return found.select(folder.alias("folder"), "file_size", "file_checksum", "file_type")


@query(
    f"""SELECT (c_custkey // {BUCKET})::VARCHAR AS folder,
               string_agg(c_name || chr(10), '' ORDER BY c_custkey) AS content
        FROM customer GROUP BY c_custkey // {BUCKET}"""
)
def text_files(spark, sf):
    found = files.read_content(spark, name_files(spark, sf), "customers", "part-*")
    folder = F.regexp_extract("id", FOLDER, 1)
    return documents.text_docs(found).select(folder.alias("folder"), "content")


@query("SELECT page_id, url FROM pages WHERE starts_with(url, 'https://m.')")
def list_prefix(spark, sf):
    return files.with_prefix(table(spark, sf, "pages"), "https://m.", key="url").select("page_id", "url")


@query("SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'")
def list_delta(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "ts")
    return files.modified_after(rows, datetime(2024, 1, 15), "ts")


@query(
    r"""WITH p AS (SELECT page_id, regexp_replace(url, '[?#].*', '') AS bare FROM pages),
             n AS (SELECT page_id, bare || CASE page_id % 4 WHEN 0 THEN '.HTML' WHEN 1 THEN '/.profile'
                          WHEN 2 THEN '/a.tar.gz' ELSE '' END AS path FROM p)
        SELECT page_id, coalesce(nullif(lower(regexp_extract(path, '(?:^|/)\.*[^./][^/]*\.([^./]*)$', 1)), ''),
                                 'unknown') AS extension,
               replace(path, '/', '_') AS flat_name FROM n"""
)
def file_ext(spark, sf):
    bare = F.regexp_replace("url", "[?#].*", "")
    kind = F.col("page_id") % 4
    end = F.when(kind == 0, ".HTML").when(kind == 1, "/.profile").when(kind == 2, "/a.tar.gz").otherwise("")
    path = F.concat(bare, end)
    return table(spark, sf, "pages").select(
        "page_id", tx.file_extension(path).alias("extension"), tx.flat_name(path).alias("flat_name")
    )


@query(
    """SELECT 'documents' AS source_name, doc_id::VARCHAR AS id, length(text)::BIGINT AS size FROM documents
       UNION ALL
       SELECT 'conversations', conv_id || '/' || turn, length(text)::BIGINT FROM conversations"""
)
def multi_source(spark, sf):
    size = F.length("text").cast("bigint").alias("size")
    docs = table(spark, sf, "documents").select(
        F.lit("documents").alias("source_name"), F.col("doc_id").cast("string").alias("id"), size
    )
    talk = table(spark, sf, "conversations").select(
        F.lit("conversations").alias("source_name"), F.concat_ws("/", "conv_id", "turn").alias("id"), size
    )
    return files.extract([docs, talk], "full")


@query(
    """SELECT d.doc_id::VARCHAR AS id, coalesce('label-' || l.quality, d.source) AS origin,
              d.lang AS lang, l.toxic::VARCHAR AS toxic
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
)
def meta_lookup(spark, sf):
    listed = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        maps.from_columns({"origin": F.col("source"), "lang": F.col("lang")}).alias("metadata"),
    )
    objects = table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("id"),
        maps.from_columns({"origin": F.concat(F.lit("label-"), "quality"), "toxic": F.col("toxic")}).alias("metadata"),
    )
    merged = files.merge_object_metadata(listed, objects)
    return merged.select("id", *[F.col("metadata")[k].alias(k) for k in ("origin", "lang", "toxic")])


# ---------------------------------------------------------------- tables and CSV


@query(
    """SELECT '.id' AS id, 'n_nationkey: ' || n_nationkey || chr(10) || 'n_name: ' || n_name || chr(10)
              || 'n_regionkey: ' || n_regionkey AS content, n_name AS name FROM nation"""
)
def csv_docs(spark, sf):
    docs = tables.row_docs(table(spark, sf, "nation"), to_metadata=["n_name", "missing"])
    return docs.select("id", "content", F.col("metadata")["n_name"].alias("name"))


@query(
    """SELECT c_custkey || '.c_custkey' AS id,
              'c_mktsegment: ' || trim(c_mktsegment) || chr(10) || 'c_name: ' || trim(c_name) AS content,
              c_nationkey::VARCHAR AS nation, c_name AS source, 2::BIGINT AS n_keys FROM customer"""
)
def csv_selector(spark, sf):
    docs = tables.row_docs(
        table(spark, sf, "customer"),
        id_key="c_custkey",
        to_embed=["c_mktsegment", "c_name", "missing"],
        to_metadata=["c_nationkey"],
        source_column="c_name",
    )
    meta = F.col("metadata")
    return docs.select(
        "id", "content", meta["c_nationkey"].alias("nation"), meta["source"].alias("source"),
        F.size(F.map_keys(meta)).cast("bigint").alias("n_keys"),
    )


@query(
    f"""SELECT bucket, c_custkey || '.c_custkey_' || row AS id, row,
               'c_custkey: ' || c_custkey || chr(10) || 'c_name: ' || c_name || chr(10)
               || 'c_mktsegment: ' || c_mktsegment AS content
        FROM (SELECT *, c_custkey // {BUCKET} AS bucket,
                     row_number() OVER (PARTITION BY c_custkey // {BUCKET} ORDER BY c_custkey) - 1 AS row
              FROM customer)"""
)
def csv_files(spark, sf):
    path = cluster.scratch_path(spark, "customers")
    rows = customers_by_bucket(spark, sf, "c_name", "c_mktsegment")
    rows.write.partitionBy("bucket").csv(path, header=True, sep=";", quote="'")
    docs = tables.csv_docs(
        spark, path, id_key="c_custkey", unique_ids=True, sep=";", quote="'", recursiveFileLookup="true"
    )
    meta = F.col("metadata")
    return docs.select(
        F.regexp_extract(meta["source"], "bucket=([0-9]+)/", 1).cast("bigint").alias("bucket"),
        "id",
        meta["row"].cast("bigint").alias("row"),
        "content",
    )


# Bytes of texts that one task writes.
FILE_BYTES = 64_000_000


@query(
    f"""SELECT doc_id % 7 AS part, doc_id || '.doc_id' AS id,
               row_number() OVER (PARTITION BY doc_id % 7 ORDER BY doc_id) - 1 AS row,
               'doc_id: ' || doc_id || chr(10) || 'cell: "' || replace(text, ' ', chr(10)) || '", ' || source AS content
        FROM documents"""
)
def csv_quoted(spark, sf):
    """Seven folders of files whose cells hold line breaks, each file read in many splits that begin anywhere.

    A task writes files of some ``FILE_BYTES``, however long a folder is; its rows are numbered through all its files.
    """
    path = cluster.scratch_path(spark, "quoted")
    cell = F.concat(F.lit('"'), F.translate("text", " ", "\n"), F.lit('", '), "source", F.lit("\n"))
    rows = table(spark, sf, "documents", "doc_id", "text", "source").withColumn("part", F.col("doc_id") % 7)
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # Ranges of part and id go to tasks in order, and Spark numbers the files by their tasks.
    ordered = rows.repartitionByRange(max(7, -(-size // FILE_BYTES)), "part", "doc_id").sortWithinPartitions("part", "doc_id")
    ordered.select("part", "doc_id", cell.alias("cell")).write.partitionBy("part").csv(path, header=True, escape='"')
    docs = quoted.docs(quoted.read_rows(spark, path, "*.csv", split_bytes=100_000, by_folder=True), id_key="doc_id")
    meta = F.col("metadata")
    part = F.regexp_extract(meta["source"], "part=([0-9]+)/", 1).cast("bigint")
    return docs.select(part.alias("part"), "id", meta["row"].cast("bigint").alias("row"), "content")


@query(
    """WITH f AS (
            SELECT doc_id, source, CASE WHEN doc_id % 5 = 0 THEN 'csv' WHEN doc_id % 7 = 0 THEN 'metadata' ELSE 'txt' END AS ext, length(text) AS size
            FROM documents
        ), w AS (
            SELECT *, CASE WHEN ext = 'metadata' THEN 'skipped format' WHEN ext = 'csv' THEN 'format not supported' WHEN size > 3000 THEN 'too large' END AS why FROM f
        ), n AS (
            SELECT *, count(CASE WHEN why IS NULL THEN 1 END) OVER (PARTITION BY source ORDER BY doc_id::VARCHAR || '.' || ext) AS n FROM w
        )
        SELECT doc_id::VARCHAR || '.' || ext AS id, source AS source_name, CASE WHEN why IS NULL AND n > 25 THEN 'too many files' ELSE why END AS refused FROM n"""
)
def admitted_files(spark, sf):
    """Which of the documents, seen as files, a run takes: by format, size and number per source."""
    kind = F.when(F.col("doc_id") % 5 == 0, "csv").when(F.col("doc_id") % 7 == 0, "metadata").otherwise("txt")
    name = F.concat(F.col("doc_id").cast("string"), F.lit("."), kind)
    listed = table(spark, sf, "documents").select(
        name.alias("id"), name.alias("path"), F.col("source").alias("source_name"), F.length("text").alias("size")
    )
    return admit.refusal(listed, max_bytes=3000, max_files=admit.MAX_FILES).select("id", "source_name", "refused")


@query(
    """SELECT c_custkey, n_name AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey
       WHERE n_regionkey NOT IN (1, 3) OR n_nationkey % 2 = 0"""
)
def protected_rows(spark, sf):
    """Nations of two regions are protected; the user's group opens every other nation."""
    nations = table(spark, sf, "nation")
    own = F.when(F.col("n_nationkey") % 2 == 0, "users").otherwise("owners")
    protected = nations.where("n_regionkey IN (1, 3)").select(F.col("n_name").alias("index"), F.explode(F.array(own, F.lit("admins"))).alias("group"))
    rows = table(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("nation"))
    return admit.visible(rows, protected, ["users", "guests"], "nation").select("c_custkey", "nation")


# ---------------------------------------------------------------- JSON


@query("SELECT event_id, 'k' AS id, json_extract_string(props, '$.k') AS content FROM events")
def json_flatten(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "props")
    return jsondocs.json_docs(rows, "props").select("event_id", "id", "content")


def order_json(spark, sf):
    """Each order as a nested JSON object with its lines' keys on the customer's side."""
    rows = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    nested = F.struct(
        F.col("o_orderkey").alias("id"),
        F.struct(
            F.col("o_custkey").alias("id"),
            F.struct(F.col("o_orderstatus").alias("status")).alias("state"),
        ).alias("customer"),
        F.array(F.struct(F.col("o_orderpriority").alias("p")), F.struct(F.col("o_orderstatus").alias("p"))).alias("tags"),
        (F.col("o_custkey") % 2 == 0).alias("flag"),
        F.array(F.lit(1), F.lit(2)).alias("n"),
    )
    return rows.select(F.to_json(nested).alias("content"))


@query(
    """SELECT o_orderkey || '.id' AS id, o_orderkey::VARCHAR AS content FROM orders
       UNION ALL SELECT o_custkey || '.customer.id', o_custkey::VARCHAR FROM orders
       UNION ALL SELECT 'customer.state.status', o_orderstatus FROM orders
       UNION ALL SELECT 'tags.p', o_orderpriority FROM orders
       UNION ALL SELECT 'tags.p', o_orderstatus FROM orders
       UNION ALL SELECT o_orderkey || '.flag', CASE WHEN o_custkey % 2 = 0 THEN 'true' ELSE 'false' END FROM orders
       UNION ALL SELECT o_orderkey || '.n', '1' FROM orders
       UNION ALL SELECT o_orderkey || '.n', '2' FROM orders"""
)
def json_nested(spark, sf):
    return jsondocs.json_docs(order_json(spark, sf)).select("id", "content")


@query(
    """SELECT 'customer.state.status' AS id, o_orderstatus AS content, o_orderkey::VARCHAR AS id_meta,
              'file' AS origin FROM orders
       UNION ALL SELECT 'tags.p', o_orderpriority, o_orderkey::VARCHAR, 'file' FROM orders
       UNION ALL SELECT 'tags.p', o_orderstatus, o_orderkey::VARCHAR, 'file' FROM orders"""
)
def json_selector(spark, sf):
    rows = order_json(spark, sf).withColumn("metadata", maps.from_columns({"origin": F.lit("file")}))
    docs = jsondocs.json_docs(
        rows,
        to_embed=["customer", "customer.state", "customer.state.status", "tags", "tags.p", "n.x"],
        to_metadata=["id", "origin"],
    )
    meta = F.col("metadata")
    return docs.select("id", "content", meta["id"].alias("id_meta"), meta["origin"].alias("origin"))


# ---------------------------------------------------------------- text, HTML, Markdown, pages

SQUEEZE = r"""regexp_replace(regexp_replace(regexp_replace({0}, '[ \t\r\f\x0b\x{{a0}}]+', ' ', 'g'),
              ' ?\n[ \n]*', chr(10), 'g'), '^[ \n]+|[ \n]+\z', '', 'g')"""


def sql_chain(text, steps):
    for pattern, replacement in steps:
        new = "chr(10)" if replacement == "\n" else "'" + replacement.replace("$1", r"\1") + "'"
        text = f"regexp_replace({text}, '{pattern}', {new}, 'g')"
    return text


# What the pages of the tables hold, written out: their elements and their entities.
HTML_STEPS = [
    (r"(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>", ""),
    (r"(?i)</?(?:p|li|br|h1|title|article|div|footer|nav|ul)(?: [^>]*)?/?>", "\n"),
    (r"(?i)</?(?:html|head|body|meta|a|b|!doctype)(?: [^>]*)?>", ""),
]
PAGE_ENTITIES = ("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"')


def sql_entities(text):
    for entity, char in PAGE_ENTITIES:
        text = f"replace({text}, '{entity}', '{char}')"
    return f"regexp_replace({text}, '&amp(;|([^a-zA-Z0-9=;]|$))', '&\\2', 'g')"


@query(f"SELECT page_id::VARCHAR AS id, {SQUEEZE.format(sql_entities(sql_chain('html', HTML_STEPS)))} AS content FROM pages")
def html_text(spark, sf):
    rows = table(spark, sf, "pages", "page_id", "html").select(
        F.col("page_id").cast("string").alias("id"), F.col("html").alias("content"), maps.empty_map().alias("metadata")
    )
    return documents.html_docs(rows).select("id", "content")


MARKED = r"regexp_replace('# ' || regexp_replace(text, '\. ', '. **so** [on](http://x.org/) `code` ', 'g'), '\n', chr(10) || '- ', 'g')"


# The marks that the query below puts into the texts.
MARKDOWN_STEPS = [
    ("(?m)^# ", ""),
    ("(?m)^- ", ""),
    (r"\*\*so\*\*", "so"),
    (r"\[on\]\(http://x.org/\)", "on"),
    ("`code`", "code"),
]


@query(f"SELECT doc_id::VARCHAR AS id, {SQUEEZE.format(sql_chain(MARKED, MARKDOWN_STEPS))} AS content FROM documents")
def markdown_text(spark, sf):
    marked = F.regexp_replace("text", r"\. ", ". **so** [on](http://x.org/) `code` ")
    marked = F.regexp_replace(F.concat(F.lit("# "), marked), "\n", "\n- ")
    rows = documents.string_docs(
        table(spark, sf, "documents", "doc_id", "text").withColumn("text", marked), "doc_id", "text"
    )
    return documents.markdown_docs(rows).select("id", "content")


@query("SELECT doc_id::VARCHAR AS id, text AS content, lang FROM documents")
def string_docs(spark, sf):
    docs = documents.string_docs(
        table(spark, sf, "documents"), "doc_id", "text", maps.from_columns({"lang": F.col("lang")})
    )
    return docs.select("id", "content", F.col("metadata")["lang"].alias("lang"))


def mixed_files(spark, sf):
    """Documents, pages and events as files of different types."""
    none = maps.empty_map().alias("metadata")
    docs = table(spark, sf, "documents", "doc_id", "text", "lang").select(
        F.concat(F.lit("d"), "doc_id").alias("id"),
        F.concat(F.lit("d/"), "doc_id").alias("path"),
        F.when(F.col("lang") == "en", "text/plain").when(F.col("lang") == "de", "pdf").otherwise("string").alias("type"),
        none,
        F.when(F.col("lang") == "de", F.replace("text", F.lit("\n"), F.lit("\f"))).otherwise(F.col("text")).alias("content"),
    )
    pages = table(spark, sf, "pages", "page_id", "url", "html").select(
        F.concat(F.lit("p"), "page_id").alias("id"), F.col("url").alias("path"), F.lit("text/html").alias("type"),
        none, F.col("html").alias("content"),
    )
    events = table(spark, sf, "events", "event_id", "props", "event_type", "user_id").select(
        F.concat(F.lit("e"), "event_id").alias("id"),
        F.concat(F.lit("e/"), "event_id").alias("path"),
        F.when(F.col("event_id") % 2 == 0, "application/json").otherwise("text/csv").alias("type"),
        none,
        F.when(F.col("event_id") % 2 == 0, F.col("props"))
        .otherwise(F.concat(F.lit("id,kind\n"), "event_id", F.lit(","), "event_type", F.lit("\n"), "user_id", F.lit(",x\n")))
        .alias("content"),
    )
    return docs.unionByName(pages).unionByName(events)


HTML_SQL = SQUEEZE.format(sql_entities(sql_chain("html", HTML_STEPS)))


@query(
    f"""SELECT 'd' || doc_id AS id, text AS content, 'd' || doc_id AS file_id FROM documents WHERE lang <> 'de'
        UNION ALL SELECT 'd' || doc_id, unnest(string_split(text, chr(10))), 'd' || doc_id
                  FROM documents WHERE lang = 'de'
        UNION ALL SELECT 'p' || page_id, {HTML_SQL}, 'p' || page_id FROM pages
        UNION ALL SELECT 'k', json_extract_string(props, '$.k'), 'e' || event_id FROM events WHERE event_id % 2 = 0
        UNION ALL SELECT event_id || '.id', 'id: ' || event_id || chr(10) || 'kind: ' || event_type, 'e' || event_id
                  FROM events WHERE event_id % 2 = 1
        UNION ALL SELECT user_id || '.id', 'id: ' || user_id || chr(10) || 'kind: x', 'e' || event_id
                  FROM events WHERE event_id % 2 = 1"""
)
def auto_route(spark, sf):
    docs = documents.auto_docs(mixed_files(spark, sf))
    return docs.select("id", "content", F.col("metadata")[documents.FILE_KEY].alias("file_id"))


@query(
    """SELECT doc_id::VARCHAR AS id, i - 1 AS page, parts[i] AS content
       FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents) d,
            LATERAL (SELECT unnest(range(1, len(d.parts) + 1)) AS i)"""
)
def page_docs(spark, sf):
    paged = table(spark, sf, "documents").withColumn("text", F.translate("text", "\n", "\f"))
    docs = documents.page_docs(documents.string_docs(paged, "doc_id", "text"))
    return docs.select("id", F.col("metadata")["page"].cast("bigint").alias("page"), "content")


def sentences(content):
    """A caller's parser: a page per sentence, and no reading of some files."""
    text = content.decode()
    if len(text) % 11 == 0:
        raise ValueError("cannot be read")
    return text.split(". ")


@query(
    """WITH d AS (SELECT doc_id, text, length(text) % 11 = 0 AS bad FROM documents)
       SELECT doc_id::VARCHAR AS file, (i - 1)::BIGINT AS page, parts[i] AS content, false AS failed
       FROM (SELECT doc_id, string_split(text, '. ') AS parts FROM d WHERE NOT bad) p, LATERAL (SELECT unnest(range(1, len(p.parts) + 1)) AS i)
       UNION ALL SELECT doc_id::VARCHAR, NULL, NULL, true FROM d WHERE bad"""
)
def parsed_pages(spark, sf):
    """Files of a kind that only the caller's parser reads, into pages; those it fails on are named."""
    rows = table(spark, sf, "documents", "doc_id", "text").select(
        F.col("doc_id").cast("string").alias("id"), F.concat("doc_id", F.lit(".book")).alias("path"), F.lit("application/pdf").alias("type"),
        maps.empty_map().alias("metadata"), F.col("text").cast("binary").alias("content"),
    )
    found = documents.auto_docs(rows, strict=False, options=documents.Load(parsers={"book": sentences}))
    meta = F.col("metadata")
    return found.select(
        meta[documents.FILE_KEY].alias("file"), meta["page"].cast("bigint").alias("page"), "content", F.col("error").isNotNull().alias("failed")
    )


# ---------------------------------------------------------------- conversion


def converted(spark, sf):
    """Documents as files to convert: text files, good binary files, and failing ones."""
    ext = F.when(F.col("doc_id") % 3 == 0, ".TXT").when(F.col("doc_id") % 3 == 1, ".pdf").otherwise(".bad.doc")
    rows = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.lit("in/doc"), "doc_id", ext).alias("name"),
        F.encode("text", "UTF-8").alias("content"),
    )

    def convert(name, content):
        if name.endswith(".bad.doc"):
            raise ValueError("cannot read " + name)
        return content.decode("utf-8"), []

    return documents.convert_batch(rows, convert)


@query(
    """SELECT doc_id::VARCHAR AS id,
              CASE doc_id % 3 WHEN 0 THEN 'in/doc' || doc_id || '.TXT' WHEN 1 THEN 'doc' || doc_id
                   ELSE 'doc' || doc_id || '.bad' END AS filename,
              CASE WHEN doc_id % 3 < 2 THEN text END AS markdown,
              CASE WHEN doc_id % 3 = 2 THEN 'cannot read in/doc' || doc_id || '.bad.doc' END AS error,
              CASE WHEN doc_id % 3 = 2 THEN 'FAILURE' ELSE 'SUCCESS' END AS status FROM documents"""
)
def convert_batch(spark, sf):
    results = documents.conversion_status(converted(spark, sf))
    return results.select("id", "filename", "markdown", "error", "status")


@query(
    """SELECT 'SUCCESS' AS status, count(*) AS items, count(*) FILTER (doc_id % 3 = 2) AS failures
       FROM documents"""
)
def batch_status(spark, sf):
    return documents.conversion_summary(converted(spark, sf))


@query(
    """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
            k AS (SELECT doc_id, parts,
                         list_transform(parts, lambda p: CASE WHEN length(p) % 3 = 0 THEN 'table' ELSE 'picture' END)
                         AS kinds FROM l),
            c AS (SELECT *, len(list_filter(kinds, lambda x: x = 'picture')) AS n FROM k)
       SELECT doc_id::VARCHAR AS id,
              array_to_string(list_transform(range(1, len(parts) + 1), lambda i:
                CASE WHEN i = 1 THEN parts[i] WHEN i - 1 <= n THEN 'picture-' || (i - 1) || '.png' || parts[i]
                     ELSE '<!-- image -->' || parts[i] END), '') AS markdown,
              array_to_string(list_transform(range(1, len(kinds) + 1), lambda i:
                kinds[i] || '-' || len(list_filter(kinds[1:i], lambda x: x = kinds[i])) || '.png'), ' ') AS names,
              array_to_string(list_transform(parts, lambda p: base64(encode(p))), ' ') AS images
       FROM c"""
)
def image_placeholders(spark, sf):
    lines = F.split("text", "\n")
    images = F.transform(
        lines,
        lambda p: F.struct(
            F.when(F.length(p) % 3 == 0, "table").otherwise("picture").alias("type"),
            F.encode(p, "UTF-8").alias("image"),
        ),
    )
    rows = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.replace("text", F.lit("\n"), F.lit(documents.IMAGE_MARK)).alias("markdown"),
        images.alias("images"),
    )
    placed = documents.place_images(rows)
    return placed.select(
        "id",
        "markdown",
        F.array_join(F.transform("images", lambda i: i["filename"]), " ").alias("names"),
        F.array_join(F.transform("images", lambda i: i["image"]), " ").alias("images"),
    )


@query("SELECT doc_id::VARCHAR AS id, text AS content, source AS origin FROM documents")
def doc_json(spark, sf):
    docs = documents.string_docs(
        table(spark, sf, "documents"), "doc_id", "text", maps.from_columns({"origin": F.col("source")})
    )
    back = docs.select(documents.doc_from_json(documents.doc_to_json()).alias("d"))
    return back.select("d.id", "d.content", F.col("d.metadata")["origin"].alias("origin"))


@query(
    """SELECT event_id, '{"event":{"at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","user":' || user_id || '}}'
              AS json FROM events"""
)
def iso_times(spark, sf):
    nested = F.struct(F.struct(F.col("ts").alias("at"), F.col("user_id").alias("user")).alias("event"))
    return table(spark, sf, "events").select("event_id", documents.iso_json(nested).alias("json"))
