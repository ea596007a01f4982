"""Whole files as documents: text, HTML, Markdown, pages; routing by type; batch conversion."""

import csv
import io
import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvec.functions import maps
from docvec.functions import text as tx
from docvec.sources import jsondocs

DOC = "id string, content string, metadata map<string,string>"
# The file id under which a document's vectors can be deleted.
FILE_KEY = "_file_entry_id"
# A type that contains the left text takes the right route; the first match counts.
ROUTES = (
    ("csv", "csv"),
    ("string", "text"),
    ("application/octet-stream", "markdown"),
    ("html", "html"),
    ("pdf", "pages"),
    ("json", "json"),
)
GENERIC = "generic"
PARSED = "parsed"
# Metadata that chooses a file's chunker.
CHUNKER_KEYS = ("chunker_name", "chunker_information")
# Loader names a file may ask for, and the extensions that lead to a route.
EXTENSION_ROUTES = {"csv": "csv", "html": "html", "htm": "html", "md": "markdown", "pdf": "pages", "json": "json"}
# The marker of an image in converted Markdown.
IMAGE_MARK = "<!-- image -->"


def string_docs(rows: DataFrame, id: str, text: str, metadata: Column | None = None) -> DataFrame:
    """In-memory texts as documents."""
    return rows.select(
        F.col(id).cast("string").alias("id"),
        F.col(text).alias("content"),
        (metadata if metadata is not None else maps.empty_map()).alias("metadata"),
    )


def text_docs(files: DataFrame) -> DataFrame:
    """Files of plain text as documents; bytes that are no UTF-8 are an error."""
    return _content(files, tx.decode_utf8(F.col("content")))


def html_docs(files: DataFrame) -> DataFrame:
    return _content(files, tx.html_to_text(_as_text(files)))


def markdown_docs(files: DataFrame) -> DataFrame:
    return _content(files, tx.markdown_to_text(_as_text(files)))


def _as_text(files: DataFrame) -> Column:
    binary = dict(files.dtypes)["content"] == "binary"
    return tx.decode_utf8(F.col("content")) if binary else F.col("content")


def _content(files: DataFrame, content: Column) -> DataFrame:
    return files.select("id", content.alias("content"), maps.or_empty(F.col("metadata")).alias("metadata"))


def with_file_id(docs: DataFrame, file_id: Column) -> DataFrame:
    """Record the file a document comes from, so that its vectors can be deleted by file."""
    entry = maps.from_columns({FILE_KEY: file_id})
    return docs.withColumn("metadata", maps.merge(F.col("metadata"), entry))


def page_docs(
    files: DataFrame, pages: Callable[[bytes], list[str]] | None = None, unique_ids: bool = False
) -> DataFrame:
    """One document per page, all under the file's id.

    ``pages`` turns the bytes of one file into page texts; a PDF parser goes here. Without it
    the content is text and a form feed ends a page.
    """
    if pages is None:
        texts = F.split(_as_text(files), "\f")
    else:
        texts = F.transform(page_leaves(F.col("content"), pages)["docs"], lambda leaf: leaf["content"])
    rows = files.select("id", "metadata", F.posexplode(texts).alias("_page", "content"))
    doc_id = F.concat_ws("_", "id", "_page") if unique_ids else F.col("id")
    entry = maps.from_columns({"page": F.col("_page")})
    return rows.select(
        doc_id.alias("id"), "content", maps.merge(F.col("metadata"), entry).alias("metadata")
    )


# ---------------------------------------------------------------- routing


def route(file_type: Column) -> Column:
    """The loader for a file's type."""
    chosen = F.lit(GENERIC)
    for part, name in reversed(ROUTES):
        chosen = F.when(F.contains(file_type, F.lit(part)), name).otherwise(chosen)
    return chosen


def route_by_extension(path: Column) -> Column:
    """The loader for a path; anything unknown is generic text."""
    table = F.create_map(*[F.lit(x) for pair in EXTENSION_ROUTES.items() for x in pair])
    return F.coalesce(table[tx.file_extension(path)], F.lit(GENERIC))


@dataclass(frozen=True)
class Load:
    """How files are read. Fields of CSV rows and JSON values are chosen by ``to_embed`` and
    ``to_metadata``, their ids by ``id_key``; a CSV row's ``source`` may come from a column.
    ``parsers`` turn the bytes of files into page texts, by extension, whatever the file's type.
    """

    id_key: str = "id"
    to_embed: tuple[str, ...] = ()
    to_metadata: tuple[str, ...] = ()
    source_column: str | None = None
    delimiter: str = ","
    quote: str = '"'
    encoding: str = "UTF-8"
    parsers: Mapping[str, Callable[[bytes], list[str]]] = field(default_factory=dict)
    unique_ids: bool = False


def csv_leaves(text: Column, id_key: str = "id", strict: bool = True, options: "Load | None" = None) -> Column:
    """Rows of a CSV text with its own header, in the shape of ``jsondocs.json_leaves``.

    For files with many different headers; files that share one are better read by
    ``tables.csv_docs``, which splits large files.
    """
    return jsondocs.leaf_reader(csv_parser(options or Load(id_key=id_key)), strict, lambda t: "not valid CSV")(text)


def csv_parser(chosen: Load) -> Callable[[str], Iterator[jsondocs.Leaf]]:
    """What makes the rows of a CSV text."""

    def rows(text: str) -> Iterator[jsondocs.Leaf]:
        csv.field_size_limit(sys.maxsize)  # the parser's own limit is 131,072 characters a cell
        reader = csv.DictReader(io.StringIO(text, newline=""), delimiter=chosen.delimiter, quotechar=chosen.quote)
        for i, row in enumerate(reader):
            named = {k: (v or "").strip() for k, v in row.items() if k is not None}
            shown = [k for k in chosen.to_embed if k in named] if chosen.to_embed else named
            content = "\n".join(f"{k.strip()}: {named[k]}" for k in shown)
            metadata = {k: named[k] for k in chosen.to_metadata if k in named} | {"row": str(i)}
            if chosen.source_column:
                metadata["source"] = named.get(chosen.source_column, "")
            yield f"{row.get(chosen.id_key) or ''}.{chosen.id_key}", content, metadata

    return rows


def page_leaves(content: Column, pages: Callable[[bytes], list[str]], strict: bool = True) -> Column:
    """Pages of a file by the caller's parser, in the shape of ``jsondocs.json_leaves``."""

    def numbered(content: bytes) -> Iterator[jsondocs.Leaf]:
        for i, page in enumerate(pages(content)):
            yield "", page, {"page": str(i)}

    return jsondocs.leaf_reader(numbered, strict, lambda c: "not valid pages")(content)


def parsed_leaves(
    content: Column, extension: Column, parsers: Mapping[str, Callable[[bytes], list[str]]], strict: bool = True
) -> Column:
    """Pages of files by the parser of their extension, in the shape of ``jsondocs.json_leaves``."""

    def numbered(content: bytes, extension: str) -> Iterator[jsondocs.Leaf]:
        for i, page in enumerate(parsers[extension](content)):
            yield "", page, {"page": str(i)}

    return jsondocs.leaf_reader(numbered, strict, lambda c, e: "not valid pages")(content, extension)


def auto_docs(
    files: DataFrame,
    by: Column | None = None,
    pages: Callable[[bytes], list[str]] | None = None,
    unique_ids: bool = False,
    strict: bool = True,
    keep: Sequence[str] = (),
    options: Load | None = None,
) -> DataFrame:
    """Load each file by its route, in one pass over the files.

    ``files`` has id, path, type, metadata and content. Every route gives an array of
    documents; a Python worker sees only the content of the routes that need it. Each
    document carries its file's id under ``_file_entry_id``, its position in the file, and
    the file's columns named by ``keep``. If not strict, a file that cannot be read gives one
    row without content that names the ``error``. ``options`` sets how files are read.
    """
    options = options or Load(unique_ids=unique_ids)
    unique_ids = unique_ids or options.unique_ids
    chosen = by if by is not None else route(F.col("type"))
    extension = tx.file_extension(F.col("path"))
    if options.parsers:
        chosen = F.when(extension.isin(*options.parsers), PARSED).otherwise(chosen)
    routed = files.withColumn("_route", chosen)
    binary = dict(files.dtypes)["content"] == "binary"

    def content_of(*routes: str) -> Column:
        return F.when(F.col("_route").isin(*routes), F.col("content"))

    def text_of(*routes: str) -> Column:
        """Content as text on the given routes, null elsewhere."""
        if not binary:
            return content_of(*routes)
        if options.encoding.upper() not in ("UTF-8", "UTF8"):
            return F.decode(content_of(*routes), options.encoding)
        if strict:
            return tx.decode_utf8(content_of(*routes))
        return F.regexp_replace(F.try_validate_utf8(content_of(*routes).cast("string")), r"^\x{FEFF}", "")

    def leaf(text: Column, metadata: Column) -> Column:
        return F.struct(F.lit("").alias("id"), text.alias("content"), metadata.alias("metadata"))

    def checked(docs: Column, text: Column) -> Column:
        bad = text.isNull() & F.col("content").isNotNull()
        return F.struct(F.when(text.isNotNull(), docs).alias("docs"), F.when(bad, "not valid UTF-8").alias("error"))

    # A column of its own: expressions below use the text more than once.
    routed = routed.withColumn(
        "_text",
        F.when(F.col("_route") == "markdown", tx.markdown_to_text(text_of("markdown")))
        .when(F.col("_route") == "html", tx.html_to_text(text_of("html")))
        .otherwise(text_of("text", "pages", GENERIC)),
    )
    text = F.col("_text")
    if pages is not None:
        paged = page_leaves(content_of("pages"), pages, strict)
    else:
        numbered = lambda p, i: leaf(p, maps.from_columns({"page": i}))
        paged = checked(F.transform(F.split(text, "\f"), numbered), text)
    # One function for both kinds: each function that takes batches one by one has workers of its own.
    parsers = {"csv": csv_parser(options), "json": jsondocs.json_parser(options.id_key, options.to_embed, options.to_metadata)}
    leaves = jsondocs.leaf_reader(lambda t, kind: parsers[kind](t), strict, lambda t, kind: f"not valid {kind.upper()}")
    loaded = (
        F.when(F.col("_route").isin("csv", "json"), leaves(text_of("csv", "json"), F.col("_route")))
        .when(F.col("_route") == "pages", paged)
        .otherwise(checked(F.array(leaf(text, maps.empty_map())), text))
    )
    if options.parsers:
        parsed = parsed_leaves(content_of(PARSED), extension, options.parsers, strict)
        loaded = F.when(F.col("_route") == PARSED, parsed).otherwise(loaded)
    # CSV rows record their source instead of the file's metadata, but keep the file's chunker.
    chunker = maps.pick(maps.or_empty(F.col("metadata")), list(CHUNKER_KEYS))
    source = maps.empty_map() if options.source_column else maps.from_columns({"source": F.col("path")})
    outer = F.when(F.col("_route") == "csv", maps.merge(chunker, source)).otherwise(maps.or_empty(F.col("metadata")))
    # What belongs to the file is made once per file, and the array of its documents does not go on beside them: it
    # would be copied to the row of each.
    given = ["_file", "_route", "_outer", *keep]
    rows = routed.select(F.col("id").alias("_file"), "_route", outer.alias("_outer"), loaded.alias("_loaded"), *keep)
    entry = maps.merge(F.col("_outer"), maps.from_columns({FILE_KEY: F.col("_file")}))
    rows = rows.select(
        "_file", "_route", entry.alias("_outer"), *keep, F.col("_loaded.error").alias("error"), F.col("_loaded.docs").alias("_docs")
    ).select(*given, "error", F.posexplode_outer("_docs").alias("_at", "_doc"))
    rows = rows.filter(F.col("_doc").isNotNull() | F.col("error").isNotNull())
    # Pages and whole files go under the file's id; leaves and rows have their own.
    own = F.when(F.col("_route").isin("csv", "json"), F.col("_doc.id")).otherwise(F.col("_file"))
    doc_id = F.concat_ws("_", own, "_at") if unique_ids else own
    return rows.select(
        doc_id.alias("id"),
        F.col("_doc.content").alias("content"),
        maps.merge(F.col("_doc.metadata"), F.col("_outer")).alias("metadata"),
        F.col("_file").alias("file_id"),
        F.col("_at").alias("position"),
        *keep,
        *([] if strict else ["error"]),
    )


# ---------------------------------------------------------------- conversion


def convert_batch(
    files: DataFrame, convert: Callable[[str, bytes], tuple[str, list[tuple[str, bytes]]]]
) -> DataFrame:
    """Convert files to Markdown and images; a failing file gets an error, the rest go on.

    ``convert(name, content)`` returns Markdown and (type, bytes) images; type is ``table``
    or ``picture``. A ``.txt`` file is its own Markdown and needs no converter. The file
    name of a converted file loses its extension.
    """
    cells = pa.list_(pa.struct([("type", pa.string()), ("image", pa.binary())]))
    out = pa.struct([("markdown", pa.string()), ("images", cells), ("error", pa.string())])

    @F.arrow_udf("struct<markdown:string,images:array<struct<type:string,image:binary>>,error:string>")
    def run(name: pa.Array, content: pa.Array) -> pa.Array:
        rows = []
        for n, c in zip(name.to_pylist(), content.to_pylist()):
            try:
                markdown, images = (None, []) if c is None else convert(n, c)
                rows.append({"markdown": markdown, "images": [{"type": t, "image": b} for t, b in images], "error": None})
            except Exception as failure:
                rows.append({"markdown": None, "images": None, "error": str(failure) or type(failure).__name__})
        return pa.array(rows, type=out)

    plain = F.lower(F.col("name")).endswith(".txt")
    done = files.withColumn("_plain", plain).withColumn(
        "_done", run(F.col("name"), F.when(~F.col("_plain"), F.col("content")))
    )
    decoded = F.try_validate_utf8(F.col("content").cast("string"))
    rows = done.select(
        "id",
        F.when(F.col("_plain"), F.col("name")).otherwise(tx.file_stem(F.col("name"))).alias("filename"),
        F.when(F.col("_plain"), decoded).otherwise(F.col("_done.markdown")).alias("markdown"),
        F.when(~F.col("_plain"), F.col("_done.images")).alias("images"),
        F.when(F.col("_plain"), F.when(decoded.isNull(), F.lit("not valid UTF-8")))
        .otherwise(F.col("_done.error"))
        .alias("error"),
    )
    return place_images(rows)


def one_line_base64(content: Column) -> Column:
    """Base64 text without the line breaks some session settings put in."""
    return F.replace(F.base64(content), F.lit("\r\n"), F.lit(""))


def place_images(docs: DataFrame) -> DataFrame:
    """Name images and put picture names into the Markdown.

    Tables and pictures count separately, ``table-n.png`` and ``picture-n.png``. The k-th
    marker becomes the k-th picture's name while pictures last; tables take no marker.
    ``images`` is an array of (type, image bytes); the bytes come out as base64 text.
    """
    images = F.coalesce(F.col("images"), F.expr("cast(array() as array<struct<type:string,image:binary>>)"))
    kinds = F.transform(images, lambda x: F.when(x["type"] == "table", "table").otherwise("picture"))
    start = F.struct(F.lit(0).alias("t"), F.lit(0).alias("p"), F.expr("cast(array() as array<string>)").alias("names"))

    def step(acc: Column, kind: Column) -> Column:
        t = acc["t"] + F.when(kind == "table", 1).otherwise(0)
        p = acc["p"] + F.when(kind == "picture", 1).otherwise(0)
        number = F.when(kind == "table", t).otherwise(p)
        name = F.concat(kind, F.lit("-"), number, F.lit(".png"))
        return F.struct(t.alias("t"), p.alias("p"), F.array_append(acc["names"], name).alias("names"))

    named = docs.withColumn("_kinds", kinds).withColumn("_names", F.aggregate("_kinds", start, step)["names"])
    pictures = F.size(F.filter("_kinds", lambda k: k == "picture"))
    parts = F.split(F.col("markdown"), F.lit(rf"\Q{IMAGE_MARK}\E"), -1)
    filled = F.transform(
        parts,
        lambda part, i: F.when(i == 0, part)
        .when(i <= pictures, F.concat(F.lit("picture-"), i, F.lit(".png"), part))
        .otherwise(F.concat(F.lit(IMAGE_MARK), part)),
    )
    shaped = F.transform(
        F.arrays_zip(images.alias("i"), F.col("_kinds").alias("k"), F.col("_names").alias("n")),
        lambda z: F.struct(
            z["k"].alias("type"), z["n"].alias("filename"), one_line_base64(z["i"]["image"]).alias("image")
        ),
    )
    return named.withColumn("markdown", F.array_join(filled, "")).withColumn("images", shaped).drop("_kinds", "_names")


def conversion_status(results: DataFrame) -> DataFrame:
    """Each item's status: FAILURE if it has an error, else SUCCESS."""
    return results.withColumn("status", F.when(F.col("error").isNotNull(), "FAILURE").otherwise("SUCCESS"))


def conversion_summary(results: DataFrame) -> DataFrame:
    """A batch that ran is a success whatever its items did; failures are counted."""
    return results.agg(
        F.lit("SUCCESS").alias("status"),
        F.count("*").alias("items"),
        F.count_if(F.col("error").isNotNull()).alias("failures"),
    )


# ---------------------------------------------------------------- documents as JSON


def doc_to_json(*columns: str) -> Column:
    """A document as JSON text."""
    return F.to_json(F.struct(*(columns or ("id", "content", "metadata"))))


def doc_from_json(text: Column) -> Column:
    """A document struct from JSON text; null is an error."""
    parsed = F.from_json(text, DOC, {"mode": "FAILFAST"})
    return F.when(text.isNull(), F.raise_error(F.lit("no document to read"))).otherwise(parsed)


def iso_json(value: Column) -> Column:
    """Nested values as JSON with ISO-8601 times at every depth."""
    fmt = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
    return F.to_json(value, {"timestampFormat": fmt + "XXX", "timestampNTZFormat": fmt, "dateFormat": "yyyy-MM-dd"})
