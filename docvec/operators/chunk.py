"""Documents to chunks.

A chunker is a column expression: text in, array of chunk texts out. Only the text column
ever reaches a Python worker; ids and metadata stay in the JVM and ``explode_chunks`` joins
them row by row, without a shuffle.

Without overlap, and with separators whose occurrences cannot overlap each other, the greedy
rule "as many pieces as fit" is the greedy rule of a regular expression, so those settings
run in the JVM. All others run in an Arrow function that places chunk borders by binary
search in the array of piece borders.
"""

import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate, chain, pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvec.functions import text as tx
from docvec.functions.batches import slices, values

# Defaults of the chunkers.
CHUNK_SIZE = 500
CHUNK_OVERLAP = 0
SEPARATOR = "\n\n"
SEPARATORS = ("\n\n", "\n", " ", "")
# Names of chunkers in metadata; any other name means the recursive chunker.
CHARACTER = "characterchunker"
CUSTOM = "customchunker"

# No text is longer, so larger sizes mean the same; a regular expression takes no larger count.
LONGEST = (1 << 31) - 1


def check_sizes(size: int, overlap: int) -> None:
    if size < 1:
        raise ValueError(f"chunk_size must be at least 1, got {size}")
    if overlap < 0:
        raise ValueError(f"chunk_overlap must not be negative, got {overlap}")
    if overlap > size:
        raise ValueError(f"chunk_overlap {overlap} is larger than chunk_size {size}")


def _self_overlapping(separator: str) -> bool:
    """Whether two occurrences can share characters, as in a run of three line breaks."""
    return any(separator.startswith(separator[i:]) for i in range(1, len(separator)))


def _in_class(char: str) -> str:
    return rf"\x{{{ord(char):x}}}"


def _literal(separator: str) -> str:
    return "".join(_in_class(c) for c in separator)


# ---------------------------------------------------------------- greedy merge


def merge_spans(lengths: Sequence[int], size: int, overlap: int, gap: int) -> list[tuple[int, int]]:
    """Greedy merge of pieces: index ranges [start, end) of the emitted chunks.

    ``gap`` is the length of the joining separator. A piece longer than ``size`` stays whole.
    After a chunk, the following one starts as far back as ``overlap`` and the next piece allow.
    """
    n = len(lengths)
    at = list(accumulate((length + gap for length in lengths), initial=0))
    spans, start, end = [], 0, 0
    while end < n:
        end = min(n, max(end + 1, bisect_right(at, at[start] + size + gap) - 1))
        spans.append((start, end))
        if end < n:
            back = max(at[end] - gap - overlap, at[end] + lengths[end] - size)
            start = min(end, max(start, bisect_left(at, back)))
    return spans


def split_on(text: str, separator: str, size: int, overlap: int) -> list[str]:
    """Pieces between separators, merged up to ``size`` with the separator between them."""
    pieces = [p for p in (text.split(separator) if separator else text) if p]
    spans = merge_spans([len(p) for p in pieces], size, overlap, len(separator))
    chunks = (separator.join(pieces[s:e]).strip() for s, e in spans)
    return [c for c in chunks if c]


def split_recursively(text: str, separators: Sequence[str], size: int, overlap: int) -> list[str]:
    """Cut before each first-choice separator, merge short pieces, recurse into long ones."""
    if len(text) < size:
        whole = text.strip()
        return [whole] if whole else []
    level = next((i for i, s in enumerate(separators) if s in text), len(separators) - 1)
    separator, rest = separators[level], separators[level + 1 :]
    if separator:
        cuts = [m.start() for m in re.finditer(re.escape(separator), text)]
        borders = [0, *cuts, len(text)] if cuts[:1] != [0] else [*cuts, len(text)]
    else:
        borders = range(len(text) + 1)
    lengths = [b - a for a, b in pairwise(borders)]
    chunks: list[str] = []
    run = 0
    for i in [*(i for i, n in enumerate(lengths) if n >= size), len(lengths)]:
        for s, e in merge_spans(lengths[run:i], size, overlap, 0):
            chunks.append(text[borders[run + s] : borders[run + e]].strip())
        if i < len(lengths):
            piece = text[borders[i] : borders[i + 1]]
            chunks.extend(split_recursively(piece, rest, size, overlap) if rest else [piece])
        run = i + 1
    return [c for c in chunks if c]


def split_windows(text: str, separator: str, size: int, overlap: int) -> list[str]:
    """Fixed windows that prefer to end behind the last separator inside them."""
    chunks, at = [], 0
    while at < len(text):
        if len(text) - at <= size:
            chunks.append(text[at:])
            break
        cut = text.rfind(separator, at, at + size) if separator else -1
        end = cut + len(separator) if cut >= 0 else at + size
        chunks.append(text[at:end])
        at = max(end - overlap, at + 1)
    return chunks


# ---------------------------------------------------------------- Arrow form


def texts_to_lists(split: Callable[..., list[str]]) -> Callable[..., Column]:
    """Run ``split(text, *settings)`` over Arrow batches; null text or settings give null."""

    @F.arrow_udf("array<string>")
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for part in chain.from_iterable(map(slices, batches)):
            rows = zip(*map(values, part))
            yield pa.array([None if row[0] is None else split(*row) for row in rows], type=pa.list_(pa.string()))

    return run


def texts_to_results(split: Callable[..., list[str]]) -> Callable[..., Column]:
    """As ``texts_to_lists``, but a struct of ``chunks`` and ``error``, so that a text that fails fails alone."""

    @F.arrow_udf("struct<chunks:array<string>,error:string>")
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for part in chain.from_iterable(map(slices, batches)):
            lists, errors = [], []
            for row in zip(*map(values, part)):
                error = None
                try:
                    found = None if row[0] is None else split(*row)
                except Exception as failure:
                    found, error = None, f"not chunked: {failure or type(failure).__name__}"
                lists.append(found)
                errors.append(error)
            columns = [pa.array(lists, pa.list_(pa.string())), pa.array(errors, pa.string())]
            yield pa.StructArray.from_arrays(columns, names=["chunks", "error"])

    return run


def _arrow(split: Callable[..., list[str]], text: Column) -> Column:
    return texts_to_lists(split)(text)


# ---------------------------------------------------------------- JVM form


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), group)


def _clean(chunks: Column) -> Column:
    return F.filter(F.transform(chunks, tx.strip), lambda c: c != "")


def _native_character(text: Column, separator: str, size: int) -> Column:
    sep = _literal(separator)
    pieces = F.regexp_replace(F.btrim(text, F.lit(separator)), f"{sep}{{2,}}", F.lit(separator))
    return _clean(_matches(pieces, rf"(?s)(.{{1,{size}}}|.+?)(?:{sep}|\z)", 1))


def _native_recursive(text: Column, separators: Sequence[str], size: int) -> Column:
    separator, rest = separators[0], separators[1:]
    if separator == "":
        return _matches(text, rf"(?s).{{1,{size}}}")
    sep = _literal(separator)
    border = rf"(?={sep}|\z)"
    parts = _matches(text, rf"(?s).{{1,{size}}}{border}|{sep}.*?{border}|.+?{border}")
    if not rest:
        return parts
    deeper = F.transform(
        parts,
        lambda p: F.when(F.length(p) > size, _native_recursive(p, rest, size)).otherwise(F.array(p)),
    )
    return F.flatten(deeper)


# ---------------------------------------------------------------- chunkers


def character_chunks(
    text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, separator: str = SEPARATOR
) -> Column:
    """Split by one separator, merge pieces up to ``size``; a longer piece stays whole."""
    check_sizes(size, overlap)
    if overlap == 0 and len(separator) == 1:
        return _native_character(text, separator, min(size, LONGEST))
    return _arrow(lambda t: split_on(t, separator, size, overlap), text)


def recursive_chunks(
    text: Column,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: Sequence[str] = SEPARATORS,
) -> Column:
    """Split by the first separator present, merge short pieces, recurse into long ones."""
    check_sizes(size, overlap)
    separators = tuple(separators)
    if not separators:
        raise ValueError("separators must not be empty")
    ends_in_characters = separators[-1] == "" and "" not in separators[:-1]
    # Single characters are longer than "shorter than 1" and would not be trimmed.
    if size > 1 and overlap == 0 and ends_in_characters and not any(map(_self_overlapping, separators)):
        return _clean(_native_recursive(text, separators, min(size, LONGEST)))
    return _arrow(lambda t: split_recursively(t, separators, size, overlap), text)


def window_chunks(
    text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, separator: str | None = None
) -> Column:
    """Windows of ``size`` characters; with a separator they prefer to end behind it.

    Each match looks ahead over one window and then moves on by one step, so the work is
    linear in the text, unlike a ``substring`` per window.
    """
    check_sizes(size, overlap)
    if overlap == size:
        raise ValueError("chunk_overlap must be smaller than chunk_size")
    if size > LONGEST:
        size, overlap = LONGEST, min(overlap, LONGEST - 1)
    if not separator or len(separator) > size:
        step = size - overlap
        return _matches(text, rf"(?s)(?=(.{{1,{size}}}))(?:.{{1,{size}}}\z|.{{{step}}})", 1)
    if overlap == 0:
        sep = _literal(separator)
        fill = size - len(separator)
        return _matches(text, rf"(?s).{{1,{size}}}\z|.{{0,{fill}}}{sep}|.{{{size}}}")
    return _arrow(lambda t: split_windows(t, separator, size, overlap), text)


def custom_chunks(text: Column, split: Callable[[str], list[str]]) -> Column:
    """The caller's ``split`` function over Arrow batches."""
    return _arrow(lambda t: list(split(t)), text)


def explode_chunks(docs: DataFrame, chunks: Column, keep: Column | None = None) -> DataFrame:
    """One row per chunk: id ``<document id>_<i>``, the document's metadata and other columns.

    A document without chunks has no row, unless ``keep`` holds; then its content is null. Chunks
    of a document without an id have none either, so that no two documents share them.
    """
    taken = {"content", "doc_id", "chunk_index"}
    kept = [c for c in docs.columns if c not in taken and c != "id"]
    explode = F.posexplode if keep is None else F.posexplode_outer
    rows = docs.select(F.col("id").alias("doc_id"), *kept, explode(chunks).alias("chunk_index", "content"))
    if keep is not None:
        rows = rows.filter(F.col("content").isNotNull() | keep)
    return rows.select(
        F.concat(F.col("doc_id"), F.lit("_"), F.col("chunk_index")).alias("id"), "content", *kept, "doc_id", "chunk_index"
    )


def chunk_by_metadata(
    docs: DataFrame,
    custom: Callable[[str], list[str]] | None = None,
    keep: Column | None = None,
    strict: bool = True,
) -> DataFrame:
    """Chunk each document as its own metadata says.

    ``metadata['chunker_name']`` picks the chunker and ``metadata['chunker_information']``, a
    JSON object, its settings; absent settings are the defaults. An unknown or missing name,
    or settings that are present but null, mean the recursive chunker. If not strict, a document
    that cannot be chunked gives one row without content that names the ``error``.
    """
    info = F.from_json(
        F.col("metadata")["chunker_information"],
        "chunk_size int, chunk_overlap int, separator string, separators array<string>",
    )

    def split(text, name, settings):
        chosen = {} if settings is None else json.loads(settings)
        size, overlap = chosen.get("chunk_size", CHUNK_SIZE), chosen.get("chunk_overlap", CHUNK_OVERLAP)
        separator, separators = chosen.get("separator"), chosen.get("separators")
        check_sizes(size, overlap)
        if name == CHARACTER:
            return split_on(text, SEPARATOR if separator is None else separator, size, overlap)
        if name == CUSTOM:
            if custom is None:
                raise ValueError("a document asks for a custom chunker and none was given")
            return list(custom(text))
        return split_recursively(text, separators or SEPARATORS, size, overlap)

    # As text: Spark measures a batch after each row, and a column of arrays is gone through whole for that.
    given = docs.withColumn("_info", F.to_json(info, {"ignoreNullFields": "true"}))
    meta = F.col("metadata")
    nulled = F.map_contains_key(meta, "chunker_information") & meta["chunker_information"].isNull()
    name = F.when(~nulled, F.lower(meta["chunker_name"]))
    if strict:
        chunks = texts_to_lists(split)(F.col("content"), name, F.col("_info"))
        return explode_chunks(given, chunks, keep).drop("_info")
    done = given.withColumn("_done", texts_to_results(split)(F.col("content"), name, F.col("_info")))
    earlier = F.col("error") if "error" in docs.columns else F.lit(None).cast("string")
    done = done.withColumn("error", F.coalesce(earlier, F.col("_done.error")))
    failed = F.col("error").isNotNull()
    kept = failed if keep is None else failed | keep
    return explode_chunks(done, F.col("_done.chunks"), kept).drop("_info", "_done")
