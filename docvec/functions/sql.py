"""Loaders and chunkers in SQL, as table functions for ``LATERAL``.

    sql.register(spark)
    SELECT d.id, c.chunk_index, c.content FROM docs d, LATERAL recursive_chunks(d.content, 500, 50) c

They give the rows of the column expressions of ``operators`` and ``sources``, through Arrow. A null
text has no rows.
"""

import json
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from docvec.functions import html
from docvec.operators import chunk, sections
from docvec.sources import jsondocs

CHUNK = "chunk_index int, content string"


class RecursiveChunks:
    """``recursive_chunks(text, size, overlap)``"""

    def eval(self, text: str, size: int, overlap: int) -> Iterator[tuple]:
        chunk.check_sizes(size, overlap)
        if text is not None:
            yield from enumerate(chunk.split_recursively(text, chunk.SEPARATORS, size, overlap))


class CharacterChunks:
    """``character_chunks(text, separator, size, overlap)``"""

    def eval(self, text: str, separator: str, size: int, overlap: int) -> Iterator[tuple]:
        chunk.check_sizes(size, overlap)
        if text is not None:
            yield from enumerate(chunk.split_on(text, separator, size, overlap))


class WindowChunks:
    """``window_chunks(text, size, overlap)``"""

    def eval(self, text: str, size: int, overlap: int) -> Iterator[tuple]:
        chunk.check_sizes(size, overlap)
        if overlap == size:
            raise ValueError("chunk_overlap must be smaller than chunk_size")
        if text is not None:
            yield from enumerate(chunk.split_windows(text, "", size, overlap))


class MarkdownSections:
    """``markdown_sections(text)``"""

    def eval(self, text: str) -> Iterator[tuple]:
        if text is not None:
            for i, (content, headings) in enumerate(sections.split_at_headings(text)):
                yield i, content, headings


class JsonLeaves:
    """``json_leaves(text, id_key)``"""

    def eval(self, text: str, id_key: str) -> Iterator[tuple]:
        if text is not None:
            yield from jsondocs.walk(json.loads(text), id_key, frozenset(), (), "json")


class HtmlLines:
    """``html_lines(text)``: the lines of a page's text that are not blank."""

    def eval(self, text: str) -> Iterator[tuple]:
        lines = [" ".join(line.split()) for line in html.visible(text or "").split("\n")]
        yield from enumerate(line for line in lines if line)


TABLE_FUNCTIONS = {
    "recursive_chunks": (RecursiveChunks, CHUNK),
    "character_chunks": (CharacterChunks, CHUNK),
    "window_chunks": (WindowChunks, CHUNK),
    "markdown_sections": (MarkdownSections, "section_index int, content string, headings map<string,string>"),
    "json_leaves": (JsonLeaves, "id string, content string, metadata map<string,string>"),
    "html_lines": (HtmlLines, "line int, content string"),
}


def register(spark: SparkSession) -> None:
    """Make the table functions known to the session's SQL."""
    for name, (handler, kind) in TABLE_FUNCTIONS.items():
        spark.udtf.register(name, F.udtf(handler, returnType=kind, useArrow=True))
