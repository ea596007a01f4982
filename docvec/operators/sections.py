"""Markdown documents cut at their headings: each section knows the headings it stands under."""

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvec.functions import maps

# Marks of headings, and the metadata keys of what stands behind them.
HEADINGS = (("#", "Header 1"), ("##", "Header 2"), ("###", "Header 3"))
FENCE = re.compile(r" {0,3}(`{3,}(?!.*`)|~{3,})")
SECTION = "array<struct<content:string,headings:map<string,string>>>"
ARROW = pa.list_(pa.struct([("content", pa.string()), ("headings", pa.map_(pa.string(), pa.string()))]))


def split_at_headings(text: str, headings: Sequence[tuple[str, str]] = HEADINGS, keep: bool = False) -> Iterator[tuple[str, dict[str, str]]]:
    """Sections of a text and their headings from the outermost on, in one pass over its lines.

    A heading is a mark of ``headings`` at the begin of a line, alone or with a blank behind it; it
    ends all headings of its own and deeper levels. Lines between fences are never headings, and a
    fence ends at one of the same sign that is no shorter. Sections without text have none. With
    ``keep`` a section begins with its heading's line.
    """
    marks = sorted(((m, len(m), name) for m, name in headings), key=lambda x: -x[1])
    lines: list[str] = []
    stack: list[tuple[int, str, str]] = []
    fence = ""

    def section() -> Iterator[tuple[str, dict[str, str]]]:
        content = "\n".join(lines).strip()
        if content:
            yield content, {name: title for _, name, title in stack}

    for line in text.split("\n"):
        found = FENCE.match(line)
        if found and not fence:
            fence = found[1]
        elif fence:
            if found and found[1].startswith(fence) and not line[found.end() :].strip():
                fence = ""
        else:
            bare = line.strip()
            level = next(((n, name) for m, n, name in marks if bare.startswith(m) and bare[n : n + 1] in ("", " ", "\t")), None)
            if level:
                yield from section()
                lines.clear()
                while stack and stack[-1][0] >= level[0]:
                    stack.pop()
                stack.append((*level, bare[level[0] :].strip()))
                if not keep:
                    continue
        lines.append(line)
    yield from section()


def sections(text: Column, headings: Sequence[tuple[str, str]] = HEADINGS, keep: bool = False) -> Column:
    """``split_at_headings`` of a column; a null text has no sections."""

    @F.arrow_udf(SECTION)
    def cut(texts: pa.Array) -> pa.Array:
        rows = [None if t is None else [{"content": c, "headings": list(h.items())} for c, h in split_at_headings(t, headings, keep)] for t in texts.to_pylist()]
        return pa.array(rows, ARROW)

    return cut(text)


def explode_sections(docs: DataFrame, headings: Sequence[tuple[str, str]] = HEADINGS, keep: bool = False) -> DataFrame:
    """One row per section: id ``<document id>_<i>``, its headings added to the document's metadata, and all other columns.

    Sections are documents again, so that any chunker can cut long ones further.
    """
    rest = [c for c in docs.columns if c not in ("id", "content", "metadata", "doc_id", "section_index")]
    found = docs.select(F.col("id").alias("doc_id"), "metadata", *rest, F.posexplode(sections(F.col("content"), headings, keep)).alias("section_index", "_s"))
    return found.select(
        F.concat("doc_id", F.lit("_"), "section_index").alias("id"), F.col("_s.content").alias("content"),
        maps.merge(maps.or_empty(F.col("metadata")), F.col("_s.headings")).alias("metadata"), *rest, "doc_id", "section_index",
    )
