"""Scalar leaves of JSON values as documents.

The depth of a JSON value is not known when a plan is made, so the walk is one small
function over Arrow batches. Numbers keep the text of the parsed value.
"""

import json
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docvec.functions import maps
from docvec.functions.batches import slices, values

LEAF = "struct<id:string,content:string,metadata:map<string,string>>"
STYLES = ("json", "python")
Leaf = tuple[str, str, dict[str, str]]  # id, content, metadata


def leaf_text(value: object, style: str) -> str:
    """A scalar as text; ``json`` spells ``true`` and ``null``, ``python`` ``True`` and ``None``."""
    if style == "json" and (value is None or isinstance(value, bool)):
        return json.dumps(value)
    return str(value)


def entry_text(value: object, style: str) -> str:
    return json.dumps(value, ensure_ascii=False) if isinstance(value, dict | list) else leaf_text(value, style)


def walk(root: object, id_key: str, to_embed: frozenset, to_metadata: Sequence[str], style: str) -> list[Leaf]:
    """Leaves in document order as (id, text, metadata of the enclosing objects).

    A leaf's id is its dotted path, after the enclosing object's own id if it has one. With
    ``to_embed`` a member is entered only if its path is listed. Outer metadata wins. The
    open values are kept on a list, so depth is not limited by the call stack.
    """
    leaves: list[Leaf] = []
    todo: list[tuple[object, str, str, dict[str, str]]] = [(root, "", "", {})]
    while todo:
        value, path, leaf_id, outer = todo.pop()
        if isinstance(value, dict):
            above = path + "." if path else ""
            owner = leaf_text(value[id_key], style) + "." if id_key in value else ""
            meta = {k: entry_text(value[k], style) for k in to_metadata if k in value} | outer
            for key in reversed(value):
                at = above + key
                if not to_embed or at in to_embed:
                    todo.append((value[key], at, owner + at, meta))
        elif isinstance(value, list):
            todo.extend([(member, path, leaf_id, outer) for member in reversed(value)])
        else:
            leaves.append((leaf_id or path, value if isinstance(value, str) else leaf_text(value, style), outer))
    return leaves


def leaf_array(rows: list[list[Leaf]]) -> pa.Array:
    """Lists of (id, content, metadata) as an Arrow array of type ``array<LEAF>``."""
    leaves = [leaf for row in rows for leaf in row]
    entries = [entry for _, _, metadata in leaves for entry in metadata.items()]

    def offsets(sizes: list[int]) -> pa.Array:
        return pa.array(list(accumulate(sizes, initial=0)), pa.int32())

    metadata = pa.MapArray.from_arrays(
        offsets([len(m) for _, _, m in leaves]),
        pa.array([k for k, _ in entries], pa.string()),
        pa.array([v for _, v in entries], pa.string()),
    )
    ids, contents = (pa.array([leaf[i] for leaf in leaves], pa.string()) for i in (0, 1))
    values = pa.StructArray.from_arrays([ids, contents, metadata], names=["id", "content", "metadata"])
    return pa.ListArray.from_arrays(offsets([len(row) for row in rows]), values)


def leaf_reader(
    parse: Callable[..., Iterable[Leaf]], strict: bool, failure: Callable[..., str]
) -> Callable[..., Column]:
    """Run ``parse`` over Arrow batches of one or more columns; the result is a struct of ``docs`` and ``error``.

    What cannot be parsed is an error of the job or, if not strict, of its own row, which
    then has no documents and the text that ``failure`` gives of the same values. Null has neither.
    """

    @F.arrow_udf(f"struct<docs:array<{LEAF}>,error:string>")
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for part in chain.from_iterable(map(slices, batches)):
            rows: list[list[Leaf]] = []
            errors: list[str | None] = []
            for item, *rest in zip(*map(values, part)):
                error = None
                try:
                    found = [] if item is None else list(parse(item, *rest))
                except Exception:
                    if strict:
                        raise
                    found, error = [], failure(item, *rest)
                rows.append(found)
                errors.append(error)
            yield pa.StructArray.from_arrays([leaf_array(rows), pa.array(errors, pa.string())], names=["docs", "error"])

    return run


def json_leaves(
    text: Column,
    id_key: str = "id",
    to_embed: Sequence[str] = (),
    to_metadata: Sequence[str] = (),
    style: str = "json",
    strict: bool = True,
) -> Column:
    """Leaves of a JSON text as ``docs``, and ``error`` for bad JSON unless that is strict."""
    return leaf_reader(json_parser(id_key, to_embed, to_metadata, style), strict, lambda t: "not valid JSON")(text)


def json_parser(
    id_key: str = "id", to_embed: Sequence[str] = (), to_metadata: Sequence[str] = (), style: str = "json"
) -> Callable[[str], list[Leaf]]:
    """What makes the leaves of a JSON text."""
    if style not in STYLES:
        raise ValueError(f"style must be one of {STYLES}, got {style!r}")
    wanted, keys = frozenset(to_embed or ()), tuple(to_metadata)
    return lambda t: walk(json.loads(t), id_key, wanted, keys, style)


def json_docs(
    values: DataFrame,
    column: str = "content",
    id_key: str = "id",
    to_embed: Sequence[str] = (),
    to_metadata: Sequence[str] = (),
    style: str = "json",
    unique_ids: bool = False,
    strict: bool = True,
) -> DataFrame:
    """One document per leaf; a ``metadata`` column of ``values`` overrides the leaf's own.

    ``unique_ids`` appends the leaf's position, because siblings in a list share an id.
    Other columns are kept.
    """
    kept = [c for c in values.columns if c not in ("id", "content", "metadata", column)]
    outer = F.col("metadata") if "metadata" in values.columns else maps.empty_map()
    leaves = json_leaves(F.col(column), id_key, to_embed, to_metadata, style, strict)["docs"]
    rows = values.select(*kept, outer.alias("_outer"), F.posexplode(leaves).alias("_at", "_leaf"))
    doc_id = F.concat_ws("_", "_leaf.id", "_at") if unique_ids else F.col("_leaf.id")
    return rows.select(
        doc_id.alias("id"),
        F.col("_leaf.content").alias("content"),
        maps.merge(F.col("_leaf.metadata"), F.col("_outer")).alias("metadata"),
        *kept,
    )


def read_json_docs(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """Documents of JSON files, each file one JSON value of any shape."""
    files = spark.read.text(paths, wholetext=True)
    shaped = files.select(
        F.regexp_replace("value", r"^\x{FEFF}", "").alias("content"),
        maps.from_columns({"source": F.col("_metadata.file_path")}).alias("metadata"),
    )
    return json_docs(shaped, **options)
