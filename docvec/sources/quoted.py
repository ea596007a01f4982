"""CSV files of any size whose quoted cells may hold line breaks, cut over tasks.

Where a record begins depends on all quotes before it. So every split of a file is looked at twice:
first its quotes are counted, and the records that begin in it if it begins outside of quotes and
if it begins inside; sums over the splits of a file then tell which of both is true and how many
rows stand before. Then each task parses the records that begin behind a line break of its split,
and reads on to the end of the last one. No file is read by one task, however long its cells.
"""

import csv
import io
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docvec.cluster import written
from docvec.functions import maps
from docvec.functions import text as tx
from docvec.sources import files, objects
from docvec.sources.tables import ID_KEY

# Bytes of a split; bytes read at a time beyond it; bytes of rows that a task hands over at once.
SPLIT_BYTES, PIECE, BATCH_BYTES = 64 << 20, 1 << 20, 4 << 20
LINE, RETURN = 10, 13
MARK = b"\xef\xbb\xbf"


class Records:
    """Where records of a file begin. ``read`` gives the bytes of a range, fewer at the end of the file."""

    def __init__(self, read: Callable[[int, int], bytes], size: int, quote: str):
        self.read, self.size, self.quote = read, size, ord(quote)

    def breaks(self, data: np.ndarray, inside: int) -> np.ndarray:
        """Line breaks outside of quotes, in bytes before which ``inside`` quotes are open."""
        lines = np.flatnonzero(data == LINE)
        quotes = np.flatnonzero(data == self.quote)
        return lines[(np.searchsorted(quotes, lines) + inside) % 2 == 0]

    def counts(self, start: int, stop: int) -> tuple[int, int, int]:
        """Quotes of a split modulo 2, and the records behind its line breaks, begun outside and inside of quotes.

        Empty lines are no records.
        """
        data = np.frombuffer(self.read(start, stop + 2), np.uint8)
        own, found = data[: stop - start], []
        for inside in (0, 1):
            found.append(int(self.filled(data, self.breaks(own, inside), start).sum()))
        return int((own == self.quote).sum()) % 2, found[0], found[1]

    def filled(self, data: np.ndarray, breaks: np.ndarray, start: int) -> np.ndarray:
        """Which line breaks a record follows: not the file's end, and no other line break."""
        padded = np.concatenate([data, np.full(2, LINE, np.uint8)])
        after, second = padded[breaks + 1], padded[breaks + 2]
        left = self.size - start - breaks - 1
        return (left > 0) & (after != LINE) & ~((after == RETURN) & ((second == LINE) | (left == 1)))

    def rest(self, at: int, inside: int) -> tuple[bytes, int]:
        """The bytes from ``at`` up to the first line break outside of quotes, and how many quotes are open behind them."""
        found = []
        while at < self.size:
            data = self.read(at, min(self.size, at + PIECE))
            array = np.frombuffer(data, np.uint8)
            ends = self.breaks(array, inside)
            if len(ends):
                found.append(data[: int(ends[0])])
                return b"".join(found), 0
            found.append(data)
            inside = (inside + int((array == self.quote).sum())) % 2
            at += len(data)
        return b"".join(found), inside

    def text(self, start: int, stop: int, inside: int) -> tuple[bytes, int]:
        """The records behind the line breaks of a split, as they stand, and the quotes open at their end."""
        data = self.read(start, stop)
        array = np.frombuffer(data, np.uint8)
        ends = self.breaks(array, inside)
        if not len(ends):
            return b"", 0
        after = data[int(ends[0]) + 1 :]
        open_quotes = int((array[int(ends[-1]) + 1 :] == self.quote).sum()) % 2
        more, still_open = self.rest(stop, open_quotes)
        return after + more, still_open


ROW = "path string, row long, names array<string>, cells array<string>"
ROW_SCHEMA = pa.schema([("path", pa.string()), ("row", pa.int64()), ("names", pa.list_(pa.string())), ("cells", pa.list_(pa.string()))])


def read_rows(
    spark: SparkSession, root: str, glob: str | None = None, sep: str = ",", quote: str = '"', encoding: str = "UTF-8",
    split_bytes: int = SPLIT_BYTES, strict: bool = True, by_folder: bool = False,
) -> DataFrame:
    """``path``, ``row``, ``names`` and ``cells`` of the rows of all CSV files below ``root``, each with its own header.

    With ``by_folder`` the files of a folder are numbered on, in the order of their names, as if they were one file.

    Quotes are doubled inside of quotes and stand for nothing else, as RFC 4180 has it; a file
    where that does not hold is an error, or without ``strict`` a row with its ``path`` only.
    ``encoding`` must be one where commas, quotes and line breaks are single bytes. Rows have the
    numbers that a parser from the first line on would count, empty lines left out; a row may have
    fewer or more cells than names. One record must stay below 2 GB. The store must be one that
    tasks can read.
    """
    store_of = objects.Store.of(spark, root)
    if store_of is None:
        raise ValueError(f"tasks cannot read {root!r}")
    if len(f"{sep}{quote}\n".encode(encoding)) != 3:
        raise ValueError(f"{encoding} has separators of several bytes")
    found = objects.walk(spark, root)
    if glob:
        found = found.where(files.named(glob))
    last = F.greatest(F.lit(0), F.ceil(F.col("length") / split_bytes) - 1)
    splits = found.where("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("split"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    splits = splits.repartition(partitions, "path", "split")

    def opened(path: str, size: int) -> tuple[Records, object]:
        store = store_of()
        file = store.files.open_input_file(path[len(store.scheme) :])
        return Records(lambda a, b: file.read_at(max(0, min(b, size) - a), a), size, quote), file

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, size, split in zip(*(batch.column(c).to_pylist() for c in ("path", "length", "split")), strict=True):
                records, file = opened(path, size)
                with file:
                    open_quotes, outside, within = records.counts(split * split_bytes, min(size, (split + 1) * split_bytes))
                rows.append({"path": path, "length": size, "split": split, "quotes": open_quotes, "outside": outside, "within": within})
            yield pa.RecordBatch.from_pylist(rows, schema=COUNTS)

    counts = written(splits.mapInArrow(counted, "path string, length long, split long, quotes long, outside long, within long"), "splits")
    # A file has a row per split here, so its splits, and those of a folder, fit one window.
    before = W.partitionBy("path").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    known = counts.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    known = known.withColumn("n", F.when(F.col("inside") == 1, F.col("within")).otherwise(F.col("outside")))
    if by_folder:
        folder = F.regexp_extract("path", "^(.*)/", 1)
        before = W.partitionBy(folder).orderBy("path", "split").rowsBetween(W.unboundedPreceding, -1)
    known = known.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    known = written(known.select("path", "length", "split", "inside", "n", "first"), "begins").repartition(partitions, "path", "split")

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(sys.maxsize)  # the parser's own limit is 131,072 characters a cell
        for batch in batches:
            for path, size, split, inside, n, first in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                records, file = opened(path, size)
                with file:
                    yield from rows_of(records, path, split, inside, n, first)

    def rows_of(records: Records, path: str, split: int, inside: int, n: int, first: int) -> Iterator[pa.RecordBatch]:
        raw, wrong = records.text(split * split_bytes, min(records.size, (split + 1) * split_bytes), inside)
        if n or wrong:
            header, open_quotes = records.rest(0, 0)
            names = next(cells_of(header.removeprefix(MARK)), [])
            rows, size, seen = [], 0, 0
            for cells in cells_of(raw):
                if cells:
                    rows.append({"path": path, "row": first + seen, "names": names, "cells": cells})
                    seen, size = seen + 1, size + sum(map(len, cells)) + 100
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=ROW_SCHEMA)
                    rows, size = [], 0
            wrong = wrong or open_quotes or seen != n
            if wrong and strict:
                raise ValueError(f"quotes of {path} do not pair up; read it as a whole")
            if wrong:
                rows.append({"path": path})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=ROW_SCHEMA)

    def cells_of(raw: bytes) -> Iterator[list[str]]:
        return csv.reader(io.StringIO(raw.decode(encoding), newline=""), delimiter=sep, quotechar=quote)

    return known.mapInArrow(parsed, ROW)


COUNTS = pa.schema([("path", pa.string()), *[(c, pa.int64()) for c in ("length", "split", "quotes", "outside", "within")]])


def docs(
    rows: DataFrame, id_key: str = ID_KEY, to_embed: Sequence[str] = (), to_metadata: Sequence[str] = (), source_column: str | None = None,
    unique_ids: bool = False,
) -> DataFrame:
    """Documents of ``read_rows``, as ``tables.csv_docs`` makes them; names may differ from file to file."""
    pairs = F.arrays_zip("names", "cells")

    def value(name: str):
        return F.get(F.filter(pairs, lambda p: p["names"] == name), 0)["cells"]

    def line(name, cell):
        return F.concat(tx.strip(name), F.lit(": "), F.coalesce(tx.strip(cell), F.lit("")))

    if to_embed:
        known = [F.when(F.array_contains("names", c), line(F.lit(c), value(c))) for c in to_embed]
        content = F.concat_ws("\n", *known)
    else:
        named = F.filter(pairs, lambda p: p["names"].isNotNull())
        content = F.array_join(F.transform(named, lambda p: line(p["names"], p["cells"])), "\n")
    key = F.concat(F.coalesce(value(id_key), F.lit("")), F.lit(f".{id_key}"))
    entries = {c: value(c) for c in to_metadata} | {"source": value(source_column) if source_column else F.col("path"), "row": F.col("row")}
    return rows.select(
        (F.concat_ws("_", key, F.col("row")) if unique_ids else key).alias("id"), content.alias("content"), maps.from_columns(entries).alias("metadata")
    )
