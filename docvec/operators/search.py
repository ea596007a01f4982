"""Exact top-k by cosine similarity, with filters.

Rows are ranked by their score and equal scores go by id. Scores keep twelve decimals, which is
all that a sum of doubles is sure of; beyond them the order would depend on how the rows were laid
out. A stored vector that is null, holds
a null, or has another size than the query is no hit; ``malformed`` counts them.
"""

import heapq
import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docvec.cluster import fits
from docvec.functions import filters as flt
from docvec.functions import maps

DECIMALS = 12
# Queries up to this count travel to every task; more are joined in blocks.
BROADCAST_QUERIES = 4096
BLOCK_QUERIES = 16384
# Values of the vectors, and of the queries, that one block of a task holds at most; pairs of blocks per core at least.
BLOCK_VALUES, QUERY_VALUES, PAIRS_PER_CORE = 1 << 24, 1 << 22, 3
# Numbers of one kind held at once in one task: scores, or values of vectors.
NUMBERS = 4_000_000
# Vectors that a query is compared with in one step, if they and its scores fit.
WIDTH = 8192

BATCH_SCHEMA = "query_id string, id string, score double"


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows as doubles scaled to length 1; a row without length stays zero and scores 0."""
    rows = rows.astype(np.float64)
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, lengths, out=np.zeros_like(rows), where=lengths > 0)


def usable(vectors: pa.Array, dim: int) -> np.ndarray:
    """Which lists are vectors of this size without a null."""
    right = pc.fill_null(pc.equal(pc.list_value_length(vectors), dim), False).to_numpy(zero_copy_only=False)
    if vectors.flatten().null_count:
        right &= np.array([v is not None and None not in v for v in vectors.to_pylist()], dtype=bool)
    return right


def matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Usable lists as a matrix."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def malformed(vectors: DataFrame, dim: int) -> DataFrame:
    """``n``, the rows that no query of this size can find."""
    good = F.col("vector").isNotNull() & (F.size("vector") == dim) & F.forall("vector", lambda v: v.isNotNull())
    return vectors.agg(F.count_if(~F.coalesce(good, F.lit(False))).alias("n"))


def blocks(n: int, width: int) -> Iterator[slice]:
    """Slices of ``n`` rows such that ``width`` numbers per row stay below ``NUMBERS``."""
    step = max(1, NUMBERS // max(1, width))
    return (slice(at, at + step) for at in range(0, n, step))


def cosine_to(vector: Column, query: Sequence[float]) -> Column:
    """Cosine of each row's vector to one query vector; null where the vector is malformed."""
    target = unit_rows(np.asarray([query], dtype=np.float32))[0]

    @F.arrow_udf("double")
    def run(batch: pa.Array) -> pa.Array:
        valid = usable(batch, len(target))
        rows = matrix(batch.filter(pa.array(valid)), len(target))
        scores = [unit_rows(rows[part]) @ target for part in blocks(len(rows), len(target))]
        out = np.zeros(len(batch))
        out[valid] = np.round(np.concatenate([*scores, []]), DECIMALS) + 0.0
        return pa.array(out, mask=~valid)

    return run(vector)


def hits(rows: DataFrame, score: Column) -> DataFrame:
    """Rows in the shape of search results; rows without an id are skipped."""
    return rows.filter(F.col("id").isNotNull()).select(
        "id", maps.or_empty(F.col("metadata")).alias("metadata"), score.alias("score"), "vector"
    )


def search(
    vectors: DataFrame, query: Sequence[float] | None, k: int, filters: list[dict] | None = None
) -> DataFrame:
    """The ``k`` nearest rows that pass all filters; without a query, any order by id.

    Each task keeps its own ``k`` best, so only those are sorted together.
    """
    rows = flt.apply(vectors, filters)
    if query is None:
        return hits(rows, F.lit(1.0)).orderBy("id").limit(k)
    scored = hits(rows, cosine_to(F.col("vector"), query)).filter(F.col("score").isNotNull())
    return scored.orderBy(F.desc("score"), "id").limit(k)


def first_documents(vectors: DataFrame, size: int = 10) -> DataFrame:
    """``size`` rows, by id."""
    return search(vectors, None, size)


class _Best:
    """The k best (score, id) per query over the blocks of one task.

    Scores of all pairs are taken in single precision first. It errs by less than ``margin``, so
    only rows that reach a query's k-th best score less that margin can change it; these are
    scored again as doubles.
    """

    def __init__(self, query_ids: list[str], queries: np.ndarray, k: int):
        self.query_ids, self.queries, self.k = query_ids, unit_rows(queries), k
        self.kept: list[list[tuple[float, str]]] = [[] for _ in query_ids]
        self.rough = self.queries.astype(np.float32)
        self.margin = (self.queries.shape[1] + 8) * float(np.finfo(np.float32).eps)
        self.floor = np.full((len(query_ids), 1), -np.inf, np.float32)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        for part in blocks(len(ids), max(self.queries.shape[1], NUMBERS // WIDTH)):
            units, own = unit_rows(vectors[part]), ids[part]
            single = units.astype(np.float32).T
            for some in blocks(len(self.queries), len(units)):
                rough = self.rough[some] @ single
                near = ~(rough < self.floor[some])
                for q in np.flatnonzero(near.any(axis=1)):
                    take = np.flatnonzero(near[q])
                    if len(take) > self.k:
                        best = np.partition(rough[q, take], -self.k)[-self.k]
                        take = take[~(rough[q, take] < best - 2 * self.margin)]
                    scores = np.round(units[take] @ self.queries[some.start + q], DECIMALS) + 0.0
                    self._merge(some.start + q, scores, own[take])

    def _merge(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        kept, k = self.kept[q], self.k
        take = np.arange(len(scores))
        if len(kept) == k:
            worst, last = -kept[-1][0], kept[-1][1]
            take = np.flatnonzero(scores >= worst)
            take = take[(scores[take] > worst) | (ids[take] < last)]
        if len(take) > k:
            floor = np.partition(scores[take], -k)[-k]
            take = take[scores[take] >= floor]
        if len(take):
            new = zip((-scores[take]).tolist(), ids[take].tolist())
            self.kept[q] = heapq.nsmallest(k, [*kept, *new])
            if len(self.kept[q]) == k:
                self.floor[q] = -self.kept[q][-1][0] - 2 * self.margin

    def table(self) -> pa.RecordBatch:
        rows = [(q, i, -s) for q, kept in zip(self.query_ids, self.kept) for s, i in kept]
        q, i, s = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(q, pa.string()), pa.array(i, pa.string()), pa.array(s, pa.float64())],
            names=["query_id", "id", "score"],
        )


def whole(table: pa.RecordBatch | pa.Table) -> pa.RecordBatch | pa.Table:
    """Rows that have all their values.

    Nulls are dropped here and not by a filter of the plan, which would move below the
    projection that embeds and run the embedder twice.
    """
    return table.filter(reduce(pc.and_, [pc.is_valid(c) for c in table.columns]))


def _id_array(ids: pa.Array) -> np.ndarray:
    return np.asarray(ids.to_pylist(), dtype=object)


def _add(kept: _Best, table: pa.RecordBatch | pa.Table, dim: int) -> None:
    """Score the usable vectors of a table of ids and vectors."""
    vectors = table["vector"]
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    good = pa.array(usable(vectors, dim))
    kept.add(_id_array(table["id"].filter(good)), matrix(vectors.filter(good), dim))


def search_batch(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    filters: list[dict] | None = None,
    max_broadcast: int = BROADCAST_QUERIES,
) -> DataFrame:
    """The ``k`` nearest rows for each query of ``queries(query_id, vector)``, with their rank.

    Up to ``max_broadcast`` queries are sent to every task, and each task returns at most
    ``k`` rows per query. More queries are met with the vectors block by block: every block
    of queries is copied to every block of vectors, and only the best of a pair of blocks
    leave it. No pair of a query and a vector ever becomes a row.
    """
    rows = flt.apply(vectors, filters).select(F.col("id").cast("string").alias("id"), "vector")
    # Renamed, because queries may come from the very frame they are compared with.
    asked = queries.select(F.col("query_id").cast("string").alias("query_id"), F.col("vector").alias("query"))
    found = _to_all(rows, asked, k) if fits(asked, max_broadcast) else _by_blocks(rows, asked, k)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _to_all(rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    table = whole(asked.toArrow())
    if table.num_rows == 0:
        return rows.sparkSession.createDataFrame([], BATCH_SCHEMA)
    names = table["query_id"].to_pylist()
    vectors = table["query"].combine_chunks()
    shared = rows.sparkSession.sparkContext.broadcast(matrix(vectors, len(vectors[0])))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _Best(names, shared.value, k)
        for batch in map(whole, batches):
            _add(kept, batch, shared.value.shape[1])
        yield kept.table()

    return rows.mapInArrow(best, BATCH_SCHEMA)


def _by_blocks(
    rows: DataFrame, asked: DataFrame, k: int, per_query: int = BLOCK_QUERIES, values: int = BLOCK_VALUES
) -> DataFrame:
    sizes = asked.agg(F.count("*").alias("n"), F.max(F.size("query")).alias("dim")).first()
    dim = max(1, sizes["dim"] or 1)
    n_v = max(1, math.ceil(rows.count() * dim / values))
    # Each block of vectors costs every query a step, a copy of the vectors only its shuffle: all cores get queries of their own.
    least = math.ceil(PAIRS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism / n_v)
    n_q = max(1, math.ceil(sizes["n"] / per_query), math.ceil(sizes["n"] * dim / QUERY_VALUES), min(least, sizes["n"]))

    def spread(df: DataFrame, key: str, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        home = F.pmod(F.xxhash64(key), F.lit(n_own)).cast("int").alias(own)
        return df.select("*", home, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other))

    left = spread(rows, "id", "_v", n_v, "_q", n_q).groupBy("_v", "_q")
    right = spread(asked, "query_id", "_q", n_q, "_v", n_v).groupBy("_v", "_q")

    def best(block: pa.Table, of: pa.Table) -> pa.Table:
        block, of = whole(block), whole(of)
        if block.num_rows and of.num_rows:
            vectors = of["query"].combine_chunks()
            dim = len(vectors[0])
            kept = _Best(of["query_id"].to_pylist(), matrix(vectors, dim), k)
            _add(kept, block, dim)
        else:
            kept = _Best([], np.zeros((0, 1)), k)
        return pa.Table.from_batches([kept.table()])

    return left.cogroup(right).applyInArrow(best, BATCH_SCHEMA)
