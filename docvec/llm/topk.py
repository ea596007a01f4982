"""Exact top-k by integer inner product, with whole blocks of documents pruned by bounds.

Vectors stand in blocks of consecutive documents. A block keeps its vectors (the forward index)
and the largest and smallest value of each component (the term maxima). For every query the
blocks are taken in descending order of the bound that these give, and scoring ends when the next
bound lies below the k-th score.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docvec.cluster import written

BLOCK = 256  # vectors of a block
CHUNK_BLOCKS = 128  # blocks that meet a group of queries in one task
GROUP_QUERIES = 8192  # queries of a group
EXACT = float(1 << 53)
BLOCKS = "size int, chunk long, block int, n int, ids binary, vectors binary"
HITS = "query_chunk long, query_at int, query_id long, vec_id long, score long, at long"


def block_table(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """The usable vectors as a written table of blocks in ascending order of the key.

    Components become ``floor(scale * x)``. Vectors that are null or hold null or non-finite
    components, and rows without key, are left out.
    """
    x = F.col(vector)
    usable = F.col(key).isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long"))
    rows = df.where(usable).select(F.col(key).cast("long").alias("id"), whole.alias("v"), F.size(x).alias("size"))
    ordered = rows.repartitionByRange(spread(df), "size", "id").sortWithinPartitions("size", "id")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, held, size = TaskContext.get().partitionId(), 0, [], None
        seq = {"block": 0}

        def flush() -> pa.RecordBatch:
            ids, vectors = np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held])
            row = {"size": size, "chunk": (part << 32) + seq["block"] // CHUNK_BLOCKS, "block": seq["block"] % CHUNK_BLOCKS, "n": len(ids)}
            seq["block"] += 1
            held.clear()
            return pa.RecordBatch.from_pylist([row | {"ids": ids.tobytes(), "vectors": vectors.tobytes()}], schema=SCHEMA)

        for batch in batches:
            ids, sizes = batch.column("id").to_numpy(), batch.column("size").to_numpy()
            lists = batch.column("v")
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)])
            cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(ids)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if held and size != int(sizes[a]):
                    yield flush()
                    count = 0
                    seq["block"] = -(-seq["block"] // CHUNK_BLOCKS) * CHUNK_BLOCKS  # a chunk has vectors of one size
                size = int(sizes[a])
                while a < b:
                    take = min(b - a, BLOCK - count)
                    held.append((ids[a : a + take].copy(), flat[ends[a] : ends[a + take]].reshape(take, size)))
                    a, count = a + take, count + take
                    if count == BLOCK:
                        yield flush()
                        count = 0
        if held:
            yield flush()

    return written(ordered.mapInArrow(blocks, BLOCKS), "blocks")


SCHEMA = pa.schema([("size", pa.int32()), ("chunk", pa.int64()), ("block", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary())])


def spread(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.sparkSession.sparkContext.defaultParallelism)


def product(left: np.ndarray, right: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of rows; in floats, which are faster, where every sum stays exact."""
    return (left.astype(float) @ right.astype(float).T).astype(np.int64) if exact else left @ right.T


def best(queries: np.ndarray, own: np.ndarray, blocks: list[np.ndarray], ids: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """For each query its k best vectors of all blocks: scores, ids, places; and how many block visits that took.

    ``own`` has the place of a query itself, which is no candidate, or -1. Places count over all
    blocks; empty places are -1. Equal scores go to the smaller id.
    """
    n, size = queries.shape
    top = np.array([b.max(axis=0) for b in blocks]).reshape(len(blocks), size)
    low = np.array([b.min(axis=0) for b in blocks]).reshape(len(blocks), size)
    largest = float(np.abs(queries.astype(float)).max(initial=0)) * float(max(np.abs(top.astype(float)).max(initial=0), np.abs(low.astype(float)).max(initial=0)))
    exact = largest * max(size, 1) * 2 < EXACT
    bounds = product(np.maximum(queries, 0), top, exact) + product(np.minimum(queries, 0), low, exact)
    order = np.argsort(-bounds, axis=1, kind="stable")
    starts = np.cumsum([0, *map(len, blocks)])
    lowest = np.iinfo(np.int64).min
    scores = np.full((n, k), lowest)
    names, places = np.full((n, k), np.iinfo(np.int64).max), np.full((n, k), -1)
    active, visits = np.arange(n), 0
    for turn in range(len(blocks)):
        turns = order[active, turn]
        # Equal bounds stay open: a tie may hold a smaller id.
        go = (places[active, k - 1] < 0) | (bounds[active, turns] >= scores[active, k - 1])
        active, turns = active[go], turns[go]
        if not len(active):
            break
        visits += len(active)
        by = np.argsort(turns, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(turns[by])) + 1).tolist(), len(by)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            who, block = active[by[a:b]], int(turns[by[a]])
            found = product(queries[who], blocks[block], exact)
            at = np.arange(starts[block], starts[block + 1])
            # Only queries whose k-th score is reached go on.
            reached = (found >= scores[who, k - 1][:, None]).any(axis=1)
            who, found = who[reached], found[reached]
            itself = own[who, None] == at
            found = np.concatenate([scores[who], np.where(itself, lowest, found)], axis=1)
            name = np.concatenate([names[who], np.broadcast_to(ids[block], itself.shape)], axis=1)
            place = np.concatenate([places[who], np.where(itself, -1, at)], axis=1)
            pick = np.lexsort((place, name, -found, place < 0), axis=1)[:, :k]
            scores[who], names[who], places[who] = (np.take_along_axis(x, pick, axis=1) for x in (found, name, place))
    return scores, names, places, visits


def top_k(df: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """The k best other rows of every query row: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.

    ``queries`` is a condition on ``id``, the key; a query meets all usable rows of as many
    components but itself, also repeated ones and those with its key. Scores are inner products of
    ``floor(scale * x)``; ties go to the smaller key. Fewer candidates than k give fewer rows, an
    empty table none.
    """
    table = block_table(df, key, vector, scale)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                width = 8 * row["size"]
                vectors = [row["vectors"][i * width : (i + 1) * width] for i in range(len(ids))]
                columns = [pa.array([row["size"]] * len(ids), pa.int32()), pa.array([row["chunk"]] * len(ids), pa.int64())]
                columns += [pa.array(row["block"] * BLOCK + np.arange(len(ids)), pa.int32()), pa.array(ids), pa.array(vectors, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["size", "chunk", "at", "id", "vector"])

    asked = table.mapInArrow(chosen, "size int, chunk long, at int, id long, vector binary").where(queries)
    asked = written(asked, "queries")
    counts = asked.groupBy("size").count().collect()  # one row per vector length
    groups = F.lit(1)
    for row in counts:
        groups = F.when(F.col("size") == row["size"], F.lit(-(-row["count"] // GROUP_QUERIES))).otherwise(groups)
    grouped = asked.withColumn("group", F.pmod(F.xxhash64("id", "at"), groups.cast("long")))
    # Every chunk of vectors meets every group of queries: each is sent once per partner, both bounded.
    chunks = table.select("size", "chunk").distinct().groupBy("size").agg(F.collect_list("chunk").alias("to"))
    left = grouped.join(chunks, "size").withColumn("to", F.explode("to"))
    wanted = grouped.select("size", "group").distinct().groupBy("size").agg(F.collect_list("group").alias("groups"))
    right = table.join(wanted, "size").withColumn("group", F.explode("groups")).withColumnRenamed("chunk", "to").drop("groups")

    def meet(asking: pa.Table, having: pa.Table) -> pa.Table:
        if not asking.num_rows or not having.num_rows:
            return pa.Table.from_pylist([], schema=HIT_SCHEMA)
        size, to = asking.column("size")[0].as_py(), having.column("to")[0].as_py()
        rows = having.sort_by("block")
        ids = [np.frombuffer(x, np.int64) for x in rows.column("ids").to_pylist()]
        blocks = [np.frombuffer(x, np.int64).reshape(len(i), size) for x, i in zip(rows.column("vectors").to_pylist(), ids, strict=True)]
        vectors = np.frombuffer(b"".join(asking.column("vector").to_pylist()), np.int64).reshape(asking.num_rows, size)
        chunk, at = asking.column("chunk").to_numpy(), asking.column("at").to_numpy()
        first = int(rows.column("block")[0].as_py()) * BLOCK
        scores, names, places, _ = best(vectors, np.where(chunk == to, at - first, -1), blocks, ids, k)
        hit = places >= 0
        who = np.nonzero(hit)[0]
        columns = [chunk[who], at[who], asking.column("id").to_numpy()[who], names[hit], scores[hit], (places[hit] + first)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, HIT_SCHEMA, strict=True)], schema=HIT_SCHEMA)

    hits = left.groupBy("size", "to", "group").cogroup(right.groupBy("size", "to", "group")).applyInArrow(meet, HITS)
    order = W.partitionBy("query_id", "query_chunk", "query_at").orderBy(F.desc("score"), "vec_id", "at")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


HIT_SCHEMA = pa.schema(
    [("query_chunk", pa.int64()), ("query_at", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("at", pa.int64())]
)
