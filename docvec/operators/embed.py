"""Texts to vectors.

An embedder is a column expression: text in, float array out, so a vector stays on the row
of its text and nothing has to be paired afterwards. The model runs in Arrow batches.
"""

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docvec.cluster import written
from docvec.functions.batches import values
from docvec.functions.numbers import whole_quotient
from docvec.operators import usage

Model = Callable[[list[str]], Sequence[Sequence[float]]]

# Model name, default size, whether another size may be asked for, allowed
# sizes, price per token.
MODELS = (
    ("text-embedding-3-small", 1024, True, [256, 512, 1024, 1536], 0.00000002),
    ("jina-v2-base", 768, False, [768], 0.0000001),
    ("text-embedding-ada-002", 1536, False, [1536], 0.0000001),
    ("text-embedding-3-large", 1024, True, [256, 1024, 3072], 0.00000013),
)
# Texts per request, by kind of model service.
REQUEST_BATCH = {"openai": 10, "hosted": 100, "gateway": 16}
# Chunks handed on together.
CHUNK_BATCH = 1000
HASH_DIM = 64
# A worker remembers the buckets of this many distinct tokens; more are computed again.
TOKENS_KEPT = 200_000


def models(spark: SparkSession) -> DataFrame:
    """The known models as literals, so that Spark sees how small they are when it joins them."""
    names = ("model", "default_dims", "override", "allowed", "price")
    rows = [
        F.struct(*[(F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)).alias(n) for n, v in zip(names, m)])
        for m in MODELS
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def hash_embedder(text: Column, dim: int = HASH_DIM) -> Column:
    """Counts of hashed words, scaled to length 1; a text without words gives zeros.

    A word is a run of ASCII letters, digits and any non-ASCII characters, in lower case.
    Its bucket is the first 32 bits of its MD5 modulo ``dim``.
    """

    class Buckets(dict):
        """Bucket of each word seen."""

        def __missing__(self, word: str) -> int:
            bucket = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dim
            if len(self) < TOKENS_KEPT:
                self[word] = bucket
            return bucket

    def count(texts: list[str | None], words: re.Pattern, buckets: Buckets) -> np.ndarray:
        """One row of counts per text."""
        hits: list[int] = []
        sizes = []
        for text in texts:
            found = words.findall(text.lower()) if text else ()
            hits.extend(map(buckets.__getitem__, found))
            sizes.append(len(found))
        cells = np.repeat(np.arange(len(texts)) * dim, sizes) + np.asarray(hits, dtype=np.int64)
        return np.bincount(cells, minlength=len(texts) * dim).reshape(len(texts), dim)

    @F.arrow_udf("array<float>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = re.compile("[0-9a-z\u0080-\U0010ffff]+")
        buckets = Buckets()
        for batch in batches:
            counts = count(values(batch), words, buckets)
            lengths = np.sqrt((counts * counts).sum(axis=1, keepdims=True, dtype=np.float64))
            unit = np.divide(counts, lengths, out=np.zeros(counts.shape), where=lengths > 0)
            offsets = np.arange(0, counts.size + dim, dim, dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(unit.ravel().astype(np.float32)))

    return run(text)


def model_embedder(text: Column, model: Model, dim: int, batch_size: int = 100, strict: bool = True) -> Column:
    """Vectors of the caller's ``model``, called with up to ``batch_size`` texts in order.

    A reply of another length, or a vector of another size than ``dim``, is an error.
    Null texts are not sent and have no vector. If not strict, the texts of a call that fails are
    sent again one by one, and those that fail alone have no vector.
    """

    def asked(texts: list[str]) -> list[np.ndarray]:
        reply = model(texts)
        if len(reply) != len(texts):
            raise ValueError(f"sent {len(texts)} texts, received {len(reply)} vectors")
        for vector in reply:
            if len(vector) != dim:
                raise ValueError(f"expected {dim} values per vector, received {len(vector)}")
        return [np.asarray(v, dtype=np.float32) for v in reply]

    def one_by_one(texts: list[str]) -> list:
        found: list = []
        for t in texts:
            try:
                found += asked([t])
            except Exception:
                found.append(None)
        return found

    check_batch_size(batch_size)

    @F.arrow_udf("array<float>")
    def run(batch: pa.Array) -> pa.Array:
        values = batch.to_pylist()
        at = [i for i, v in enumerate(values) if v is not None]
        out: list = [None] * len(values)
        for start in range(0, len(at), batch_size):
            part = at[start : start + batch_size]
            texts = [values[i] for i in part]
            try:
                found = asked(texts)
            except Exception:
                if strict:
                    raise
                found = one_by_one(texts)
            for i, vector in zip(part, found):
                out[i] = vector
        return pa.array(out, type=pa.list_(pa.float32()))

    return run(text)


def embed(docs: DataFrame, vector: Column, column: str = "vector") -> DataFrame:
    """Documents with their vector and their token count."""
    tokens = usage.token_count(F.col("content"))
    return docs.withColumns({column: vector, "prompt_tokens": tokens, "total_tokens": tokens})


def pair_by_id(chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    """Chunks with vectors that arrive as a table of (id, vector)."""
    return chunks.join(vectors.select("id", "vector"), "id")


def check_batch_size(n: int) -> None:
    if not isinstance(n, int) or isinstance(n, bool):
        raise TypeError("batch size must be an integer")
    if n == 0:
        raise ZeroDivisionError("batch size must not be zero")
    if n < 0:
        raise ValueError("batch size must not be negative")


def numbered(df: DataFrame, group: Sequence[str], order: str) -> DataFrame:
    """Add ``row_number``, from 1, by the unique integer ``order`` within ``group``.

    Rows are dealt out by ranges of group and order, so that a group of any size, and any spacing
    of the order, is spread over many tasks. Each task numbers its own rows of a group, and what
    comes before them is known from a table of one row per group and task.
    """
    group = list(group)
    placed = df.repartitionByRange(*group, order).withColumn("_part", F.spark_partition_id())
    placed = written(placed, "numbered")  # both uses below must see the same parts
    earlier = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sizes = placed.groupBy(*group, "_part").agg(F.count("*").alias("_n"))
    offsets = sizes.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col("_part").alias("_p"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
    matched = placed.join(offsets, [*same, F.col("_part") == F.col("_p")])
    within = F.row_number().over(W.partitionBy(*group, "_part").orderBy(order))
    return matched.withColumn("row_number", (within + F.col("_before")).cast("bigint")).select(
        *df.columns, "row_number"
    )


def batches(df: DataFrame, group: Sequence[str], order: str, n: int = CHUNK_BATCH) -> DataFrame:
    """Number consecutive batches of ``n`` rows per group from 1; the last may be short."""
    check_batch_size(n)
    batch = whole_quotient(F.col("row_number") - 1, n) + 1
    return numbered(df, group, order).withColumn("batch", batch)


def content_batches(df: DataFrame, group: Sequence[str], order: str, content: str, n: int) -> DataFrame:
    """One row per batch with its texts in order; a batch has at most ``n`` of them."""
    rows = batches(df, group, order, n)
    items = F.array_sort(F.collect_list(F.struct("row_number", content)))
    return rows.groupBy(*group, "batch").agg(
        F.count("*").alias("items"), F.transform(items, lambda x: x[content]).alias("contents")
    )


def resolve_dims(requests: DataFrame, known: DataFrame) -> DataFrame:
    """Add ``dims`` and ``error`` to requests of (model, dims).

    An unknown model, a size the model does not let you choose, and a size it does not have
    are errors; without a size the model's default counts.
    """
    asked = F.col("requested")
    table = known.select(
        F.col("model").alias("_model"), "default_dims", "override", "allowed"
    )
    rows = requests.withColumnRenamed("dims", "requested").join(
        table, F.col("model") == F.col("_model"), "left"
    )
    error = (
        F.when(F.col("_model").isNull(), "unknown model")
        .when(asked.isNull(), None)
        .when(~F.col("override") & (asked != F.col("default_dims")), "dimensions cannot be changed")
        .when(~F.array_contains("allowed", asked), "dimensions not supported")
    )
    return (
        rows.withColumn("error", error)
        .withColumn("dims", F.when(F.col("error").isNull(), F.coalesce(asked, F.col("default_dims"))))
        .select(*[c for c in requests.columns if c != "dims"], "requested", "dims", "error")
    )
