"""A copy of a vector table for exact searches that read a part of it.

Rows lie in cells of nearby directions, and in a cell by their angle to its centre. By the triangle
inequality a row whose angle to the centre is a and a query at the angle t from it are at least
|t - a| apart. So once ``k`` rows are known, only rows with angles close to t can be better, which
is a range on a stored column: cells, files and row groups outside of it are not read. Keys of the
metadata that filters use are columns of their own, so filters reach the scan as well.
"""

import json
import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docvec.cluster import written
from docvec.functions import filters as flt
from docvec.operators import search as full

# Rows that a cell has on average, cells at most, values of the sample that centres are learned from, and its rounds.
CELL_ROWS, MAX_CELLS, SAMPLE_VALUES, ROUNDS = 5_000, 1024, 4_000_000, 10
# Cells of the first reading; each further one takes so many times as many.
FIRST_CELLS, GROWTH = 1, 4
# The cell of rows without a direction of the index's size: null, another size, zeros, no numbers. It is always read.
OTHER = -1
# Radians by which rounding may move an angle.
MARGIN = 3e-6
# Bytes of a row group, few enough that a range of angles leaves some out.
GROUP_BYTES = 2 << 20


def centres(vectors: DataFrame, dim: int, rows: int, cells: int) -> np.ndarray:
    """Directions in the middle of groups of a sample of rows, chosen by hash and bounded in values.

    The sample only decides how well cells fit, not what a search finds.
    """
    most = max(1, SAMPLE_VALUES // dim)
    share = min(1.0, most / max(1, rows))
    chosen = vectors.where((F.size("vector") == dim) & (F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < math.ceil(share * (1 << 20))))
    arrays = chosen.select("vector").limit(2 * most).toArrow()["vector"].combine_chunks()
    good = pa.array(full.usable(arrays, dim))
    found = full.unit_rows(full.matrix(arrays.filter(good), dim))
    found = found[np.isfinite(found).all(axis=1) & found.any(axis=1)]
    if not len(found):
        return np.zeros((0, dim))
    random = np.random.default_rng(0)
    middle = found[random.choice(len(found), min(cells, len(found)), replace=False)]
    for _ in range(ROUNDS):
        nearest = np.concatenate([np.argmax(found[part] @ middle.T, axis=1) for part in full.blocks(len(found), len(middle))])
        sums = np.zeros_like(middle)
        np.add.at(sums, nearest, found)
        used = np.bincount(nearest, minlength=len(middle)) > 0
        middle = full.unit_rows(np.where(used[:, None], sums, middle))
    return np.unique(middle[middle.any(axis=1)], axis=0)


def column_of(key: str) -> str:
    """The name of a metadata key's column, as filters look for it."""
    return f"metadata.{key}"


def build(vectors: DataFrame, path: str, keys: Sequence[str] = (), cell_rows: int = CELL_ROWS, max_cells: int = MAX_CELLS) -> None:
    """Write the copy of ``vectors`` (``id``, ``vector``, ``metadata`` and more) below ``path``.

    Every row is kept with all its columns. ``keys`` of the metadata become columns. The size of
    most vectors is that of the index; rows of other sizes are found too. The copy is of the table
    as it is now: build it again, at another path, after writes.
    """
    spark = vectors.sparkSession
    sizes = vectors.groupBy(F.size("vector").alias("dim")).count().where("dim > 0").orderBy(F.desc("count"), "dim").first()
    dim, rows = (sizes["dim"], sizes["count"]) if sizes else (1, 0)
    middle = centres(vectors, dim, rows, min(max_cells, max(1, rows // cell_rows)))
    shared = spark.sparkContext.broadcast(middle)

    @F.arrow_udf("struct<cell:int,angle:double>")
    def placed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        middle = shared.value
        for batch in batches:
            cell, angle = np.full(len(batch), OTHER, np.int32), np.zeros(len(batch))
            valid = np.flatnonzero(full.usable(batch, dim)) if len(middle) else np.empty(0, np.int64)
            found = full.matrix(batch.take(pa.array(valid)), dim)
            for part in full.blocks(len(found), max(middle.shape, default=1)):
                unit = full.unit_rows(found[part])
                sound = np.isfinite(unit).all(axis=1) & unit.any(axis=1)
                cosines = unit[sound] @ middle.T
                place = valid[part][sound]
                cell[place] = np.argmax(cosines, axis=1)
                angle[place] = np.arccos(np.clip(cosines.max(axis=1), -1, 1))
            yield pa.StructArray.from_arrays([pa.array(cell), pa.array(angle)], ["cell", "angle"])

    named = {column_of(k): F.col("metadata")[k] for k in keys}
    held = vectors.withColumns(named).withColumn("_at", placed("vector")).withColumns({"cell": F.col("_at.cell"), "angle": F.col("_at.angle")}).drop("_at")
    ordered = held.repartitionByRange("cell", "angle", F.xxhash64("id")).sortWithinPartitions("cell", "angle")
    ordered.write.option("parquet.block.size", GROUP_BYTES).partitionBy("cell").parquet(f"{path}/rows")
    spark.range(1).select(F.lit(ordered.schema.json())).coalesce(1).write.text(f"{path}/schema")
    stats = read(spark, path).groupBy("cell").agg(F.count("*").alias("n"), F.min("angle").alias("least"), F.max("angle").alias("most"))
    schema = "cell int, centre array<double>"
    known = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(middle)], schema)
    stats.join(F.broadcast(known), "cell", "left").coalesce(1).write.parquet(f"{path}/cells")


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the copy, with ``cell`` and ``angle``."""
    schema = T.StructType.fromJson(json.loads(spark.read.text(f"{path}/schema").first()[0]))
    return spark.read.schema(schema).parquet(f"{path}/rows")


class Cells:
    """The cells of an index, at most ``MAX_CELLS`` and the others' one, and how far a query is from each."""

    def __init__(self, spark: SparkSession, path: str, query: Sequence[float]):
        rows = spark.read.parquet(f"{path}/cells").collect()
        target = full.unit_rows(np.asarray([query], dtype=np.float32))[0]
        self.directed = bool(np.isfinite(target).all() and target.any())
        own = [r for r in rows if r["cell"] != OTHER and len(r["centre"]) == len(target)]
        self.total = sum(r["n"] for r in rows)
        # Vectors of another size than the query's are no hits.
        self.others = [r["cell"] for r in rows if r["cell"] == OTHER]
        self.cell = np.array([r["cell"] for r in own], dtype=np.int64)
        self.least, self.most = np.array([r["least"] for r in own]), np.array([r["most"] for r in own])
        centre = np.array([r["centre"] for r in own]).reshape(len(own), len(target))
        self.theta = np.arccos(np.clip(centre @ target, -1, 1)) if self.directed else np.zeros(len(own))
        # No row of the cell is nearer to the query than this.
        self.bound = np.maximum(0, np.maximum(self.theta - self.most, self.least - self.theta)) if self.directed else np.zeros(len(own))

    def reach(self, worst: float | None) -> float:
        """The angle beyond which no row is as good as ``worst``, the k-th score so far."""
        if worst is None or not self.directed:
            return math.inf
        return math.acos(min(1.0, max(-1.0, worst - 2 * 10.0**-full.DECIMALS))) + MARGIN

    def within(self, chosen: np.ndarray, reach: float):
        """The predicate of the rows in these cells that may be as near as ``reach``."""
        cells = F.col("cell").isin(self.cell[chosen].tolist())
        if math.isinf(reach):
            return cells
        low, high = self.theta[chosen] - reach, self.theta[chosen] + reach
        number = int(self.cell.max()) + 1
        lows, highs = np.full(number, math.inf), np.full(number, -math.inf)
        lows[self.cell[chosen]], highs[self.cell[chosen]] = low, high
        own = [F.get(F.array(*map(F.lit, x.tolist())), F.col("cell")) for x in (lows, highs)]
        return cells & F.col("angle").between(float(low.min()), float(high.max())) & F.col("angle").between(*own)


def search(
    spark: SparkSession, path: str, query: Sequence[float], k: int, filters: list[dict] | None = None, seen: dict | None = None
) -> DataFrame:
    """The ``k`` nearest rows that pass all filters, as ``search.search`` over the whole table gives them.

    Cells are read nearest first, each time ``GROWTH`` times as many, within the reach that the
    k-th score so far leaves; it ends when no cell is in reach. The driver holds the cells and ``k``
    scores. ``seen`` gets ``scored``, the rows that were compared with the query, ``total`` and ``rounds``.
    """
    cells = Cells(spark, path, query)
    rows = flt.apply(read(spark, path), filters)
    order = np.argsort(cells.bound, kind="stable")
    kept, worst, scored, rounds, size = None, None, 0, 0, FIRST_CELLS
    while True:
        reach = cells.reach(worst)
        order = order[cells.bound[order] <= reach]
        now, order = order[:size], order[size:]
        parts = [cells.within(now, reach)] if len(now) else []
        if not rounds and cells.others:
            parts.append(F.col("cell") == OTHER)
        if not parts and rounds:
            break
        watch = Observation()
        candidates = rows.where(reduce(lambda a, b: a | b, parts, F.lit(False))).observe(watch, F.count("*").alias("n"))
        found = full.hits(candidates, full.cosine_to(F.col("vector"), query)).where(F.col("score").isNotNull())
        both = found if kept is None else kept.unionByName(found)
        kept = written(both.orderBy(F.desc("score"), "id").limit(k), "nearest")
        best = kept.agg(F.count("*").alias("n"), F.min("score").alias("worst")).first()
        worst = best["worst"] if best["n"] >= k > 0 else None
        scored, rounds, size = scored + watch.get["n"], rounds + 1, size * GROWTH
    if seen is not None:
        seen.update(scored=scored, total=cells.total, rounds=rounds)
    return kept.orderBy(F.desc("score"), "id")
