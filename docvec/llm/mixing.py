"""Mixing sources to target weights by entropy balancing.

The mix takes document d ``w`` times. Among all rates with ``0 <= w <= most`` whose tokens add up
to each source's target, it looks for those nearest to one copy of each in relative entropy. They
are ``w = min(most, exp(tilt * size / mean size))``: each source has one dual variable, its tilt,
that Newton's method finds. All sums run over counts per source and size, exact in decimals, so
reruns agree to the last bit. Rates become whole copies by running sums along each source's
documents in order of size, which keeps each source within a few documents of its target.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docvec.cluster import written
from docvec.llm.kernels import set_aside

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
ROUNDS = 60
# Rates are whole multiples of 1 / UNIT, so that their sums are exact.
UNIT = 1 << 24
NEAR = 1e-9


def size_of(text: Column) -> Column:
    """The number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(cells: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``source``, ``source_size``, ``target``, from cells of ``source``, ``size`` and ``n``.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` times all
    sizes. A target stops at ``most`` times its source's size; what it can't take is reshared by
    weight. The sources that stop are those with the least room per weight, so one pass over the
    sources in that order finds the level at which the rest stand.
    """
    sizes = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    numbered = sizes.withColumn("turn", F.row_number().over(W.orderBy(F.asc_nulls_last("source"))) - 1)
    choose = F.element_at(F.array(*map(F.lit, weights)), (F.col("turn") % len(weights) + 1).cast("int"))
    weighed = numbered.select("source", "source_size", choose.alias("weight"), (F.col("source_size") * F.lit(most)).alias("room"))
    by_room = W.orderBy(F.col("room") / F.col("weight"), F.asc_nulls_last("source"))
    behind = by_room.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    # If this source and all with more room per weight stood at one level, it would be this.
    left = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("room").over(behind), F.lit(0.0))
    level = left / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(behind), F.lit(0.0)))
    leveled = weighed.withColumn("level", level)
    # The first source in that order whose room reaches its level sets it for all after it.
    final = F.min(F.when(F.col("room") >= F.col("level") * F.col("weight"), F.struct(F.col("room") / F.col("weight"), F.col("level")))).over(everything)
    return leveled.select("source", "source_size", F.least("room", F.coalesce(final["level"], F.lit(float("inf"))) * F.col("weight")).alias("target"))


def tilts(cells: DataFrame, aims: DataFrame, most: float, rounds: int) -> DataFrame:
    """``source``, ``source_size``, ``target``, ``mean`` and ``tilt``.

    Every round adds up the tokens and their slope under the tilts of the round before, over all
    cells, and moves each source's tilt by a Newton step, or to the middle of its bounds where the
    step would leave them. Rounds end when all sources are within a billionth of their targets.
    """
    stats = cells.where(F.col("size") > 0).groupBy("source").agg(
        F.min("size").alias("least"), (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean")
    )
    ratio = F.col("target") / F.col("source_size")
    # At high every document of the source is at the most, at low none is above the ratio.
    state = aims.join(stats, aims["source"].eqNullSafe(stats["source"])).drop(stats["source"])
    state = state.withColumns(
        {
            "low": F.least(F.lit(0.0), F.log(ratio) * F.col("mean") / F.col("least")),
            "high": F.greatest(F.lit(0.0), F.log(F.lit(most)) * F.col("mean") / F.col("least")),
            "tilt": F.when(ratio >= most, F.log(F.lit(most)) * F.col("mean") / F.col("least")).otherwise(F.lit(0.0)),
            "done": ratio >= most,
        }
    )
    state = written(state, "tilts")
    for _ in range(rounds):
        joined = cells.where(F.col("size") > 0).alias("c").join(state.where(~F.col("done")).alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")))
        if state.where(~F.col("done")).isEmpty():
            break
        z = F.col("size") / F.col("mean")
        raw = F.exp(F.least(F.col("tilt") * z, F.lit(50.0)))
        tokens = F.col("n") * F.col("size") * F.least(raw, F.lit(most))
        slope = F.when(raw < most, F.col("n") * F.col("size") * z * raw).otherwise(0.0)
        sums = joined.groupBy(F.col("c.source").alias("of")).agg(
            F.sum(tokens.cast("decimal(38,9)")).cast("double").alias("tokens"), F.sum(slope.cast("decimal(38,9)")).cast("double").alias("slope")
        )
        next_state = state.join(sums, state["source"].eqNullSafe(sums["of"]), "left").drop("of")
        gap = F.col("target") - F.col("tokens")
        near = F.coalesce(F.abs(gap) <= F.greatest(F.col("target") * NEAR, F.lit(1e-6)), F.lit(True))
        low, high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("low")), F.when(gap < 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") + F.try_divide(gap, F.col("slope"))
        inside = F.coalesce((step > low) & (step < high), F.lit(False))
        moved = F.when(F.col("done") | near, F.col("tilt")).when(inside, step).otherwise((low + high) / 2)
        state = written(
            next_state.select(
                "source", "source_size", "target", "least", "mean",
                F.when(F.col("done"), F.col("low")).otherwise(low).alias("low"),
                F.when(F.col("done"), F.col("high")).otherwise(high).alias("high"),
                moved.alias("tilt"),
                (F.col("done") | near).alias("done"),
            ),
            "tilts",
        )
    return state


def mix(df: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", weights: Sequence[float] = WEIGHTS, share: float = SHARE,
        most: float = MOST, rounds: int = ROUNDS, keep: Sequence[str] = ()) -> DataFrame:
    """For each row ``source_size``, ``target`` (its source's), ``rate`` and ``copies``, with ``size``, the key and ``keep``.

    A null source is a source of its own; a null or empty text has size 0 and is taken as often as
    its rate of 1 says. Equal keys and repeated rows count as documents of their own. ``copies`` is
    a whole number, at most ``most`` rounded up. An empty table gives an empty mix. Columns that
    are neither the key nor in ``keep`` are dropped.
    """
    rows = df.select(*{key, *keep}, F.col(source).alias("mix_source"), size_of(F.col(text)).alias("size"))
    # Documents in one order over all tasks: by source and size, then by a hash. A hot source or
    # size takes several tasks, because the hash splits it.
    order = [F.asc_nulls_last("mix_source"), F.asc("size"), F.asc("spot"), F.asc_nulls_first(key)]
    spotted = rows.withColumn("spot", F.xxhash64(F.col(key).cast("string"), F.lit("mix")))
    placed = written(spotted.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), "mix")
    cells = written(placed.groupBy(F.col("mix_source").alias("source"), "size").agg(F.count("*").alias("n")), "cells")
    aims = targets(cells, weights, share, most)
    solved = tilts(cells, written(aims, "targets"), most, rounds)
    known = aims.alias("a").join(solved.select("source", "mean", "tilt").alias("t"), F.col("a.source").eqNullSafe(F.col("t.source")), "left")
    known = written(known.select("a.source", "source_size", "target", "mean", "tilt"), "solved")
    rate = F.when(F.col("size") > 0, F.least(F.lit(most), F.exp(F.least(F.lit(50.0), F.col("tilt") * F.col("size") / F.col("mean"))))).otherwise(F.lit(1.0))
    rated = placed.join(known, placed["mix_source"].eqNullSafe(known["source"])).drop("source").withColumn("parts", F.round(rate * UNIT).cast("long"))
    # The running sum of the rates along that order: within a task's rows, and before them.
    totals = rated.groupBy("mix_source", "part").agg(F.sum("parts").alias("sum"))
    ahead = W.partitionBy("mix_source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(F.col("mix_source").alias("of"), F.col("part").alias("at"), F.coalesce(F.sum("sum").over(ahead), F.lit(0)).alias("offset"))
    inner = W.partitionBy("mix_source", "part").orderBy("size", "spot", key).rowsBetween(W.unboundedPreceding, 0)
    run = rated.withColumn("run", F.sum("parts").over(inner))
    whole = run.join(offsets, run["mix_source"].eqNullSafe(offsets["of"]) & (run["part"] == offsets["at"]))
    end = F.col("offset") + F.col("run") + UNIT // 2
    copies = F.floor(end / UNIT) - F.floor((end - F.col("parts")) / UNIT)
    return whole.select(*{key, *keep}, "size", "source_size", "target", (F.col("parts") / UNIT).alias("rate"), copies.cast("long").alias("copies"))


def repeat(df: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", **options) -> DataFrame:
    """The mix itself: each row of ``df`` as often as ``mix`` takes it, all columns as they are.

    Rows that repeat a key with the same text are taken together. Texts move once, to meet their
    number of copies.
    """
    df, given = set_aside(df, text, source, key)
    rows = df.select("*", F.xxhash64(text).alias("row_hash"))
    taken = mix(rows, text, source, key, keep=["row_hash"], **options).groupBy(key, "row_hash").agg(F.sum("copies").alias("row_copies"))
    taken = taken.where("row_copies > 0").select(F.col(key).alias("row_key"), F.col("row_hash").alias("taken_hash"), "row_copies")
    here = F.col(key).eqNullSafe(F.col("row_key")) & (F.col("row_hash") == F.col("taken_hash"))
    met = rows.join(taken, here).drop("row_key", "taken_hash").dropDuplicates([key, "row_hash"])
    return given(met.withColumn("row_copies", F.explode(F.sequence(F.lit(1), F.col("row_copies")))))
