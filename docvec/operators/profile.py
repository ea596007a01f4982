"""Profiles of tables, for choosing what to embed and what to filter by."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvec.functions import text as tx

EXAMPLES = 2
# The start of a profile text.
TITLE = "Columns (Properties): "


def sample_text(df: DataFrame, order: Sequence[str], columns: Sequence[str] | None = None, n: int = EXAMPLES) -> DataFrame:
    """One row of text: the column names and the first ``n`` rows by ``order``."""
    names = list(columns or df.columns)
    cells = [F.concat(F.lit(f"{c}: "), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("null"))) for c in names]
    head = ", ".join(names)
    return _as_text(df.orderBy(*order).limit(n), order, F.concat_ws(", ", *cells), F.lit(head), f"{TITLE}{head}\n")


def json_sample_text(df: DataFrame, column: str, order: Sequence[str], n: int = EXAMPLES) -> DataFrame:
    """The same for a JSON column: the first object's keys, and the first ``n`` objects."""
    entries = F.map_entries(F.from_json(column, "map<string,string>"))
    cells = F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("null"))))
    keys = F.transform(entries, lambda e: e["key"])
    first = df.orderBy(*order).limit(n)
    return _as_text(first, order, F.array_join(cells, ", "), F.array_join(keys, ", "))


def _as_text(first: DataFrame, order: Sequence[str], row: Column, head: Column, empty: str = "") -> DataFrame:
    """Ordered rows as one text under a head line taken from the first of them, or ``empty``."""
    rows = F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("at"), row.alias("text"), head.alias("head"))))
    lines = F.transform(
        "_rows", lambda r, i: F.concat(F.lit("Row "), (i + 1).cast("string"), F.lit(": "), r["text"], F.lit("\n"))
    )
    top = F.concat(F.lit(TITLE), F.get(F.col("_rows"), 0)["head"], F.lit("\n"))
    whole = F.concat(top, F.lit("Example Rows:\n"), F.array_join(lines, ""))
    return first.agg(rows.alias("_rows")).select(F.coalesce(whole, F.lit(empty)).alias("text"))


def metadata_fields(df: DataFrame) -> list[str]:
    """Columns that can serve as metadata."""
    return list(df.columns)


def json_fields(df: DataFrame, column: str) -> DataFrame:
    """Distinct top-level keys of a JSON column; values that are no object have none."""
    return df.select(F.explode(F.json_object_keys(column)).alias("field")).distinct()


def column_profile(
    df: DataFrame, columns: Sequence[str] | None = None, exact: bool = False, rsd: float = 0.05
) -> DataFrame:
    """One row per column: rows, nulls, distinct values, mean length and mean words.

    All columns are measured in one pass. Distinct values are estimated with ``rsd``
    relative error unless ``exact``; then they are counted by a 128-bit hash, one column at a time,
    so that no text is shuffled and no row is copied once per column.
    """
    names = list(columns or df.columns)
    measures: list[Column] = []
    for i, name in enumerate(names):
        c = F.col(f"`{name}`").cast("string")
        distinct = F.lit(0).cast("bigint") if exact else F.approx_count_distinct(c, rsd)
        measures.append(
            F.struct(
                F.lit(name).alias("name"),
                F.count("*").alias("n_rows"),
                F.count_if(c.isNull()).alias("n_null"),
                distinct.alias("n_distinct"),
                F.avg(F.length(c)).alias("mean_length"),
                F.avg(tx.word_count(c)).alias("mean_words"),
            ).alias(f"_{i}")
        )
    one = df.agg(*measures)
    found = one.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(names))])))
    if not exact:
        return found
    hashed = [F.md5(F.col(f"`{name}`").cast("string").cast("binary")) for name in names]
    counts = [
        df.select(h.alias("h")).where("h IS NOT NULL").distinct().agg(F.count("*").alias("_d")).select(F.lit(name).alias("name"), "_d")
        for h, name in zip(hashed, names)
    ]
    exactly = reduce(lambda a, b: a.unionByName(b), counts)
    return found.join(exactly, "name").withColumn("n_distinct", F.col("_d")).drop("_d")


def fields_to_embed(profile: DataFrame, min_words: float = 2.0, min_distinct: float = 0.1) -> DataFrame:
    """Columns of running, mostly different texts are worth embedding; the rest are filters."""
    ratio = F.col("n_distinct") / F.greatest(F.col("n_rows") - F.col("n_null"), F.lit(1))
    wanted = (F.col("mean_words") >= min_words) & (ratio >= min_distinct)
    return profile.withColumn("embed", F.coalesce(wanted, F.lit(False)))


def attribute_info(df: DataFrame, columns: Sequence[str] | None = None, width: int = 40) -> DataFrame:
    """Name, description with a short example, and type of each column.

    The example is the smallest non-null value, so it does not change from run to run.
    """
    types = dict(df.dtypes)
    names = list(columns or df.columns)
    examples = df.agg(*[F.min(F.col(f"`{c}`").cast("string")).alias(f"_{i}") for i, c in enumerate(names)])
    rows = [
        F.struct(
            F.lit(name).alias("name"),
            F.concat(
                F.lit(f"{name} of type {types[name]}, for example "),
                F.coalesce(F.substring(F.col(f"_{i}"), 1, width), F.lit("null")),
            ).alias("description"),
            F.lit(types[name]).alias("type"),
        )
        for i, name in enumerate(names)
    ]
    return examples.select(F.inline(F.array(*rows)))
