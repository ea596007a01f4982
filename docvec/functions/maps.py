"""Map columns: picking keys and merging with a clear winner."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY = "cast(map() as map<string,string>)"


def empty_map() -> Column:
    return F.expr(EMPTY)


def or_empty(m: Column) -> Column:
    return F.coalesce(m, empty_map())


def pick(m: Column, keys: list[str]) -> Column:
    """Only the entries of ``m`` whose key is listed."""
    return F.map_filter(m, lambda k, _: k.isin(list(keys)))


def merge(*maps: Column) -> Column:
    """One map of all entries; on equal keys the later map wins."""

    def two(left: Column, right: Column) -> Column:
        kept = F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k))
        return F.map_concat(kept, right)

    return reduce(two, [or_empty(m) for m in maps])


def from_columns(columns: dict[str, Column]) -> Column:
    """A map of named values as text; a null value keeps its key."""
    if not columns:
        return empty_map()
    return F.create_map(*[x for k, c in columns.items() for x in (F.lit(k), c.cast("string"))])
