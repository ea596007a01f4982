"""The filter language: a list of {field, operator, value} becomes one predicate.

Where a field is a top-level column, the literal takes the column's type, so the predicate
reaches the Parquet scan. Fields of the metadata map are ``metadata.<key>`` or, when no
column has the name, the plain key; their values are text. A column named ``metadata.<key>`` stands
for that key, so its predicates reach the scan too.
"""

import json
import re
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Operator names and their signs.
OPERATORS = {
    "EQUAL": "=",
    "NOT_EQUAL": "!=",
    "LESS_THAN": "<",
    "LESS_THAN_OR_EQUAL": "<=",
    "GREATER_THAN": ">",
    "GREATER_THAN_OR_EQUAL": ">=",
    "IN": "IN",
    "NOT_IN": "NOT IN",
    "BETWEEN": "BETWEEN",
    "NOT_BETWEEN": "NOT BETWEEN",
    "LIKE": "LIKE",
    "NOT_LIKE": "NOT LIKE",
    "IS_NULL": "IS NULL",
    "IS_NOT_NULL": "IS NOT NULL",
    "MATCH": "MATCH",
}
NUMBER = re.compile(r"[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?")


def operator_name(operator: str) -> str:
    """The name of an operator given by name or sign, in any case."""
    wanted = operator.strip().upper()
    for name, sign in OPERATORS.items():
        if wanted in (name, sign):
            return name
    raise ValueError(f"not a filter operator: {operator}; supported are {', '.join(OPERATORS)}")


def _field(df: DataFrame, field: str) -> tuple[Column, T.DataType]:
    by_name = {f.name: f.dataType for f in df.schema.fields}
    if field in by_name:
        return F.col(f"`{field}`"), by_name[field]
    key = field.removeprefix("metadata.")
    if f"metadata.{key}" in by_name:  # a key of the metadata that has a column of its own
        return F.col(f"`metadata.{key}`"), by_name[f"metadata.{key}"]
    if isinstance(by_name.get("metadata"), T.MapType):
        return F.col("metadata")[key], T.StringType()
    raise ValueError(f"no column and no metadata for field {field!r}")


def _operands(column: Column, kind: T.DataType, values: list, ranged: bool) -> tuple[Column, list[Column]]:
    """Column and literals in the type they compare in.

    Columns stay bare, so that a predicate reaches the scan; only in a range does text compare as
    numbers, if every literal is one. Literals of whole and decimal columns never go through a
    float.
    """
    texts = [v if isinstance(v, str) else json.dumps(v) for v in values]
    numeric = all(NUMBER.fullmatch(t.strip()) for t in texts)
    if isinstance(kind, T.NumericType):
        if not numeric:
            raise ValueError(f"not a number: {texts}")
        if isinstance(kind, T.FloatType | T.DoubleType):
            return column, [F.lit(float(t)) for t in texts]
        return column, [_exact(t) for t in texts]
    if isinstance(kind, T.StringType) and numeric and ranged:
        # Twenty digits before the point and eighteen behind it; beyond them, and for huge or tiny
        # literals, doubles.
        if all(abs(Decimal(t.strip())) < Decimal(10) ** 20 and Decimal(t.strip()).as_tuple().exponent >= -18 for t in texts):
            return column.try_cast("decimal(38,18)"), [F.lit(Decimal(t.strip())) for t in texts]
        return column.try_cast("double"), [F.lit(float(t)) for t in texts]
    if isinstance(kind, T.StringType):
        return column, [F.lit(t) for t in texts]
    return column, [F.lit(t).cast(kind) for t in texts]


def _exact(text: str) -> Column:
    """A literal for whole and decimal columns; one that no decimal holds is a double."""
    value = Decimal(text.strip())
    if value == value.to_integral_value() and abs(value) < 1 << 63:
        return F.lit(int(value))
    digits = value.as_tuple()
    if len(digits.digits) <= 38 and -38 <= digits.exponent <= 0:
        return F.lit(value)
    return F.lit(float(value))


def _list(value, size: int | None = None) -> list:
    values = json.loads(value) if isinstance(value, str) else list(value)
    if not isinstance(values, list) or (size and len(values) != size):
        raise ValueError(f"expected a list{f' of {size} values' if size else ''}, got {value!r}")
    return values


def match_any(column: Column, value: str) -> Column:
    """Whether the text shares a word with ``value``; case does not matter."""
    tokens = [t for t in re.split(r"[^0-9a-z\u0080-\U0010ffff]+", value.lower()) if t]
    words = F.split(F.lower(column), r"[^0-9a-z\x{80}-\x{10FFFF}]+")
    return F.arrays_overlap(words, F.array(*[F.lit(t) for t in tokens])) if tokens else F.lit(False)


def condition(df: DataFrame, field: str, operator: str, value=None) -> Column:
    """One predicate with SQL meaning; a null field passes only ``IS_NULL``.

    Text equals a literal character by character, so ``5`` and ``05`` differ; in a range between
    numbers text counts as the number it spells, and text that spells none is in no range.
    """
    name = operator_name(operator)
    column, kind = _field(df, field)
    if name == "IS_NULL":
        return column.isNull()
    if name == "IS_NOT_NULL":
        return column.isNotNull()
    if name in ("LIKE", "NOT_LIKE"):
        like = column.cast("string").like(value)
        return like if name == "LIKE" else ~like
    if name == "MATCH":
        return match_any(column.cast("string"), value)
    if name in ("IN", "NOT_IN"):
        values = _list(value)
        if not values:
            return F.lit(False) if name == "IN" else column.isNotNull()
        left, literals = _operands(column, kind, values, ranged=False)
        return left.isin(*literals) if name == "IN" else ~left.isin(*literals)
    if name in ("BETWEEN", "NOT_BETWEEN"):
        left, (low, high) = _operands(column, kind, _list(value, 2), ranged=True)
        if name == "BETWEEN":
            return left.between(low, high)
        # Text that is no number is not between two numbers.
        return column.isNotNull() & ~F.coalesce(left.between(low, high), F.lit(False))
    left, (right,) = _operands(column, kind, [value], ranged=name not in ("EQUAL", "NOT_EQUAL"))
    return {
        "EQUAL": left == right,
        "NOT_EQUAL": left != right,
        "LESS_THAN": left < right,
        "LESS_THAN_OR_EQUAL": left <= right,
        "GREATER_THAN": left > right,
        "GREATER_THAN_OR_EQUAL": left >= right,
    }[name]


def apply(df: DataFrame, filters: list[dict] | None) -> DataFrame:
    """Rows that satisfy all conditions."""
    if not filters:
        return df
    parts = [condition(df, f["field"], f["operator"], f.get("value")) for f in filters]
    return df.filter(reduce(lambda a, b: a & b, parts))
