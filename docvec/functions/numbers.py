"""Whole numbers and times."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_quotient(a: Column, n: int) -> Column:
    """``a`` divided by ``n`` without a fraction, exact for any 64-bit number."""
    return F.call_function("div", a, F.lit(n))


def clamp(a: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(a, F.lit(high)), F.lit(low))


def naive_utc(at: Column) -> Column:
    """An instant as a UTC time without a zone, whatever the session's zone; null is an error."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    micros = F.unix_micros(at) * F.expr("interval '0.000001' second")
    return F.when(at.isNull(), F.raise_error(F.lit("no time to convert"))).otherwise(epoch + micros)


def iso_now() -> Column:
    """The time of the query, in UTC, as ISO-8601 text."""
    return F.date_format(naive_utc(F.current_timestamp()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
