"""Parsing that turns a bad value into null instead of failing the job.

Spark 4 runs in ANSI mode, where a plain cast of ``'abc'`` to int raises. Every raw cell
goes through one of these functions, all of them built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A whole number with an optional fraction, as a non-ANSI cast accepts it.
_NUMBER = r"^\s*([+-]?\d+)(?:\.\d*)?\s*$"
# What a count and a price are cleared of, and the formats of a date.
_NOT_DIGIT, _NOT_PRICE = "[^0-9]", "[^0-9.]"
_DAY_FORMATS = ("M/d/yyyy", "yyyy-MM-dd")
# A date and a time as type inference reads a timestamp.
_TIMESTAMP = r"^\s*\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}.*$"
# A count that type inference has turned into a double.
_DOUBLE_COUNT = r"^\s*(\d+)\.0\s*$"


def to_int(value: Column, dtype: T.DataType | None = None) -> Column:
    """Truncating integer: ``'4.5'`` is 4; ``'4d'``, ``'1e1'`` and overflow are null.

    ``dtype`` is the type of ``value`` when known; numbers are cast without going
    through text.
    """
    if isinstance(dtype, T.NumericType):
        return value.try_cast("int")
    return F.regexp_extract(value.cast("string"), _NUMBER, 1).try_cast("int")


def to_float(value: Column) -> Column:
    return value.try_cast("float")


def digits(value: Column, dtype: T.DataType | None = None) -> Column:
    """All digits of a cell as one integer: ``'1,234 people'`` is 1234, ``'none'`` null.

    A column of numbers (``dtype``) is truncated and loses its sign; as text it would bring
    the digits of its fraction and exponent along.
    """
    if isinstance(dtype, T.NumericType):
        return F.abs(value).try_cast("int")
    whole = F.regexp_replace(value.cast("string"), _DOUBLE_COUNT, "$1")
    return F.regexp_replace(whole, _NOT_DIGIT, "").try_cast("int")


def price(value: Column, dtype: T.DataType | None = None) -> Column:
    """Digits and dots of a cell as float. The sign is lost and a price range is null.

    A column of numbers (``dtype``) only loses its sign: its text may hold an exponent.
    """
    if isinstance(dtype, T.NumericType):
        return F.abs(value).try_cast("float")
    return F.regexp_replace(value.cast("string"), _NOT_PRICE, "").try_cast("float")


def null_outside(value: Column, low=None, high=None) -> Column:
    """``value`` where it lies in [low, high], else null. NaN counts as above any bound."""
    if low is None and high is None:
        return value
    inside = F.lit(True)
    if low is not None:
        inside = inside & (value >= F.lit(low))
    if high is not None:
        inside = inside & (value <= F.lit(high))
    return F.when(inside, value)


def parse_date(value: Column, dtype: T.DataType | None = None) -> Column:
    """``M/d/yyyy``, or an ISO date or timestamp as type inference would have read it; anything
    else is null. A timestamp without a zone keeps its day whatever the session's zone."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return value.cast("date")
    text = value.cast("string")
    day = F.coalesce(*[F.try_to_date(text, form) for form in _DAY_FORMATS])
    return F.coalesce(day, F.when(text.rlike(_TIMESTAMP), text.try_cast("timestamp_ntz").cast("date")))


def label(value: Column) -> Column:
    """Lower-cased text without surrounding spaces."""
    return F.lower(F.trim(value.cast("string")))


def flag(value: Column, yes: str) -> Column:
    """True where the label equals ``yes``; null becomes false."""
    return F.coalesce(label(value) == F.lit(yes), F.lit(False))
