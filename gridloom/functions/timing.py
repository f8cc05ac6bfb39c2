"""Time bounds and comparable instants.

Bounds are two scalars typed by the time column, so they are coerced on the
driver and end up as literals that the Parquet scan can use.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidSelectionError


def parse_instant(value) -> datetime | None:
    """UTC instant of a date, datetime, epoch-millisecond number or ISO text."""
    if isinstance(value, datetime):
        return value.astimezone(timezone.utc) if value.tzinfo else value.replace(tzinfo=timezone.utc)
    if isinstance(value, date):
        return datetime.combine(value, time(), timezone.utc)
    if isinstance(value, (int, float)):
        return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(milliseconds=value)
    try:
        return parse_instant(datetime.fromisoformat(str(value).strip()))
    except ValueError:
        return None


def _epoch_ms(instant: datetime) -> float:
    return (instant - datetime(1970, 1, 1, tzinfo=timezone.utc)) / timedelta(milliseconds=1)


def epoch_micros(instant: datetime) -> int:
    return (instant - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def coerce_bound(value, dtype: T.DataType):
    """Bound as a Python value of the kind the time column holds."""
    if isinstance(dtype, T.NumericType):
        if isinstance(value, (int, float)):
            return value
        if not isinstance(value, date):
            try:
                return float(value)
            except ValueError:
                pass
        instant = parse_instant(value)
        if instant is not None:
            return _epoch_ms(instant)
        raise InvalidSelectionError(f'Unable to read "{value}" as a number or a date.')
    instant = parse_instant(value)
    if instant is None:
        raise InvalidSelectionError(f'Unable to read "{value}" as a date.')
    return instant


def normalize_time_range(start, end, dtype: T.DataType) -> tuple:
    """Both bounds coerced, the earlier one first."""
    first, last = coerce_bound(start, dtype), coerce_bound(end, dtype)
    return (last, first) if first > last else (first, last)


def bound_literal(value, dtype: T.DataType) -> Column:
    if isinstance(value, datetime):
        text = value.strftime("%Y-%m-%dT%H:%M:%S.%f")
        if isinstance(dtype, T.TimestampNTZType):
            return F.lit(text).cast("timestamp_ntz")
        return F.lit(text + "Z").cast("timestamp")
    return F.lit(value)


def within_time(column: Column, dtype: T.DataType, start, end) -> Column:
    """Inclusive range predicate; pushable for every type but text."""
    first, last = normalize_time_range(start, end, dtype)
    if isinstance(dtype, T.StringType):
        # Equal instants can be spelt differently, so text is compared parsed.
        instant = F.try_to_timestamp(column)
        ts = T.TimestampType()
        return instant.between(bound_literal(first, ts), bound_literal(last, ts))
    if isinstance(dtype, T.DateType):
        # A date counts as its midnight: round the start up, the end down.
        low = first.date() if first.time() == time() else first.date() + timedelta(days=1)
        return column.between(F.lit(low), F.lit(last.date()))
    return column.between(bound_literal(first, dtype), bound_literal(last, dtype))


def to_comparable(column: Column, dtype: T.DataType) -> Column:
    """Orderable form of a concatenation axis: text becomes epoch milliseconds."""
    if isinstance(dtype, T.StringType):
        return F.unix_millis(F.to_timestamp(column))
    return column


def coerce_time(column: Column, target: str) -> Column:
    """Column form of the bound coercion: ISO text to ``timestamp``, epoch
    milliseconds (``number``), or normalised ISO ``text``.

    Text that is already numeric is kept as that number in the ``number`` form.
    """
    instant = F.try_to_timestamp(column)
    if target == "number":
        millis = F.unix_millis(instant).cast("double")
        return F.coalesce(column.try_cast("double"), millis)
    if target == "timestamp":
        return instant.cast("timestamp_ntz")
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def normalized_time_range(start: Column, end: Column, target: str) -> Column:
    """Column form of ``normalize_time_range``: a struct of ``first`` and ``last``.

    ``target`` is what the time column holds, as in ``coerce_time``. Bounds that cannot be read as
    that leave both ends NULL. Where it holds ``text``, the bounds stay as they are spelt, and only
    those that are instants in falling order change places, as normalised ISO text.
    """
    low, high = coerce_time(start, target), coerce_time(end, target)
    if target == "text":
        falls = F.coalesce(F.try_to_timestamp(start) > F.try_to_timestamp(end), F.lit(False))
        return F.struct(
            F.when(falls, high).otherwise(start).alias("first"), F.when(falls, low).otherwise(end).alias("last")
        )
    read = low.isNotNull() & high.isNotNull()
    return F.struct(F.when(read, F.least(low, high)).alias("first"), F.when(read, F.greatest(low, high)).alias("last"))
