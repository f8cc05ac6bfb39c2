"""Outcome of a store retrieval, read from its message."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Message parts that mean the store was not reachable.
CONNECTION_PHRASES = (
    "Connection refused",
    "Max retries exceeded",
    "Timeout",
    "timed out",
    "ECONNREFUSED",
    "ETIMEDOUT",
)


def retrieval_status(message: Column) -> Column:
    """``ok`` without a message, else ``connection_error`` or ``error``."""
    unreachable = reduce(or_, [message.contains(p) for p in CONNECTION_PHRASES])
    return (
        F.when(message.isNull(), "ok").when(unreachable, "connection_error").otherwise("error")
    )
