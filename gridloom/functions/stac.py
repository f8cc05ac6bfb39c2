"""Typed reads of catalog item properties."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def string_prop(properties: Column, key: str) -> Column:
    """Property of a MAP<STRING, VARIANT> when it is JSON text, else NULL."""
    value = properties.getItem(key)
    return F.when(F.schema_of_variant(value) == "STRING", value.cast("string"))


def number_prop(properties: Column, key: str) -> Column:
    """Property of a MAP<STRING, VARIANT> when it is a JSON number, else NULL."""
    value = properties.getItem(key)
    kind = F.schema_of_variant(value)
    numeric = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    return F.when(numeric, value.cast("double"))


def string_list(value: Column) -> Column:
    """The text elements of a VARIANT array; NULL when it is no array."""
    elements = F.try_variant_get(value, "$", "array<variant>")
    texts = F.filter(elements, lambda v: F.schema_of_variant(v) == "STRING")
    return F.transform(texts, lambda v: v.cast("string"))


def item_bbox(bbox: Column) -> Column:
    """West, south, east and north when at least four numbers are given."""
    return F.when(F.size(bbox) >= 4, F.slice(bbox, 1, 4))


def item_time_extent(start: Column, end: Column, instant: Column) -> Column:
    """Struct of start and end text, each falling back to the single instant."""
    first, last = F.coalesce(start, instant), F.coalesce(end, instant)
    extent = F.struct(first.alias("start"), last.alias("end"))
    return F.when(first.isNotNull() | last.isNotNull(), extent)
