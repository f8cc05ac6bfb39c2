"""Flat records and JSON rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .introspect import get_variable

FLOATS = (T.DoubleType, T.FloatType)


def to_records(df: DataFrame, dims, variable: str, precision: int | None = None) -> DataFrame:
    """Dimensions and ``value`` of one variable; missing values are kept."""
    if variable not in df.columns or variable in dims:
        raise KeyError(f"No variable named {variable}.")
    value = F.col(variable)
    if precision is not None:
        value = F.round(value, precision)
    return get_variable(df, dims, variable).select(*dims, value.alias("value"))


def to_json_records(df: DataFrame) -> DataFrame:
    """One JSON object per cell in a ``json`` column; missing values are null.

    Write it with ``.write.text``. A single document for the whole dataset
    would have to pass through one task and is not offered.
    """
    fields = [
        F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, FLOATS)
        else F.col(f.name)
        for f in df.schema
    ]
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("json"))
