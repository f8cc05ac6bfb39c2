"""The flat item table every catalog job works on.

One row per catalog item: ``collection``, ``id``, ``ord`` (item order, any
orderable type), ``data_href`` (NULL without a data asset) and the typed
properties below. Columns a catalog lacks are added as NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ITEM_PROPERTIES = {
    "organization": "string",
    "dataset_id": "string",
    "variant": "string",
    "observation": "string",
    "latest_cid": "string",
    "concat_priority": "double",
    "concat_dimension": "string",
    "bbox": "array<double>",
    "start_datetime": "string",
    "end_datetime": "string",
    "datetime": "string",
}


def with_properties(items: DataFrame, *names: str) -> DataFrame:
    """The item table with the named property columns present."""
    missing = [n for n in names if n not in items.columns]
    return items.select("*", *[F.lit(None).cast(ITEM_PROPERTIES[n]).alias(n) for n in missing])
