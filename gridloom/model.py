"""Data model: coordinate roles, lineage metadata, requests and catalog keys."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Coordinate names tried for each role, in order of preference.
LATITUDE_KEYS = ("latitude", "lat", "y")
LONGITUDE_KEYS = ("longitude", "lon", "lng", "x")
TIME_KEYS = (
    "time",
    "valid_time",
    "datetime",
    "date",
    "forecast_reference_time",
    "forecast_time",
    "analysis_time",
    "initial_time",
    "verification_time",
    "step",
    "t",
)

# Directory partition column added by ``write_cells``; never a variable.
YEAR_PARTITION = "cell_year"

# White space as understood by the catalog's name normalisation: the ASCII
# blanks and the Unicode space separators.
BLANKS = r"\s\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"


def normalize_name(name: str) -> str:
    """Trim, lower-case and join blank runs with ``_`` (one Python string)."""
    trimmed = re.sub(f"^[{BLANKS}]+|[{BLANKS}]+$", "", name, flags=re.ASCII)
    return re.sub(f"[{BLANKS}]+", "_", trimmed.lower(), flags=re.ASCII)


def infer_coord(columns, candidates) -> str | None:
    """First candidate present among ``columns`` after normalisation."""
    by_name: dict[str, str] = {}
    for column in columns:
        by_name.setdefault(normalize_name(column), column)
    for candidate in candidates:
        found = by_name.get(normalize_name(candidate))
        if found is not None:
            return found
    return None


def infer_dims(schema: T.StructType) -> tuple[str, ...]:
    """Columns whose names play a coordinate role, in schema order."""
    roles = {*LATITUDE_KEYS, *LONGITUDE_KEYS, *TIME_KEYS}
    return tuple(f.name for f in schema if normalize_name(f.name) in roles)


@dataclass(frozen=True)
class DatasetMetadata:
    """Lineage of a dataset; shared unchanged by every selection made from it."""

    dataset: str = ""
    collection: str | None = ""
    variant: str | None = ""
    organization: str | None = ""
    path: str = ""
    cid: str = ""
    source: str = "direct_cid"
    concatenated_variants: tuple[str, ...] | None = None
    concat_dimension: str | None = None
    fetched_at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    def with_changes(self, **changes) -> DatasetMetadata:
        return replace(self, **changes)


@dataclass(frozen=True)
class DatasetRequest:
    dataset: str | None = None
    collection: str | None = None
    variant: str | None = None
    organization: str | None = None
    cid: str | None = None


@dataclass(frozen=True)
class CatalogKeys:
    """Names of the custom catalog properties: ``keys["variant"]`` and so on.

    The namespace in front of them is the publisher's; pass the one your
    catalog uses.
    """

    namespace: str = "grid"

    def __getitem__(self, suffix: str) -> str:
        return f"{self.namespace}:{suffix}"


def field_attrs(df: DataFrame, column: str) -> dict:
    """Attributes (units, description, ...) of one column."""
    return dict(df.schema[column].metadata or {})
