"""Catalog names and identifiers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import BLANKS

# Fixed value: variant name of an item whose id carries none.
DEFAULT_VARIANT = "default"


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def normalize_segment(c: Column) -> Column:
    trimmed = F.regexp_replace(c, f"^[{BLANKS}]+|[{BLANKS}]+$", "")
    return F.regexp_replace(F.lower(trimmed), f"[{BLANKS}]+", "_")


def _after_prefix(item_id: Column, collection: Column) -> Column:
    prefix = F.concat(collection, F.lit("-"))
    return F.when(
        item_id.startswith(prefix), F.substring(item_id, F.length(prefix) + 1, F.length(item_id))
    ).otherwise(item_id)


def _tail(parts: Column, start: int) -> Column:
    """Parts from the 0-based ``start`` on, joined again; NULL when empty."""
    rest = F.slice(parts, start + 1, F.greatest(F.size(parts) - start, F.lit(0)))
    return blank_to_null(F.array_join(rest, "-"))


def dataset_by_prefix(item_id: Column, collection: Column) -> Column:
    """Dataset name left after the ``{collection}-`` prefix of an item id."""
    return F.get(F.split(_after_prefix(item_id, collection), "-"), 0)


def variant_by_prefix(item_id: Column, collection: Column) -> Column:
    parts = F.split(_after_prefix(item_id, collection), "-")
    return F.coalesce(_tail(parts, 1), F.lit(DEFAULT_VARIANT))


def collection_by_split(item_id: Column) -> Column:
    return F.get(F.split(item_id, "-"), 0)


def dataset_by_split(item_id: Column) -> Column:
    """Second ``-`` part of an item id, NULL when there is none."""
    return F.get(F.split(item_id, "-"), 1)


def variant_by_split(item_id: Column) -> Column:
    return F.coalesce(_tail(F.split(item_id, "-"), 2), F.lit(DEFAULT_VARIANT))


def strip_ipfs(uri: Column) -> Column:
    return F.regexp_replace(uri, "^ipfs://", "")


def resolve_ipfs_uri(uri: Column, gateway) -> Column:
    return F.when(
        uri.startswith("ipfs://"), F.concat(_col(gateway), F.lit("/ipfs/"), strip_ipfs(uri))
    ).otherwise(uri)


def qualify_collection(collection: Column, organization: Column) -> Column:
    """Put the organization in front of a collection that does not carry it yet."""
    applies = (
        (F.coalesce(organization, F.lit("")) != "")
        & (collection != "")
        & ~collection.startswith(F.concat(organization, F.lit("_")))
    )
    return F.when(applies, F.concat(organization, F.lit("_"), collection)).otherwise(collection)


def org_from_collection(collection: Column) -> Column:
    return blank_to_null(F.when(collection.contains("_"), F.split_part(collection, F.lit("_"), F.lit(1))))


def dataset_path(*parts: Column) -> Column:
    return F.concat_ws("-", *[blank_to_null(p) for p in parts])
