"""Catalog listings, one row per variant.

The nested collection > dataset > variants document of a catalog browser is
this table grouped; it stays flat here because a collection may hold any
number of items and must not be gathered in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stac import item_bbox, item_time_extent
from ..functions.text import (
    blank_to_null,
    collection_by_split,
    dataset_by_prefix,
    dataset_by_split,
    org_from_collection,
    strip_ipfs,
    variant_by_split,
)
from .items import with_properties

KEY = ["collection", "dataset", "variant"]

LISTING = [
    *KEY,
    "cid",
    "west",
    "south",
    "east",
    "north",
    "start",
    "end",
    "organization",
    "title",
    "category",
    "position",
]

_EXTENT = ("bbox", "start_datetime", "end_datetime", "datetime")


def _extent_columns() -> list[Column]:
    box = item_bbox(F.col("bbox"))
    when = item_time_extent(F.col("start_datetime"), F.col("end_datetime"), F.col("datetime"))
    sides = [F.get(box, i).alias(name) for i, name in enumerate(("west", "south", "east", "north"))]
    return [*sides, when["start"].alias("start"), when["end"].alias("end")]


def _with_collection_attrs(rows: DataFrame, attrs: DataFrame) -> DataFrame:
    """Attach organization, title and category."""
    return rows.join(attrs, "collection", "left").select(*LISTING)


def list_datasets(
    items: DataFrame,
    collections: DataFrame | None = None,
    declared: DataFrame | None = None,
) -> DataFrame:
    """Listing of an item tree: names come from the item ids.

    Items without a data asset or with an unsplittable id are left out.
    ``declared`` (``collection``, ``dataset``) adds datasets that have no item
    yet, with a NULL variant. ``collections`` carries ``collection``,
    ``organization``, ``title`` and ``category``.
    """
    parsed = with_properties(items, *_EXTENT).select(
        "collection",
        dataset_by_split(F.col("id")).alias("dataset"),
        variant_by_split(F.col("id")).alias("variant"),
        strip_ipfs(F.col("data_href")).alias("cid"),
        *_extent_columns(),
        F.col("ord").alias("position"),
    )
    rows = parsed.where(F.col("dataset").isNotNull() & F.col("cid").isNotNull())
    if declared is not None:
        known = rows.select("collection", "dataset").distinct()
        wanted = declared.select("collection", "dataset").where(F.col("dataset") != "").distinct()
        if collections is not None:
            wanted = wanted.join(collections.select("collection").distinct(), "collection", "left_semi")
        without_items = wanted.join(known, ["collection", "dataset"], "left_anti")
        rows = rows.unionByName(without_items, allowMissingColumns=True)
    if collections is None:
        return rows.select(
            *LISTING[:10],
            org_from_collection(F.col("collection")).alias("organization"),
            F.lit(None).cast("string").alias("title"),
            F.lit(None).cast("string").alias("category"),
            "position",
        )
    attrs = collections.groupBy("collection").agg(
        *[F.min(c).alias(c) for c in ("organization", "title", "category")]
    )
    return _with_collection_attrs(rows, attrs)


def _api_names(items: DataFrame) -> DataFrame:
    """Names by property, with the item id as the fallback."""
    full = with_properties(items, "dataset_id", "variant", "observation", "latest_cid", *_EXTENT)
    item_id = F.col("id")
    from_id = F.when(item_id.contains("-"), collection_by_split(item_id))
    return full.withColumns(
        {
            "collection": F.coalesce("collection", from_id),
            "dataset": F.coalesce("dataset_id", dataset_by_split(item_id)),
            "variant": F.coalesce("variant", variant_by_split(item_id)),
        }
    ).where(F.col("collection") != "")


def collection_category(items: DataFrame) -> DataFrame:
    """Category of each collection whose items agree on one observation."""
    seen = blank_to_null(F.col("observation"))
    return (
        _api_names(items)
        .groupBy("collection")
        .agg(F.min(seen).alias("low"), F.max(seen).alias("high"))
        .select("collection", F.when(F.col("low") == F.col("high"), F.col("low")).alias("category"))
    )


def latest_variant_rows(items: DataFrame) -> DataFrame:
    """The newest item per variant, at the position of the oldest one.

    A map-side aggregation rather than a window, so a dataset with most of the
    items needs no large sort.
    """
    payload = F.struct(
        blank_to_null(strip_ipfs(F.col("latest_cid"))).alias("cid"), *_extent_columns()
    )
    return (
        _api_names(items)
        .where(F.col("dataset") != "")
        .groupBy(*KEY)
        .agg(F.max_by(payload, "ord").alias("newest"), F.min("ord").alias("position"))
        .select(*KEY, "newest.*", "position")
    )


def list_datasets_api(items: DataFrame, collections: DataFrame | None = None) -> DataFrame:
    """Listing of an item search: names come from the item properties.

    The organization is the part of the collection id before its first ``_``;
    collections known only from items are listed too, without a title.
    """
    attrs = collection_category(items).withColumn(
        "organization", org_from_collection(F.col("collection"))
    )
    if collections is not None:
        titles = collections.groupBy("collection").agg(F.max("title").alias("title"))
        attrs = attrs.join(titles, "collection", "left")
    else:
        attrs = attrs.withColumn("title", F.lit(None).cast("string"))
    return _with_collection_attrs(latest_variant_rows(items), attrs)


def available_datasets(items: DataFrame) -> DataFrame:
    """Distinct dataset names of each collection."""
    return items.select(
        "collection", dataset_by_prefix(F.col("id"), F.col("collection")).alias("dataset")
    ).distinct()


def _same_key(left: Column, right: Column) -> Column:
    """Keys of two listings are equal; the variant of a dataset without items is NULL on both sides."""
    same = F.lit(True)
    for name in KEY:
        same = same & left[name].eqNullSafe(right[name])
    return same


def catalog_parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows on which two listings disagree.

    Compared by collection, dataset and variant: presence, cid, box, extents
    as instants, organization, title and category. Repeated variants count
    with their last row; a declared dataset without items is a row with a NULL variant.
    """
    boxes = ["west", "south", "east", "north"]
    texts = ["organization", "title", "category"]

    def keyed(listing: DataFrame, name: str) -> DataFrame:
        row = F.struct(
            F.lit(True).alias("present"),
            "cid",
            *boxes,
            *[F.try_to_timestamp(F.col(c)).alias(c) for c in ("start", "end")],
            *texts,
        )
        last = listing.groupBy(*KEY).agg(F.max_by(row, F.coalesce("position", F.lit(-1))).alias("row"))
        return last.select(F.struct(*KEY).alias(f"{name}_key"), F.col("row").alias(name))

    same_key = _same_key(F.col("l_key"), F.col("r_key"))
    both = keyed(left, "l").join(keyed(right, "r"), same_key, "full_outer")

    def same(*names: str) -> Column:
        equal = F.lit(True)
        for name in names:
            equal = equal & F.col("l")[name].eqNullSafe(F.col("r")[name])
        return equal

    key = F.coalesce("l_key", "r_key")
    compared = both.select(
        *[key[name].alias(name) for name in KEY],
        F.when(F.col("r").isNull(), "left_only")
        .when(F.col("l").isNull(), "right_only")
        .otherwise("both")
        .alias("presence"),
        same("cid").alias("same_cid"),
        same(*boxes).alias("same_bbox"),
        same("start", "end").alias("same_extent"),
        *[same(t).alias(f"same_{t}") for t in texts],
    )
    agreed = F.col("same_cid") & F.col("same_bbox") & F.col("same_extent")
    for t in texts:
        agreed = agreed & F.col(f"same_{t}")
    return compared.where((F.col("presence") != "both") | ~agreed)


def catalog_key_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Catalog keys that only one of two listings has; datasets without items by a NULL variant."""
    sides = [
        listing.select(*KEY).withColumn("side", F.lit(side)) for side, listing in (("left", left), ("right", right))
    ]
    return (
        sides[0]
        .unionByName(sides[1])
        .groupBy(*KEY)
        .agg(F.min("side").alias("low"), F.max("side").alias("only_in"))
        .where(F.col("low") == F.col("only_in"))
        .drop("low")
    )


def catalog_set_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """What only one of two listings has, at each level: ``(level, collection, dataset, variant, only_in)``.

    A collection that one side lacks is a row of level ``collection`` and all its datasets and
    variants are rows as well. One aggregation over grouping sets, so a collection with most
    of the items is summed where it lies.
    """
    sides = [
        listing.select(*KEY, F.lit(side).alias("side")) for side, listing in (("left", left), ("right", right))
    ]
    sets = [[F.col("collection")], [F.col("collection"), F.col("dataset")], [F.col(c) for c in KEY]]
    found = (
        sides[0]
        .unionByName(sides[1])
        .groupingSets(sets, *[F.col(c) for c in KEY])
        .agg(F.grouping_id().alias("depth"), F.min("side").alias("low"), F.max("side").alias("only_in"))
    )
    level = F.when(F.col("depth") == 3, "collection").when(F.col("depth") == 1, "dataset").otherwise("variant")
    return found.where(F.col("low") == F.col("only_in")).select(level.alias("level"), *KEY, "only_in")
