"""Items of a dataset that can be joined into one series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import collection_by_split, dataset_by_split, strip_ipfs, variant_by_split
from .items import with_properties

# Place and axis of an item that states none.
DEFAULT_PRIORITY = 0.0
DEFAULT_DIMENSION = "time"


def link_meta_join(items: DataFrame, item_links: DataFrame) -> DataFrame:
    """Fill priority and dimension from the collection's link to the item.

    The first link naming the item counts; the item's own properties win.
    """
    meta = item_links.groupBy("collection", "id").agg(
        F.min(F.struct("ord", "concat_priority", "concat_dimension")).alias("meta")
    )
    full = with_properties(items, "concat_priority", "concat_dimension")
    met = full.join(meta, ["collection", "id"], "left")
    return met.withColumns(
        {
            "concat_priority": F.coalesce("concat_priority", "meta.concat_priority"),
            "concat_dimension": F.coalesce("concat_dimension", "meta.concat_dimension"),
        }
    ).drop("meta")


def concatenable_items(items: DataFrame, item_links: DataFrame | None = None) -> DataFrame:
    """Variants with cid, priority and dimension, for every dataset.

    Names are the ``-`` parts of the item id, and the first part must be the
    collection. Items without a data asset are left out.
    """
    full = with_properties(items, "concat_priority", "concat_dimension")
    if item_links is not None:
        full = link_meta_join(full, item_links)
    item_id = F.col("id")
    return full.where(
        (collection_by_split(item_id) == F.col("collection"))
        & dataset_by_split(item_id).isNotNull()
        & F.col("data_href").isNotNull()
    ).select(
        "collection",
        dataset_by_split(item_id).alias("dataset"),
        variant_by_split(item_id).alias("variant"),
        strip_ipfs(F.col("data_href")).alias("cid"),
        F.coalesce(F.col("concat_priority").cast("double"), F.lit(DEFAULT_PRIORITY)).alias("concat_priority"),
        F.coalesce("concat_dimension", F.lit(DEFAULT_DIMENSION)).alias("concat_dimension"),
        "ord",
    )


def concatenation_groups(concatenable: DataFrame) -> DataFrame:
    """Datasets with more than one variant, how many, and the first one's axis."""
    return (
        concatenable.groupBy("collection", "dataset")
        .agg(
            F.count("*").alias("n_variants"),
            F.min(F.struct("concat_priority", "ord", "concat_dimension"))["concat_dimension"].alias(
                "concat_dimension"
            ),
        )
        .where(F.col("n_variants") > 1)
    )
