"""Requests resolved to catalog items, as one batch job.

Items are pre-aggregated to one row per dataset and one per variant before any
join, so a request meets at most one row however many items or requests share
a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    blank_to_null,
    collection_by_split,
    dataset_by_prefix,
    org_from_collection,
    qualify_collection,
    strip_ipfs,
    variant_by_prefix,
    DEFAULT_VARIANT,
)
from .items import with_properties

# Variants preferred, in this order, when none is requested.
PREFERRED_VARIANTS = ("default", "final", "finalized", "latest")

# Outcomes of a request.
OK = "ok"
ORGANIZATION_NOT_FOUND = "organization_not_found"
COLLECTION_NOT_FOUND = "collection_not_found"
DATASET_NOT_FOUND = "dataset_not_found"
VARIANT_NOT_FOUND = "variant_not_found"
AMBIGUOUS_VARIANT = "ambiguous_variant"
NO_DATA_ASSET = "no_data_asset"

REQUEST = ["request_id", "collection", "dataset", "variant", "organization"]


def _requests(requests: DataFrame) -> DataFrame:
    text = [c for c in REQUEST[1:] if c in requests.columns]
    missing = [c for c in REQUEST[1:] if c not in requests.columns]
    return requests.select(
        "request_id",
        *[blank_to_null(F.col(c)).alias(c) for c in text],
        *[F.lit(None).cast("string").alias(c) for c in missing],
    )


def _preference(variant: Column) -> Column:
    rank = F.lit(None).cast("int")
    for place, name in reversed(list(enumerate(PREFERRED_VARIANTS))):
        rank = F.when(variant == name, F.lit(place)).otherwise(rank)
    return rank


def org_resolve(requests: DataFrame, declared: DataFrame) -> DataFrame:
    """Add ``organization_id``: the one requested, or else the first (by
    ``org_ord``) that declares the collection, with or without its prefix.

    ``declared``: ``organization_id``, ``org_ord``, ``collection``.
    """
    prefix = F.concat("organization_id", F.lit("_"))
    bare = F.when(
        F.col("collection").startswith(prefix),
        F.substring(F.col("collection"), F.length(prefix) + 1, F.length("collection")),
    )
    org = F.struct("org_ord", "organization_id").alias("org")
    spellings = F.array(*[F.struct(n.alias("name"), org) for n in (F.col("collection"), bare)])
    names = (
        declared.select(F.explode(spellings).alias("spelt"))
        .where(F.col("spelt.name").isNotNull())
        .groupBy(F.col("spelt.name").alias("collection"))
        .agg(F.min("spelt.org")["organization_id"].alias("declaring"))
    )
    found = _requests(requests).join(names, "collection", "left")
    return found.select(*REQUEST, F.coalesce("organization", "declaring").alias("organization_id"))


def resolve_collections(requests: DataFrame, collections: DataFrame, declared: DataFrame) -> DataFrame:
    """Add ``organization_id`` and ``collection_id`` (NULL when not found).

    ``collections``: ``collection``, ``organization_id``, ``ord``. A collection
    of the organization is preferred to one of the same name elsewhere; within
    those the first in catalog order.
    """
    org, asked = F.col("organization_id"), F.col("collection")
    qualified = qualify_collection(asked, F.coalesce("organization", F.lit("")))
    prefixed = F.concat(org, F.lit("_"), asked)

    def candidates(owner: Column, tier: int, *names: Column) -> list[Column]:
        return [
            F.struct(owner.alias("owner"), n.alias("name"), F.lit(tier).alias("tier")) for n in names
        ]

    anywhere = F.lit("")
    tried = F.array_distinct(
        F.array(
            *candidates(org, 0, qualified, asked, prefixed),
            *candidates(anywhere, 1, qualified, prefixed),
        )
    )
    opened = (
        org_resolve(requests, declared)
        .select(*REQUEST, "organization_id", F.explode(tried).alias("try"))
        .select(*REQUEST, "organization_id", "try.*")
    )
    first = F.min("ord").alias("ord")
    owned = collections.groupBy(
        F.col("organization_id").alias("owner"), F.col("collection").alias("name")
    ).agg(first)
    named = collections.groupBy(F.col("collection").alias("name")).agg(first)
    lookup = owned.unionByName(named.withColumn("owner", anywhere))
    met = opened.join(lookup, ["owner", "name"], "left")
    best = F.min(F.when(F.col("ord").isNotNull(), F.struct("tier", "ord", "name")))
    return (
        met.groupBy(*REQUEST, "organization_id")  # five candidates per request
        .agg(best.alias("best"))
        .select(*REQUEST, "organization_id", F.col("best.name").alias("collection_id"))
    )


def _match(requests: DataFrame, items: DataFrame, take_first: bool) -> DataFrame:
    """Join requests on (collection_id, dataset[, variant]) to item summaries.

    ``items``: collection_id, dataset, variant (NULL = unnamed), shown (variant
    reported), ord, id, data_href.
    """
    chosen = F.struct("ord", "shown", "id", "data_href")
    rank = _preference(F.col("variant"))
    by_dataset = items.groupBy("collection_id", "dataset").agg(
        F.count("*").alias("n_items"),
        F.min(chosen).alias("first"),
        F.min(F.when(rank.isNotNull(), F.struct(rank.alias("rank"), chosen.alias("item"))))["item"].alias(
            "preferred"
        ),
    )
    by_variant = (
        items.where(F.col("variant").isNotNull())
        .groupBy("collection_id", "dataset", "variant")
        .agg(F.min(chosen).alias("exact"))
    )
    met = requests.join(by_dataset, ["collection_id", "dataset"], "left")
    met = met.join(by_variant, ["collection_id", "dataset", "variant"], "left")
    unrivalled = F.when(F.lit(take_first) | (F.col("n_items") == 1), F.col("first"))
    open_choice = F.coalesce("preferred", unrivalled)
    item = F.when(F.col("variant").isNotNull(), F.col("exact")).otherwise(open_choice)
    return met.withColumn("item", item)


def _outcome(met: DataFrame, no_asset: Column) -> DataFrame:
    status = (
        F.when(F.col("organization_id").isNull(), ORGANIZATION_NOT_FOUND)
        .when(F.col("collection_id").isNull(), COLLECTION_NOT_FOUND)
        .when(F.col("n_items").isNull(), DATASET_NOT_FOUND)
        .when(F.col("item").isNull() & F.col("variant").isNotNull(), VARIANT_NOT_FOUND)
        .when(F.col("item").isNull(), AMBIGUOUS_VARIANT)
        .when(no_asset, NO_DATA_ASSET)
        .otherwise(OK)
    )
    found = F.col("status").isin(OK, NO_DATA_ASSET)
    return (
        met.withColumn("status", status)
        .withColumn("item", F.when(found, F.col("item")))
        .select(
            "request_id",
            "collection",
            "dataset",
            "variant",
            F.col("organization_id"),
            "collection_id",
            F.col("item.shown").alias("resolved_variant"),
            F.col("item.id").alias("item_id"),
            F.when(F.col("status") == OK, strip_ipfs(F.col("item.data_href"))).alias("cid"),
            "status",
        )
    )


def items_by_id(items: DataFrame) -> DataFrame:
    """Items with the names that their ids give behind the collection's prefix."""
    item_id, collection = F.col("id"), F.col("collection")
    variant = variant_by_prefix(item_id, collection)
    return items.select(
        collection.alias("collection_id"),
        dataset_by_prefix(item_id, collection).alias("dataset"),
        variant.alias("variant"),
        variant.alias("shown"),
        "ord",
        "id",
        "data_href",
    )


def items_by_property(items: DataFrame) -> DataFrame:
    """Items with the names that their properties give.

    An item without a collection is of the one that its id begins with, as in the listing.
    """
    item_id = F.col("id")
    from_id = F.when(item_id.contains("-"), collection_by_split(item_id))
    full = with_properties(items, "dataset_id", "variant")
    full = full.withColumn("collection", F.coalesce(blank_to_null(F.col("collection")), from_id))
    return full.select(
        F.col("collection").alias("collection_id"),
        F.coalesce(blank_to_null(F.col("dataset_id")), dataset_by_prefix(item_id, F.col("collection"))).alias("dataset"),
        "variant",
        F.coalesce("variant", F.lit(DEFAULT_VARIANT)).alias("shown"),
        "ord",
        "id",
        "data_href",
    )


def available_variants(named: DataFrame) -> DataFrame:
    """Distinct variants of each dataset, of items named by id or by property."""
    return named.select("collection_id", "dataset", F.col("shown").alias("variant")).distinct()


def pick_variant(requests: DataFrame, items: DataFrame) -> DataFrame:
    """Items form: names parsed from ids behind the collection prefix.

    ``requests`` carries ``collection_id`` and ``organization_id``. Without a
    requested variant: the only one, else the first preferred one, else the
    request is ambiguous.
    """
    return _outcome(_match(requests, items_by_id(items), take_first=False), F.col("item.data_href").isNull())


def pick_variant_api(requests: DataFrame, items: DataFrame) -> DataFrame:
    """API form: names from properties, and the first match as last resort."""
    met = _match(requests, items_by_property(items), take_first=True)
    href = F.col("item.data_href")
    return _outcome(met, href.isNull() | (href == ""))


def collections_of(items: DataFrame) -> DataFrame:
    """Collection table of a catalog known only by its items."""
    full = with_properties(items, "organization")
    found = full.groupBy("collection").agg(
        F.min("organization").alias("stated"), F.min("ord").alias("ord")
    )
    organization = F.coalesce("stated", org_from_collection(F.col("collection")))
    return found.select("collection", organization.alias("organization_id"), "ord")


def resolve_datasets(
    requests: DataFrame,
    items: DataFrame,
    collections: DataFrame | None = None,
    declared: DataFrame | None = None,
) -> DataFrame:
    """Organization, collection, dataset, variant, asset and cid per request.

    Every request yields one row; ``status`` tells how far it got.
    """
    collections = collections_of(items) if collections is None else collections
    if declared is None:
        declared = collections.groupBy("organization_id", "collection").agg(F.min("ord").alias("org_ord"))
    placed = resolve_collections(requests, collections, declared)
    return pick_variant(placed, items)


def resolve_datasets_api(requests: DataFrame, items: DataFrame) -> DataFrame:
    """Resolution against an item search: collections are taken by name."""
    asked = _requests(requests)
    collection = qualify_collection(F.col("collection"), F.coalesce("organization", F.lit("")))
    named = asked.select(
        *REQUEST,
        F.coalesce("organization", org_from_collection(collection), F.lit("")).alias("organization_id"),
        collection.alias("collection_id"),
    )
    return pick_variant_api(named, items)


def resolve_api_then_items(
    requests: DataFrame,
    items: DataFrame,
    collections: DataFrame | None = None,
    declared: DataFrame | None = None,
) -> DataFrame:
    """The outcome of the item search where it succeeds, else that of the item tree."""
    searched = resolve_datasets_api(requests, items)
    row = F.struct(*[c for c in searched.columns if c != "request_id"])
    first = searched.where(F.col("status") == OK).select("request_id", row.alias("api"))
    second = resolve_datasets(requests, items, collections, declared).select("request_id", row.alias("tree"))
    both = second.join(first, "request_id", "left")
    return both.select("request_id", F.coalesce("api", "tree").alias("row")).select("request_id", "row.*")


def resolve_join(requests: DataFrame, items: DataFrame) -> DataFrame:
    """Number of items matching each request's exact collection and dataset."""
    matched = items.groupBy(
        "collection", dataset_by_prefix(F.col("id"), F.col("collection")).alias("dataset")
    ).agg(F.count("*").alias("n_items"))
    asked = _requests(requests)
    met = asked.join(matched, ["collection", "dataset"], "left")
    return met.select(
        "request_id", "collection", "dataset", F.coalesce("n_items", F.lit(0)).alias("n_items")
    )
