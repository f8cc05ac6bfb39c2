"""Catalog trees held as a document table, parsed once and walked with joins.

Root > organizations > collections > items. Every document is parsed once, to the few typed fields
that a walk needs; each level then explodes the links of the one above and equi-joins those narrow
rows on ``href``, so a tree of any width takes three joins and no body is moved. Links whose
document is absent or unreadable drop out and are reported by ``broken_links``.

The document table has ``href`` and ``body`` (JSON). A long document may be
split over rows with the same ``href`` and a ``part`` number, each holding
some of its links.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import StacLoadError
from ..functions.stac import number_prop, string_list, string_prop
from ..functions.text import blank_to_null
from ..model import CatalogKeys
from .sizing import settle

_NODE = "id STRING, title STRING, links ARRAY<MAP<STRING, VARIANT>>, bad STRING"
# Fields of open form are read as they are, so that an odd one costs no more than itself.
_ITEM = "id STRING, properties MAP<STRING, VARIANT>, bbox VARIANT, assets VARIANT, bad STRING"

_ENTRIES = "array<struct<key_pos: int, key: string, values: array<string>>>"
_LINKS = (
    "array<struct<pos: int, rel: string, href: string, id: string, title: string, concat_priority: double, "
    f"concat_dimension: string, entries: {_ENTRIES}>>"
)
#: What a walk knows of a document: as a node, with its links, and as an item. NULL where the body
#: is no JSON of that form.
PARSED = (
    f"href string, part int, node struct<id: string, title: string, links: {_LINKS}>, "
    "item struct<id: string, data_href: string, dataset_id: string, variant: string, observation: string, "
    "latest_cid: string, concat_priority: double, concat_dimension: string, bbox: array<double>, "
    "start_datetime: string, end_datetime: string, datetime: string>"
)


@dataclass(frozen=True)
class Catalog:
    """Flat tables of a walked tree."""

    organizations: DataFrame
    collections: DataFrame
    item_links: DataFrame
    items: DataFrame
    declared: DataFrame
    declared_datasets: DataFrame
    categories: DataFrame
    broken_links: DataFrame


def _read(schema: str) -> Column:
    """The body as a struct; NULL if it is no JSON of the form."""
    body = F.from_json("body", schema, {"columnNameOfCorruptRecord": "bad"})
    return F.when(body.isNotNull() & body["bad"].isNull(), body)


def _link(keys: CatalogKeys):
    """The typed form of one link; ``entries`` are its lists of declared names."""

    def typed(link: Column, pos: Column) -> Column:
        declared = F.filter(
            F.transform(F.map_entries(link), lambda e, i: F.struct(i.alias("key_pos"), e["key"].alias("key"), string_list(e["value"]).alias("values"))),
            lambda e: e["key"].startswith(keys["collections"]) | (e["key"] == keys["datasets"]),
        )
        return F.struct(
            pos.alias("pos"),
            string_prop(link, "rel").alias("rel"),
            string_prop(link, "href").alias("href"),
            string_prop(link, keys["id"]).alias("id"),
            string_prop(link, "title").alias("title"),
            number_prop(link, keys["concatPriority"]).alias("concat_priority"),
            string_prop(link, keys["concatDimension"]).alias("concat_dimension"),
            declared.alias("entries"),
        )

    return typed


def parse_documents(docs: DataFrame, keys: CatalogKeys = CatalogKeys()) -> DataFrame:
    """One narrow row of ``PARSED`` for each row of ``href``, ``body`` and, if there, ``part``.

    Each body is read where it lies, as a node and as an item. A node without links cannot be
    followed and counts as unreadable.
    """
    part = F.col("part") if "part" in docs.columns else F.lit(0)
    read = docs.select("href", part.cast("int").alias("part"), _read(_NODE).alias("n"), _read(_ITEM).alias("i"))
    props = F.col("i.properties")
    node = F.struct(F.col("n.id").alias("id"), F.col("n.title").alias("title"), F.transform("n.links", _link(keys)).alias("links"))
    item = F.struct(
        F.col("i.id").alias("id"),
        F.try_variant_get("i.assets", "$.data.href", "string").alias("data_href"),
        string_prop(props, keys["dataset_id"]).alias("dataset_id"),
        string_prop(props, keys["variant"]).alias("variant"),
        string_prop(props, keys["observation"]).alias("observation"),
        string_prop(props, keys["latest_dataset_cid"]).alias("latest_cid"),
        number_prop(props, keys["concatPriority"]).alias("concat_priority"),
        string_prop(props, keys["concatDimension"]).alias("concat_dimension"),
        F.try_variant_get("i.bbox", "$", "array<double>").alias("bbox"),
        *[string_prop(props, c).alias(c) for c in ("start_datetime", "end_datetime", "datetime")],
    )
    return read.select(
        "href",
        "part",
        F.when(F.col("n.links").isNotNull(), node).alias("node"),
        F.when(F.col("i").isNotNull(), item).alias("item"),
    )


def _out_links(nodes: DataFrame, rel: str, *keep: str) -> DataFrame:
    """Links of one relation, each with its place in the parent document."""
    links = nodes.select(*keep, F.explode("node.links").alias("link"))
    return links.where(F.col("link.rel") == rel)


def _entries(links: DataFrame, prefix: str, *keep: str) -> DataFrame:
    """Declared names of the link keys starting with ``prefix``."""
    return (
        links.select(*keep, F.explode("link.entries").alias("entry"))
        .where(F.col("entry.key").startswith(prefix))
        .select(
            *keep,
            F.col("entry.key_pos").alias("key_pos"),
            F.col("entry.key").alias("key"),
            F.posexplode("entry.values").alias("value_pos", "value"),
        )
    )


def _behind(links: DataFrame, parsed: DataFrame) -> DataFrame:
    """The parsed documents behind links."""
    return parsed.withColumnRenamed("href", "target").join(links, "target")


def _unreadable(links: DataFrame, followed: DataFrame, level: str) -> DataFrame:
    readable = followed.select("target").distinct()
    return links.join(readable, "target", "left_anti").select(
        F.lit(level).alias("level"), F.col("source").alias("parent_href"), F.col("target").alias("href")
    )


def catalog_walk(
    docs: DataFrame, root_href: str, keys: CatalogKeys = CatalogKeys(), require_root: bool = False
) -> Catalog:
    """Flat tables of the tree under ``root_href``, all lazy."""
    return walk_parsed(parse_documents(docs, keys), root_href, keys, require_root)


def walk_parsed(
    parsed: DataFrame, root_href: str, keys: CatalogKeys = CatalogKeys(), require_root: bool = False
) -> Catalog:
    """The same from documents that are parsed already."""
    nodes = parsed.select("href", "part", "node").where(F.col("node").isNotNull())
    items_parsed = parsed.select("href", "item").where(F.col("item").isNotNull())
    root = nodes.where(F.col("href") == root_href)
    if require_root and root.isEmpty():
        raise StacLoadError(f"The catalog root {root_href} cannot be read.")
    org_links = (
        _out_links(root, "child", "href", "part")
        .where(F.col("link.id").isNotNull())
        .select(
            F.col("href").alias("source"),
            F.struct("part", "link.pos").alias("org_ord"),
            F.col("link.id").alias("organization_id"),
            F.col("link.title").alias("organization_title"),
            F.col("link.href").alias("target"),
            "link",
        )
    )
    declared = _entries(org_links, keys["collections"], "organization_id", "org_ord")
    slugs = _entries(org_links, keys["datasets"], "organization_id", "org_ord").where(
        F.col("key") == keys["datasets"]
    )
    slug_parts = F.split("value", "/")
    categories = (
        declared.where(F.col("key").startswith(keys["collections"] + ":"))
        .withColumn("category", blank_to_null(F.element_at(F.split("key", ":"), -1)))
        .where(F.col("category").isNotNull())
        .groupBy("organization_id", F.col("value").alias("collection"))
        .agg(F.max_by("category", F.struct("key_pos", "value_pos")).alias("category"))
    )
    declared_names = (
        declared.select("organization_id", "org_ord", F.col("value").alias("collection"))
        .unionByName(slugs.select("organization_id", "org_ord", F.get(slug_parts, 0).alias("collection")))
        .where(F.col("collection") != "")
        .groupBy("organization_id", "collection")
        .agg(F.min("org_ord").alias("org_ord"))
    )
    declared_datasets = (
        slugs.select("organization_id", F.get(slug_parts, 0).alias("collection"), F.get(slug_parts, 1).alias("dataset"))
        .where(F.col("dataset") != "")
        .distinct()
    )

    org_docs = _behind(org_links.drop("link"), nodes)
    carried = ["organization_id", "organization_title", "org_ord"]
    collection_links = _out_links(
        org_docs.drop("source").withColumnRenamed("target", "href"), "child", "href", "part", *carried
    ).select(
        F.col("href").alias("source"),
        *carried,
        F.struct("org_ord", "part", "link.pos").alias("ord"),
        F.col("link.href").alias("target"),
    )
    collection_docs = _behind(collection_links.drop("source"), nodes)
    found = collection_docs.groupBy(
        F.col("node.id").alias("collection"), "organization_id", "organization_title"
    ).agg(F.max("node.title").alias("title"), F.min("ord").alias("ord"))
    collections = found.join(categories, ["organization_id", "collection"], "left").select(
        "collection",
        "organization_id",
        F.col("organization_id").alias("organization"),
        "organization_title",
        "title",
        "category",
        "ord",
    )

    item_links = _out_links(
        collection_docs.withColumnRenamed("target", "href").withColumn("collection", F.col("node.id")),
        "item",
        "href",
        "collection",
        "organization_id",
        "ord",
        "part",
    ).select(
        F.col("href").alias("source"),
        "collection",
        "organization_id",
        F.struct("ord", "part", "link.pos").alias("ord"),
        F.col("link.href").alias("target"),
        "link.id",
        "link.concat_priority",
        "link.concat_dimension",
    )
    item_docs = _behind(item_links.select("collection", "organization_id", "ord", "target"), items_parsed)
    items = item_docs.select("collection", F.col("organization_id").alias("organization"), "ord", "item.*")
    broken = reduce(
        DataFrame.unionByName,
        [
            _unreadable(org_links, org_docs, "organization"),
            _unreadable(collection_links, collection_docs, "collection"),
            _unreadable(item_links, item_docs, "item"),
        ],
    )
    return Catalog(
        organizations=org_docs.select("organization_id", "organization_title", "org_ord").distinct(),
        collections=collections,
        item_links=item_links,
        items=items,
        declared=declared_names,
        declared_datasets=declared_datasets,
        categories=categories,
        broken_links=broken,
    )


def load_catalog(docs: DataFrame, root_href: str, keys: CatalogKeys = CatalogKeys()) -> Catalog:
    """``catalog_walk`` that raises when the root itself cannot be read. The parsed documents are
    settled, so that no output of the walk parses them again."""
    return walk_parsed(settle(parse_documents(docs, keys)), root_href, keys, require_root=True)
