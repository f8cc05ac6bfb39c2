"""Catalog requests turned into datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dataset import GridDataset, Narrowing
from .errors import DatasetNotFoundError, StacResolutionError
from .model import CatalogKeys, DatasetMetadata, DatasetRequest, normalize_name
from .operators.concat import (
    DEFAULT_DIMENSION,
    VariantCells,
    after_cutoff,
    concat_keyed,
    concat_variants,
    place_variants,
    variant_ends,
)
from .plans.concatenable import concatenable_items, concatenation_groups
from .plans.listing import list_datasets, list_datasets_api
from .plans.resolution import (
    AMBIGUOUS_VARIANT,
    DATASET_NOT_FOUND,
    OK,
    VARIANT_NOT_FOUND,
    available_variants,
    items_by_id,
    items_by_property,
    resolve_api_then_items,
    resolve_datasets,
    resolve_datasets_api,
)
from .plans.sizing import BROADCAST_ROWS, fits, settle
from .plans.walk import load_catalog
from .sources.cells import CellTable, cid_required
from .sources.series import KeptSeries

_REQUEST_SCHEMA = T.StructType(
    [T.StructField("request_id", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in ("collection", "dataset", "variant", "organization")]
)


RESOLVERS = ("items", "api", "api_then_items")


class GridEngine:
    """Item table plus cell store.

    ``resolver`` picks the resolution rules: ``items`` (names from item ids,
    ambiguous variants raise), ``api`` (names from properties, first match) or
    ``api_then_items`` (the first of these two that succeeds).
    """

    def __init__(
        self,
        spark: SparkSession,
        items: DataFrame,
        store,
        collections: DataFrame | None = None,
        declared: DataFrame | None = None,
        declared_datasets: DataFrame | None = None,
        item_links: DataFrame | None = None,
        resolver: str = "items",
        strict: bool = False,
    ):
        if resolver not in RESOLVERS:
            raise ValueError(f"resolver is one of {', '.join(RESOLVERS)}.")
        self.spark = spark
        self.items = items
        self.store = store
        self.collections = collections
        self.declared = declared
        self.declared_datasets = declared_datasets
        self.item_links = item_links
        self.resolver = resolver
        self.strict = strict

    @classmethod
    def from_documents(
        cls, documents: DataFrame, root_href: str, store, keys: CatalogKeys = CatalogKeys(), **options
    ) -> GridEngine:
        """Engine over a tree of catalog documents (see ``catalog_walk``)."""
        tree = load_catalog(documents, root_href, keys)
        return cls(
            documents.sparkSession,
            tree.items,
            store,
            collections=tree.collections,
            declared=tree.declared,
            declared_datasets=tree.declared_datasets,
            item_links=tree.item_links,
            **options,
        )

    # -- catalog ------------------------------------------------------------

    def list_available_datasets(self, form: str = "api") -> DataFrame:
        if form == "api":
            return list_datasets_api(self.items, self.collections)
        return list_datasets(self.items, self.collections, self.declared_datasets)

    list_catalog_entries = list_available_datasets

    def resolve(self, requests: DataFrame) -> DataFrame:
        """Resolution of a table of requests; see ``resolve_datasets``."""
        return self._resolve(requests, self.items)

    def _resolve(self, requests: DataFrame, items: DataFrame) -> DataFrame:
        if self.resolver == "api":
            return resolve_datasets_api(requests, items)
        if self.resolver == "api_then_items":
            return resolve_api_then_items(requests, items, self.collections, self.declared)
        return resolve_datasets(requests, items, self.collections, self.declared)

    def _resolve_one(self, request: DatasetRequest):
        row = (0, request.collection, request.dataset, request.variant, request.organization)
        items = self.items
        if request.collection:
            # Only collections of this name, bare or behind an organization,
            # can be meant; the predicate reaches the scan of the items.
            # Items that state no collection may be of any.
            name, unstated = F.col("collection"), F.coalesce(F.col("collection") == "", F.lit(True))
            items = items.where(unstated | (name == request.collection) | name.endswith(f"_{request.collection}"))
            if request.organization:
                full = f"{request.organization}_{request.collection}"
                items = items.where(unstated | name.isin(request.collection, full))
        found = self._resolve(self.spark.createDataFrame([row], _REQUEST_SCHEMA), items).first()
        if found.status != OK:
            raise self._failure(request, found)
        return found

    def resolve_cid(self, request: DatasetRequest) -> str:
        """Content id of one request."""
        return request.cid or self._resolve_one(request).cid

    def _failure(self, request: DatasetRequest, found) -> StacResolutionError:
        """What went wrong, with every name that would have resolved.

        The names are those that the resolver itself reads from the items of the
        collection; ``available`` on the error is the same as a table.
        """
        text = f"{request.collection}/{request.dataset}/{request.variant or ''}: {found.status}"
        named = items_by_property(self.items) if self.resolver == "api" else items_by_id(self.items)
        here = available_variants(named.where(F.col("collection_id") == found.collection_id))
        if found.status == DATASET_NOT_FOUND:
            names = here.select("dataset").distinct()
        elif found.status in (VARIANT_NOT_FOUND, AMBIGUOUS_VARIANT):
            names = here.where(F.col("dataset") == request.dataset).select("variant")
        else:
            return StacResolutionError(text, found.status)
        listed = [r[0] for r in names.orderBy(names.columns[0]).collect()]  # the names of one collection
        return StacResolutionError(f"{text}; available: {', '.join(map(str, listed))}", found.status, names)

    # -- loading ------------------------------------------------------------

    def _open(self, cid: str, metadata: DatasetMetadata) -> GridDataset:
        opened = self.store.open(cid)
        narrowing = Narrowing(opened.within) if opened.within else None
        return GridDataset(opened.cells, metadata, opened.dims, self.strict, opened.axes, opened.year_of, narrowing)

    def load_dataset(self, request: DatasetRequest, auto_concatenate: bool = False) -> GridDataset:
        """Dataset of one request: by content id, or through the catalog.

        Resolution is one job with a one-row result; the cells stay lazy.
        """
        if request.cid:
            return self._open(request.cid, DatasetMetadata(cid=request.cid, source="direct_cid"))
        if not request.dataset or not normalize_name(request.dataset):
            raise DatasetNotFoundError("A dataset name must be given.")
        if auto_concatenate and not request.variant:
            joined = self._load_concatenated(request)
            if joined is not None:
                return joined
        found = self._resolve_one(request)
        metadata = DatasetMetadata(
            dataset=request.dataset,
            collection=found.collection_id,
            variant=found.resolved_variant,
            organization=found.organization_id,
            path=_path(found.collection_id, request.dataset, found.resolved_variant),
            cid=found.cid,
            source="stac",
        )
        return self._open(found.cid, metadata)

    def _load_concatenated(self, request: DatasetRequest) -> GridDataset | None:
        collection = request.collection or ""
        if request.organization and not collection.startswith(f"{request.organization}_"):
            collection = f"{request.organization}_{collection}"
        variants = concatenable_items(self.items, self.item_links).where(
            (F.col("collection") == collection) & (F.col("dataset") == request.dataset)
        )
        listed = variants.orderBy("ord").collect()  # the variants of one dataset
        if len(listed) < 2:
            return None
        found = self._resolve_one(request)
        dimension = min(listed, key=lambda v: v.concat_priority).concat_dimension
        if isinstance(self.store, CellTable):
            # One table holds them all: it is read no more often for many variants than for two.
            held, dims = self.store.cells, self.store.dims
            loaded = [VariantCells(v.variant, held, v.concat_priority, v.concat_dimension, cid_required(v.cid)) for v in listed]
            cells = concat_keyed(held, self.store.cid_column, loaded, self.strict)
        else:
            opened = [self.store.open(v.cid) for v in listed]
            loaded = [
                VariantCells(
                    v.variant,
                    GridDataset(o.cells, dims=o.dims, year_of=o.year_of).df,
                    v.concat_priority,
                    v.concat_dimension,
                    v.cid,
                    o.axes.get(dimension),
                )
                for v, o in zip(listed, opened, strict=True)
            ]
            cells, dims = concat_variants(loaded, self.strict), opened[0].dims
        names = tuple(v.variant for v in listed)
        metadata = DatasetMetadata(
            dataset=request.dataset,
            collection=found.collection_id,
            variant=None,
            organization=found.organization_id,
            path=_path(found.collection_id, request.dataset),
            cid=listed[0].cid,
            source="stac_concatenated",
            concatenated_variants=names,
            concat_dimension=dimension,
        )
        return GridDataset(cells, metadata, dims, self.strict)

    def _concatenate_many(self, variants: DataFrame, dimension: str, group: tuple[str, ...] = ()) -> DataFrame:
        """Variants joined into series, one per ``group``, in one pass.

        The ends of the variants come from the axis tables, so the cut-offs are
        known before the cells are read, and the cells are joined only once.
        """
        # An item listed twice adds nothing the second time.
        once = variants.groupBy(*group, "variant", "cid").agg(
            F.min("concat_priority").alias("priority"), F.min("ord").alias("tie")
        )
        ends = variant_ends(self.store.axis_table(dimension), "cid", dimension)
        ended = once.join(ends, "cid")
        placed = place_variants(ended, group, "variant", "cid")
        chosen = placed.select("cid", *group, "variant", F.col("priority").alias("concat_priority"), "cutoff")
        return after_cutoff(self._join_cells(chosen), dimension).drop("cutoff")

    def _join_cells(self, chosen: DataFrame) -> DataFrame:
        """Cells of every chosen ``cid``; files of others are not opened.

        The choice is settled first, as it is looked up, counted and joined. An
        empty id names no dataset, and the predicate saying so is also what
        makes the join prune partitions at run time.
        """
        chosen = settle(chosen).where(F.col("cid") > "")
        cells = self.store.table(chosen)
        return cells.join(F.broadcast(chosen) if fits(chosen, BROADCAST_ROWS) else chosen, "cid")

    def load_many(self, requests: DataFrame) -> DataFrame:
        """Cells of every request that resolves, tagged with ``request_id``.

        One job for any number of requests; with a partitioned store only the
        directories of the resolved content ids are read.
        """
        found = self.resolve(requests).where(F.col("status") == OK)
        return self._join_cells(found.select("request_id", "cid", F.col("resolved_variant").alias("variant")))

    def auto_concatenate_many(self, dimension: str = DEFAULT_DIMENSION) -> DataFrame:
        """Every dataset with several variants along ``dimension``, each
        joined into one series, tagged with collection, dataset and variant."""
        listed = concatenable_items(self.items, self.item_links)
        groups = concatenation_groups(listed).where(F.col("concat_dimension") == dimension)
        name = ["collection", "dataset"]
        several = listed.join(groups.select(*name), name, "left_semi")
        return self._concatenate_many(several, dimension, tuple(name))

    def update_series(self, series: KeptSeries, since: int = 0) -> int:
        """Bring a kept series up to date with the writes after a commit of the store; returns the
        store's last commit, to go on from.

        The series are those of ``auto_concatenate_many``. Of datasets that were only added to, the
        added cells are read, of replaced ones all, and of others what a falling cut-off uncovers.
        """
        head = self.store.head()
        listed = concatenable_items(self.items, self.item_links)
        groups = concatenation_groups(listed).where(F.col("concat_dimension") == series.dim)
        name = ["collection", "dataset"]
        once = listed.join(groups.select(*name), name, "left_semi").groupBy(*name, "variant", "cid").agg(
            F.min("concat_priority").alias("concat_priority"), F.min("ord").alias("ord")
        )
        once = settle(once.where(F.col("cid") > ""))
        changed = settle(once.join(self.store.changes(since), "cid"))
        source = self.store.table(once).join(once, "cid").drop("cid")
        for mode, replaced in (("overwrite", True), ("append", False)):
            part = changed.where(F.col("replaced") == replaced).drop("replaced")
            if not part.isEmpty():
                cells = self.store.table(part, since=since).join(part, "cid").drop("cid")
                series.apply(cells, mode, source)
        return head

    def select_dataset(
        self, request: DatasetRequest, auto_concatenate: bool = False, **selection
    ) -> GridDataset:
        """Load and select in one call; see :meth:`GridDataset.select`."""
        return self.load_dataset(request, auto_concatenate).select(**selection)


def _path(*parts: str | None) -> str:
    return "-".join(p for p in parts if p)
