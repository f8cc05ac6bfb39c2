"""The dataset wrapper: a cell table, its dimensions and its lineage."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame

from .errors import InvalidSelectionError, NoDataFoundError
from .model import (
    LATITUDE_KEYS,
    LONGITUDE_KEYS,
    YEAR_PARTITION,
    DatasetMetadata,
    field_attrs,
    infer_coord,
    infer_dims,
)
from .operators import introspect, points as point_ops, records, selection


def read_bounds(bounds, options=None) -> tuple[float, float, float, float, dict]:
    """West, south, east, north and key options of a tuple or mapping."""
    if isinstance(bounds, dict):
        sides = [bounds.get(k) for k in ("west", "south", "east", "north")]
        options = bounds.get("options") or options
    else:
        sides = list(bounds)
    if len(sides) != 4:
        raise InvalidSelectionError("Bounds need west, south, east and north.")
    for side in sides:
        if isinstance(side, bool) or not isinstance(side, (int, float)) or not math.isfinite(side):
            raise InvalidSelectionError("Bounds must be finite numbers: west, south, east, north.")
    west, south, east, north = sides
    if west >= east:
        raise InvalidSelectionError(f"The west bound {west} must be less than the east bound {east}.")
    if south >= north:
        raise InvalidSelectionError(f"The south bound {south} must be less than the north bound {north}.")
    return west, south, east, north, dict(options or {})


@dataclass(frozen=True)
class Narrowing:
    """Selections on stored cells: ``within`` opens the files that meet all ``conditions``, and
    ``steps`` are the selections themselves, made again on what it gives."""

    within: Callable[[list], DataFrame]
    conditions: tuple = ()
    steps: tuple[Callable[[DataFrame], DataFrame], ...] = ()

    def then(self, step: Callable[[DataFrame], DataFrame], alternatives: list[dict] | None) -> Narrowing:
        more = (alternatives,) if alternatives else ()
        return Narrowing(self.within, (*self.conditions, *more), (*self.steps, step))

    def cells(self) -> DataFrame:
        found = self.within(list(self.conditions))
        for step in self.steps:
            found = step(found)
        return found


@dataclass(frozen=True)
class GridDataset:
    """Lazy selections on cells; every selection returns a new dataset.

    With ``strict`` the empty and ill-formed cases raise, at the cost of one
    small job per selection. ``axes`` maps a dimension to a table of its
    values; it is kept only by selections that leave those axes valid. Stored
    ``cells`` may carry the directory of the UTC year of ``year_of`` along, so that
    time ranges prune; ``df`` is without it. ``narrowing`` has the files of stored cells chosen by
    their zones: a box, circle, exact point or time range then opens the files that meet it and
    all selections before it, after a small job over the store's file table.
    """

    cells: DataFrame
    metadata: DatasetMetadata = field(default_factory=DatasetMetadata)
    dims: tuple[str, ...] | None = None
    strict: bool = False
    axes: dict[str, DataFrame] = field(default_factory=dict)
    year_of: str | None = None
    narrowing: Narrowing | None = None
    _settled: dict = field(default_factory=dict, init=False, repr=False, compare=False)

    def __post_init__(self):
        if self.dims is None:
            object.__setattr__(self, "dims", infer_dims(self.df.schema))

    @property
    def df(self) -> DataFrame:
        """The cells as a table of dimensions and variables."""
        return self.cells.drop(YEAR_PARTITION) if self.year_of else self.cells

    def _with(self, cells: DataFrame, **changes) -> GridDataset:
        values = {
            "metadata": self.metadata,
            "dims": self.dims,
            "strict": self.strict,
            "axes": {},
            "year_of": self.year_of,
        }
        return GridDataset(cells, **{**values, **changes})

    def _selected(self, step: Callable[[DataFrame], DataFrame], alternatives: list[dict] | None = None, **changes) -> GridDataset:
        """The dataset after a selection of rows, from the files that can hold any."""
        if self.narrowing is None:
            return self._with(step(self.cells), **changes)
        after = self.narrowing.then(step, alternatives)
        return self._with(after.cells() if alternatives else step(self.cells), narrowing=after, **changes)

    # -- introspection ------------------------------------------------------

    @property
    def info(self) -> DatasetMetadata:
        return self.metadata

    @cached_property
    def variables(self) -> list[str]:
        return introspect.variables(self.df, self.dims)

    @property
    def coords(self) -> dict[str, DataFrame]:
        return {d: self.axis(d) for d in self.dims}

    def axis(self, dim: str) -> DataFrame:
        if dim not in self.dims:
            raise KeyError(f"No dimension named {dim}.")
        return introspect.axis(self.axes.get(dim, self.df), dim)

    def sizes(self) -> DataFrame:
        return introspect.sizes(self.df, self.dims, self.axes)

    def attrs(self, variable: str) -> dict:
        return field_attrs(self.df, variable)

    def get_variable(self, name: str) -> DataFrame:
        return introspect.get_variable(self.df, self.dims, name)

    def describe(self, preview: bool = False) -> DataFrame:
        return introspect.describe_dataset(self.df, self.dims, preview, self.axes)

    def is_empty(self) -> bool:
        return self.df.isEmpty()

    def is_dataset_empty(self) -> bool:
        return introspect.is_dataset_empty(self.df, self.dims)

    def emptiness(self, wanted: DataFrame, keys: list[str]) -> DataFrame:
        """The rows of a table of selections, by values of ``keys``, with whether each is empty."""
        return introspect.emptiness(self.df, self.dims, keys, wanted)

    def ensure_has_data(self) -> GridDataset:
        if self.is_empty():
            raise NoDataFoundError("The selection holds no cells.")
        return self

    def infer_coord(self, candidates) -> str | None:
        return infer_coord(self.dims, candidates)

    # -- output -------------------------------------------------------------

    def to_records(self, variable: str, precision: int | None = None) -> DataFrame:
        return records.to_records(self.df, self.dims, variable, precision)

    def to_json_records(self) -> DataFrame:
        return records.to_json_records(self.df.select(*self.dims, *self.variables))

    # -- selections ---------------------------------------------------------

    def point(
        self,
        latitude: float,
        longitude: float,
        method: str = "nearest",
        tolerance: float | None = None,
        latitude_key: str | None = None,
        longitude_key: str | None = None,
    ) -> GridDataset:
        """Cells at one position; ``nearest`` per axis, or ``exact``."""
        lat = latitude_key or self.infer_coord(LATITUDE_KEYS)
        lon = longitude_key or self.infer_coord(LONGITUDE_KEYS)
        if not lat or not lon:
            raise InvalidSelectionError("No latitude and longitude columns among the dimensions.")
        kept = {d: t for d, t in self.axes.items() if d not in (lat, lon)}
        if method == "exact":
            picked = self._selected(
                lambda cells: selection.point_exact(cells, latitude, longitude, lat, lon),
                [{lat: (latitude, latitude), lon: (longitude, longitude)}],
                axes=kept,
            )
        else:
            # The nearest values are those of all cells of the dataset, not of the files that others left.
            known = {**{d: self.df for d in (lat, lon) if d in self.df.columns}, **self.axes}
            picked = self._selected(
                lambda cells: selection.point_nearest(cells, latitude, longitude, lat, lon, tolerance, known), axes=kept
            )
        return picked.ensure_has_data() if self.strict else picked

    def points(
        self,
        latitudes,
        longitudes=None,
        epsg_crs: int = point_ops.EPSG_WGS84,
        snap_to_grid: bool = True,
        tolerance: float = point_ops.TOLERANCE,
        latitude_key: str = "latitude",
        longitude_key: str = "longitude",
        expand: bool = True,
    ) -> GridDataset | point_ops.PointCells:
        """Cells at many positions: two lists, or a table of points.

        A table has ``point_id``, ``latitude`` and ``longitude`` and may be of
        any size. Strict datasets refuse a miss when not snapping. ``expand=False`` keeps
        points, places and cells apart (see ``PointCells``), so that points on one place share
        its cells.
        """
        if isinstance(latitudes, DataFrame):
            wanted = latitudes
        else:
            wanted = point_ops.points_table(self.df.sparkSession, latitudes, longitudes, epsg_crs)
        snapped = self._snap(wanted, latitude_key, longitude_key)
        reach = None if snap_to_grid else tolerance
        if self.strict and not snap_to_grid:
            if not point_ops.misses(snapped, latitude_key, longitude_key, reach).isEmpty():
                raise NoDataFoundError("At least one point has no grid position within the tolerance.")
        found = point_ops.hits(snapped, latitude_key, longitude_key, reach)
        if not expand:
            return point_ops.factorised(self.df, found, latitude_key, longitude_key)
        df = point_ops.join_cells(self.cells, found, latitude_key, longitude_key)
        return self._with(df, dims=(*point_ops.POINT_COLUMNS, *self.dims))

    def points_missed(
        self,
        wanted: DataFrame,
        tolerance: float = point_ops.TOLERANCE,
        latitude_key: str = "latitude",
        longitude_key: str = "longitude",
    ) -> DataFrame:
        """The points of a table that no grid position is close enough to."""
        snapped = self._snap(wanted, latitude_key, longitude_key)
        return point_ops.misses(snapped, latitude_key, longitude_key, tolerance)

    def _snap(self, wanted: DataFrame, latitude_key: str, longitude_key: str) -> DataFrame:
        """Snapped points; the axes are settled once per dataset."""
        selection.require_coords(self.df, latitude_key, longitude_key)
        for dim in (latitude_key, longitude_key):
            if dim not in self._settled:
                self._settled[dim] = point_ops.settled_axis(self.df, dim, self.axes)
        return point_ops.snap_points(self.df, wanted, latitude_key, longitude_key, self._settled)

    def circle(
        self,
        center_lat: float,
        center_lon: float,
        radius_km: float,
        latitude_key: str = "latitude",
        longitude_key: str = "longitude",
        masked: bool = False,
    ) -> GridDataset:
        """Cells within a radius; ``masked`` keeps the sub-grid around them
        with the values outside set to NULL."""
        args = (center_lat, center_lon, radius_km, latitude_key, longitude_key)
        selection.check_circle(self.cells, *args)
        zones = selection.circle_zones(*args)
        if not masked:
            return self._selected(lambda cells: selection.circle(cells, *args), zones)
        variables = self.variables
        found = self._selected(lambda cells: selection.circle_masked(cells, *args, variables=variables), zones)
        # The lines that stay follow from all cells here: no later selection may take files away.
        return self._with(found.cells)

    def rectangle(
        self,
        min_lat: float,
        min_lon: float,
        max_lat: float,
        max_lon: float,
        latitude_key: str = "latitude",
        longitude_key: str = "longitude",
    ) -> GridDataset:
        sides = (min_lat, min_lon, max_lat, max_lon, latitude_key, longitude_key)
        selection.check_rectangle(self.cells, *sides)
        if self.strict:
            selection.check_axis_ranges(self.df, latitude_key, longitude_key, self.axes)
        return self._selected(
            lambda cells: selection.rectangle(cells, *sides),
            [{latitude_key: (min_lat, max_lat), longitude_key: (min_lon, max_lon)}],
        )

    def time_range(self, start, end, dimension: str = "time") -> GridDataset:
        kept = self._selected(
            lambda cells: selection.time_range(cells, start, end, dimension, self.dims, self.year_of),
            selection.time_zones(self.cells, start, end, dimension, self.dims),
        )
        if self.strict and kept.is_empty():
            raise InvalidSelectionError(f"No data between {start} and {end}.")
        return kept

    def select(self, point: dict | None = None, time_range=None, bounds=None, bounds_options=None) -> GridDataset:
        """Point, then time range, then bounds, in one lazy plan.

        ``point``: arguments of :meth:`point`; ``time_range``: a pair or a
        mapping of ``start`` and ``end``; ``bounds``: (west, south, east,
        north) or a mapping. After a point, a dataset without a usable time
        column keeps the point result.
        """
        if point and bounds:
            raise InvalidSelectionError("A selection takes a point or bounds, not both.")
        current = self
        if point:
            current = current.point(**point)
        if time_range:
            start, end = (
                (time_range["start"], time_range["end"]) if isinstance(time_range, dict) else time_range
            )
            try:
                key = selection.time_key(current.dims)
            except InvalidSelectionError:
                if not point:
                    raise
            else:
                current = current.time_range(start, end, key)
        if bounds:
            west, south, east, north, options = read_bounds(bounds, bounds_options)
            current = current.rectangle(south, west, north, east, **options)
            if self.strict:
                current.ensure_has_data()
        return current
