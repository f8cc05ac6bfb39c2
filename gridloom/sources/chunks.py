"""Array chunks turned into addressable cells."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import InvalidSelectionError


@dataclass(frozen=True)
class ChunkAxis:
    """One dimension of a chunk, slowest first in the list of dimensions.

    A regular axis has an ``origin`` (first coordinate of the chunk) and a
    ``step``. An irregular one has ``values``, a table of ``position`` and
    ``value``, and ``origin`` is the position of the chunk's first element.
    ``size`` is the length inside the chunk; the slowest axis needs none.
    """

    name: str
    origin: Column | float = 0.0
    step: Column | float = 1.0
    size: Column | int | None = None
    values: DataFrame | None = None


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _offsets(axes: list[ChunkAxis], position: Column) -> dict[str, Column]:
    """Index of an element along each axis, from its place in the flat array."""
    offsets = {}
    for axis in reversed(axes):
        if axis.size is None:
            offsets[axis.name] = position
        else:
            size = _col(axis.size).cast("int")
            offsets[axis.name] = F.pmod(position, size)
            position = F.floor(position / size)
    return offsets


def _addressed(
    elements: DataFrame, variable: str, axes: list[ChunkAxis], keep: dict[str, Column], how: str = "left"
) -> DataFrame:
    """Elements (``_pos``, ``_value`` and the columns of their chunk) as cells."""
    offsets = _offsets(axes, F.col("_pos"))
    coordinates = [
        (_col(a.origin) + offsets[a.name] * _col(a.step)).cast("double").alias(a.name)
        if a.values is None
        else (_col(a.origin) + offsets[a.name]).cast("long").alias(a.name)
        for a in axes
    ]
    cells = elements.select(
        *coordinates,
        *[c.alias(name) for name, c in keep.items()],
        F.col("_value").cast("double").alias(variable),
    )
    for axis in axes:
        if axis.values is not None:
            lookup = axis.values.select(F.col("position").alias(axis.name), F.col("value").alias("_at"))
            cells = cells.join(lookup, axis.name, how)
            cells = cells.withColumn(axis.name, F.col("_at")).drop("_at")
    return cells.select(*[a.name for a in axes], *keep, variable)


def explode_chunks(
    chunks: DataFrame, values: str, variable: str, axes: list[ChunkAxis], keep: dict[str, Column] | None = None
) -> DataFrame:
    """One row per array element: coordinates, ``keep`` columns, value.

    Every chunk is exploded where it lies; a chunk is the unit of work, so no
    shuffle is needed on regular axes. A position that an irregular axis does not
    have keeps its cell, with a NULL coordinate.
    """
    cells = chunks.select("*", F.posexplode(values).alias("_pos", "_value"))
    return _addressed(cells, variable, axes, keep or {})


#: Inclusive ends of a selection along an axis; None leaves a side open.
Bounds = dict[str, tuple[float | None, float | None]]


def _length(axes: list[ChunkAxis], axis: ChunkAxis, values: str) -> Column:
    """Elements of a chunk along an axis; the slowest may leave it to the array."""
    if axis.size is not None:
        return _col(axis.size).cast("long")
    others = F.lit(1).cast("long")
    for other in axes:
        if other is not axis:
            others = others * _col(other.size).cast("long")
    return F.ceil(F.size(values) / F.greatest(others, F.lit(1)))


def _regular_range(axis: ChunkAxis, low: float | None, high: float | None, length: Column) -> tuple[Column, Column]:
    """First and last index whose coordinate may lie between the ends.

    One more on either side than the division says, as it is rounded; the exact test on the
    coordinate follows. A step of zero says nothing.
    """
    origin, step = _col(axis.origin).cast("double"), _col(axis.step).cast("double")
    begin, end = F.lit(0).cast("long"), length - 1
    at = lambda value: F.try_divide(F.lit(float(value)) - origin, step)
    rising = step > 0
    least, most = F.lit(None).cast("double"), F.lit(None).cast("double")
    if low is not None:
        least, most = F.when(rising, at(low)), F.when(~rising, at(low))
    if high is not None:
        least = F.coalesce(least, F.when(~rising, at(high)))
        most = F.coalesce(most, F.when(rising, at(high)))
    # Far beyond any index, a double does not fit a long; NULL says nothing.
    clipped = lambda v: F.least(F.greatest(v, F.lit(-2.0)), F.lit(2.0**40))
    first = F.when(least.isNotNull(), F.greatest(begin, F.ceil(clipped(least)) - 1)).otherwise(begin)
    last = F.when(most.isNotNull(), F.least(end, F.floor(clipped(most)) + 1)).otherwise(end)
    return first, last


def _known_range(axis: ChunkAxis, low: float | None, high: float | None, length: Column) -> tuple[ChunkAxis, Column, Column]:
    """The same for an axis given as a table, which is cut to the values between the ends."""
    inside = F.col("value").isNotNull()
    if low is not None:
        inside = inside & (F.col("value") >= F.lit(low))
    if high is not None:
        inside = inside & (F.col("value") <= F.lit(high))
    kept = axis.values.where(inside)
    origin = _col(axis.origin).cast("long")
    ends = kept.agg(F.min("position").alias("low"), F.max("position").alias("high"))
    # No value between the ends: no index either.
    first = F.coalesce(ends.select("low").scalar() - origin, length)
    last = F.coalesce(ends.select("high").scalar() - origin, F.lit(-1).cast("long"))
    cut = ChunkAxis(axis.name, axis.origin, axis.step, axis.size, kept)
    return cut, F.greatest(first, F.lit(0).cast("long")), F.least(last, length - 1)


def _further(first: Column, last: Column, length: Column) -> Callable[[Column], Column]:
    """Places along one more axis behind each place so far."""
    return lambda base: F.transform(F.sequence(first, last), lambda i: base * length + i)


def select_chunks(
    chunks: DataFrame,
    values: str,
    variable: str,
    axes: list[ChunkAxis],
    bounds: Bounds,
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """The cells of ``explode_chunks`` whose coordinates lie within ``bounds``, ends included.

    The bounds become a range of indices of each chunk, by arithmetic on its origin, step
    and size. Chunks without any are dropped ahead of the explosion, and of the others only the
    elements in the ranges are taken out of the array and exploded. Cells without a coordinate on a
    bounded axis are in no selection.
    """
    unknown = set(bounds) - {a.name for a in axes}
    if unknown:
        raise InvalidSelectionError(f"No axis named {', '.join(sorted(unknown))}.")
    kept_axes, ranges, exact = [], [], F.lit(True)
    for axis in axes:
        length = _length(axes, axis, values)
        low, high = bounds.get(axis.name, (None, None))
        if low is None and high is None:
            first, last = F.lit(0).cast("long"), length - 1
        elif axis.values is None:
            first, last = _regular_range(axis, low, high, length)
            if low is not None:
                exact = exact & (F.col(axis.name) >= F.lit(float(low)))
            if high is not None:
                exact = exact & (F.col(axis.name) <= F.lit(float(high)))
        else:
            axis, first, last = _known_range(axis, low, high, length)
        kept_axes.append(axis)
        ranges.append((first, last, length))
    # Columns of their own: a range may hang on a subquery, which a lambda cannot hold.
    named = {f"_{part}{k}": c for k, r in enumerate(ranges) for part, c in zip("fln", r, strict=True)}
    chunks = chunks.select("*", *[c.cast("long").alias(name) for name, c in named.items()])
    ranges = [tuple(F.col(f"_{part}{k}") for part in "fln") for k in range(len(ranges))]
    some = F.lit(True)
    for first, last, _ in ranges:
        some = some & (first <= last)
    # Places in the flat array, the slowest axis outside; the ranges are not empty here.
    places = F.array(F.lit(0).cast("long"))
    for first, last, length in ranges:
        places = F.flatten(F.transform(places, _further(first, last, length)))
    within = F.filter(places, lambda p: p < F.size(values))
    taken = F.transform(within, lambda p: F.struct(p.alias("pos"), F.get(F.col(values), p.cast("int")).alias("value")))
    found = chunks.where(F.col(values).isNotNull() & some).select("*", F.explode(taken).alias("_taken"))
    found = found.withColumns({"_pos": F.col("_taken.pos"), "_value": F.col("_taken.value")})
    bounded = any(a.values is not None and a.name in bounds and bounds[a.name] != (None, None) for a in axes)
    if not bounded:
        return _addressed(found, variable, kept_axes, keep or {}).where(exact)
    # Axes that were cut join from the inside; one that was not keeps its cells without a coordinate.
    cut = [a for a in kept_axes if a.values is not None and bounds.get(a.name, (None, None)) != (None, None)]
    whole = [a.name for a in kept_axes if a.values is not None and a not in cut]
    if not whole:
        return _addressed(found, variable, kept_axes, keep or {}, "inner").where(exact)
    cells = _addressed(found, variable, kept_axes, keep or {})
    for axis in cut:
        cells = cells.where(F.col(axis.name).isNotNull())
    return cells.where(exact)


def nearest_coordinate(chunks: DataFrame, axis: ChunkAxis, at: float) -> Column:
    """The coordinate of an axis nearest to ``at``, the lower of two as near, as a scalar subquery.

    Each chunk offers the two indices around the place. No array is read, so a chunk counts with
    the coordinates that its row states, whether its array holds them or not.
    """
    if axis.values is not None:
        offered = axis.values.where(F.col("value").isNotNull()).select(F.col("value").alias("c"))
    else:
        if axis.size is None:
            raise InvalidSelectionError(f"The size of {axis.name} inside a chunk must be given.")
        origin, step = _col(axis.origin).cast("double"), _col(axis.step).cast("double")
        last = _col(axis.size).cast("double") - 1
        place = F.coalesce(F.try_divide(F.lit(float(at)) - origin, step), F.lit(0.0))
        ends = [F.least(F.greatest(f(place), F.lit(0.0)), last) for f in (F.floor, F.ceil)]
        offered = chunks.select(F.explode(F.array(*[(origin + i.cast("long") * step).cast("double") for i in ends])).alias("c"))
    return offered.agg(F.min_by("c", F.struct(F.abs(F.col("c") - F.lit(float(at))), F.col("c")))).scalar()


@dataclass(frozen=True)
class ChunkGrid:
    """A grid held as array chunks, of which a selection reads what it needs."""

    chunks: DataFrame
    values: str
    variable: str
    axes: list[ChunkAxis]
    keep: dict[str, Column] | None = None

    def cells(self) -> DataFrame:
        return explode_chunks(self.chunks, self.values, self.variable, self.axes, self.keep)

    def select(self, bounds: Bounds) -> DataFrame:
        return select_chunks(self.chunks, self.values, self.variable, self.axes, bounds, self.keep)

    def nearest(self, place: dict[str, float]) -> DataFrame:
        """Cells at the nearest coordinate of each named axis; the coordinates are settled by one
        small job over the chunks' origins."""
        named = {a.name: a for a in self.axes}
        if set(place) - set(named):
            raise InvalidSelectionError(f"No axis named {', '.join(sorted(set(place) - set(named)))}.")
        wanted = [nearest_coordinate(self.chunks, named[n], at).alias(n) for n, at in place.items()]
        found = self.chunks.sparkSession.range(1).select(*wanted).first()
        if any(v is None for v in found):
            return self.cells().limit(0)
        return self.select({n: (found[n], found[n]) for n in place})
