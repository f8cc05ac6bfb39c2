"""Gridded climate data selection on Spark."""

from .dataset import GridDataset
from .engine import GridEngine
from .errors import (
    DatasetNotFoundError,
    GridloomError,
    InvalidSelectionError,
    NoDataFoundError,
    StacCatalogError,
    StacLoadError,
    StacResolutionError,
    WriteConflictError,
)
from .model import CatalogKeys, DatasetMetadata, DatasetRequest
from .sources.cells import CellStore, CellTable, read_cells, vacuum, write_cells
