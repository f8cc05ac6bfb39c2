"""Exceptions raised by the driver-side API.

Batch jobs never raise per row; they carry the same outcomes in a ``status``
column instead.
"""


class GridloomError(Exception):
    """Base class of every error raised on purpose by this package."""


class DatasetNotFoundError(GridloomError):
    """The request does not name a dataset."""


class InvalidSelectionError(GridloomError):
    """The selection cannot be applied to the dataset."""


class NoDataFoundError(GridloomError):
    """The selection is valid but holds no cells."""


class WriteConflictError(GridloomError, ValueError):
    """Another write of the same datasets was finished first."""


class StacCatalogError(GridloomError):
    """Base class of catalog failures."""


class StacLoadError(StacCatalogError):
    """The catalog documents cannot be read."""


class StacResolutionError(StacCatalogError):
    """A request does not resolve to one item of the catalog."""

    def __init__(self, message, status=None, available=None):
        super().__init__(message)
        self.status = status
        self.available = available
