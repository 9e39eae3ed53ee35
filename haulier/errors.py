"""Exceptions raised before or during a load."""

from __future__ import annotations


class LoadError(Exception):
    """Base class of every error this package raises on purpose."""


class ContractError(LoadError, ValueError):
    """The task description is incomplete or contradicts itself."""


class SchemaError(LoadError, ValueError):
    """The source columns cannot be landed as asked."""


class LayoutError(LoadError):
    """The dataset on disk has another layout than the load would write."""


class StateError(LoadError):
    """The stored watermark and the dataset do not belong together."""


class CommitError(LoadError):
    """A rename or delete on the target file system did not succeed."""
