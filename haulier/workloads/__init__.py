"""Example loads; importing this package registers all of them."""

from . import appends, full_loads, replaces, scans, tasks
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "appends", "full_loads", "replaces", "scans", "tasks"]
