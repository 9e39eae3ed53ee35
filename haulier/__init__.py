"""Copy tables into Parquet datasets with Spark and keep them up to date.

Full load, rebuild of the last N calendar partitions, and append above a stored watermark.
"""

from .errors import CommitError, ContractError, LayoutError, LoadError, SchemaError, StateError
from .operators.landing import read_landed
from .operators.shape import Partitioning
from .plans.jobs import LoadResult, append_new, full_load, replace_window
from .plans.replicate import replicate
from .state.executions import ExecutionTable
from .state.watermarks import WatermarkTable
from .task import Task, task_from_mapping

__all__ = [
    "CommitError",
    "ContractError",
    "ExecutionTable",
    "LayoutError",
    "LoadError",
    "LoadResult",
    "Partitioning",
    "SchemaError",
    "StateError",
    "Task",
    "WatermarkTable",
    "append_new",
    "full_load",
    "read_landed",
    "replace_window",
    "replicate",
    "task_from_mapping",
]
