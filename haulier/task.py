"""The task contract: what to read, where to land it, and how.

Plain dataclasses; :func:`task_from_mapping` accepts the nested form used in task files.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from .errors import ContractError
from .functions.periods import LEVELS
from .operators.shape import Partitioning

# Source and target kinds a task may name. The last two sources are Spark's own.
SOURCE_TYPES = ("postgresql", "sqlserver", "oracle", "mongodb", "parquet", "table")
TARGET_TYPES = ("local", "s3")
MODES = ("full_load", "incremental")
STRATEGIES = ("append", "replace")

# Default lineage column names.
INGESTION_COLUMN = "$data_ingestao"
ORIGIN_COLUMN = "$banco_origem"


def _known(value: str | None, allowed: Any, label: str) -> str:
    text = (value or "").strip().lower()
    if text not in allowed:
        raise ContractError(f"{label} '{value}' is unknown; use one of {sorted(allowed)}")
    return text


def _filled(value: str | None, label: str) -> str:
    if not (value or "").strip():
        raise ContractError(f"{label} is required")
    return value


def _positive(value: int | str | None, label: str) -> int | None:
    if isinstance(value, str) and value.strip().isdigit():
        value = int(value)
    if value is not None and (isinstance(value, bool) or not isinstance(value, int) or value <= 0):
        raise ContractError(f"{label} must be an integer greater than 0")
    return value


def _switch(value: bool | str, label: str) -> bool:
    """A switch as YAML or a command line writes it; any other text is refused, not taken for yes."""
    text = str(value).strip().lower()
    if text not in ("true", "false"):
        raise ContractError(f"{label} must be true or false, not '{value}'")
    return text == "true"


@dataclass(frozen=True)
class Table:
    name: str
    target_schema_name: str
    target_name: str
    schema_name: str | None = None

    def __post_init__(self) -> None:
        for label in ("name", "target_schema_name", "target_name"):
            _filled(getattr(self, label), f"table.{label}")

    @property
    def qualified_name(self) -> str:
        return f"{self.schema_name}.{self.name}" if self.schema_name else self.name

    @property
    def target_dataset_path(self) -> str:
        return f"{self.target_schema_name}/{self.target_name}"

    @property
    def task_identifier(self) -> str:
        return f"{self.target_schema_name}.{self.target_name}"


@dataclass(frozen=True)
class Source:
    type: str
    runtime: str
    query_path: str | None = None
    chunk_size: int | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "type", _known(self.type, SOURCE_TYPES, "source.type"))
        _filled(self.runtime, "source.runtime")
        object.__setattr__(self, "chunk_size", _positive(self.chunk_size, "source.chunk_size"))


@dataclass(frozen=True)
class Target:
    type: str
    runtime: str
    chunk_size: int | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "type", _known(self.type, TARGET_TYPES, "target.type"))
        _filled(self.runtime, "target.runtime")
        object.__setattr__(self, "chunk_size", _positive(self.chunk_size, "target.chunk_size"))


@dataclass(frozen=True)
class Partition:
    type: str
    reference_column: str | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "type", _known(self.type, LEVELS, "partition.type"))
        _filled(self.reference_column, "partition.reference_column")

    def layout(self) -> Partitioning:
        return Partitioning(self.reference_column, self.type)


@dataclass(frozen=True)
class Strategy:
    type: str
    reference_column: str
    aggregation: str | None = None
    lookback_periods: int | None = None

    def __post_init__(self) -> None:
        if self.type not in STRATEGIES:
            raise ContractError(f"strategy.type '{self.type}' is unknown; use one of {sorted(STRATEGIES)}")
        _filled(self.reference_column, "strategy.reference_column")
        object.__setattr__(self, "lookback_periods", _positive(self.lookback_periods, "strategy.lookback_periods"))
        if self.type == "replace" and self.lookback_periods is None:
            raise ContractError("strategy.lookback_periods is required for replace")
        if self.type == "append" and self.lookback_periods is not None:
            raise ContractError("strategy.lookback_periods does not apply to append")
        if self.aggregation is not None and self.aggregation.strip().upper() != "MAX":
            raise ContractError("strategy.aggregation can only be MAX")


@dataclass(frozen=True)
class Replication:
    mode: str
    strategy: Strategy | None = None
    partition: Partition | None = None

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ContractError(f"replication.mode '{self.mode}' is unknown; use one of {sorted(MODES)}")
        if self.mode == "full_load":
            if self.strategy is not None:
                raise ContractError("replication.strategy does not apply to full_load")
            return
        if self.strategy is None:
            raise ContractError("replication.strategy is required for incremental")
        if self.strategy.type == "replace":
            if self.partition is None:
                raise ContractError("replication.partition is required for replace")
            if self.partition.reference_column.strip() != self.strategy.reference_column.strip():
                raise ContractError(
                    "replace rebuilds partitions of strategy.reference_column; "
                    "partition.reference_column must name the same column"
                )


@dataclass(frozen=True)
class LineageColumn:
    enabled: bool = True
    column_name: str | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "enabled", _switch(self.enabled, "enabled of a lineage column"))

    def name(self, default: str) -> str:
        if self.column_name is None:
            return default
        if not self.column_name.strip():
            raise ContractError(f"the name of a lineage column must not be blank (default: {default})")
        return self.column_name.strip()


@dataclass(frozen=True)
class Metadata:
    """Lineage switches; both columns are on by default."""

    enabled: bool = True
    ingestion: LineageColumn = field(default_factory=LineageColumn)
    origin: LineageColumn = field(default_factory=LineageColumn)

    def __post_init__(self) -> None:
        object.__setattr__(self, "enabled", _switch(self.enabled, "metadata.enabled"))

    def lineage(self, origin: str, now: datetime) -> dict[str, str]:
        """Column names with their text, ingestion first."""
        if not self.enabled:
            return {}
        pairs = []
        if self.ingestion.enabled:
            stamp = now.replace(tzinfo=None).isoformat(timespec="seconds")
            pairs.append((self.ingestion.name(INGESTION_COLUMN), stamp))
        if self.origin.enabled:
            pairs.append((self.origin.name(ORIGIN_COLUMN), origin))
        if len({name.lower() for name, _ in pairs}) < len(pairs):
            raise ContractError("the two lineage columns need different names")
        return dict(pairs)


@dataclass(frozen=True)
class Task:
    table: Table
    source: Source
    target: Target
    replication: Replication
    metadata: Metadata = field(default_factory=Metadata)


def task_from_mapping(raw: Mapping[str, Any]) -> Task:
    """Build a task from nested mappings, for example a parsed task file."""
    if not isinstance(raw, Mapping):
        raise ContractError(f"a task must be a mapping, not {type(raw).__name__}")
    replication = dict(_section(raw, "replication"))
    metadata = dict(raw.get("metadata") or {})
    columns = dict(metadata.get("columns") or {})
    # The keys of the two lineage columns in a task file.
    ingestion, origin = columns.get("data_ingestao"), columns.get("banco_origem")
    return Task(
        table=_build(Table, _section(raw, "table"), "table"),
        source=_build(Source, _section(raw, "source"), "source"),
        target=_build(Target, _section(raw, "target"), "target"),
        replication=Replication(
            mode=replication.get("mode"),
            strategy=_optional(Strategy, replication.get("strategy"), "strategy"),
            partition=_optional(Partition, replication.get("partition"), "partition"),
        ),
        metadata=Metadata(
            enabled=metadata.get("enabled", True),
            ingestion=_build(LineageColumn, ingestion or {}, "metadata.columns.data_ingestao"),
            origin=_build(LineageColumn, origin or {}, "metadata.columns.banco_origem"),
        ),
    )


def _section(raw: Mapping[str, Any], name: str) -> Mapping[str, Any]:
    found = raw.get(name)
    if not isinstance(found, Mapping):
        raise ContractError(f"a task needs the section '{name}'")
    return found


def _optional(kind: type, values: Mapping[str, Any] | None, label: str) -> Any:
    return None if values is None else _build(kind, values, label)


def _build(kind: type, values: Mapping[str, Any], label: str) -> Any:
    unknown = sorted(str(key) for key in values if key not in kind.__dataclass_fields__)
    if unknown:
        raise ContractError(f"{label} has unknown keys {unknown}; known are {sorted(kind.__dataclass_fields__)}")
    try:
        return kind(**values)
    except TypeError as problem:
        raise ContractError(f"{label}: {problem}") from problem
