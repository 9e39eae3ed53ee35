"""The three load modes. Each reads the source once, in one Spark job, and then commits."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, replace
from datetime import date, datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..errors import LayoutError, StateError
from ..functions.bounds import bound_literal, check_bound, watermark_type
from ..functions.names import column, require_column
from ..functions.periods import window_bounds, window_partitions
from ..operators import landing, versions
from ..operators.landing import Staged
from ..operators.shape import Partitioning, keep_window
from ..sources.tables import lower_bound
from ..state import leases
from ..state.watermarks import Watermark, WatermarkTable


@dataclass(frozen=True)
class LoadResult:
    """Outcome of a load. ``rows`` counts the rows written by this run."""

    dataset: str
    rows: int
    schema: T.StructType
    files: int = 0
    bytes: int = 0
    partitions: int = 0
    partitions_removed: tuple[str, ...] = ()
    watermark: str | None = None
    watermark_type: str | None = None
    rows_null_reference: int = 0
    rows_dropped_null: int | None = 0
    files_undone: int = 0


def _result(dataset: str, staged: Staged) -> LoadResult:
    return LoadResult(
        dataset=dataset,
        rows=staged.rows,
        schema=staged.schema,
        files=staged.files,
        bytes=staged.bytes,
        partitions=staged.partitions,
        rows_null_reference=staged.rows_null_reference,
        rows_dropped_null=staged.rows_dropped_null,
    )


def full_load(
    source: DataFrame,
    dataset: str,
    *,
    partitioning: Partitioning | None = None,
    lineage: Mapping[str, str] | None = None,
    max_rows_per_file: int | None = None,
    clustered: bool = False,
    versioned: bool | None = None,
) -> LoadResult:
    """Replace the dataset by the source. The old data stays until the new data is complete.

    ``versioned`` chooses the commit: by renames (False), or by a new version, without renames (True). None: as the dataset
    is committed already, else as the session setting ``spark.haulier.commit`` says. A plain dataset becomes versioned by a full load only.
    """
    spark = source.sparkSession
    landing.check_path(dataset)
    if versions.wanted(spark, dataset, versioned):
        plain = not versions.is_versioned(spark, dataset)
        with _new_load(spark, dataset) as (load, folder):
            staged = landing.stage(source, folder, partitioning=partitioning, lineage=lineage, max_rows_per_file=max_rows_per_file, clustered=clustered)
            versions.commit_whole(spark, dataset, load, partitioning.granularity if partitioning else None)
        if plain:
            versions.adopt(spark, dataset)
        return _result(dataset, staged)
    try:
        staging = landing.open_staging(spark, dataset)
        staged = landing.stage(
            source,
            staging,
            partitioning=partitioning,
            lineage=lineage,
            max_rows_per_file=max_rows_per_file,
            clustered=clustered,
        )
        landing.commit_swap(spark, dataset)
    except BaseException:
        landing.discard_staging(spark, dataset)
        raise
    return _result(dataset, staged)


def replace_window(
    source: DataFrame,
    dataset: str,
    *,
    partitioning: Partitioning,
    lookback_periods: int,
    as_of: date | None = None,
    lineage: Mapping[str, str] | None = None,
    max_rows_per_file: int | None = None,
    clustered: bool = False,
    versioned: bool | None = None,
) -> LoadResult:
    """Rebuild the last ``lookback_periods`` partitions up to the one of ``as_of`` (today in UTC).

    A partition of the window without rows is removed; partitions outside the window, also
    future ones, stay as they are, and source rows outside it are never read. ``versioned`` as in :func:`full_load`.
    """
    spark = source.sparkSession
    landing.check_path(dataset)
    as_of = as_of or datetime.now(timezone.utc).date()
    granularity = partitioning.granularity
    first, end = window_bounds(as_of, granularity, lookback_periods)
    window = window_partitions(as_of, granularity, lookback_periods)
    if _incremental_versions(spark, dataset, versioned):
        landing.check_layout(spark, dataset, partitioning)
        landing.check_types(spark, dataset, source.schema, window)
        with _new_load(spark, dataset) as (load, folder):
            rows = keep_window(source, partitioning, first, end)
            staged = landing.stage(rows, folder, partitioning=partitioning, lineage=lineage, max_rows_per_file=max_rows_per_file, clustered=clustered)
            removed = versions.commit_window(spark, dataset, load, granularity, window)
        return replace(_result(dataset, staged), partitions_removed=tuple(removed))
    try:
        staging = landing.open_staging(spark, dataset)
        landing.check_layout(spark, dataset, partitioning)
        landing.check_types(spark, dataset, source.schema, window)
        staged = landing.stage(
            keep_window(source, partitioning, first, end),
            staging,
            partitioning=partitioning,
            lineage=lineage,
            max_rows_per_file=max_rows_per_file,
            clustered=clustered,
        )
        removed = landing.commit_partitions(spark, dataset, granularity, window)
    except BaseException:
        landing.discard_staging(spark, dataset)
        raise
    return replace(_result(dataset, staged), partitions_removed=tuple(removed))


def append_new(
    source: DataFrame,
    dataset: str,
    *,
    task_identifier: str,
    reference_column: str,
    watermarks: WatermarkTable,
    partitioning: Partitioning | None = None,
    upper_bound: Any = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    lineage: Mapping[str, str] | None = None,
    max_rows_per_file: int | None = None,
    clustered: bool = False,
    versioned: bool | None = None,
    lease_seconds: float | None = None,
) -> LoadResult:
    """Add the rows strictly above the stored watermark, or load everything when there is none.

    The first run replaces the dataset. A later run adds files, and then stores the new
    watermark; if it dies in between, the next run removes those files and loads them again.
    Rows at or below the watermark, and NULLs after the first run, are never read.
    ``upper_bound`` fixes the upper edge for sources whose parallel reads are no single snapshot.
    ``prepare`` shapes the rows behind the bounds (type casts, say): bounds and watermark are those of the source's
    own column, exact to the last digit, and stay in reach of the scan. A maximum that Spark fails to report is
    ``upper_bound``, or is read again. ``versioned`` as in :func:`full_load`. With ``lease_seconds`` the load holds the dataset for that long at most: a
    second one is refused before it writes, and one whose lease is over before it commits.
    """
    spark = source.sparkSession
    landing.check_path(dataset)
    lease = leases.acquire(spark, watermarks.root, dataset, lease_seconds) if lease_seconds is not None else None
    try:
        return _append(
            source,
            dataset,
            task_identifier=task_identifier,
            reference_column=reference_column,
            watermarks=watermarks,
            partitioning=partitioning,
            upper_bound=upper_bound,
            prepare=prepare,
            lineage=lineage,
            max_rows_per_file=max_rows_per_file,
            clustered=clustered,
            versioned=versioned,
            lease=lease,
        )
    finally:
        if lease is not None:
            lease.release()


def _append(
    source: DataFrame,
    dataset: str,
    *,
    task_identifier: str,
    reference_column: str,
    watermarks: WatermarkTable,
    partitioning: Partitioning | None,
    upper_bound: Any,
    prepare: Callable[[DataFrame], DataFrame] | None,
    lineage: Mapping[str, str] | None,
    max_rows_per_file: int | None,
    clustered: bool,
    versioned: bool | None,
    lease: leases.Lease | None,
) -> LoadResult:
    spark = source.sparkSession
    name = require_column(source.columns, reference_column, "strategy.reference_column")
    known = watermarks.get(task_identifier, name)
    by_versions = _incremental_versions(spark, dataset, versioned)
    load = versions.new_load(spark, dataset) if by_versions else None

    def discard() -> None:
        versions.discard_load(spark, dataset, load) if by_versions else landing.discard_staging(spark, dataset)

    try:
        staging = versions.load_folder(spark, dataset, load) if by_versions else landing.open_staging(spark, dataset)
        undone = _settle_pending(source, dataset, watermarks)
        if known is not None:
            if landing.check_layout(spark, dataset, partitioning) is None:
                raise StateError(
                    f"a watermark ({known.watermark_value}) exists for {task_identifier} but {dataset} has no data; "
                    "rows up to it would be missing for good"
                )
        rows = new_rows(source, name, known, upper_bound)
        landed = (prepare(rows) if prepare else rows).schema
        if known is not None:
            landing.check_types(spark, dataset, landed)
        staged = landing.stage(
            rows,
            staging,
            partitioning=partitioning,
            lineage=lineage,
            track=name,
            prepare=prepare,
            max_rows_per_file=max_rows_per_file,
            clustered=clustered,
            # A few new rows spread over every task of a large scan must not become as many files.
            gather=known is not None,
            upper_bound=upper_bound,
        )
        if staged.rows == 0:
            discard()
            kept = known.watermark_value if known else None
            return LoadResult(
                dataset,
                0,
                staged.schema,
                watermark=kept,
                watermark_type=known.watermark_type if known else None,
                rows_null_reference=staged.rows_null_reference,
                rows_dropped_null=staged.rows_dropped_null,
                files_undone=undone,
            )
        if lease is not None:
            lease.confirm()
        granularity = partitioning.granularity if partitioning else None
        version = watermarks.next_version(task_identifier, name)
        if by_versions and known is None:
            versions.commit_whole(spark, dataset, load, granularity)
        elif by_versions:
            note = landing.append_note(task_identifier, name, version, watermarks.root)
            versions.commit_more(spark, dataset, load, granularity, note)
        elif known is None:
            landing.commit_swap(spark, dataset)
        else:
            landing.commit_append(spark, dataset, partitioning, task_identifier, name, version, watermarks.root)
    except BaseException:
        discard()
        # A commit that failed half-way has stored no watermark yet: take its files back now.
        _settle_pending(source, dataset, watermarks)
        raise

    label = watermark_type(landed[name].dataType)
    if staged.top is not None:
        watermarks.put(task_identifier, name, staged.top, label, staged.rows)
    if known is not None:
        landing.close_append(spark, dataset)
    return replace(
        _result(dataset, staged),
        watermark=staged.top,
        watermark_type=label if staged.top is not None else None,
        files_undone=undone,
    )


@contextmanager
def _new_load(spark: SparkSession, dataset: str) -> Iterator[tuple[str, str]]:
    """Name and folder of a load that is committed by a version; the folder goes if it is not."""
    load = versions.new_load(spark, dataset)
    try:
        yield load, versions.load_folder(spark, dataset, load)
    except BaseException:
        versions.discard_load(spark, dataset, load)
        raise


def _incremental_versions(spark: SparkSession, dataset: str, versioned: bool | None) -> bool:
    """Whether a replace or append commits by versions; what is already there decides, and telling otherwise is refused."""
    has_versions = versions.is_versioned(spark, dataset)
    if not has_versions and not versions.wanted(spark, dataset, versioned):
        return False
    plain = not has_versions and landing.dataset_layout(spark, dataset) is not None
    if (versioned is True and plain) or (versioned is False and has_versions):
        raise LayoutError(f"{dataset} is committed {'by versions' if has_versions else 'by renames'}; run a full load to change that")
    return not plain


def new_rows(source: DataFrame, name: str, known: Watermark | None, upper_bound: Any = None) -> DataFrame:
    """The part of the source that an append reads."""
    dtype = source.schema[name].dataType
    rows = source
    if known is not None:
        rows = lower_bound(rows, name, known.watermark_value, inclusive=False)
    if upper_bound is not None:
        check_bound(source.sparkSession, upper_bound, dtype)
        below = column(name) <= bound_literal(upper_bound, dtype)
        rows = rows.filter(below if known is not None else below | column(name).isNull())
    return rows


def _settle_pending(source: DataFrame, dataset: str, watermarks: WatermarkTable) -> int:
    """Finish or undo an append that stopped between its commit and its watermark."""
    spark = source.sparkSession
    note = landing.pending_append(spark, dataset)
    if note is None:
        return 0
    if note.get("state_root") and note["state_root"] != watermarks.root:
        raise StateError(f"an append to {dataset} waits for its watermark in {note['state_root']}; run it with that state first")
    stored = watermarks.get(note["task_identifier"], note["reference_column"])
    if stored is not None and stored.version >= note["version"]:
        landing.close_append(spark, dataset)
        return 0
    return landing.undo_append(spark, dataset, note["tag"])
