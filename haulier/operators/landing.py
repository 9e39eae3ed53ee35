"""Staged Parquet writes and their commits.

A load writes to ``<dataset>/_tmp`` with one Spark job. Only after that job succeeded does a commit
touch live data, by renames:

* swap      - the staged folder takes the place of the dataset (three renames at any size);
* partitions - each partition of a window is exchanged or removed;
* append    - the staged files are moved in beside the others under a run tag.

Whatever a crash leaves behind is undone by :func:`open_staging` of the next load. Datasets can also be committed by
versions, without renames: see :mod:`versions`. What reads a dataset here knows both kinds.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import LayoutError, SchemaError, StateError
from ..functions.bounds import bound_literal, max_expression, watermark_text
from ..functions.names import column, require_column
from ..functions.periods import LEVELS, levels
from .shape import PERIOD, Partitioning, add_lineage, check_lineage, check_partitioning, drop_null_periods
from .shape import with_path_columns, with_period
from . import versions
from .storage import Storage

# Fixed value: staging folder inside the dataset; Spark skips it when reading.
STAGING = "_tmp"
REPLACED = "_old"
# Replaced partitions behind their commit point: nothing in here is ever put back.
GONE = "_gone"
PENDING = "_append"

# A few periods hashed into as few shuffle partitions collide, and one task would get two of them.
# AQE merges the partitions that stay empty or thin.
SPREAD = 64

# How long to wait for the counters of a finished write.
REPORT_SECONDS = 60.0


@dataclass(frozen=True)
class Staged:
    """What one staged write did.

    ``rows`` is counted in the task that writes the file, once per committed task. The two NULL
    counters are taken before any shuffle, so a re-run map task can raise them: they are reports,
    nothing is decided on them. ``rows_dropped_null`` is None when it could not be observed, and when
    nothing was written. ``top`` is the exact maximum of the tracked source column over all rows read.
    """

    rows: int
    files: int
    bytes: int
    partitions: int
    top: str | None
    rows_null_reference: int
    rows_dropped_null: int | None
    schema: T.StructType


# ---------------------------------------------------------------- write


def open_staging(spark: SparkSession, dataset: str) -> str:
    """An unused staging folder inside the dataset, after clearing up behind a crashed load."""
    discard_staging(spark, dataset)
    live = Storage(spark, dataset)
    live.make_folder()
    return live.url(STAGING)


def discard_staging(spark: SparkSession, dataset: str) -> None:
    """Drop staged data and put back whatever an unfinished commit had moved aside."""
    folder, name = _split(dataset)
    parent, live = Storage(spark, folder), Storage(spark, dataset)
    following, previous = f"_next-{name}", f"_prev-{name}"
    if parent.exists(previous):
        if parent.exists(name):
            parent.delete(previous)
        else:
            parent.rename(previous, name)
    parent.delete(following)
    _restore_partitions(live)
    live.delete(STAGING)


def stage(
    source: DataFrame,
    staging: str,
    *,
    partitioning: Partitioning | None = None,
    lineage: Mapping[str, str] | None = None,
    track: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    max_rows_per_file: int | None = None,
    clustered: bool = False,
    gather: bool = False,
    upper_bound: Any = None,
) -> Staged:
    """Write all rows with one job and measure on the way.

    The maximum of ``track`` covers every row read, also rows that have no partition, and is taken from the
    source's own column, before ``prepare`` casts it. Partitioned rows are shuffled by period so that a
    period gets few, large files; the rebalance lets AQE split a hot period over many tasks and merge thin
    ones. ``clustered=True`` skips the shuffle for a source whose files already follow the partition column.
    Flat rows are written by the tasks that read them; ``gather=True`` brings few rows out of many tasks
    together first. Constants and path columns are added behind the shuffle. Should Spark lose the report of the maximum, it is
    ``upper_bound``, where all rows up to it were read, or it is taken by a second read of that column.
    """
    reads = tracked_measures(source, track)
    seen = Observation() if reads else None
    tracked = source.observe(seen, *reads) if seen else source
    shaped = prepare(tracked) if prepare else tracked
    shuffle = (partitioning is not None or gather) and not clustered
    bare = prepare(source) if prepare else source
    rows, dropped, written, schema = staging_plan(shaped, partitioning, lineage or {}, shuffle, track, bare)
    writer = rows.write.mode("errorifexists")
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    if partitioning:
        writer = writer.partitionBy(*partitioning.levels)
    writer.parquet(staging)

    def again(landed: int) -> dict[str, Any]:
        edge = None if upper_bound is None else bound_literal(upper_bound, source.schema[track].dataType)
        return _measured_again(source, bare, partitioning, reads, landed, track, edge)

    counters = _counters(source.sparkSession, staging, schema, seen, dropped, written, again)
    area = Storage(source.sparkSession, staging)
    files, size = area.summary()
    return Staged(
        rows=counters["rows"],
        files=files - 1 if area.exists("_SUCCESS") else files,
        bytes=size,
        partitions=len(area.glob(_level_glob(partitioning.granularity))) if partitioning else 0,
        top=watermark_text(counters.get("top"), source.schema[track].dataType) if track else None,
        rows_null_reference=counters.get("null_reference", 0),
        rows_dropped_null=counters["null_period"],
        schema=schema,
    )


def _counters(
    spark: SparkSession,
    staging: str,
    schema: T.StructType,
    seen: Observation | None,
    dropped: Observation | None,
    written: Observation,
    again: Callable[[int], dict[str, Any]],
) -> dict[str, Any]:
    """What the write observed.

    Spark can lose a report. The number of rows is then counted in the staged files, a report on dropped rows is
    left out, and the maximum comes from ``again``.
    """
    after = observed(written) or spark.read.schema(schema).parquet(staging).agg(F.count(F.lit(1)).alias("rows")).first().asDict()
    if not after["rows"]:
        # Nothing will be committed. AQE drops a shuffle stage without output, and with it what was observed in it.
        return {**after, "null_period": None if dropped else 0}
    before = observed(seen) if seen else {}
    if before is None:
        before = again(after["rows"])
    report = observed(dropped) if dropped else {"null_period": 0}
    return {**before, **(report or {"null_period": None}), **after}


def _measured_again(
    source: DataFrame, bare: DataFrame, partitioning: Partitioning | None, reads: list[Column], landed: int, track: str, edge: Column | None
) -> dict[str, Any]:
    """The measures of the rows read, from a second source.

    With a fixed upper edge everything up to it was read, and it is the watermark. Else the tracked column is read once more, and the
    result holds only if that read finds as many rows as were landed: a source that has changed meanwhile stops the load,
    with live data and state untouched.
    """
    if edge is not None:
        one = source.sparkSession.range(1).select(edge.alias("edge"))
        return {**one.agg(max_expression(F.col("edge"), source.schema[track].dataType).alias("top")).first().asDict(), "null_reference": 0}
    found = source.agg(*reads).first().asDict()
    kept = bare.filter(column(partitioning.column).isNotNull()) if partitioning else bare
    if kept.agg(F.count(F.lit(1)).alias("rows")).first()["rows"] != landed:
        raise StateError("Spark lost the report of the rows read, and the source has changed since, so the new watermark is unknown; run the load again")
    return found


def observed(observation: Observation, patience: float = REPORT_SECONDS) -> dict[str, Any] | None:
    """Result of an observation whose job has finished; None if it does not come.

    Observations travel over the listener bus, which drops events when a job of very many tasks
    overruns it. Waiting without a limit would then never end.
    """
    report = observation._jo.future()
    give_up = time.monotonic() + patience
    while not report.isCompleted():
        if time.monotonic() > give_up:
            return None
        time.sleep(0.002)
    return observation.get


def tracked_measures(source: DataFrame, track: str | None) -> list[Column]:
    """Aggregates over all rows read: maximum and NULLs of ``track``."""
    if not track:
        return []
    require_column(source.columns, track, "strategy.reference_column")
    top = max_expression(column(track), source.schema[track].dataType)
    return [top.alias("top"), F.count_if(column(track).isNull()).alias("null_reference")]


def staging_plan(
    source: DataFrame,
    partitioning: Partitioning | None,
    lineage: Mapping[str, str],
    shuffle: bool,
    track: str | None = None,
    bare: DataFrame | None = None,
) -> tuple[DataFrame, Observation | None, Observation, T.StructType]:
    """The frame that is written, its observations (rows without a period, rows written), and the schema it lands with.

    ``bare`` is the source without observations, for counts that must not end them.
    """
    check_lineage(source, lineage)
    day = check_partitioning(source, partitioning, lineage) if partitioning else None
    rows, dropped = source, None
    if partitioning:
        dropped = Observation()
        rows = rows.observe(dropped, F.count_if(column(partitioning.column).isNull()).alias("null_period"))
        rows = with_period(drop_null_periods(rows, partitioning), day, partitioning)
    if shuffle:
        counted = with_period(drop_null_periods(source if bare is None else bare, partitioning), day, partitioning) if partitioning else None
        rows = spread(rows, partitioning, track, counted)
    rows = add_lineage(rows, lineage)
    if partitioning:
        rows = with_path_columns(rows, partitioning)

    schema = landed_schema(source.schema, lineage, partitioning)
    written = Observation()
    return rows.observe(written, F.count(F.lit(1)).alias("rows")), dropped, written, schema


def spread(rows: DataFrame, partitioning: Partitioning | None, track: str | None = None, counted: DataFrame | None = None) -> DataFrame:
    """Shuffle into well-sized tasks: by period, without tying a period to one task, or by the reference column.

    A shuffle by a column needs no sort in front of it, as one by turns would. Without AQE nothing splits a hot period at run time: one
    pass over the dates of ``counted`` finds how many tasks each period is worth, and it is dealt to that many.
    """
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
    if partitioning is None:
        key = column(track)
        return rows.hint("rebalance", tasks, key) if adaptive else rows.repartition(tasks, key)
    if adaptive:
        return rows.hint("rebalance", max(tasks, SPREAD), PERIOD)
    periods = (rows if counted is None else counted).groupBy(PERIOD).agg(F.count(F.lit(1)).alias("n"))
    total = Window.partitionBy()  # over one row per period
    widths = periods.select(F.col(PERIOD).alias("_p"), F.ceil(F.col("n") * tasks / F.sum("n").over(total)).cast("int").alias("_width"))
    # A day is four bytes and there are a few million of them at most.
    dealt = rows.join(F.broadcast(widths), rows[PERIOD] == F.col("_p"), "left")
    salt = F.monotonically_increasing_id() % F.coalesce(F.col("_width"), F.lit(1))
    return dealt.repartition(tasks, F.col(PERIOD), salt).drop("_p", "_width")


def landed_schema(source: T.StructType, lineage: Mapping[str, str], partitioning: Partitioning | None) -> T.StructType:
    """Source columns, then lineage text, then integer path levels; all nullable as Parquet reads them."""
    fields = [T.StructField(f.name, f.dataType, True) for f in source.fields]
    fields += [T.StructField(name, T.StringType(), True) for name in lineage]
    fields += [T.StructField(lv, T.IntegerType(), True) for lv in (partitioning.levels if partitioning else ())]
    return T.StructType(fields)


# ---------------------------------------------------------------- commits


def commit_swap(spark: SparkSession, dataset: str) -> None:
    """Replace the whole dataset by the staged folder, whatever the old layout was."""
    folder, name = _split(dataset)
    parent = Storage(spark, folder)
    following, previous = f"_next-{name}", f"_prev-{name}"
    parent.rename(f"{name}/{STAGING}", following)
    parent.rename(name, previous)
    parent.rename(following, name)
    parent.delete(previous)


def commit_partitions(spark: SparkSession, dataset: str, granularity: str, window: Collection[str]) -> list[str]:
    """Exchange the staged partitions and remove those of the window that got no rows.

    Partitions outside the window stay. Returns the removed partitions. One rename ends the exchange: up to it
    a crash brings the replaced partitions back whole, from it on nothing of them, however far their deletion came.
    """
    live = Storage(spark, dataset)
    pattern = _level_glob(granularity)
    staged = {p.removeprefix(f"{STAGING}/") for p in live.glob(f"{STAGING}/{pattern}")}
    present = set(window).intersection(live.glob(pattern))
    live.rename_all([(p, f"{REPLACED}/{p}") for p in sorted(present)])
    live.rename_all([(f"{STAGING}/{p}", p) for p in sorted(staged)])
    if live.exists(REPLACED):
        live.rename(REPLACED, GONE)
    live.delete(GONE)
    live.delete(STAGING)
    return sorted(present - staged)


def append_tag(task_id: str, reference_column: str, version: int) -> str:
    """Prefix of the files that one append adds; the same for every retry of that append."""
    digest = hashlib.sha1(f"{task_id}\n{reference_column}".encode()).hexdigest()[:12]
    return f"part-{digest}-v{version:08d}"


def append_note(task_id: str, reference_column: str, version: int, state_root: str) -> dict[str, Any]:
    """What an append leaves behind until its watermark is stored."""
    tag = append_tag(task_id, reference_column, version)
    return {"tag": tag, "task_identifier": task_id, "reference_column": reference_column, "version": version, "state_root": state_root}


def commit_append(
    spark: SparkSession,
    dataset: str,
    partitioning: Partitioning | None,
    task_id: str,
    reference_column: str,
    version: int,
    state_root: str = "",
) -> None:
    """Move the staged files in. ``version`` is the watermark version the load will store in the table at ``state_root``."""
    live = Storage(spark, dataset)
    note = append_note(task_id, reference_column, version, state_root)
    tag = note["tag"]
    live.write_text(PENDING, json.dumps(note))
    folders = f"{STAGING}/{_level_glob(partitioning.granularity)}" if partitioning else STAGING
    moves = []
    for path in live.glob(f"{folders}/part-*"):
        folder, _, name = path.removeprefix(f"{STAGING}/").rpartition("/")
        landed = f"{tag}-{name.removeprefix('part-')}"
        moves.append((path, f"{folder}/{landed}" if folder else landed))
    live.move_files(moves)
    live.delete(STAGING)


def pending_append(spark: SparkSession, dataset: str) -> dict[str, Any] | None:
    """The append whose watermark may not have been stored, if there is one."""
    now = versions.current(spark, dataset)
    if now is not None:
        return dict(now.pending) if now.pending else None
    text = Storage(spark, dataset).read_text(PENDING)
    return json.loads(text) if text else None


def close_append(spark: SparkSession, dataset: str) -> None:
    """The watermark is stored: the files of the append are final."""
    if versions.is_versioned(spark, dataset):
        return versions.close_append(spark, dataset)
    Storage(spark, dataset).delete(PENDING)


def undo_append(spark: SparkSession, dataset: str, tag: str) -> int:
    """Delete the files of an append whose watermark was never stored. Returns their number."""
    if versions.is_versioned(spark, dataset):
        return versions.undo_append(spark, dataset)
    live = Storage(spark, dataset)
    patterns = [f"{tag}-*"] + [f"{_level_glob(g)}/{tag}-*" for g in LEVELS]
    found = [path for pattern in patterns for path in live.glob(pattern)]
    live.delete_all(found)
    live.delete(PENDING)
    return len(found)


def delete_partition(spark: SparkSession, dataset: str, path: str) -> None:
    """Delete one partition folder or one file of a dataset; absent is fine."""
    if not path.strip("/"):
        raise LayoutError("a partition path is needed; the dataset itself is not a partition")
    if versions.is_versioned(spark, dataset):
        return versions.drop_partition(spark, dataset, path.strip("/"))
    Storage(spark, dataset).delete(path.strip("/"))


def delete_table_partition(spark: SparkSession, table: str, path: str) -> None:
    """Delete one partition of a table of Spark's catalog, from the table and from its folder; absent is fine.

    ``path`` is the partition as its folder names it, ``year=2024/month=02``; all path levels of the table must be given.
    """
    given = dict(piece.partition("=")[::2] for piece in path.strip("/").split("/"))
    described = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    columns = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if not columns or set(given) != set(columns):
        raise LayoutError(f"{table} is partitioned by {columns}, not by {sorted(given)}")
    values = ", ".join(f"`{name}` = '{given[name]}'" for name in columns)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({values})")
    if described.get("Type") == "EXTERNAL":
        # The catalog leaves the files of an external table where they are.
        Storage(spark, described["Location"]).delete("/".join(f"{name}={given[name]}" for name in columns))
    spark.catalog.refreshTable(table)


# ---------------------------------------------------------------- layout and schema guards


def dataset_layout(spark: SparkSession, dataset: str) -> str | None:
    """``flat``, ``year``, ``month`` or ``day``; None when there is no data. Mixed layouts raise."""
    now = versions.current(spark, dataset)
    if now is not None:
        return (now.granularity or "flat") if now.loads else None
    live = Storage(spark, dataset)
    found = ["flat"] if live.any("*.parquet") else []
    if live.any("year=*"):
        for granularity in LEVELS:
            if any(live.any(f"{partition}/*.parquet") for partition in live.glob(_level_glob(granularity))):
                found.append(granularity)
    if len(found) > 1:
        raise LayoutError(f"{dataset} mixes layouts {found}; Spark would read only part of it")
    return found[0] if found else None


def check_layout(spark: SparkSession, dataset: str, partitioning: Partitioning | None) -> str | None:
    """An incremental load must write the layout that is already there, which is returned."""
    wanted = partitioning.granularity if partitioning else "flat"
    present = dataset_layout(spark, dataset)
    if present not in (None, wanted):
        raise LayoutError(f"{dataset} is laid out by '{present}', the load writes '{wanted}'; run a full load first")
    return present


def check_types(spark: SparkSession, dataset: str, schema: T.StructType, replaced: Collection[str] = ()) -> None:
    """Columns that stay in the dataset must keep their types.

    One footer is read. ``replaced`` lists partitions that the load rewrites anyway.
    """
    now = versions.current(spark, dataset)
    live = Storage(spark, dataset)
    if now is None:
        sample = _kept_file(live, frozenset(replaced))
    else:
        folders = (f"{path}/*.parquet" for path in now.paths() if not any(path.endswith(f"/{p}") for p in replaced))
        sample = next((live.url(found) for found in map(live.first, folders) if found), None)
    if sample is None:
        return
    present = {f.name: f.dataType for f in spark.read.parquet(sample).schema.fields}
    changed = [
        f"{f.name}: {present[f.name].simpleString()} -> {f.dataType.simpleString()}"
        for f in schema.fields
        if f.name in present and present[f.name].simpleString() != f.dataType.simpleString()
    ]
    if changed:
        raise SchemaError(f"column types changed since {dataset} was landed: {changed}")


def _kept_file(live: Storage, replaced: frozenset[str]) -> str | None:
    flat = live.first("*.parquet")
    if flat:
        return live.url(flat)
    for granularity in reversed(LEVELS):
        for partition in live.glob(_level_glob(granularity)):
            if partition not in replaced:
                found = live.first(f"{partition}/*.parquet")
                if found:
                    return live.url(found)
    return None


# ---------------------------------------------------------------- reading back


def read_landed(spark: SparkSession, dataset: str, schema: T.StructType | None = None) -> DataFrame:
    """The dataset as a frame, of a versioned one its current version. With the schema of the load it also reads an empty dataset."""
    if versions.is_versioned(spark, dataset):
        return versions.read(spark, dataset, schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(dataset)


# ---------------------------------------------------------------- helpers


def check_path(dataset: str) -> None:
    """A dataset is a folder of its own, and no pattern."""
    _split(dataset)


def _split(dataset: str) -> tuple[str, str]:
    folder, _, name = dataset.rstrip("/").rpartition("/")
    if not name:
        raise LayoutError("a dataset needs a folder of its own")
    if set(dataset) & set("*?[]{}\\"):
        raise LayoutError(f"{dataset} contains characters that file listings read as patterns")
    return folder or "/", name


def _level_glob(granularity: str) -> str:
    return "/".join(f"{lv}=*" for lv in levels(granularity))


def _restore_partitions(live: Storage) -> None:
    """Put back partitions that a crashed exchange had moved aside but not replaced; drop what was replaced for good."""
    live.delete(GONE)
    if not live.exists(REPLACED):
        return
    for granularity in reversed(LEVELS):
        aside = [p.removeprefix(f"{REPLACED}/") for p in live.glob(f"{REPLACED}/{_level_glob(granularity)}")]
        if aside:
            live.rename_all([(f"{REPLACED}/{p}", p) for p in aside if not live.exists(p)])
            break
    live.delete(REPLACED)
