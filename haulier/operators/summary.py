"""What a landed dataset holds: rows and files per partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.periods import DIGITS, levels


def partition_counts(landed: DataFrame, granularity: str) -> DataFrame:
    """``(partition_path, rows, files)`` per partition.

    Counted per file first: the scan reads no data column, and a partition with most of the rows is
    already reduced to one row per file before anything is shuffled.
    """
    pieces = [F.concat(F.lit(f"{lv}="), F.lpad(F.col(lv).cast("string"), DIGITS[lv], "0")) for lv in levels(granularity)]
    per_file = landed.select(F.concat_ws("/", *pieces).alias("partition_path"), F.col("_metadata.file_path").alias("file"))
    return (
        per_file.groupBy("partition_path", "file")
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("partition_path")
        .agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"))
    )


def file_counts(landed: DataFrame) -> DataFrame:
    """``(file, rows)`` per data file of a dataset."""
    return landed.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
