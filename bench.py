"""Time the headline loads; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 5).
Each load is warmed up twice and then timed; the median counts. Spark start-up is excluded.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import SparkSession

from haulier import Partitioning, WatermarkTable, append_new, full_load, replace_window
from haulier.session import scratch_folder
from haulier.task import Metadata
from haulier.workloads.registry import table

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
WARM_UPS = 2
CUTOFF = "l_shipdate <= TIMESTAMP_NTZ '2000-06-30'"


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("haulier-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


class Loads:
    """The measured loads. Each returns its result; preparation is outside the timed part."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self.lineitem = table(spark, FOLDER, "lineitem")
        self.documents = table(spark, FOLDER, "documents")
        self.lineage = Metadata().lineage("tpch.lineitem", datetime(2024, 2, 1))
        self.month, self.year = Partitioning("l_shipdate", "month"), Partitioning("l_shipdate", "year")

    def full_load_flat(self) -> Callable:
        return lambda: full_load(self.lineitem, f"{self.root}/flat", lineage=self.lineage, max_rows_per_file=200_000)

    def full_load_year(self) -> Callable:
        return lambda: full_load(
            self.lineitem, f"{self.root}/year", partitioning=self.year, lineage=self.lineage, max_rows_per_file=200_000
        )

    def full_load_month(self) -> Callable:
        return lambda: full_load(self.lineitem, f"{self.root}/month", partitioning=self.month, lineage=self.lineage)

    def full_load_text(self) -> Callable:
        return lambda: full_load(self.documents, f"{self.root}/text", lineage=self.lineage)

    def replace_two_years(self) -> Callable:
        full_load(self.lineitem, f"{self.root}/replace", partitioning=self.year, lineage=self.lineage)
        return lambda: replace_window(
            self.lineitem,
            f"{self.root}/replace",
            partitioning=self.year,
            lookback_periods=2,
            as_of=date(2000, 6, 15),
            lineage=self.lineage,
        )

    def append_first(self) -> Callable:
        return self._appender("append_first", self.lineitem)

    def append_second(self) -> Callable:
        run = self._appender("append_second", self.lineitem.filter(CUTOFF))
        run()
        return self._appender("append_second", self.lineitem)

    def append_nothing_new(self) -> Callable:
        self._appender("append_nothing", self.lineitem)()
        return self._appender("append_nothing", self.lineitem)

    def _appender(self, name: str, source) -> Callable:
        state = WatermarkTable(self.spark, f"{self.root}/{name}/state")
        return lambda: append_new(
            source,
            f"{self.root}/{name}/data",
            task_identifier=f"raw.{name}",
            reference_column="l_shipdate",
            watermarks=state,
            lineage=self.lineage,
        )


NAMES = [
    "full_load_flat",
    "full_load_year",
    "full_load_month",
    "full_load_text",
    "replace_two_years",
    "append_first",
    "append_second",
    "append_nothing_new",
]


def main() -> None:
    spark = session()
    root = scratch_folder(spark, "bench")
    seconds, rates = {}, {}
    for name in NAMES:
        times, rows = [], 0
        for attempt in range(WARM_UPS + RUNS):
            # A fresh folder per attempt: an append is a first or second run only once.
            run = getattr(Loads(spark, f"{root}/{attempt}"), name)()
            begun = time.perf_counter()
            rows = run().rows
            times.append(time.perf_counter() - begun)
        seconds[name] = round(statistics.median(times[WARM_UPS:]), 3)
        rates[name] = round(rows / seconds[name])
    print(
        json.dumps(
            {
                "metric": "sum of median load times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rates,
                "sf": float(os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
