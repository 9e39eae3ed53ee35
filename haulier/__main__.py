"""Run one task file: ``spark-submit`` or ``python -m haulier run task.yaml --connections ... --state-root ...``.

Task and connection files are YAML (or JSON) on any file system Spark reads.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Sequence
from datetime import date
from typing import Any

from pyspark.sql import SparkSession

from .errors import ContractError
from .plans.replicate import replicate
from .session import LOAD_CONF
from .task import task_from_mapping

try:
    import yaml
except ImportError:  # JSON files still work
    yaml = None

logger = logging.getLogger("haulier")


def read_mapping(spark: SparkSession, path: str) -> Any:
    """Content of one YAML or JSON file."""
    text = spark.read.text(path, wholetext=True).first()[0]
    broken = (ValueError, yaml.YAMLError) if yaml else ValueError
    try:
        return yaml.safe_load(text) if yaml else json.loads(text)
    except broken as problem:
        raise ContractError(f"{path} cannot be parsed: {problem}") from problem


def main(argv: Sequence[str] | None = None) -> int:
    """Exit code 0 when the load succeeded, 1 when it failed."""
    parser = argparse.ArgumentParser(prog="haulier")
    run = parser.add_subparsers(dest="command", required=True).add_parser("run", help="run one task")
    run.add_argument("task", help="task file")
    run.add_argument("--connections", required=True, help="file with the settings of every runtime name")
    run.add_argument("--state-root", required=True, help="folder of the watermark and execution tables")
    run.add_argument("--queries", help="folder in which source.query_path is looked up")
    run.add_argument("--as-of", type=date.fromisoformat, help="last day of a replace window (default: today in UTC)")
    options = parser.parse_args(argv)

    builder = SparkSession.builder.appName("haulier")
    for key, value in LOAD_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        result = replicate(
            spark,
            task_from_mapping(read_mapping(spark, options.task)),
            connections=read_mapping(spark, options.connections),
            state_root=options.state_root,
            queries=options.queries,
            as_of=options.as_of,
        )
    except Exception:
        logger.exception("the task failed")
        return 1
    logger.info("%s rows landed in %s", result.rows, result.dataset)
    return 0


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s [%(name)s] %(message)s")
    sys.exit(main())
