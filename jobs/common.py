"""What the jobs share: configuration, logged writes, command line."""

from __future__ import annotations

import argparse
import json
import logging
from dataclasses import asdict

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meshquilt.plans.registry import parameter_hash
from meshquilt.sources.scratch import by_model, joined_in_parts

log = logging.getLogger("meshquilt.jobs")


def configured(spark: SparkSession, kind, path: str | None = None):
    """A ``kind`` (dataclass) with its defaults and the values of a JSON file, read by Spark, so the path may be remote. Unknown keys raise."""
    if path is None:
        return kind()
    raw = json.loads(spark.read.text(path, wholetext=True).first()[0])
    return kind(**{k: tuple(tuple(x) if isinstance(x, list) else x for x in v) if isinstance(v, list) else v for k, v in raw.items()})


def config_name(config) -> str:
    """A short name of the configuration: outputs of different ones do not mix."""
    return parameter_hash(asdict(config))[:12]


def write(df: DataFrame, path: str, what: str, *by: str, **options: str) -> int:
    """Overwrite ``path`` with the rows, partitioned by ``by``; logs and returns how many there are."""
    seen = Observation()
    with joined_in_parts(df.sparkSession):
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").options(**options).partitionBy(*by).parquet(path)
    n = seen.get["n"]
    log.info("wrote %s rows of %s to %s", n, what, path)
    return n


def aside(df: DataFrame, path: str, rows: int) -> DataFrame:
    """An intermediate table, written over what ``path`` holds, and read back dealt out by model in as many parts as ``rows`` rows have."""
    with joined_in_parts(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return by_model(df.sparkSession.read.schema(df.schema).parquet(path), rows)


def command(doc: str, *paths: str) -> argparse.Namespace:
    """The command line: one option for each path and ``--config``."""
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(message)s")
    parser = argparse.ArgumentParser(description=doc)
    for name in paths:
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--config", help="a JSON file of settings")
    return parser.parse_args()


def session(name: str) -> SparkSession:
    return SparkSession.builder.appName(name).getOrCreate()
