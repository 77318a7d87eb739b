"""Artefact registry: what is done, what must be done again, with which parameters."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parameter_hash(parameters: dict) -> str:
    return hashlib.sha256(json.dumps(parameters, sort_keys=True, default=str).encode()).hexdigest()


def todo(inputs: DataFrame, registry: DataFrame, stage: str, parameters: dict) -> DataFrame:
    """Models (model_id, input_hash) without a finished artefact of this stage for this input and these parameters."""
    done = registry.filter((F.col("stage") == stage) & (F.col("param_hash") == parameter_hash(parameters)) & (F.col("status") == "ok")).select("model_id", "input_hash")
    return inputs.join(done, ["model_id", "input_hash"], "left_anti")


def entries(results: DataFrame, stage: str, parameters: dict) -> DataFrame:
    """Registry rows of a stage's results (model_id, input_hash, error): one model's failure is a row, not a stop."""
    return results.select("model_id", "input_hash", F.lit(stage).alias("stage"), F.lit(parameter_hash(parameters)).alias("param_hash"), F.when(F.col("error").isNull(), "ok").otherwise("failed").alias("status"), "error")


def stale(stored: DataFrame, wanted: DataFrame) -> DataFrame:
    """Stored models that nothing wants any more."""
    return stored.select("model_id").distinct().join(wanted, "model_id", "left_anti")


def cache_complete(cached: DataFrame, failed: DataFrame, eligible: DataFrame) -> bool:
    """The cached and the failed ids together are the eligible ones."""
    from meshquilt.operators.selection import set_difference

    return not set_difference(cached.select("id").unionByName(failed.select("id")), eligible).limit(1).count()


def run_metadata(spark, config: dict, seeds: dict, code: str, commit: str = "unknown") -> DataFrame:
    """One row: the resolved configuration, the seeds, the checksum of the code and the commit that it was taken from."""
    row = (json.dumps(config, sort_keys=True, default=str), json.dumps(seeds, sort_keys=True), hashlib.sha256(code.encode()).hexdigest(), commit)
    return spark.createDataFrame([row], "config string, seeds string, code_sha256 string, commit string")
