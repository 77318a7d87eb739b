"""Incremental ingestion: new files of candidate rows are evaluated once; results and registry rows belong to the batch that made them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshquilt.plans.registry import entries, todo

BATCH = "ingest_batch"
REGISTRY = f"model_id bigint, input_hash string, stage string, param_hash string, status string, error string, {BATCH} bigint"


def _put(rows: DataFrame, path: str, batch: int) -> None:
    """The batch's partition, in place of what an earlier try of it left."""
    rows.withColumn(BATCH, F.lit(batch).cast("bigint")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)


def registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REGISTRY).parquet(path)


def published(results: DataFrame, registered: DataFrame) -> DataFrame:
    """The results of batches that are registered: what a batch wrote before it failed is not among them."""
    return results.join(registered.select(BATCH).distinct(), BATCH, "left_semi")


def ingest(spark: SparkSession, source: str, schema: str, registry_path: str, out_path: str, checkpoint: str, stage: str, parameters: dict, work):
    """A streaming query over Parquet files in ``source``. Each batch drops models that other batches have registered for this
    input and these parameters, runs ``work`` (DataFrame -> DataFrame with model_id, input_hash, error) on the rest, and writes results, then
    registry rows, each as the partition of its batch number. A batch that failed between the two, or at any other place, is run again by the
    stream, sees the same other batches, and replaces its own partitions: nothing is doubled. Readers take ``published`` results."""
    spark.createDataFrame([], REGISTRY).write.mode("append").partitionBy(BATCH).parquet(registry_path)  # so that it can be read

    def batch(rows: DataFrame, number: int) -> None:
        own = rows.sparkSession
        known = registry(own, registry_path).filter(F.col(BATCH) != number)
        done = work(todo(rows.dropDuplicates(["model_id", "input_hash"]), known, stage, parameters))
        _put(done, out_path, number)
        made = own.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in done.schema.fields)}, {BATCH} bigint").parquet(out_path).filter(F.col(BATCH) == number)
        _put(entries(made, stage, parameters), registry_path, number)

    return spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
