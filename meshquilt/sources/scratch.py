"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict = {}

#: Rows of a part at most, as far as models allow: what one task sorts or groups at once, however long the table is.
PART_ROWS = 1 << 14


def scratch(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir (a local one only where that is unset and Spark runs on one machine)."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        base = _LOCAL.setdefault("folder", "file://" + tempfile.mkdtemp(prefix="meshquilt-"))
    return f"{base.rstrip('/')}/meshquilt-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """The rows written to ``path`` and read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled_joins(df: DataFrame) -> DataFrame:
    """``df`` whose joins are never broadcast. Columns of ids shrink to a hundredth in a file, so by a file's size Spark would send millions of rows through the driver."""
    return df.hint("merge")


def kept(df: DataFrame, path: str) -> DataFrame:
    """``stored``, for rows in proportion to the corpus: never broadcast, however small their files."""
    return shuffled_joins(stored(df, path))


def parts_of(spark: SparkSession, rows: int) -> int:
    """The number of parts of about ``rows`` rows: of ``PART_ROWS`` each, one for each core at least."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // PART_ROWS))


def by_model(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of about ``rows`` rows dealt out by model, in parts of ``PART_ROWS``. The number of parts is given, so that adaptive execution does not
    put small files together into a few large tasks; groups and windows by model and more stay in their part, in ``joined_in_parts`` joins too."""
    return shuffled_joins(df.repartition(parts_of(df.sparkSession, rows), "model_id"))


@contextmanager
def joined_in_parts(spark: SparkSession) -> Iterator[None]:
    """While it lasts, what is planned joins tables dealt by model on (model, vertex) and the like where they are. Otherwise Spark deals both sides again for every join on more
    than the model. A model is worked in one task then: what spreads are models, not the vertices of one."""
    # a union of tables with as many parts each is dealt again: adaptive execution may give one side other parts than the plan says
    names = ("spark.sql.requireAllClusterKeysForCoPartition", "spark.sql.unionOutputPartitioning")
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name in names:
            spark.conf.set(name, "false")
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def kept_in_parts(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` written, with its joins in their models' parts, and read back, dealt out again by model in as many parts as ``rows`` rows have; without ``rows`` it is
    not dealt again (results, that are not joined any more)."""
    spark = df.sparkSession
    with joined_in_parts(spark):
        out = kept(df, scratch(spark))
    return out if rows is None else by_model(out, rows)
