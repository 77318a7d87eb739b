"""Text files whose lines have one order over all their parts, and numbers as C prints them."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_lines(lines: DataFrame, path: str, *order: str) -> None:
    """Text of the column ``value`` in the order of the other columns named (none: the rows are in order). Spark's global sort deals the rows out by ranges, so the parts, read by name
    one after another, are the file; no task holds more than a range."""
    (lines.orderBy(*order) if order else lines).select("value").write.mode("overwrite").text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, part (a part's name) and line (from 0, within the part): ordered by these two they are the file."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("part"), "value").filter("value <> ''")
    return whole.select("part", F.posexplode(F.split(F.regexp_replace("value", r"\n\z", ""), "\n")).alias("line", "value"))


def printed(df: DataFrame, *columns: str) -> DataFrame:
    """The double columns as text of 17 significant digits, without trailing zeros, as C's %.17g: exact digits, so every double reads back. (The JVM's own formats
    go through the shortest decimal.)"""
    import pyarrow as pa

    def rows(batches):
        for b in batches:
            for c in columns:
                i = b.schema.get_field_index(c)
                text = pa.array([None if v is None else format(v, ".17g") for v in b.column(i).to_pylist()], pa.string())
                b = b.set_column(i, c, text)
            yield b

    shape = ", ".join(f"`{f.name}` {'string' if f.name in columns else f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(rows, shape)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
