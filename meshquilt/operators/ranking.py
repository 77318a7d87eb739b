"""Global order without a global window: rows are dealt out by ranges, numbered in their part, and parts know how many rows stand before them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshquilt.sources.scratch import scratch, stored

_PLACE = (1 << 33) - 1


def parted(df: DataFrame, *order: Column | str, parts: int | None = None) -> DataFrame:
    """``df`` in global order over parts, stored, with ``_part`` and ``_place`` (from 0 within the part). A part is a range of the order, of even size as far as
    the order tells rows apart."""
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    return stored(dealt, scratch(spark)).withColumns({"_part": F.shiftright("_id", 33).cast("int"), "_place": F.col("_id").bitwiseAND(F.lit(_PLACE))}).drop("_id")


def ranked(df: DataFrame, *order: Column | str, name: str = "rank", parts: int | None = None) -> DataFrame:
    """``df`` with its place (from 1) in the order as ``name``; rows that the order does not tell apart get places of their own. Only the
    parts' sizes, a row each, are summed in one task."""
    rows = parted(df, *order, parts=parts)
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(sizes.select("_part", before.alias("_before")), "_part").withColumn(name, F.col("_before") + F.col("_place") + 1).drop("_part", "_place", "_before")


def next_after(asked: DataFrame, free: DataFrame, group: str, at: str, value: str, parts: int | None = None) -> DataFrame:
    """``asked`` (group, at, other columns) with ``next``: the struct (at, value) of the first row of ``free`` in the group with a larger ``at`` (null: none).
    Both are put in one order by ranges; a row finds its answer in its own part, or takes the first one of a later part: no group is one task's."""
    other = [c for c in asked.columns if c not in (group, at)]
    both = asked.select(group, at, F.lit(None).cast(free.schema[value].dataType).alias("_v"), F.struct(*other).alias("_a"))
    both = both.unionByName(free.select(group, at, F.col(value).alias("_v"), F.lit(None).cast(both.schema["_a"].dataType).alias("_a")))
    rows = parted(both, group, at, parts=parts)
    offer = F.when(F.col("_v").isNotNull(), F.struct(F.col(at).alias(at), F.col("_v").alias(value)))
    mine = F.min(offer).over(Window.partitionBy("_part", group).orderBy(at).rangeBetween(1, Window.unboundedFollowing))
    heads = rows.groupBy("_part", group).agg(F.min(offer).alias("_h"))  # a row for each part and group
    later = F.min("_h").over(Window.partitionBy(group).orderBy("_part").rowsBetween(1, Window.unboundedFollowing))
    tails = heads.select("_part", group, later.alias("_later"))
    # a later part begins with rows of the same ``at`` as this one's last, where the cut fell between equal ones
    found = rows.withColumn("_mine", mine).filter("_a IS NOT NULL").join(tails, ["_part", group])
    ok = F.when(F.col(f"_later.{at}") > F.col(at), F.col("_later"))
    return found.select(group, at, "_a.*", F.coalesce("_mine", ok).alias("next"))
