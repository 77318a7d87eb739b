"""Mixing sources to target weights (5), DataFrame functions only: capped water-filling.

Each source has a weight; all share ``total`` words. A source whose share passes ``max_epochs`` times
its size is clamped there and what it leaves is shared out again by weight among the others, until no
share is above its cap. A share is then taken as whole repetitions plus a seeded fraction.

The fraction is drawn without sorting a source: documents fall into seeded hash buckets, so many that the
largest source has about ``BUCKET_ROWS`` rows in one (``BUCKETS`` at least); their sizes are summed per source; whole
buckets below the point where the share is met are taken, and only the bucket that holds the point is put in
order. The last document there is taken in part, so a source's words meet its target exactly (rounded down). Words
are counted once; everything up to the plan works on the stored counts.

``mix`` gives whole documents: a last part of at least half a document counts as one, so a source's words are off its
target by half of one document at most.

Defined results: null text has size 0 and takes nothing; a null source is a source of its own, last;
repeated rows share one place in the order and are split between them; an empty table gives no rows;
a source without words has target 0. Other columns are kept by ``mix`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2.0
SEED = 17
BUCKETS, BUCKET_ROWS = 4096, 4096


def _size():
    return F.coalesce(F.size(F.expr(rf"regexp_extract_all(text, r'{shared.WORD}', 0)")), F.lit(0)).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and the number of words, stored."""
    return shared.stored(docs.select("doc_id", "source", _size().alias("size")), shared.scratch(docs.sparkSession))


def _hash(seed: int):
    """60 bits of a digest of the seed and the id."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 15), 16, 10).cast("long")


def _key():
    return F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))  # a key without nulls


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, source_size, n_docs, weight, target. Sources rank by code point (UTF-8
    byte order), null last, and the weights repeat along the rank."""
    spark = sizes.sparkSession
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    listed = F.array(*(F.lit(float(w)) for w in weights))
    path = shared.scratch(spark)
    by = shared.stored(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")).withColumn("weight", F.element_at(listed, (rank % len(weights) + 1).cast("int"))),
        path,
    )
    cap = F.col("source_size") * F.lit(max_epochs)
    total = float(by.agg(F.sum("source_size")).first()[0] or 0) * share
    level, before = 0.0, -1
    while True:  # each round clamps at least one more source, or ends
        over = cap <= F.col("weight") * F.lit(level)
        clamped, n, free = by.agg(F.sum(F.when(over, cap)), F.count(F.when(over, 1)), F.sum(F.when(~over, F.col("weight")))).first()
        if n == before or not free:
            break
        before, level = n, max(0.0, total - (clamped or 0.0)) / free
    return by.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def _plan(sizes: DataFrame, goal: DataFrame, seed: int) -> tuple[DataFrame, int]:
    """A row for each source (key _k): target, repetitions _whole, words _need of the next one, the bucket _edge where
    they are met and the words _before it; and the number of buckets."""
    most = goal.agg(F.max("n_docs")).first()[0] or 0
    buckets = max(BUCKETS, 1 << (max(most // BUCKET_ROWS, 1) - 1).bit_length())
    plan = goal.select(_key().alias("_k"), "source_size", "target", F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))).alias("_whole"))
    plan = plan.withColumn("_need", F.greatest(F.floor("target") - F.col("_whole") * F.col("source_size"), F.lit(0)))
    filled = sizes.groupBy(_key().alias("_k"), F.pmod(_hash(seed), F.lit(buckets)).cast("int").alias("_b")).agg(F.sum("size").alias("_s"))
    upto = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        filled.withColumn("_before", F.coalesce(F.sum("_s").over(upto), F.lit(0)))
        .join(plan.select("_k", "_need"), "_k")
        .filter((F.col("_before") <= F.col("_need")) & (F.col("_before") + F.col("_s") > F.col("_need")))
        .groupBy("_k")
        .agg(F.min("_b").alias("_edge"), F.min_by("_before", "_b").alias("_before"))
    )
    return shared.stored(plan.join(edges, "_k", "left"), shared.scratch(sizes.sparkSession)), buckets


def _dealt(rows: DataFrame, plan: DataFrame, buckets: int, seed: int) -> DataFrame:
    """``rows`` (d: any struct, doc_id, source, size) with source_size, target and ``taken``. Only per-source plans are
    joined, so Spark sends those to the rows; the rows of the buckets that hold a point are ordered on their own."""
    placed = rows.withColumn("_k", _key()).withColumn("_h", _hash(seed)).withColumn("_b", F.pmod("_h", F.lit(buckets)).cast("int")).join(plan, "_k")
    edge = F.col("_b") == F.col("_edge")
    below = F.col("_edge").isNull() & (F.col("_need") > 0) | (F.col("_b") < F.col("_edge"))
    most = placed.filter(F.coalesce(~edge, F.lit(True))).withColumn("taken", F.col("size") * (F.col("_whole") + F.when(below, 1).otherwise(0)))
    order = Window.partitionBy("_k").orderBy("_h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rest = placed.filter(edge).withColumn("_sum", F.col("_before") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    part = F.greatest(F.least(F.col("size"), F.col("_need") - F.col("_sum")), F.lit(0))
    rest = rest.withColumn("taken", F.col("size") * F.col("_whole") + part)
    out = ["d", "doc_id", "source", "size", "source_size", "target", F.col("taken").cast("long").alias("taken")]
    return most.select(*out).unionByName(rest.select(*out))


def taken(sizes: DataFrame, goal: DataFrame, seed: int = SEED) -> DataFrame:
    """sizes with source_size, target and ``taken``, the words that the mix takes of each row."""
    return _dealt(sizes.select(F.lit(None).cast("int").alias("d"), "doc_id", "source", "size"), *_plan(sizes, goal, seed), seed).drop("d")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents as often as the mix takes them (a part of at least half counts as whole), all columns as they were."""
    sizes = sized(docs)
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("d"), "doc_id", "source", _size().alias("size"))
    how = _dealt(rows, *_plan(sizes, targets(sizes, **options), SEED), SEED)
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    return how.select("d", F.explode(F.array_repeat(F.lit(1), times)).alias("_")).select("d.*")


def op5_mixing_sources(spark, sf_dir: str) -> DataFrame:
    sizes = sized(shared.table(spark, sf_dir, "documents"))
    return taken(sizes, targets(sizes)).select("doc_id", "size", "source_size", "target", "taken")


#: The targets in closed form: sources in the order in which they reach their caps, the first level at which the next one does not.
SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{shared.WORD}')), 0) AS size,
    CAST(('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)) AS BIGINT) AS h FROM documents),
g AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS r FROM d GROUP BY source),
w AS (SELECT *, CAST([{", ".join(map(str, WEIGHTS))}][r % {len(WEIGHTS)} + 1] AS DOUBLE) AS weight, source_size * {MAX_EPOCHS}::DOUBLE AS cap, CAST(sum(source_size) OVER () AS DOUBLE) * {SHARE}::DOUBLE AS total FROM g),
o AS (SELECT *, row_number() OVER (ORDER BY cap / weight, r) AS k FROM w),
v AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o),
t AS (SELECT *, least(cap, weight * coalesce((SELECT min_by(level, k) FROM v WHERE cap / weight > level), 1e300)) AS target FROM v),
p AS (SELECT *, CAST(floor(target / greatest(source_size, 1)) AS BIGINT) AS whole, greatest({BUCKETS}, CAST(pow(2, ceil(log2(greatest((SELECT max(n) FROM g) // {BUCKET_ROWS}, 1)))) AS BIGINT)) AS buckets FROM t),
q AS (SELECT doc_id, size, source_size, target, whole, CAST(floor(target) AS BIGINT) - whole * source_size AS need,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h % buckets, h, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(size * whole + greatest(least(size, need - before), 0) AS BIGINT) AS taken FROM q
"""
