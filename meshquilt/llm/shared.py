"""Session helpers of the training-data operators: scratch tables, batch sizes, labels, Bloom filters."""

from __future__ import annotations

import contextlib
import sys
import tempfile
import uuid

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BATCH_ROWS = 256
_LOCAL: dict = {}


def by_value(name: str) -> None:
    """Ship the module's functions inside the tasks, so that executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal_table(spark: SparkSession, rows, names: tuple[str, ...]) -> DataFrame:
    """A small table of strings held in the plan itself, so that Spark knows its size."""
    rows = [tuple(r) for r in rows]
    if not rows:
        return spark.createDataFrame([], ", ".join(f"{n} string" for n in names))
    marks = ", ".join("(" + ", ".join(f":v{i}_{j}" for j in range(len(names))) + ")" for i in range(len(rows)))
    return spark.sql(f"SELECT * FROM VALUES {marks} AS t({', '.join(names)})", args={f"v{i}_{j}": v for i, r in enumerate(rows) for j, v in enumerate(r)})


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows: texts may be very long, and a batch is held whole."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


@contextlib.contextmanager
def batches(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows for the jobs that run inside; the session's own setting comes back after them."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(rows))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def scratch(spark: SparkSession) -> str:
    """A new folder in the cluster's shared checkpoint folder (a local one only where none is set and Spark runs on one machine)."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        base = _LOCAL.setdefault("folder", "file://" + tempfile.mkdtemp(prefix="meshquilt-"))
    return f"{base.rstrip('/')}/meshquilt-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """The rows written to ``path`` and read back: lineage ends, lost executors lose nothing."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Tables:
    """Scratch tables of one job; ``drop`` deletes those that nothing reads any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def stored(self, df: DataFrame) -> DataFrame:
        self.paths.append(scratch(self.spark))
        return stored(df, self.paths[-1])

    def drop(self) -> None:
        discard(self.spark, *self.paths)
        self.paths.clear()


def fold(column: str, parts: int):
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(parts)


def trim() -> None:
    """Give memory that a worker has freed back to the system: the next task's worker may be another one."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # no glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def largest(df: DataFrame, column: str, bound: int) -> DataFrame:
    """The rows with the largest positive values, at most ``bound``: a histogram of at most a few hundred buckets
    finds the cut, so no task or driver ever orders the rows. ``df`` is read twice."""
    bucket = F.floor(F.log2(F.col(column)) * 16).cast("int")
    counts = sorted(df.filter(F.col(column) > 0).groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["b"])
    cut, total = None, 0
    for r in counts:
        total += r["n"]
        if total > bound:
            break
        cut = r["b"]
    return df.filter((F.col(column) > 0) & (bucket >= cut)) if cut is not None else df.limit(0)


def drawn(df: DataFrame, total: int, bound: int, *ids: str) -> DataFrame:
    """About 0.95 ``bound`` of ``total`` rows (all, if there are no more), drawn by a hash of the ids and of the row's place in
    the table, so rows of one id are drawn one by one, however many there are. ``df`` reads stored rows: their places
    are the same every time. The share leaves seven deviations to a bound of 20,000, so no limit has to gather the rows in one task."""
    if total <= bound:
        return df
    rate = int(0.95 * bound / total * (1 << 30))
    return df.filter(F.pmod(F.xxhash64(*ids, F.monotonically_increasing_id()), F.lit(1 << 30)) < rate)


def bloom(keys: DataFrame, column: str, bits: int = 1 << 23, hashed=F.xxhash64) -> np.ndarray:
    """A bitmap of fixed size over the hashes of ``column`` (``hashed`` gives them as longs): at most ``bits``/64 words reach the driver,
    whatever the input; a full one lets more rows pass and loses none."""
    h = hashed(F.col(column))
    both = [F.pmod(h, F.lit(bits)), F.pmod(F.shiftright(h, 32), F.lit(bits))]
    found = (
        keys.select(F.explode(F.array(*both)).alias("b"))
        .groupBy(F.shiftright("b", 6).alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("v"))
        .toPandas()
    )
    out = np.zeros(bits >> 6, np.int64)
    out[found["w"].to_numpy(np.int64)] = found["v"].to_numpy(np.int64)
    return out.view(np.uint64)


def passes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which xxhash64 values (int64) the bitmap of ``bloom`` lets pass."""
    bits = len(bitmap) << 6
    ok = np.ones(len(hashes), bool)
    for b in (np.mod(hashes, bits), np.mod(hashes >> 32, bits)):
        ok &= (bitmap[b >> 6] >> (b & 63).astype(np.uint64)) & np.uint64(1) == 1
    return ok
