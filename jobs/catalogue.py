"""A ledger of model descriptions, kept up to date from growing files.

    python -m jobs.catalogue --descriptions PATH --output DIR --checkpoint DIR [--config jobs/catalogue.json]

Takes what is new under ``--descriptions`` (a folder or a pattern of Parquet files as of ``documents``: doc_id, text, lang, source) by a file stream whose checkpoint
holds the files that were taken, and ends when all are. Each description is measured once: words, digest, keywords of the wanted and unwanted kinds,
stratum, and the first rule that it breaks. The split hangs on the digest and the seed alone, so copies of a text, whenever
they come, never stand in different splits. A description that is in the ledger already (same id, same text) adds nothing.

``ledger/`` is partitioned by batch and split. A batch overwrites its own partitions only and leaves out what
other batches have, so one that failed halfway and is run again leaves the rows once, and so does a run that has lost its checkpoint and takes all files anew. ``summary/`` (counts by source, split and
reason) is made anew from the whole ledger by every run. Null texts count as empty; of rows with one id and text the least (lang, source) stays.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import common
from meshquilt.operators import selection as S

TAKEN = "doc_id long, text string, lang string, source string"
LEDGER = "doc_id long, lang string, source string, digest string, n_words long, wanted boolean, preferred boolean, stratum string, reason string, batch long, split string"
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Config:
    min_words: int = 20
    max_words: int = 10_000
    strata: tuple = (("short", 1, 200), ("middle", 201, 1000), ("long", 1001, 1_000_000_000))
    validation: float = 0.1
    test: float = 0.1
    seed: int = 1949


def described(rows: DataFrame, config: Config) -> DataFrame:
    """One row for each id and text, without ``batch``."""
    text = F.coalesce("text", F.lit(""))
    words = F.size(F.expr(f"regexp_extract_all(coalesce(text, ''), r'{WORD}', 0)")).cast("long")
    seen = rows.select("doc_id", "lang", "source", F.sha2(text, 256).alias("digest"), words.alias("n_words"), S.is_sofa(F.lit(None).cast("string"), text).alias("wanted"), S.any_word(text, S.PREFERRED).alias("preferred"), S.any_word(text, S.EXCLUDED).alias("unwanted"))
    n = F.col("n_words")
    broken = (
        F.when(n == 0, "empty_description").when(n < config.min_words, "too_short").when(n > config.max_words, "too_long")
        .when(F.col("unwanted"), "excluded_sofa_subtype_keyword").when(F.col("source").isNull(), "unknown_source")
    )
    one = seen.groupBy("doc_id", "digest").agg(F.min(F.struct("lang", "source", "n_words", "wanted", "preferred", "unwanted")).alias("r")).select("doc_id", "digest", "r.*")
    return one.select(
        "doc_id", "lang", "source", "digest", "n_words", "wanted", "preferred", S.stratum(n, config.strata).alias("stratum"), broken.alias("reason"), S.hash_split(F.col("digest"), config.seed, config.validation, config.test).alias("split")
    )


def take(rows: DataFrame, batch: int, ledger: str, config: Config) -> int:
    """Add what other batches do not have of ``rows`` as this batch's partitions."""
    known = rows.sparkSession.read.schema(LEDGER).parquet(ledger).filter(F.col("batch") != batch).select(F.col("doc_id").alias("k_id"), F.col("digest").alias("k_digest"))
    fresh = described(rows, config).join(known, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("digest") == F.col("k_digest")), "left_anti")
    return common.write(fresh.withColumn("batch", F.lit(batch).cast("long")), ledger, f"batch {batch}", "batch", "split", partitionOverwriteMode="dynamic")


def run(spark: SparkSession, descriptions: str, output: str, checkpoint: str, config: Config = Config()) -> tuple[DataFrame, DataFrame]:
    """Takes what is new, waits for the end, and returns, read back, the ledger and its summary."""
    ledger, summary = f"{output}/ledger", f"{output}/summary"
    spark.createDataFrame([], LEDGER).write.mode("append").partitionBy("batch", "split").parquet(ledger)  # so that it can be read
    stream = spark.readStream.schema(TAKEN).parquet(descriptions)
    query = stream.writeStream.foreachBatch(lambda rows, batch: take(rows, batch, ledger, config)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    read = sum(p.numInputRows for p in query.recentProgress)
    common.log.info("read %s new rows from %s in %s batches", read, descriptions, sum(p.numInputRows > 0 for p in query.recentProgress))
    whole = spark.read.schema(LEDGER).parquet(ledger)
    counts = whole.groupBy("source", "reason", "split").agg(F.count("*").alias("n"))
    common.write(counts, summary, "the summary", "split")
    return whole, spark.read.schema(counts.schema).parquet(summary)


def main() -> None:
    args = common.command(__doc__, "descriptions", "output", "checkpoint")
    spark = common.session("catalogue")
    try:
        run(spark, args.descriptions, args.output, args.checkpoint, common.configured(spark, Config, args.config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
