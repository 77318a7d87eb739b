"""The training-corpus pipeline: toxicity, quality rules, near-duplicate removal, mixing, packing.

``STAGES`` lists (name, function); every function takes (spark, docs, sf_dir) and returns a DataFrame,
which ``run`` writes to the shared scratch folder and reads back as the next one's ``docs``. All stages but
the last return the columns of ``documents``. Documents with null or empty texts fall at the quality
rules; repeated rows are copies, of which one stays; an empty table passes through as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meshquilt.llm import jaccard_join, mixing, packing, quality_rules, shared, toxicity


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models score under one half."""
    model = toxicity.learn(toxicity.labelled(docs, shared.table(spark, sf_dir, "labels")))
    return toxicity.keep_clean(docs, model)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    return quality_rules.keep(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    return jaccard_join.deduplicated(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents and their places in sequences."""
    return packing.pack(docs, packing.tokenizer_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("mixing_sources", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: Learned scores, tokenizers and packing choices have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = shared.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = shared.stored(stage(spark, docs, sf_dir), shared.scratch(spark))
    return STAGES[-1][1](spark, docs, sf_dir)
