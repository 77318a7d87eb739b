"""The jobs as registered queries: each runs its function twice over the whole tables into one new folder and returns what stands there then."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobs import catalogue, prepare_targets
from meshquilt.plans.queries import rounded
from meshquilt.sources.corpus import MESH_SQL
from meshquilt.sources.scratch import scratch


def job1_prepare_targets(spark, sf_dir: str):
    """The manifest with the targets of each model; a rejected one has a row of its own."""
    output = scratch(spark)
    prepare_targets.run(spark, sf_dir, output)
    manifest, targets = prepare_targets.run(spark, sf_dir, output)
    both = manifest.join(targets.drop("split"), "model_id", "left")
    return rounded(both.withColumns({k: F.round(k, 4) for k in ("tx", "ty", "tz")}))


def job2_catalogue(spark, sf_dir: str):
    """The ledger with the count of its source, split and reason from the summary. (The table is one file or a folder of them: a pattern
    takes either.)"""
    output = scratch(spark)
    for _ in range(2):
        ledger, summary = catalogue.run(spark, f"{sf_dir}/documents.parquet*", output, f"{output}/checkpoint")
    s = summary.select(*(F.col(c).alias(f"s_{c}") for c in ("source", "reason", "split")), F.col("n").alias("n_alike"))
    alike = F.col("source").eqNullSafe(F.col("s_source")) & F.col("reason").eqNullSafe(F.col("s_reason")) & (F.col("split") == F.col("s_split"))
    return ledger.join(s, alike).select("doc_id", "lang", "source", "digest", "n_words", "wanted", "preferred", "stratum", "reason", "split", "n_alike")


def _split(key: str, config) -> str:
    place = f"CAST(('0x' || substr(md5('{config.seed}:' || {key}), 1, 8)) AS BIGINT) % 10000"
    return f"CASE WHEN {place} < {round(config.validation * 10_000)} THEN 'validation' WHEN {place} < {round((config.validation + config.test) * 10_000)} THEN 'test' ELSE 'train' END"


def _any(words) -> str:
    return " OR ".join(f"contains(t, '{w}')" for w in words)


_P, _C = prepare_targets.Config(), catalogue.Config()
QUERIES = {"job1_prepare_targets": job1_prepare_targets, "job2_catalogue": job2_catalogue}
ORACLES = {
    "job1_prepare_targets": MESH_SQL
    + f""", n AS (SELECT model_id, count(*) AS n_vertices FROM vert GROUP BY model_id), nf AS (SELECT model_id, count(*) AS n_faces FROM face GROUP BY model_id),
    mf AS (SELECT model_id, n_vertices, coalesce(n_faces, 0) AS n_faces, {_split("CAST(model_id AS VARCHAR)", _P)} AS split, CASE WHEN n_faces IS NULL THEN 'empty_vertices_or_faces'
      WHEN n_vertices < {_P.min_vertices} OR n_faces < {_P.min_faces} THEN 'below_minimum_complexity' WHEN n_faces > {_P.max_faces} THEN 'too_many_faces' END AS reason FROM n LEFT JOIN nf USING (model_id)),
    q AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY model_id) = 1 THEN 100.0 ELSE CAST(100 AS double) * (row_number() OVER (PARTITION BY model_id ORDER BY area, vid) - 1) / (count(*) OVER (PARTITION BY model_id) - 1) END AS p FROM rep),
    t AS (SELECT l.model_id, l.vid, lx, ly, lz, coalesce(h, 0) AS h, coalesce(degree, 0) AS degree, coalesce(h, 0) * coalesce(h, 0) + 1e-12 AS d, area, p FROM lap l LEFT JOIN hh USING (model_id, vid) JOIN q USING (model_id, vid))
    SELECT m.model_id, n_vertices, n_faces, reason, split, vid, round(lx, 6) AS lx, round(ly, 6) AS ly, round(lz, 6) AS lz, round(h, 6) AS h, degree, h > 0 AS valid, round(lx / d, 4) AS tx, round(ly / d, 4) AS ty, round(lz / d, 4) AS tz,
      round(area, 6) AS area, round(p, 6) AS area_percentile FROM mf m LEFT JOIN t ON t.model_id = m.model_id AND m.reason IS NULL""",
    "job2_catalogue": f"""
    WITH d AS (SELECT DISTINCT doc_id, lang, source, coalesce(text, '') AS x FROM documents),
    w AS (SELECT doc_id, lang, source, sha256(x) AS digest, CAST(len(regexp_extract_all(x, '{catalogue.WORD}')) AS BIGINT) AS n_words, lower(x) AS t FROM d),
    k AS (SELECT *, ({_any(catalogue.S.SOFA_WORDS)}) AND NOT contains(t, 'sofastool') AS wanted, {_any(catalogue.S.PREFERRED)} AS preferred, {_any(catalogue.S.EXCLUDED)} AS unwanted FROM w),
    l AS (SELECT doc_id, lang, source, digest, n_words, wanted, preferred, CASE {" ".join(f"WHEN n_words BETWEEN {a} AND {b} THEN '{n}'" for n, a, b in _C.strata)} ELSE 'out_of_range' END AS stratum,
      CASE WHEN n_words = 0 THEN 'empty_description' WHEN n_words < {_C.min_words} THEN 'too_short' WHEN n_words > {_C.max_words} THEN 'too_long' WHEN unwanted THEN 'excluded_sofa_subtype_keyword'
        WHEN source IS NULL THEN 'unknown_source' END AS reason, {_split("digest", _C)} AS split FROM k)
    SELECT *, count(*) OVER (PARTITION BY source, reason, split) AS n_alike FROM l""",
}
