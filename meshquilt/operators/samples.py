"""Manifest joins, observation merging, training samples, oracle roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshquilt.operators import geometry as G
from meshquilt.operators import selection as S
from meshquilt.operators import topology as T
from meshquilt.operators.ranking import ranked
from meshquilt.sources.scratch import kept_in_parts, shuffled_joins

#: The fields that a merge must leave as they were.
FROZEN = ("faces", "edges", "current_positions", "target_positions", "current_laplacian", "target_laplacian", "edge_scale", "normalization", "sample_id", "split")
VISIBILITY = ("frustum", "backface", "occlusion", "combined", "mask_support", "depth_visible")


def missing(wanted: DataFrame, have: DataFrame, key: str) -> DataFrame:
    return wanted.select(key).distinct().join(have, key, "left_anti")


def require(wanted: DataFrame, have: DataFrame, key: str) -> DataFrame:
    """``wanted`` joined with ``have``; keys without a partner are an error."""
    lost = [r[0] for r in missing(wanted, have, key).limit(10).collect()]
    if lost:
        raise ValueError(f"no {key} for {lost}")
    return wanted.join(have, key)


def manifest_join(left: DataFrame, right: DataFrame, key: str = "sample_id") -> tuple[DataFrame, DataFrame]:
    """Two manifests on their key, order and split of the left: (rows, issues: key, issue). Duplicates, keys of one side
    only and differing splits are issues."""
    dup = [S.duplicates(d, key).select(F.col(key), F.lit(f"duplicate_{n}").alias("issue")) for n, d in (("left", left), ("right", right))]
    sides = S.set_difference(left, right, key).select(F.col(key), F.concat(F.lit("only_"), "side").alias("issue"))
    both = left.join(right.select(key, F.col("split").alias("_split"), *(F.col(c).alias(f"right_{c}") for c in right.columns if c not in (key, "split"))), key)
    moved = both.filter(~F.col("split").eqNullSafe(F.col("_split"))).select(F.col(key), F.lit("split_differs").alias("issue"))
    return both.drop("_split"), dup[0].unionByName(dup[1]).unionByName(sides).unionByName(moved)


def variants_of(records: DataFrame, n: int, base_seed: int, key: str = "object_id") -> DataFrame:
    """n variants of every object, each with its seed."""
    out = records.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("variant"))
    return out.withColumn("seed", S.variant_seed(F.col(key), base_seed, F.col("variant")))


def merge_observations(graph: DataFrame, views: DataFrame, observed: list[str], key: str = "sample_id") -> DataFrame:
    """Graph columns from the left, the named observation columns from the right; visibility columns of either are dropped,
    since they belong to the old views."""
    keep = [c for c in graph.columns if c not in observed and c not in VISIBILITY]
    return shuffled_joins(graph.select(*keep)).join(views.select(key, *[c for c in observed if c not in VISIBILITY]), key)


def changed(before: DataFrame, after: DataFrame, columns=FROZEN, key: str = "sample_id") -> DataFrame:
    """Keys whose frozen columns differ, with the names of those columns."""
    cols = [c for c in columns if c in before.columns and c in after.columns and c != key]
    b = after.select(key, *(F.col(c).alias(f"_a_{c}") for c in cols))
    met = before.join(b, key)
    names = F.array_compact(F.array(*(F.when(~F.col(c).eqNullSafe(F.col(f"_a_{c}")), c) for c in cols)))
    return met.select(key, names.alias("columns")).filter(F.size("columns") > 0)


def absolute_paths(paths, root: str):
    return F.transform(paths, lambda p: F.when(F.startswith(p, F.lit("/")), p).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), p)))


def relative_paths(paths, root: str):
    base = root.rstrip("/") + "/"
    return F.transform(paths, lambda p: F.when(F.startswith(p, F.lit(base)), F.substr(p, F.lit(len(base) + 1))).otherwise(p))


def synthetic_sample(vertices: DataFrame, faces: DataFrame, seed: int, **how) -> DataFrame:
    """One perturbed current mesh per model with its training fields: model_id, vid, current, target, both Laplacians, the
    edge scale of the current mesh and the scale-normalised target."""
    n = vertices.count()
    # stored and dealt by model, so that the joins of the fields are planned in the models' parts
    cur = kept_in_parts(G.perturb(vertices, faces, seed, **how).select("model_id", "vid", "x", "y", "z"), n)
    edges = T.unique_edges(faces)
    lap_c, lap_t = G.laplacian(cur, edges), G.laplacian(vertices, edges)
    fields = G.normalized_target(lap_t, G.edge_scale(cur, edges)).select("model_id", "vid", "h", "h2", *(F.col(f"l{k}").alias(f"target_l{k}") for k in "xyz"), *(F.col(f"t{k}").alias(f"target_t{k}") for k in "xyz"), "round_trip_error")
    out = cur.join(vertices.select("model_id", "vid", *(F.col(k).alias(f"target_{k}") for k in "xyz")), ["model_id", "vid"])
    return kept_in_parts(out.join(lap_c.select("model_id", "vid", *(F.col(f"l{k}").alias(f"current_l{k}") for k in "xyz")), ["model_id", "vid"]).join(fields, ["model_id", "vid"]), n)


def packed_samples(points: DataFrame, faces: DataFrame, paths: DataFrame, split: DataFrame) -> DataFrame:
    """One row per sample: arrays of structs in id order, image paths in view order, metadata as a struct."""
    p = points.groupBy("model_id").agg(F.sort_array(F.collect_list(F.struct("vid", *[c for c in points.columns if c not in ("model_id", "vid")]))).alias("points"))
    f = faces.groupBy("model_id").agg(F.sort_array(F.collect_list(F.struct("fid", "i0", "i1", "i2"))).alias("faces"))
    v = paths.groupBy("model_id").agg(F.sort_array(F.collect_list(F.struct("view_id", "path"))).alias("_v"))
    out = p.join(f, "model_id").join(v, "model_id", "left").join(split, "model_id")
    meta = F.to_json(F.struct(F.lit("lazy_image_paths_v1").alias("prepared_storage_format"), F.size("points").alias("n_points"), F.size("faces").alias("n_faces")))
    return out.select("model_id", "split", "points", "faces", F.col("_v.path").alias("image_paths"), meta.alias("metadata"))


def oracle_rollup(checks: DataFrame, flags: list[str], maxima: list[str]) -> DataFrame:
    """All-pass flags and largest errors (0 where there is none)."""
    return checks.agg(F.count("*").alias("n"), *(F.coalesce(F.bool_and(c), F.lit(True)).alias(f"all_{c}") for c in flags), *(F.coalesce(F.max(c), F.lit(0.0)).alias(f"max_{c}") for c in maxima))


def oracle_check(sample: DataFrame, faces: DataFrame) -> DataFrame:
    """A saved sample checked from its own fields: the stored target Laplacian against one computed anew, the inverse of the
    normalised target against it."""
    target = sample.select("model_id", "vid", *(F.col(f"target_{k}").alias(k) for k in "xyz"))
    lap = G.laplacian(target, T.unique_edges(faces))
    met = sample.join(lap, ["model_id", "vid"])
    d = F.col("h2") + F.lit(G.EPS_EDGE)
    err = F.greatest(*(F.abs(F.col(f"target_l{k}") - F.col(f"l{k}")) for k in "xyz"))
    back = F.greatest(*(F.abs(F.col(f"target_t{k}") * d - F.col(f"target_l{k}")) for k in "xyz"))
    return met.groupBy("model_id").agg(F.max(err).alias("target_error"), F.max(back).alias("round_trip_error"), (F.max(err) <= 1e-7).alias("target_ok"), (F.max(back) <= 1e-5).alias("round_trip_ok"))


def manifest(samples: DataFrame, path_of: str = "samples/") -> DataFrame:
    order = F.array_position(F.array(F.lit("train"), F.lit("validation"), F.lit("test")), F.col("split"))
    placed = ranked(samples.select("model_id", "split").withColumn("_o", order), "_o", "model_id", name="position").drop("_o")
    return placed.withColumn("position", F.col("position").cast("int")).withColumn("path", F.concat(F.lit(path_of), F.col("model_id").cast("string"), F.lit(".parquet")))
