"""Validation suites: every rule is a column, a model's broken rules are rows (model_id, rule)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshquilt.operators import geometry as G
from meshquilt.operators import selection as S
from meshquilt.operators import topology as T
from meshquilt.sources.scratch import kept_in_parts


def issues_of(facts: DataFrame, rules: list[tuple[str, object]], key: str = "model_id") -> DataFrame:
    """(key, rule) for each rule that holds; a rule over nulls does not hold."""
    found = F.array_compact(F.array(*(F.when(rule, name) for name, rule in rules)))
    return facts.select(key, F.explode(found).alias("rule"))


def summary(issues: DataFrame, models: DataFrame, key: str = "model_id") -> DataFrame:
    """Status and pipe-joined, sorted issues of every model."""
    by = issues.groupBy(key).agg(F.array_sort(F.collect_set("rule")).alias("rules"))
    out = models.select(key).distinct().join(by, key, "left")
    return out.select(key, F.when(F.col("rules").isNull(), "valid").otherwise("invalid").alias("status"), F.coalesce(F.array_join("rules", "|"), F.lit("")).alias("issues"))


def raise_if_any(issues: DataFrame, limit: int = 20) -> None:
    rows = issues.limit(limit).collect()
    if rows:
        raise ValueError("; ".join(":".join(str(v) for v in r) for r in rows))


def geometry_rules(vertices: DataFrame, faces: DataFrame, models: DataFrame | None = None) -> DataFrame:
    return S.model_facts(vertices, faces, models).select("model_id", F.explode(S.mesh_issues()).alias("rule"))


def unit_sphere_rules(vertices: DataFrame, tolerance: float = 1e-5) -> DataFrame:
    """Largest radius within [1 - tolerance, 1 + 1e-6] and the box centred."""
    r = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))
    facts = vertices.groupBy("model_id").agg(F.max(r).alias("r"), F.greatest(*(F.abs(F.max(k) + F.min(k)) / 2 for k in "xyz")).alias("off"))
    return issues_of(facts, [("unit_sphere_radius_mismatch", (F.col("r") > 1 + 1e-6) | (F.col("r") < 1 - tolerance)), ("bounding_box_not_centred", F.col("off") > 1e-6)])


def laplacian_rules(vertices: DataFrame, faces: DataFrame, stored_laplacian: DataFrame, tolerance: float = 2e-7) -> DataFrame:
    """The stored Laplacian (model_id, vid, lx, ly, lz) against one computed from the mesh."""
    lap = G.laplacian(vertices, T.unique_edges(faces)).select("model_id", "vid", *(F.col(f"l{k}").alias(f"m{k}") for k in "xyz"))
    met = lap.join(stored_laplacian, ["model_id", "vid"], "left")
    err = F.greatest(*(F.abs(F.col(f"m{k}") - F.col(f"l{k}")) for k in "xyz"))
    facts = met.groupBy("model_id").agg(F.max(err).alias("err"), F.count(F.when(F.col("lx").isNull(), 1)).alias("lost"))
    return issues_of(facts, [("laplacian_target_contract_mismatch", F.col("err") > tolerance), ("missing_laplacian_rows", F.col("lost") > 0)])


def target_rules(targets: DataFrame, n_vertices: DataFrame) -> DataFrame:
    """Surface targets: one per vertex, all valid, weights of at least 0 that sum to 1. ``n_vertices``: model_id, n_vertices."""
    w = F.col("w0") + F.col("w1") + F.col("w2")
    facts = targets.groupBy("model_id").agg(F.count("*").alias("n"), F.count(F.when(~F.col("valid"), 1)).alias("bad"), F.max(F.abs(w - 1)).alias("sum"), F.min(F.least("w0", "w1", "w2")).alias("least"))
    met = n_vertices.join(facts, "model_id", "left")
    return issues_of(met, [("surface_target_count_mismatch", F.coalesce("n", F.lit(0)) != F.col("n_vertices")), ("invalid_surface_targets", F.col("bad") > 0), ("barycentric_weights_not_on_simplex", (F.col("sum") > 1e-6) | (F.col("least") < -1e-9))])


def split_rules(rows: DataFrame, quotas: dict[str, int]) -> DataFrame:
    """Global rules of a split table (id, thing_id, split): counts, overlap, duplicates, leakage."""
    spark = rows.sparkSession
    want = spark.createDataFrame([*quotas.items()], "split string, quota long")
    have = rows.groupBy("split").agg(F.count("*").alias("n"))
    counts = want.join(have, "split", "full").filter(~F.coalesce("n", F.lit(0)).eqNullSafe(F.coalesce("quota", F.lit(0)))).select(F.col("split").alias("model_id"), F.lit("split_count_mismatch").alias("rule"))
    over = S.overlap(rows).select(F.col("id").cast("string").alias("model_id"), F.lit("in_several_splits").alias("rule"))
    dup = S.duplicates(rows, "id", "split").select(F.col("id").cast("string").alias("model_id"), F.lit("duplicate_in_split").alias("rule"))
    leak = S.leakage(rows).select(F.col("thing_id").cast("string").alias("model_id"), F.lit("thing_leakage").alias("rule"))
    return counts.unionByName(over).unionByName(dup).unionByName(leak)


def midpoint_rules(coarse: DataFrame, expanded: DataFrame, parents: DataFrame, remap: DataFrame, tolerance: float = 3e-6) -> DataFrame:
    """Every expanded vertex is a coarse vertex or the midpoint of its parents."""
    old = remap.withColumnRenamed("old_vid", "vid")
    is_ = expanded.select("model_id", F.col("vid").alias("new_vid"), *(F.col(k).alias(f"e{k}") for k in "xyz"))
    kept = coarse.join(old, ["model_id", "vid"]).join(is_, ["model_id", "new_vid"]).select("model_id", "new_vid", *(F.abs(F.col(k) - F.col(f"e{k}")).alias(f"d{k}") for k in "xyz"))
    p = coarse.select("model_id", F.col("vid").alias("p0"), *(F.col(k).alias(f"a{k}") for k in "xyz"))
    q = coarse.select("model_id", F.col("vid").alias("p1"), *(F.col(k).alias(f"b{k}") for k in "xyz"))
    mid = parents.join(p, ["model_id", "p0"]).join(q, ["model_id", "p1"]).join(old.withColumnRenamed("vid", "child_vid"), ["model_id", "child_vid"]).join(is_, ["model_id", "new_vid"])
    mid = mid.select("model_id", "new_vid", *(F.abs((F.col(f"a{k}") + F.col(f"b{k}")) / 2 - F.col(f"e{k}")).alias(f"d{k}") for k in "xyz"))
    n = coarse.count()
    # stored, as a plan with all these joins holds too many sorts at once
    kept, mid = (kept_in_parts(df.select("model_id", "new_vid", F.greatest("dx", "dy", "dz").alias("err")), n) for df in (kept, mid))
    facts = kept.unionByName(mid).groupBy("model_id").agg(F.max("err").alias("err"), F.count_distinct("new_vid").alias("n"))
    facts = kept_in_parts(facts.join(expanded.groupBy("model_id").agg(F.count("*").alias("all")), "model_id", "right"))
    return issues_of(facts, [("midpoint_reconstruction_mismatch", F.col("err") > tolerance), ("unmapped_expanded_vertices", F.coalesce("n", F.lit(0)) != F.col("all"))])


def camera_rules(cameras: DataFrame, expected: DataFrame, tolerance: float = 1e-8) -> DataFrame:
    """A model's cameras against the layout: count, names and order, centres, forward axis."""
    from meshquilt.operators.views import centres

    e = centres(expected).select("view_id", F.col("name").alias("e_name"), *(F.col(f"c{k}").alias(f"e{k}") for k in "xyz"))
    met = centres(cameras).join(F.broadcast(e), "view_id", "left")  # a layout: dozens of rows
    off = F.greatest(*(F.abs(F.col(f"c{k}") - F.col(f"e{k}")) for k in "xyz"))
    size = F.sqrt(F.col("ex") ** 2 + F.col("ey") ** 2 + F.col("ez") ** 2)
    turn = F.greatest(*(F.abs(F.col("r")[6 + i] + F.col(f"e{k}") / size) for i, k in enumerate("xyz")))
    facts = met.groupBy("model_id").agg(F.count("*").alias("n"), F.max(off).alias("off"), F.max(turn).alias("turn"), F.bool_and(F.col("name").eqNullSafe(F.col("e_name"))).alias("named"))
    n = expected.count()
    return issues_of(facts, [("unexpected_view_count", F.col("n") != n), ("cube_camera_centers_mismatch", F.col("off") > tolerance), ("cube_camera_order_mismatch", ~F.col("named")), ("cube_camera_orientation_mismatch", F.col("turn") > tolerance)])


def contract_issues(rows: DataFrame, expected: dict, key: str = "model_id", prefix: str = "unexpected_") -> DataFrame:
    """Cache contracts: every expected field that differs (null-safe) is an issue unexpected_<field>."""
    return issues_of(rows, [(prefix + c, ~F.col(c).eqNullSafe(F.lit(v))) for c, v in expected.items()], key)


def forbidden_columns(samples: DataFrame, names: list[str]) -> list[str]:
    """Oracle fields that an inference sample must not carry."""
    return sorted(set(samples.columns) & set(names))


def loader_audit(samples: DataFrame, views: int) -> DataFrame:
    """Prepared samples: format, embedded images, path count."""
    return issues_of(
        samples,
        [
            ("raw_prepared_sample_embeds_images", F.lit("images" in samples.columns)),
            ("unexpected_prepared_storage_format", ~F.get_json_object("metadata", "$.prepared_storage_format").eqNullSafe(F.lit("lazy_image_paths_v1"))),
            ("unexpected_lazy_image_path_count", F.coalesce(F.size("image_paths"), F.lit(0)) != views),
        ],
    )


def unchanged_geometry(before: DataFrame, after: DataFrame) -> DataFrame:
    """Models whose checksum differs: ``before``, ``after``: model_id, checksum."""
    met = before.join(after.withColumnRenamed("checksum", "now"), "model_id", "full")
    return met.filter(~F.col("checksum").eqNullSafe(F.col("now"))).select("model_id", F.lit("geometry_changed").alias("rule"))


def round_trip_repair(written: DataFrame, read: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Models whose vertices did not survive a write and read, to be written again."""
    b = read.select("model_id", "vid", *(F.col(k).alias(f"r{k}") for k in "xyz"))
    met = written.join(b, ["model_id", "vid"], "full")
    bad = F.col("x").isNull() | F.col("rx").isNull() | (F.greatest(*(F.abs(F.col(k) - F.col(f"r{k}")) for k in "xyz")) > tolerance)
    return met.filter(bad).select("model_id").distinct()
