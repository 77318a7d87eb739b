"""A catalogue of validation rules over a prepared dataset, compiled to one aggregate for each grain.

A rule is a name and a condition in SQL over the rows of one grain (vertex, face, mesh, target, laplacian, view, file, sample, model). ``broken``
turns the catalogue into one ``groupBy(model_id).agg(...)`` for each grain, so every table is read once however many rules look
at it, and joins the few columns that come out. Rules of other projects are added to the tuple; nothing else changes.

``any`` holds for a row and breaks the rule where some row has it; ``having`` is an aggregate condition; a rule with ``tag`` names each row that
has it (``empty_mask:view_3``). ``absent`` is what a model without rows of that grain gets. A condition over nulls does not hold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshquilt.operators import geometry as G
from meshquilt.operators import topology as T

KEY = "model_id"
INF = "CAST('Infinity' AS double)"


@dataclass(frozen=True)
class Rule:
    name: str
    grain: str
    any: str | None = None
    having: str | None = None
    tag: str | None = None
    absent: bool = False

    def aggregate(self) -> str:
        """The rule as an aggregate expression: a boolean, or with ``tag`` the list of broken rows' names."""
        if self.tag:
            return f"array_agg(DISTINCT CASE WHEN {self.any} THEN concat('{self.name}:', {self.tag}) END)"
        return self.having or f"bool_or({self.any})"


def odd(*columns: str) -> str:
    """SQL: some column is null or not finite."""
    return "(" + " OR ".join(f"{c} IS NULL OR isnan({c}) OR abs({c}) = {INF}" for c in columns) + ")"


def apart(a: str, b: str, tolerance: str) -> str:
    """SQL: two vectors (three columns of one prefix each) differ by more than the tolerance in a component, or one is not there."""
    return "(" + " OR ".join(f"{a}{k} IS NULL OR {b}{k} IS NULL OR isnan({a}{k}) OR isnan({b}{k}) OR abs({a}{k} - {b}{k}) > {tolerance}" for k in "xyz") + ")"


#: The issue names and tolerances of a prepared dataset.
FIELDS = ("raw_laplacian_target", "normalized_laplacian_target", "valid_scale_mask", "local_edge_length", "local_edge_scale", "target_positions", "gt_vertices", "gt_faces")
#: What a sample's id begins with, before its model's number.
PREFIX = "sample_"
RADIUS = "sqrt(x * x + y * y + z * z)"
VALID = f"NOT {odd('tx', 'ty', 'tz')} AND NOT {odd('surface_distance')} AND closest_face >= 0 AND closest_face < n_gt_faces AND NOT {odd('w0', 'w1', 'w2')}"
RULES = (
    Rule("invalid_vertex_shape", "vertex", any="x IS NULL OR y IS NULL OR z IS NULL"),
    Rule("non_finite_vertices", "vertex", any=f"x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL AND {odd('x', 'y', 'z')}"),
    Rule("normalized_gt_out_of_expected_range", "vertex", any="role = 'gt' AND greatest(abs(x), abs(y), abs(z)) > 1.01"),
    Rule("normalized_gt_outside_unit_sphere", "vertex", having=f"max({RADIUS}) FILTER (WHERE role = 'gt') > 1.000001"),
    Rule("normalized_gt_does_not_reach_unit_sphere", "vertex", having=f"max({RADIUS}) FILTER (WHERE role = 'gt') < 0.99999"),
    Rule("invalid_face_shape", "face", any="i0 IS NULL OR i1 IS NULL OR i2 IS NULL"),
    Rule("invalid_face_indices", "face", any="least(i0, i1, i2) < 0 OR greatest(i0, i1, i2) >= n_vertices"),
    Rule("repeated_indices_in_face", "face", any="i0 = i1 OR i1 = i2 OR i2 = i0"),
    Rule("non_positive_triangle_area", "face", any="area <= 0"),
    Rule("unreferenced_vertices", "mesh", any="n_used <> n_vertices"),
    Rule("empty_vertices_or_faces", "mesh", any="n_vertices = 0 OR n_faces = 0", absent=True),
    Rule("target_positions_shape_mismatch", "target", any="NOT has_vertex OR NOT has_target"),
    Rule("laplacian_target_shape_mismatch", "target", any="NOT has_vertex OR NOT has_delta"),
    Rule("non_finite_projection_distance", "target", any=f"has_target AND {odd('surface_distance')}"),
    Rule("non_finite_target_positions", "target", any=f"has_target AND {odd('tx', 'ty', 'tz')}"),
    Rule("invalid_closest_face_indices", "target", any="closest_face < 0 OR closest_face >= n_gt_faces"),
    Rule("barycentric_sum_mismatch", "target", any="abs(w0 + w1 + w2 - 1) > 0.00001"),
    Rule("non_finite_barycentric_coordinates", "target", any=f"has_target AND {odd('w0', 'w1', 'w2')}"),
    Rule("valid_mask_shape_mismatch", "target", any="has_vertex AND valid_mask IS NULL"),
    Rule("invalid_valid_mask", "target", any="valid_mask NOT IN (0, 1)"),
    Rule("valid_mask_semantics_mismatch", "target", any=f"has_target AND (valid_mask <> 1 OR NOT ({VALID}))"),
    Rule("laplacian_target_contract_mismatch", "target", any=f"has_delta AND has_target AND {apart('d', 'e', '0.0000002')}"),
    Rule("prepared_raw_target_mismatch", "target", any=f"has_delta AND {apart('p', 'd', '0.0000002')}"),
    Rule("laplacian_shape_mismatch", "laplacian", having="max(l_row) >= max(n_expanded) OR max(l_col) >= max(n_expanded)"),
    Rule("non_finite_laplacian", "laplacian", any=f"value IS NOT NULL AND {odd('value')}"),
    Rule("laplacian_contract_mismatch", "laplacian", any="value IS NULL OR expected IS NULL OR NOT abs(value - expected) <= 0.000000000001"),
    Rule("unexpected_view_count", "view", having="count(*) <> max(expected_views)", absent=True),
    Rule("unexpected_depth_path_count", "view", having="count_if(has_depth) <> max(expected_views)", absent=True),
    Rule("cube_camera_centers_mismatch", "view", any=apart("c", "e", "0.00000001")),
    Rule("cube_camera_order_mismatch", "view", any="name IS DISTINCT FROM e_name"),
    Rule("cube_camera_orientation_mismatch", "view", any=apart("f", "g", "0.00000001")),
    Rule("empty_mask", "view", any="n_mask = 0", tag="concat('view_', CAST(view_id AS string))"),
    Rule("mask_touches_image_border", "view", any="n_mask > 0 AND n_border > 0", tag="concat('view_', CAST(view_id AS string))"),
    Rule("black_foreground", "view", any="n_mask > 0 AND n_lit = 0", tag="concat('view_', CAST(view_id AS string))"),
    Rule("invalid_foreground_depth", "view", any="n_mask > 0 AND n_bad_depth > 0", tag="concat('view_', CAST(view_id AS string))"),
    Rule("missing_views_dataset_json", "file", having="NOT bool_or(file = 'views/dataset.json')", absent=True),
    Rule("missing_cameras_json", "file", having="NOT bool_or(file = 'views/cameras.json')", absent=True),
    Rule("missing_view_mesh_obj", "file", having="NOT bool_or(file = 'views/mesh.obj')", absent=True),
    Rule("load_mesh_failed", "file", any="error IS NOT NULL", tag="concat(file, ':', error)"),
    Rule("raw_prepared_sample_embeds_images", "sample", any="embeds_images"),
    Rule("unexpected_prepared_storage_format", "sample", any="storage_format IS DISTINCT FROM 'lazy_image_paths_v1'", absent=True),
    Rule("unexpected_lazy_image_path_count", "sample", any="n_paths IS DISTINCT FROM 14", absent=True),
    Rule("lazy_loaded_image_shape_mismatch", "sample", any="n_images IS DISTINCT FROM 14 OR n_channels IS DISTINCT FROM 3", absent=True),
    Rule("prepared_sample_missing_extended_fields", "sample", any=" OR ".join(f"NOT coalesce(array_contains(fields, '{f}'), false)" for f in FIELDS), absent=True),
    Rule("prepared_sample_id_mismatch", "sample", any=f"sample_id IS DISTINCT FROM concat('{PREFIX}', CAST(model_id AS string))", absent=True),
)


# ---- grains ---------------------------------------------------------------------------------------------------


def mesh_grains(vertices: DataFrame, faces: DataFrame) -> dict[str, DataFrame]:
    """vertex, face and mesh grains of meshes with a ``role``: (model_id, role, vid, x, y, z) and (model_id, role, fid, i0, i1, i2)."""
    sides = [KEY, "role"]
    n = vertices.groupBy(*sides).agg(F.count("*").alias("n_vertices"))
    out = faces.join(n, sides, "left").withColumn("n_vertices", F.coalesce("n_vertices", F.lit(0)))
    for i, p in enumerate("abc"):
        corner = vertices.select(*sides, F.col("vid").alias(f"i{i}"), *(F.col(k).alias(f"{p}{k}") for k in "xyz"))
        out = out.join(corner, [*sides, f"i{i}"], "left")
    face = G.with_normal(out).select(*sides, "fid", "i0", "i1", "i2", "n_vertices", "area")
    used = faces.select(*sides, F.explode(F.array("i0", "i1", "i2")).alias("vid")).join(vertices.select(*sides, "vid"), [*sides, "vid"], "left_semi").distinct().groupBy(*sides).agg(F.count("*").alias("n_used"))
    m = faces.groupBy(*sides).agg(F.count("*").alias("n_faces"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    mesh = n.join(m, sides, "full").join(used, sides, "left").select(*sides, zero("n_vertices"), zero("n_faces"), zero("n_used"))
    return {"vertex": vertices, "face": face, "mesh": mesh}


def target_grain(vertices: DataFrame, faces: DataFrame, targets: DataFrame, delta: DataFrame, prepared: DataFrame, n_gt_faces: DataFrame) -> DataFrame:
    """One row for each vertex of the expanded mesh and each stored target: what is stored, and the Laplacian ``e`` of the target positions."""
    key = [KEY, "vid"]
    there = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    at = targets.select(*key, *(F.col(f"t{k}").alias(k) for k in "xyz"))
    expected = G.laplacian(at, T.unique_edges(faces)).select(*key, *(F.col(f"l{k}").alias(f"e{k}") for k in "xyz"))
    out = vertices.select(*key, F.lit(True).alias("has_vertex")).join(targets.withColumn("has_target", F.lit(True)), key, "full").join(delta.withColumn("has_delta", F.lit(True)), key, "full")
    out = out.join(prepared, key, "left").join(expected, key, "left").join(n_gt_faces, KEY, "left")
    out = out.withColumn("n_gt_faces", F.coalesce("n_gt_faces", F.lit(0)))
    flags = ("has_vertex", "has_target", "has_delta")
    return out.select(*(c for c in out.columns if c not in flags), *map(there, flags))


def laplacian_grain(vertices: DataFrame, faces: DataFrame, coo: DataFrame) -> DataFrame:
    """Stored entries (model_id, row, col, value) against those of the mesh."""
    expected = G.laplacian_matrix(vertices, T.unique_edges(faces)).withColumnRenamed("value", "expected")
    n = vertices.groupBy(KEY).agg(F.count("*").alias("n_expanded"))
    return coo.join(expected, [KEY, "row", "col"], "full").join(n, KEY, "left").withColumnsRenamed({"row": "l_row", "col": "l_col"})


def view_grain(views: DataFrame, layout: DataFrame, models: DataFrame) -> DataFrame:
    """Views (view_id, name, centre c, forward f, counts of pixels) with what the layout of the model's extent expects: centre e, forward g, e_name.
    ``layout``: view_id, e_name, u, v, w (signs); ``models``: model_id, expected_views, half_extent."""
    long = F.sqrt(sum((F.col(k) * F.col(k) for k in ("u", "v", "w")), F.lit(0.0)))
    met = views.join(models.select(KEY, "expected_views", "half_extent"), KEY, "left").join(layout, "view_id", "left")
    own = ("u", "v", "w")
    return met.select("*", *((F.col("half_extent") * F.col(s)).alias(f"e{k}") for k, s in zip("xyz", own, strict=True)), *((-F.col(s) / long).alias(f"g{k}") for k, s in zip("xyz", own, strict=True)))


# ---- compilation ----------------------------------------------------------------------------------------------


def broken(grains: dict[str, DataFrame], models: DataFrame, rules: tuple[Rule, ...] = RULES, keep=lambda facts: facts) -> DataFrame:
    """model_id and the sorted names of the rules that it breaks, for every model. Each grain is aggregated once. ``keep`` may store a grain's facts, a row a model, so that
    no task works the joins of all grains at once."""
    out = models.select(KEY).distinct()
    names = []
    for grain in dict.fromkeys(r.grain for r in rules):
        own = [(i, r) for i, r in enumerate(rules) if r.grain == grain]
        facts = keep(grains[grain].groupBy(KEY).agg(*(F.expr(r.aggregate()).alias(f"r{i}") for i, r in own)))
        out = out.join(facts.withColumn(f"has_{grain}", F.lit(True)), KEY, "left")
        for i, r in own:
            here = F.col(f"has_{grain}").isNotNull()
            hit = F.coalesce(F.col(f"r{i}"), F.lit(False)) if not r.tag else None
            names.append(F.coalesce(F.col(f"r{i}"), F.array().cast("array<string>")) if r.tag else F.array_compact(F.array(F.when(F.when(here, hit).otherwise(r.absent), r.name))))
    return out.select(KEY, F.array_sort(F.array_distinct(F.array_compact(F.flatten(F.array(*names))))).alias("issues"))


def summary(found: DataFrame) -> DataFrame:
    """model_id, status and pipe-joined issues."""
    return found.select(KEY, F.when(F.size("issues") == 0, "valid").otherwise("invalid").alias("status"), F.array_join("issues", "|").alias("issues"))
