"""Validation of refinement data: the rule catalogue of a model's stages, and the differential leakage test.

``REFINEMENT_RULES`` are compiled as those of ``rules``: the stored query mesh must be the midpoint subdivision of the raw coarse mesh, to the last
bit, and not that of the registered one; mappings must point into the fine mesh with weights on the simplex and rebuild what
is stored; registries must stay in range; the metadata must state who may train on what.

``leaks`` tests the same from outside, for any operator: what it makes must not change when only held-back columns change.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as K

from meshquilt.operators.rules import KEY, Rule, apart, odd

#: Issue names, tolerances and contract texts of refinement data.
REFINEMENT_RULES = (
    Rule("coarse_registration_shape_mismatch", "coarse", any="NOT has_raw OR NOT has_registered"),
    Rule("saved_qem_vertices_mismatch", "coarse", any=f"has_raw AND {apart('k', 'a', '0.0000001')}"),
    Rule("saved_registered_vertices_mismatch", "coarse", any=f"has_registered AND {apart('l', 'c', '0.0000001')}"),
    Rule("coarse_registration_face_indices_invalid", "coarse", any="NOT has_face"),
    Rule("coarse_registration_weights_invalid", "coarse", any="abs(w0 + w1 + w2 - 1) > 0.000002 OR w0 IS NULL OR w1 IS NULL OR w2 IS NULL"),
    Rule("coarse_registration_weights_outside_simplex", "coarse", any=f"abs(w0 + w1 + w2 - 1) <= 0.000002 AND ({odd('w0', 'w1', 'w2')} OR least(w0, w1, w2) < -0.0000000001)"),
    Rule("raw_query_faces_not_reconstructed_from_coarse_raw", "queryface", any="e0 IS DISTINCT FROM r0 OR e1 IS DISTINCT FROM r1 OR e2 IS DISTINCT FROM r2"),
    Rule("raw_query_vertices_not_reconstructed_from_coarse_raw", "query", any="qx IS DISTINCT FROM ax OR qy IS DISTINCT FROM ay OR qz IS DISTINCT FROM az"),
    Rule("gt_registered_coarse_leaked_into_query", "query", having=f"max(moved) > 0.000000000001 AND bool_and(NOT {apart('q', 'c', '0.000000000001')})"),
    Rule("correspondence_length_mismatch", "mapping", any="NOT has_vertex OR NOT has_mapping"),
    Rule("invalid_mapping_kind", "mapping", any="kind NOT IN (0, 1, 2, 3)"),
    Rule("mapping_weight_sum_mismatch", "mapping", any="abs(w0 + w1 + w2 - 1) > 0.000002"),
    Rule("mapping_face_index_out_of_range", "mapping", any="has_mapping AND NOT has_face"),
    Rule("mapping_face_vertex_indices_mismatch", "mapping", any="has_face AND (g0 IS DISTINCT FROM f0 OR g1 IS DISTINCT FROM f1 OR g2 IS DISTINCT FROM f2)"),
    Rule("mapping_weights_invalid", "mapping", any=f"has_mapping AND {odd('w0', 'w1', 'w2')}"),
    Rule("mapping_weights_outside_simplex", "mapping", any="least(w0, w1, w2) < -0.0000000001"),
    Rule("surface_target_oracle_reconstruction_mismatch", "mapping", any=f"has_face AND {apart('r', 's', '0.000003')}"),
    Rule("P_target_oracle_reconstruction_mismatch", "mapping", any=f"has_mapping AND has_vertex AND {apart('m', 'o', '0.000003')}"),
    Rule("original_gt_to_coarse_shape_mismatch", "origin", any="NOT has_vertex OR NOT has_origin"),
    Rule("original_gt_to_coarse_out_of_range", "origin", any="coarse_vid < 0 OR coarse_vid >= n_coarse"),
    Rule("collapse_history_out_of_range", "collapse", any="least(kept, gone) < 0 OR greatest(kept, gone) >= n_gt"),
    Rule("metadata_not_valid", "metadata", any="status IS DISTINCT FROM 'valid'", absent=True),
    Rule("invalid_correspondence_contract", "metadata", any="global_nearest IS DISTINCT FROM 'false'", absent=True),
    Rule("expanded_initial_raw_role_missing", "metadata", any="NOT coalesce(contains(role_expanded, 'model_query'), false)", absent=True),
    Rule("registered_coarse_oracle_role_missing", "metadata", any="NOT coalesce(contains(role_registered, 'oracle'), false)", absent=True),
    Rule("P_target_oracle_training_exclusion_missing", "metadata", any="NOT coalesce(contains(role_target, 'never training supervision'), false)", absent=True),
    Rule("registered_coarse_query_contract_invalid", "metadata", any="registered_used IS DISTINCT FROM 'false'", absent=True),
    Rule("training_loader_exclusion_missing", "metadata", any="may_train IS DISTINCT FROM 'false'", absent=True),
    Rule("GT_only_training_target_contract_missing", "metadata", any="training_target IS DISTINCT FROM 'delta_gt = L(gt_faces) @ gt_vertices'", absent=True),
    Rule("expanded_oracle_laplacian_training_exclusion_missing", "metadata", any="expanded_supervises IS DISTINCT FROM 'false'", absent=True),
)
#: column -> path in a model's metadata.
METADATA = {
    "status": "$.status",
    "global_nearest": "$.parameters.global_nearest_surface_used_for_correspondence",
    "role_expanded": "$.file_roles.expanded_initial_raw",
    "role_registered": "$.file_roles.coarse_registered_oracle",
    "role_target": "$.file_roles.P_target_oracle",
    "registered_used": "$.connectivity.registered_coarse_used_for_query",
    "may_train": "$.usage_contract.may_connect_to_training_loader",
    "training_target": "$.usage_contract.training_target",
    "expanded_supervises": "$.usage_contract.expanded_graph_oracle_laplacian_is_training_supervision",
}


def _named(df: DataFrame, prefix: str, key: str = "vid", to: str | None = None) -> DataFrame:
    """model_id, the key (under another name) and x, y, z with a prefix."""
    return df.select(KEY, F.col(key).alias(to or key), *(F.col(k).alias(f"{prefix}{k}") for k in "xyz"))


def _flag(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.lit(True))


def _no(df: DataFrame, *flags: str) -> DataFrame:
    return df.withColumns({f: F.coalesce(f, F.lit(False)) for f in flags})


def coarse_grain(raw: DataFrame, registered: DataFrame, saved: DataFrame, gt_faces: DataFrame) -> DataFrame:
    """Coarse vertices: raw a, registered c, and the saved registration (model_id, vid, k*, l*, fid, w0, w1, w2)."""
    key = [KEY, "vid"]
    met = _flag(_named(raw, "a"), "has_raw").join(_flag(_named(registered, "c"), "has_registered"), key, "full").join(saved, key, "left")
    return _no(met.join(_flag(gt_faces.select(KEY, "fid"), "has_face"), [KEY, "fid"], "left"), "has_raw", "has_registered", "has_face")


def query_grain(expanded: DataFrame, parents: DataFrame, raw: DataFrame, registered: DataFrame) -> DataFrame:
    """Vertices of the stored query q with the midpoints of their parents (model_id, vid, p0, p1; equal ones for a coarse vertex itself) on the raw (a)
    and on the registered (c) coarse mesh, and how far registration moved the first parent."""
    met = _named(expanded, "q").join(parents, [KEY, "vid"], "full")
    for i in range(2):
        met = met.join(_named(raw, f"u{i}", to=f"p{i}"), [KEY, f"p{i}"], "left").join(_named(registered, f"v{i}", to=f"p{i}"), [KEY, f"p{i}"], "left")
    middle = [((F.col(f"{s}0{k}") + F.col(f"{s}1{k}")) / 2).alias(f"{n}{k}") for s, n in (("u", "a"), ("v", "c")) for k in "xyz"]
    gap = [F.col(f"u0{k}") - F.col(f"v0{k}") for k in "xyz"]
    return met.select(KEY, "vid", "qx", "qy", "qz", *middle, F.sqrt(gap[0] * gap[0] + gap[1] * gap[1] + gap[2] * gap[2]).alias("moved"))


def face_grain(stored: DataFrame, made: DataFrame) -> DataFrame:
    """Faces of the stored query (e) and of the reconstruction (r), by id."""
    a, b = (df.select(KEY, "fid", *(F.col(f"i{i}").alias(f"{n}{i}") for i in range(3))) for df, n in ((stored, "e"), (made, "r")))
    return a.join(b, [KEY, "fid"], "full")


def mapping_grain(expanded: DataFrame, mapping: DataFrame, gt: DataFrame, gt_faces: DataFrame, alpha: DataFrame) -> DataFrame:
    """Stored mappings (model_id, vid, kind, fid, g0..g2, w0..w2, surface s, target o) with what rebuilds them: the face's corners f, the weighted
    point r, and the query blended towards the surface by the model's alpha, m."""
    met = _flag(_named(expanded, "q"), "has_vertex").join(_flag(mapping, "has_mapping"), [KEY, "vid"], "full")
    corners = gt_faces.select(KEY, "fid", *(F.col(f"i{i}").alias(f"f{i}") for i in range(3)))
    met = met.join(_flag(corners, "has_face"), [KEY, "fid"], "left").join(alpha, KEY, "left")
    for i in range(3):
        met = met.join(_named(gt, f"t{i}", to=f"f{i}"), [KEY, f"f{i}"], "left")
    r = [(F.col("w0") * F.col(f"t0{k}") + F.col("w1") * F.col(f"t1{k}") + F.col("w2") * F.col(f"t2{k}")).alias(f"r{k}") for k in "xyz"]
    b = [(F.col(f"q{k}") + F.col("alpha") * (F.col(f"s{k}") - F.col(f"q{k}"))).alias(f"m{k}") for k in "xyz"]
    return _no(met.select("*", *r, *b), "has_vertex", "has_mapping", "has_face")


def origin_grain(gt: DataFrame, origin: DataFrame, raw: DataFrame) -> DataFrame:
    """The coarse vertex (model_id, vid, coarse_vid) that every fine vertex went to."""
    n = raw.groupBy(KEY).agg(F.count("*").alias("n_coarse"))
    met = _flag(gt.select(KEY, "vid"), "has_vertex").join(_flag(origin, "has_origin"), [KEY, "vid"], "full").join(n, KEY, "left")
    return _no(met, "has_vertex", "has_origin")


def collapse_grain(history: DataFrame, gt: DataFrame) -> DataFrame:
    """Collapses (model_id, kept, gone) and the number of fine vertices."""
    return history.join(gt.groupBy(KEY).agg(F.count("*").alias("n_gt")), KEY, "left")


def metadata_grain(rows: DataFrame) -> DataFrame:
    """The contract's entries of a model's metadata (model_id, metadata: JSON text)."""
    return rows.select(KEY, *(F.get_json_object("metadata", path).alias(c) for c, path in METADATA.items()))


# ---- differential leakage -------------------------------------------------------------------------------------


def other(c: Column, kind: K.DataType) -> Column:
    """Another value of the same type, for every value but null; null becomes a value where the type has a plain one."""
    if isinstance(kind, (K.IntegralType, K.FractionalType)):
        away = -(c.cast("double")) - 1.5 if isinstance(kind, K.FractionalType) else c.bitwiseXOR(F.lit(1).cast(kind))
        return F.coalesce(F.when(F.isnan(c), 7.5).otherwise(away) if isinstance(kind, (K.DoubleType, K.FloatType)) else away, F.lit(7)).cast(kind)
    if isinstance(kind, K.StringType):
        return F.concat(F.lit("~"), F.coalesce(c, F.lit("")))
    if isinstance(kind, K.BooleanType):
        return ~F.coalesce(c, F.lit(False))
    if isinstance(kind, K.ArrayType):
        return F.coalesce(F.transform(c, lambda v: other(v, kind.elementType)), F.array().cast(kind))
    if isinstance(kind, (K.DateType, K.TimestampType, K.TimestampNTZType)):
        return F.coalesce(c + F.expr("INTERVAL 1 DAY"), F.lit("2001-01-01").cast(kind)).cast(kind)
    return F.lit(None).cast(kind)


def changed(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with every value of the columns changed."""
    return df.withColumns({c: other(F.col(c), df.schema[c].dataType) for c in columns})


def leaks(run: Callable[[dict[str, DataFrame]], DataFrame], tables: dict[str, DataFrame], held_back: dict[str, list[str]], *key: str) -> DataFrame:
    """Rows of ``run(tables)`` that the held-back columns reach: the operator runs once on the tables and once with these columns changed, and the outputs
    are compared row by row, on the key (unique in the output). Key columns and ``leaked``, the sorted names of the columns that differ, or ``row``
    where a row is on one side only. An empty result says that no value depends on what is held back."""
    a, b = run(tables), run({name: changed(df, held_back.get(name, [])) for name, df in tables.items()})
    values = [c for c in a.columns if c not in key]
    one = a.select(*key, F.struct(F.lit(True).alias("there"), *values).alias("a"))
    two = b.select(*(F.col(c).alias(f"k_{c}") for c in key), F.struct(F.lit(True).alias("there"), *values).alias("b"))
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"k_{c}"))
    met = one.join(two, same, "full")
    parts = [F.when(F.col("a").isNull() | F.col("b").isNull(), F.lit("row"))]
    parts += [F.when(F.col("a").isNotNull() & F.col("b").isNotNull() & ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in values]
    out = met.select(*(F.coalesce(c, f"k_{c}").alias(c) for c in key), F.array_sort(F.array_compact(F.array(*parts))).alias("leaked"))
    return out.filter(F.size("leaked") > 0)
