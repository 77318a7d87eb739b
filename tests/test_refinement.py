"""Refinement rules, differential leakage, families of manifests, failures that are reported."""

import numpy as np
from pyspark.sql import functions as F

from meshquilt.operators import correspond as C
from meshquilt.operators import families as FA
from meshquilt.operators import geometry as G
from meshquilt.operators import refinement as RF
from meshquilt.operators import rules as R
from meshquilt.operators import samples as SA
from meshquilt.operators import subdivide as D
from meshquilt.operators import topology as T
from meshquilt.operators import views as VW
from test_mesh import cube, mesh, sphere


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---- leakage --------------------------------------------------------------------------------------------------


def test_a_query_from_the_raw_mesh_is_clean_and_one_from_the_registered_mesh_is_not(spark):
    v, f = sphere(1)
    raw, faces = mesh(spark, v, f)
    registered, _ = mesh(spark, v * 1.01, f)

    def honest(t):
        return D.uniform(t["raw"], faces)[0].join(G.edge_scale(t["raw"], T.unique_edges(faces)).select("model_id", "vid", "h"), ["model_id", "vid"], "left")

    def leaking(t):
        made, other = D.uniform(t["raw"], faces)[0], D.uniform(t["registered"], faces)[0]
        return made.join(other.select("model_id", "vid", F.col("x").alias("ox")), ["model_id", "vid"]).withColumn("x", F.when(F.col("vid") == 50, F.col("ox")).otherwise(F.col("x"))).drop("ox")

    tables, held = {"raw": raw, "registered": registered}, {"registered": ["x", "y", "z"]}
    assert RF.leaks(honest, tables, held, "model_id", "vid").isEmpty()
    assert rows(RF.leaks(leaking, tables, held, "model_id", "vid")) == [(1, 50, ["x"])]
    dropping = lambda t: honest(t).join(t["registered"].filter("x > 0").select("model_id", "vid"), ["model_id", "vid"], "left_semi")  # noqa: E731  through the rows
    assert {tuple(r["leaked"]) for r in RF.leaks(dropping, tables, held, "model_id", "vid").collect()} == {("row",)}


def test_held_back_values_change_in_every_type(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 2L, 1.5D, float(2.5), 'a', true, array(1, 2), date'2020-01-01', timestamp'2020-01-01 00:00:00', 1.25BD), "
        "(null, null, null, null, null, null, null, null, null, null), (0, -1L, double('NaN'), float('NaN'), '', false, array(), date'1999-12-31', timestamp'1999-12-31 00:00:00', 0BD) AS t(i, l, d, f, s, b, a, dt, ts, n)"
    )
    for before, after in zip(df.collect(), RF.changed(df, df.columns).collect(), strict=True):
        for c in df.columns:
            if c != "a" or before[c]:
                assert str(before[c]) != str(after[c]), c


def test_refinement_rules_by_hand(spark):
    v, f = cube()
    raw, faces = mesh(spark, v, f)
    moved, _ = mesh(spark, v * 1.1, f)
    made, made_faces, kids = D.uniform(raw, faces)
    parents = raw.select("model_id", "vid", F.col("vid").alias("p0"), F.col("vid").alias("p1")).unionByName(kids.withColumnRenamed("child_vid", "vid"))
    leaked = D.uniform(moved, faces)[0]
    models = raw.select("model_id").distinct()
    names = lambda grains: set(R.broken(grains, models, tuple(r for r in RF.REFINEMENT_RULES if r.grain in grains)).first()["issues"])
    assert names({"query": RF.query_grain(made, parents, raw, moved), "queryface": RF.face_grain(made_faces, made_faces)}) == set()
    assert names({"query": RF.query_grain(leaked, parents, raw, moved)}) == {"raw_query_vertices_not_reconstructed_from_coarse_raw", "gt_registered_coarse_leaked_into_query"}
    assert names({"query": RF.query_grain(made, parents, raw, raw)}) == set()  # nothing was moved: nothing can leak
    assert names({"queryface": RF.face_grain(made_faces.filter("fid <> 3"), made_faces)}) == {"raw_query_faces_not_reconstructed_from_coarse_raw"}
    assert len(RF.REFINEMENT_RULES) >= 30
    assert "metadata_not_valid" in names({"metadata": RF.metadata_grain(spark.createDataFrame([(1, "no json")], "model_id long, metadata string"))})


# ---- families -------------------------------------------------------------------------------------------------


def test_nested_cameras_are_prefixes(spark):
    every = VW.nested_cameras(spark, pool=512).select("view_id", "name", "k", "r", "t")
    arms = spark.createDataFrame([("a14", 14), ("a28", 28), ("a56", 56)], "arm string, n int")
    views = arms.join(every, F.col("view_id") < F.col("n")).select("arm", F.lit(1).cast("bigint").alias("sample_id"), F.lit("train").alias("split"), "view_id", "name", "k", "r", "t")
    sizes = {"a14": 14, "a28": 28, "a56": 56}
    assert FA.nested(views, sizes).isEmpty()
    turned = views.withColumn("name", F.when((F.col("arm") == "a28") & (F.col("view_id") == 20), "x").otherwise(F.col("name")))
    assert rows(FA.nested(turned, sizes)) == [("a28", 1, "not_a_prefix")]
    assert rows(FA.nested(views.filter("arm <> 'a56' OR view_id <> 55"), sizes)) == [("a56", 1, "unexpected_view_count")]
    twice = views.unionByName(views.filter("arm = 'a14' AND view_id = 0"))
    assert ("a14", 1, "views_not_numbered") in rows(FA.nested(twice, sizes))


def test_an_arm_changes_only_the_observations(spark):
    m = "map('query_graph_variant', 'gt_adaptive', 'adaptive_reference', 'sub2')"
    graph = spark.sql(f"SELECT 1L AS sample_id, array(1.0D, 2.0D) AS vertices, array(3) AS laplacian_target, array('old') AS image_paths, true AS occlusion, {m} AS metadata")
    seen = spark.sql("SELECT 1L AS sample_id, array('a', 'b') AS image_paths, map('nested_view_count', '28') AS metadata")
    arm = SA.merge_observations(graph.drop("metadata"), seen, ["image_paths"])
    assert "occlusion" not in arm.columns
    good = arm.withColumn("metadata", F.expr(f"map_concat({m}, map('nested_view_count', '28', 'combination_arm', 'mix'))"))
    assert FA.combined(graph, seen, good, ["image_paths"], "mix").isEmpty()
    bad = good.withColumns({"vertices": F.array(F.lit(9.0)), "image_paths": F.array(F.lit("old")), "occlusion": F.lit(True), "metadata": F.expr(m)})
    want = ["combination_arm_missing", "graph_field_changed:vertices", "metadata_not_merged", "observation_field_differs:image_paths", "stale_visibility:occlusion"]
    assert [r[2] for r in rows(FA.combined(graph, seen, bad, ["image_paths"], "mix"))] == want
    assert rows(FA.combined(graph, seen, good.withColumn("sample_id", F.lit(2).cast("bigint")), ["image_paths"], "mix"))[0][2] in ("missing_in_arm", "only_in_arm", "observation_field_differs:image_paths")
    lost = good.drop("laplacian_target")
    assert [r[2] for r in rows(FA.combined(graph, seen, lost, ["image_paths"], "mix"))] == ["graph_field_changed:laplacian_target"]


def test_roles_and_artefacts(spark):
    d = spark.createDataFrame([("t", False, True, "gt_query_training"), ("i", True, False, "expanded_raw_frozen_model_inference"), ("x", True, True, "gt_query_training"), ("n", None, None, None)], "arm string, expanded boolean, training_eligible boolean, dataset_role string")
    assert {(r[0], r[2]) for r in rows(FA.roles(d))} == {("x", "training_eligibility_wrong"), ("x", "dataset_role_wrong"), ("n", "training_eligibility_wrong"), ("n", "dataset_role_wrong")}
    s = spark.createDataFrame([("a", 1, 3, 14, 14, 3), ("a", 2, 3, 14, 14, 3), ("a", 3, 3, 13, 14, 4)], "arm string, sample_id long, n_vertices int, n_paths int, v_rows int, v_columns int")
    have = spark.createDataFrame([("a", 1, 14, 3), ("a", 3, 14, 3)], "arm string, sample_id long, a_rows int, a_columns int")
    assert rows(FA.artefacts(s, have, 14)) == [("a", 2, "visibility_artefact_missing"), ("a", 3, "sample_visibility_shape"), ("a", 3, "unexpected_path_count")]


# ---- failures -------------------------------------------------------------------------------------------------


def test_a_model_that_fails_is_an_issue_and_the_others_go_on(spark):
    v, f = cube()
    dv, df = mesh(spark, v * 0.3, f, 1)
    bad_v, bad_f = mesh(spark, v * 0.3, np.concatenate((f, [[0, 1, 77]])), 2)
    gap_v = mesh(spark, v * 0.3, f, 3)[0].filter("vid <> 4")
    vs, fs = dv.unionByName(bad_v).unionByName(gap_v), df.unionByName(bad_f).unionByName(mesh(spark, v, f, 3)[1])
    audit = VW.raster_audit(VW.rasters(vs, fs, VW.cube_cameras(spark, 3.0, 64))).collect()
    assert sum(r["model_id"] == 1 for r in audit) == 14 and all(not r["issues"] for r in audit if r["model_id"] == 1)
    failed = {r["model_id"]: r["issues"] for r in audit if r["view_id"] is None}
    assert set(failed) == {2, 3} and failed[2][0].startswith("raster_failed:IndexError") and "77" in failed[2][0]
    res = C.simplified(vs, fs, 6)
    assert {r["model_id"] for r in C.failures(res).collect()} == {2, 3} and C.unpacked(res)[0].select("model_id").distinct().collect()[0][0] == 1
