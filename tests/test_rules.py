"""The rule catalogue: each rule is broken by hand in one place and named alone; sound models stay clean."""

import duckdb
import pytest

from meshquilt.operators import rules as R
from meshquilt.plans import queries_rules as QR

NAN, INF = float("nan"), float("inf")
KINDS = {
    "vertex": "model_id long, role string, vid long, x double, y double, z double",
    "face": "model_id long, role string, fid long, i0 long, i1 long, i2 long, n_vertices long, area double",
    "mesh": "model_id long, role string, n_vertices long, n_faces long, n_used long",
    "target": "model_id long, vid long, tx double, ty double, tz double, surface_distance double, closest_face long, w0 double, w1 double, w2 double, valid_mask int, dx double, dy double, dz double, px double, py double, pz double, ex double, ey double, ez double, n_gt_faces long, has_vertex boolean, has_target boolean, has_delta boolean",
    "laplacian": "model_id long, l_row long, l_col long, value double, expected double, n_expanded long",
    "view": "model_id long, view_id int, name string, cx double, cy double, cz double, fx double, fy double, fz double, n_mask long, n_border long, n_lit long, n_bad_depth long, has_depth boolean, expected_views int, half_extent double, e_name string, ex double, ey double, ez double, gx double, gy double, gz double",
    "file": "model_id long, file string, error string",
    "sample": "model_id long, sample_id string, storage_format string, embeds_images boolean, n_paths int, n_images int, n_channels int, fields array<string>",
}
BASE = {
    "vertex": [{"role": "gt", "vid": 0, "x": 1.0, "y": 0.0, "z": 0.0}, {"role": "gt", "vid": 1, "x": 0.0, "y": 0.5, "z": 0.0}, {"role": "coarse", "vid": 0, "x": 3.0, "y": 0.0, "z": 0.0}],
    "face": [{"role": "gt", "fid": 0, "i0": 0, "i1": 1, "i2": 2, "n_vertices": 3, "area": 0.5}],
    "mesh": [{"role": "gt", "n_vertices": 3, "n_faces": 1, "n_used": 3}],
    "target": [{"vid": v, **{f"{a}{k}": 0.25 for a in "tdpe" for k in "xyz"}, "surface_distance": 0.1, "closest_face": 0, "w0": 0.5, "w1": 0.5, "w2": 0.0, "valid_mask": 1, "n_gt_faces": 1, "has_vertex": True, "has_target": True, "has_delta": True} for v in range(2)],
    "laplacian": [{"l_row": 0, "l_col": 0, "value": 1.0, "expected": 1.0, "n_expanded": 2}, {"l_row": 0, "l_col": 1, "value": -1.0, "expected": -1.0, "n_expanded": 2}],
    "view": [{"view_id": i, "name": f"v{i}", "e_name": f"v{i}", **{f"{a}{k}": 0.5 for a in "cefg" for k in "xyz"}, "n_mask": 4, "n_border": 0, "n_lit": 4, "n_bad_depth": 0, "has_depth": True, "expected_views": 2, "half_extent": 1.5} for i in range(2)],
    "file": [{"file": f, "error": None} for f in QR.FILES],
    "sample": [{"sample_id": "sample_{m}", "storage_format": "lazy_image_paths_v1", "embeds_images": False, "n_paths": 14, "n_images": 14, "n_channels": 3, "fields": [*R.FIELDS, "more"]}],
}
#: rules that one change breaks: (grain, row, changes); None in place of the row: all rows go.
CHANGES = [
    ({"invalid_vertex_shape"}, "vertex", 1, {"z": None}),
    ({"non_finite_vertices"}, "vertex", 2, {"y": -INF}),
    ({"non_finite_vertices", "normalized_gt_out_of_expected_range", "normalized_gt_outside_unit_sphere"}, "vertex", 1, {"y": NAN}),  # no number is above all
    ({"normalized_gt_out_of_expected_range", "normalized_gt_outside_unit_sphere"}, "vertex", 0, {"x": -1.02}),
    ({"normalized_gt_outside_unit_sphere"}, "vertex", 0, {"x": 1.00001}),
    ({"normalized_gt_does_not_reach_unit_sphere"}, "vertex", 0, {"x": 0.999}),
    ({"invalid_face_shape"}, "face", 0, {"i2": None}),
    ({"invalid_face_indices"}, "face", 0, {"i0": -1}),
    ({"invalid_face_indices"}, "face", 0, {"i1": 3}),
    ({"repeated_indices_in_face"}, "face", 0, {"i1": 2}),
    ({"non_positive_triangle_area"}, "face", 0, {"area": 0.0}),
    ({"unreferenced_vertices"}, "mesh", 0, {"n_used": 2}),
    ({"empty_vertices_or_faces"}, "mesh", None, {}),
    ({"target_positions_shape_mismatch", "laplacian_target_shape_mismatch"}, "target", 1, {"has_vertex": False}),
    ({"target_positions_shape_mismatch"}, "target", 1, {"has_target": False}),
    ({"laplacian_target_shape_mismatch"}, "target", 1, {"has_delta": False}),
    ({"non_finite_projection_distance", "valid_mask_semantics_mismatch"}, "target", 1, {"surface_distance": INF}),
    ({"non_finite_target_positions", "valid_mask_semantics_mismatch"}, "target", 1, {"ty": NAN}),
    ({"invalid_closest_face_indices", "valid_mask_semantics_mismatch"}, "target", 1, {"closest_face": 1}),
    ({"invalid_closest_face_indices", "valid_mask_semantics_mismatch"}, "target", 1, {"closest_face": -1}),
    ({"barycentric_sum_mismatch"}, "target", 1, {"w0": 0.50002}),
    ({"non_finite_barycentric_coordinates", "valid_mask_semantics_mismatch", "barycentric_sum_mismatch"}, "target", 1, {"w2": INF}),
    ({"valid_mask_shape_mismatch"}, "target", 1, {"valid_mask": None}),
    ({"invalid_valid_mask", "valid_mask_semantics_mismatch"}, "target", 1, {"valid_mask": 2}),
    ({"valid_mask_semantics_mismatch"}, "target", 1, {"valid_mask": 0}),
    ({"laplacian_target_contract_mismatch"}, "target", 1, {"ez": 0.2500003}),
    ({"prepared_raw_target_mismatch"}, "target", 1, {"pz": 0.2500003}),
    ({"laplacian_shape_mismatch"}, "laplacian", 1, {"l_col": 2}),
    ({"non_finite_laplacian", "laplacian_contract_mismatch"}, "laplacian", 1, {"value": NAN}),
    ({"laplacian_contract_mismatch"}, "laplacian", 1, {"value": -1.00000000001}),
    ({"laplacian_contract_mismatch"}, "laplacian", 1, {"value": None}),
    ({"laplacian_contract_mismatch"}, "laplacian", 1, {"expected": None}),
    ({"unexpected_view_count", "unexpected_depth_path_count"}, "view", None, {}),
    ({"unexpected_depth_path_count"}, "view", 1, {"has_depth": False}),
    ({"cube_camera_centers_mismatch"}, "view", 1, {"cy": 0.50000002}),
    ({"cube_camera_order_mismatch"}, "view", 1, {"name": None}),
    ({"cube_camera_orientation_mismatch"}, "view", 1, {"fz": -0.5}),
    ({"empty_mask:view_1"}, "view", 1, {"n_mask": 0, "n_lit": 0, "n_border": 2}),
    ({"mask_touches_image_border:view_1"}, "view", 1, {"n_border": 1}),
    ({"black_foreground:view_0"}, "view", 0, {"n_lit": 0}),
    ({"invalid_foreground_depth:view_1"}, "view", 1, {"n_bad_depth": 1}),
    ({"missing_views_dataset_json"}, "file", 3, {"file": "other"}),
    ({"missing_cameras_json"}, "file", 4, {"file": "other"}),
    ({"missing_view_mesh_obj"}, "file", 5, {"file": "other"}),
    ({"load_mesh_failed:coarse_mesh.obj:empty"}, "file", 1, {"error": "empty"}),
    ({"missing_views_dataset_json", "missing_cameras_json", "missing_view_mesh_obj"}, "file", None, {}),
    ({"raw_prepared_sample_embeds_images"}, "sample", 0, {"embeds_images": True}),
    ({"unexpected_prepared_storage_format"}, "sample", 0, {"storage_format": None}),
    ({"unexpected_lazy_image_path_count"}, "sample", 0, {"n_paths": 15}),
    ({"lazy_loaded_image_shape_mismatch"}, "sample", 0, {"n_channels": None}),
    ({"prepared_sample_missing_extended_fields"}, "sample", 0, {"fields": None}),
    ({"prepared_sample_missing_extended_fields"}, "sample", 0, {"fields": [*R.FIELDS[1:]]}),
    ({"prepared_sample_id_mismatch"}, "sample", 0, {"sample_id": "sample_99999"}),
]


def test_every_rule_is_broken_by_hand_and_named_alone(spark):
    rows = {g: [] for g in KINDS}
    for m in range(len(CHANGES) + 1):
        _, grain, at, change = CHANGES[m] if m < len(CHANGES) else (None, None, None, {})
        for g, base in BASE.items():
            for i, row in enumerate(base):
                if g == grain and at is None:
                    continue
                new = {"model_id": m, **row, **(change if g == grain and i == at else {})}
                if g == "sample" and new["sample_id"]:
                    new["sample_id"] = new["sample_id"].replace("{m}", str(m))
                rows[g].append(new)
    grains = {g: spark.createDataFrame([tuple(r[c.split()[0]] for c in kind.split(", ")) for r in rows[g]], kind) for g, kind in KINDS.items()}
    models = spark.range(len(CHANGES) + 1).withColumnRenamed("id", "model_id")
    got = {r["model_id"]: set(r["issues"]) for r in R.broken(grains, models).collect()}
    for m, (want, *_) in enumerate(CHANGES):
        assert got[m] == want, CHANGES[m]
    assert got[len(CHANGES)] == set()
    named = {n.split(":")[0] for want, *_ in CHANGES for n in want}
    assert named == {r.name for r in R.RULES} and len(R.RULES) >= 40
    status = {r["model_id"]: (r["status"], r["issues"]) for r in R.summary(R.broken(grains, models)).collect()}
    assert status[len(CHANGES)] == ("valid", "") and status[0] == ("invalid", "invalid_vertex_shape")


def test_each_grain_is_aggregated_once(spark):
    grains = {g: spark.createDataFrame([], kind) for g, kind in KINDS.items()}
    models = spark.range(3).withColumnRenamed("id", "model_id")
    out = R.broken(grains, models)
    assert {tuple(r["issues"]) for r in out.collect()} == {tuple(sorted(r.name for r in R.RULES if r.absent))}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") <= len(KINDS) + 2  # one a grain, and the list of models


def test_damage_reaches_most_rules(spark):
    """In the registered query's dataset at the scale of the comparison every kind of damage is found, and only sound models are clean."""
    con = duckdb.connect()
    con.execute("CREATE VIEW orders AS SELECT * FROM read_parquet('/root/testdata/sf0.01/orders.parquet')")
    from meshquilt.plans.queries import ORACLES

    rows = con.execute(ORACLES["dataset_validation"]).fetchall()
    assert [m for m, status, _ in rows if status == "valid"] == [0]
    found = {n.split(":")[0] for _, _, issues in rows for n in issues.split("|") if n}
    assert {r.name for r in R.RULES} - found <= {"laplacian_shape_mismatch"} or found == {r.name for r in R.RULES}


@pytest.mark.parametrize("kind", ["any", "having"])
def test_a_rule_can_be_added(spark, kind):
    more = (R.Rule("too_light", "vertex", **{kind: "z < -5" if kind == "any" else "min(z) < -5"}),)
    v = spark.createDataFrame([(1, "gt", 0, 0.0, 0.0, -6.0), (2, "gt", 0, 0.0, 0.0, -4.0)], KINDS["vertex"])
    got = {r["model_id"]: list(r["issues"]) for r in R.broken({"vertex": v}, v.select("model_id"), more).collect()}
    assert got == {1: ["too_light"], 2: []}
