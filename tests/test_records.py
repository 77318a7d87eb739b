"""Selection, views, samples, photogrammetry, files, registry, streaming."""

import functools
import hashlib
import io
import math
import random
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from meshquilt.operators import photogram as P
from meshquilt.operators import samples as SA
from meshquilt.operators import selection as S
from meshquilt.operators import validate as VA
from meshquilt.operators import views as VW
from meshquilt.plans import queries as Q
from meshquilt.plans import queries_more as QM
from meshquilt.plans import registry as R
from meshquilt.sources import files as FS
from meshquilt.sources.corpus import mesh_arrays
from meshquilt.streaming.ingest import ingest
from test_mesh import cube, mesh, sphere


def test_sofa_predicate(spark):
    rows = [("Sofa", "x"), (None, "a Couch"), ("", "sofastool sofa"), ("Bed", "sofa")]
    d = spark.createDataFrame(rows, "s string, t string")
    assert [r[0] for r in d.select(S.is_sofa(F.col("s"), F.col("t"))).collect()] == [True, True, False, False]


def test_balanced_and_simple_split(spark):
    d = spark.createDataFrame([(f"{c}-{i}", f"cat{c}") for c in range(8) for i in range(250)], "id string, category string")
    out = S.balanced_split(d, "category", 3)
    assert {r["split"]: r["count"] for r in out.groupBy("split").count().collect()} == {"train": 1600, "validation": 200, "test": 200}
    assert {r["count"] for r in out.filter("split = 'test'").groupBy("category").count().collect()} == {25}
    assert sorted(out.collect()) == sorted(S.balanced_split(d.repartition(5), "category", 3).collect())
    fixed = S.simple_split(d.limit(50), 1, counts=(40, 5, 5))
    assert {r["split"]: r["count"] for r in fixed.groupBy("split").count().collect()} == {"train": 40, "validation": 5, "test": 5}
    assert S.overlap(out).count() == 0


def test_strata_first_match_and_inclusive(spark):
    d = spark.createDataFrame([(1999,), (2000,), (20000,), (20001,), (10**6,)], "n long")
    s = S.stratum(F.col("n"), [("low", 2000, 20000), ("middle", 20000, 60000)])
    assert [r[0] for r in d.select(s).collect()] == ["out_of_range", "low", "low", "middle", "out_of_range"]


def test_stratified_sample_spreads_things(spark):
    rows = [(i, i % 7 if i % 2 else -1, "a" if i < 40 else "b", i) for i in range(80)]
    c = spark.createDataFrame(rows, "file_id long, thing_id long, stratum string, scan_index long")
    got = S.stratified_sample(c, {"a": 10, "b": 12}, 5).collect()
    assert sum(r["stratum"] == "a" for r in got) == 10 and len({r["file_id"] for r in got}) == 22
    assert S.shortages(c, spark.createDataFrame([("a", 50), ("b", 1)], "stratum string, quota long"), "stratum").count() == 1


def test_group_split_holds_groups_apart(spark):
    rows = [(i, i if i > 60 else i % 10 + 1) for i in range(1, 101)]
    c = spark.createDataFrame(rows, "file_id long, thing_id long")
    out = S.group_split(c, {"validation": 5, "test": 5}, 1).join(c, "file_id")
    assert S.leakage(out).count() == 0 and out.count() == 100
    assert VA.split_rules(out.withColumnRenamed("file_id", "id"), {"train": 90, "validation": 5, "test": 5}).count() == 0
    bad = VA.split_rules(out.withColumnRenamed("file_id", "id").union(out.limit(1).select("file_id", F.lit("test"), "thing_id")), {"train": 90, "validation": 5, "test": 5})
    assert bad.count() >= 1


def test_ranked_selection_skips_near_duplicates(spark):
    rows = [(i, f"h{i // 2}", 1.0 + i, 1.0, [float(i)], 1000) for i in range(10)]
    c = spark.createDataFrame(rows, "id long, hash string, wd double, wh double, descriptor array<double>, n_faces long")
    pairs = S.near_duplicates(c)
    assert sorted(map(tuple, pairs.collect())) == [(i, i + 1) for i in range(0, 10, 2)]
    got = S.ranked_selection(c.withColumn("score", F.col("id") * -1.0), pairs, 3).orderBy("rank").collect()
    assert [r["id"] for r in got] == [0, 2, 4]


def test_ranked_selection_takes_one_of_a_hash_whose_head_ranks_last(spark):
    rows = [(i, "same" if i < 3 else f"h{i}", float(i), 10.0 * i, [10.0 * i], 1000) for i in range(5)]
    c = spark.createDataFrame(rows, "id long, hash string, wd double, wh double, descriptor array<double>, n_faces long")
    got = S.ranked_selection(c.withColumn("score", F.col("id") * 1.0), S.near_duplicates(c), 4).orderBy("rank").collect()
    assert [r["id"] for r in got] == [4, 3, 2]


def test_stratified_sample_fills_up_with_used_things(spark):
    c = spark.createDataFrame([(i, 1, "a") for i in range(6)] + [(9, None, "b")], "file_id long, thing_id long, stratum string")
    got = S.stratified_sample(c, {"a": 3, "b": 1}, 5).collect()
    assert len({r["file_id"] for r in got}) == 4
    with pytest.raises(ValueError, match="stratum b"):
        S.stratified_sample(c, {"b": 2}, 5)


def test_ranked_selection_walks_past_full_batches(spark):
    c = spark.createDataFrame([(i, float(-i)) for i in range(100)], "id long, score double")
    pairs = spark.createDataFrame([(0, i) for i in range(1, 40)] + [(40, i) for i in range(41, 80)], "a_id long, b_id long")
    got = S.ranked_selection(c, pairs, 4).orderBy("rank").collect()
    assert [(r["id"], r["rank"]) for r in got] == [(0, 1), (40, 2), (80, 3), (81, 4)]
    assert [r["id"] for r in S.ranked_selection(c, pairs, 90, c.filter("id = 0")).orderBy("rank").collect()] == [*range(1, 41), *range(80, 100)]


def test_ranked_distinct_selection_reads_all_of_part(spark, tmp_path):
    part = spark.range(1, 2201).select(F.col("id").alias("p_partkey"), F.lit("SOFA").alias("p_type"), (F.lit(900.0) + F.col("id") / 7).alias("p_retailprice"), (F.col("id") % 50 + 1).cast("int").alias("p_size"))
    part.write.parquet(f"{tmp_path}/part.parquet")
    c = Q._candidates(spark, tmp_path)
    score, _ = S.candidate_score(F.col("text"), F.col("wd"), F.col("wh"), F.col("n_faces") * 10, F.col("id") % 100)
    near: dict = {}
    for a, b in S.near_duplicates(c).collect():
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want: list = []
    for i, _ in sorted(c.select("id", score).collect(), key=lambda r: (-r[1], r[0])):
        if len(want) < 50 and not near.get(i, set()).intersection(want):
            want.append(i)
    got = [r["id"] for r in Q.ranked_distinct_selection(spark, tmp_path).orderBy("rank").collect()]
    assert got == want and max(got) > 2000


def test_replacements_chain(spark):
    c = spark.createDataFrame([(i, i, "s", i) for i in range(10)], "file_id long, thing_id long, stratum string, scan_index long")
    out = S.replace_until_done(c.filter("file_id IN (0, 1)"), c, lambda d: d.filter("file_id NOT IN (1, 2, 3)"))
    assert {r["file_id"] for r in out.collect()} == {0, 4}


def test_variant_seed_and_orders(spark):
    d = spark.createDataFrame([("abc", 2)], "o string, v int")
    want = int.from_bytes(hashlib.sha256(b"abc:7:2").digest()[:8], "little") % (2**63 - 1)
    assert d.select(S.variant_seed(F.col("o"), 7, F.col("v"))).first()[0] == want
    ids = list(range(20))
    random.Random(3).shuffle(ids)
    assert S.mersenne_order(list(range(20)), 3) == ids


def test_depth_visibility_fixture(spark):
    p = spark.createDataFrame([(1, 0, i, *q, 4, 4) for i, q in enumerate([(1.0, 1.0, 2.0), (2.0, 2.0, 5.0), (3.0, 3.0, 2.0), (-1.0, 0.0, 1.0)])], "model_id long, view_id int, vid long, px double, py double, depth double, width int, height int")
    at = {(1, 1): 2.0, (2, 2): 1.0, (3, 3): 2.0}
    r = spark.createDataFrame([(1, 0, y, x, (x, y) in at, at.get((x, y), math.inf)) for x in range(4) for y in range(4)], "model_id long, view_id int, py int, px int, mask boolean, depth double")
    got = VW.depth_visibility(p, r, 0.01).orderBy("vid").collect()
    assert [x["visible"] for x in got] == [True, False, True, False]
    assert [x["mask_support"] for x in VW.mask_support(p, r).orderBy("vid").collect()] == [True, True, True, False]


def test_cameras(spark):
    c = VW.centres(VW.cube_cameras(spark)).orderBy("view_id").collect()
    assert [r["name"] for r in c] == [v[0] for v in VW.CUBE_VIEWS]
    for r, (_, *d) in zip(c, VW.CUBE_VIEWS, strict=True):
        assert np.allclose((r["cx"], r["cy"], r["cz"]), np.array(d) * 1.5, atol=1e-8)
        assert np.allclose(r["r"][6:9], -np.array(d) / np.linalg.norm(d), atol=1e-8)
        assert np.linalg.det(np.array(r["r"]).reshape(3, 3)) == pytest.approx(1)
    n = VW.centres(VW.nested_cameras(spark, pool=2048)).orderBy("view_id").collect()
    assert len(n) == 56 and [r["name"] for r in n[:14]] == [r["name"] for r in c]
    for i in range(14, 56, 2):
        assert np.allclose([n[i][k] + n[i + 1][k] for k in ("cx", "cy", "cz")], 0, atol=1e-9)
    assert len({tuple(np.round([r["cx"], r["cy"], r["cz"]], 6)) for r in n}) == 56
    models = VW.cube_cameras(spark).withColumn("model_id", F.lit(1).cast("long"))
    assert VA.camera_rules(models, VW.cube_cameras(spark)).count() == 0
    assert VA.camera_rules(models.filter("view_id > 0"), VW.cube_cameras(spark)).count() == 1
    k = VW.scaled(spark.createDataFrame([([1000.0, 0.0, 960.0, 0.0, 800.0, 540.0, 0.0, 0.0, 1.0], 1920, 1080)], "k array<double>, width int, height int"), 960, 540).first()["k"]
    assert k == [500, 0, 480, 0, 400, 270, 0, 0, 1]


def test_rasters_and_renderer_visibility(spark):
    pts, faces = sphere(1)
    v, f = mesh(spark, pts * 0.8, faces)
    cams = VW.cube_cameras(spark, 3.0, 48).filter("view_id < 2")
    r = VW.rasters(v, f, cams)
    assert r.count() == 2 * 48 * 48 and VW.raster_audit(r).filter(F.size("issues") > 0).count() == 0
    vis = VW.renderer_visibility(VW.projected(v, cams), f, r, VW.rasters(v, f, cams, cull=True))
    front = {x["vid"] for x in vis.filter("view_id = 0 AND combined").collect()}
    assert front and all(pts[i][0] > -0.2 for i in front)
    stats = VW.visibility_stats(vis, "combined").first()
    assert 0 < stats["mean_views"] <= 2
    half = VW.resized_nearest(r, 24, 24)
    assert half.count() == 2 * 24 * 24


def test_an_audit_in_the_drawing_task_equals_that_of_the_pixels(spark, sf, monkeypatch):
    meshes = [mesh(spark, pts, faces, i) for i, (pts, faces) in enumerate(((sphere(1)[0] * 0.8, sphere(1)[1]), (sphere(1)[0] * 2.5, sphere(1)[1]), (cube()[0], [[0, 1, 99]]), (cube()[0], [[0, 0, 1]])))]
    v, f = (functools.reduce(lambda a, b: a.union(b), side) for side in zip(*meshes, strict=True))
    cams = VW.cube_cameras(spark, 3.0, 24).filter("view_id in (0, 7)")
    want = sorted((r["model_id"], r["view_id"] or -1, r["issues"]) for r in VW.raster_audit(VW.rasters(v, f, cams)).collect())
    assert sorted((r["model_id"], r["view_id"] or -1, r["issues"]) for r in VW.rendered_audit(v, f, cams).collect()) == want
    assert {i.split(":")[0] for r in want for i in r[2]} == {"empty_mask", "mask_touches_image_border", "raster_failed"} and len(want) == 7
    mask, depth = np.array([[0, 0, 0], [0, 1, 1], [0, 1, 0]], bool), np.array([[np.inf, 2.0, np.inf], [np.inf, np.nan, -1.0], [np.inf, 3.0, np.inf]])
    assert VW.pixel_facts(mask, depth) == (3, 2, 2, 1)
    pixels = spark.createDataFrame([(1, 0, y, x, bool(mask[y, x]), float(depth[y, x])) for y in range(3) for x in range(3)], "model_id long, view_id int, py int, px int, mask boolean, depth double")
    assert VW.raster_audit(pixels).first()["issues"] == ["mask_touches_image_border:view_0", "invalid_foreground_depth:view_0", "finite_background_depth:view_0"]
    assert VW.pixel_facts(np.zeros((1, 4), bool), np.full((1, 4), np.inf)) == (0, 0, 0, 0) and VW.pixel_facts(np.ones((1, 4), bool), np.ones((1, 4)))[1] == 4
    monkeypatch.setattr(VW, "rasters", None)  # the query makes no row for a pixel
    assert QM.raster_issues(spark, sf).count() == 70


def test_raster_queries_take_every_model(spark, sf):
    audit = QM.raster_issues(spark, sf).select("model_id", "view_id").collect()
    seen = QM.renderer_visibility(spark, sf).select("model_id", "view_id").collect()
    assert sorted(map(tuple, audit)) == sorted(map(tuple, seen)) == [(m, v) for m in range(5) for v in range(14)]


def test_synthetic_samples_round_trip(spark):
    v, f = mesh(spark, *sphere(1))
    s = SA.synthetic_sample(v, f, 3)
    c = SA.oracle_check(s, f).first()
    assert c["target_ok"] and c["round_trip_ok"]
    seeds = SA.variants_of(spark.createDataFrame([("a",), ("b",)], "object_id string"), 5, 1)
    assert seeds.select("seed").distinct().count() == 10
    roll = SA.oracle_rollup(SA.oracle_check(s, f), ["target_ok", "round_trip_ok"], ["target_error"]).first()
    assert roll["all_target_ok"] and roll["n"] == 1


def test_packed_samples_merge_and_audit(spark):
    v, f = mesh(spark, *cube())
    paths = spark.createDataFrame([(1, i, f"/data/v{i}.png") for i in range(14)], "model_id long, view_id int, path string")
    split = spark.createDataFrame([(1, "train")], "model_id long, split string")
    s = SA.packed_samples(v, f, paths, split)
    assert VA.loader_audit(s, 14).count() == 0 and VA.loader_audit(s, 28).count() == 1
    rel = s.select(SA.relative_paths(F.col("image_paths"), "/data").alias("p")).select(SA.absolute_paths(F.col("p"), "/data").alias("p")).first()["p"]
    assert rel == [f"/data/v{i}.png" for i in range(14)]
    g = spark.createDataFrame([(1, "train", 5, "old", True)], "sample_id long, split string, faces int, image_paths string, combined boolean")
    o = spark.createDataFrame([(1, "new", True)], "sample_id long, image_paths string, combined boolean")
    m = SA.merge_observations(g, o, ["image_paths", "combined"])
    assert m.columns == ["sample_id", "split", "faces", "image_paths"] and m.first()["image_paths"] == "new"
    assert SA.changed(g, m).count() == 0 and SA.changed(g, m.withColumn("faces", F.lit(6))).first()["columns"] == ["faces"]
    with pytest.raises(ValueError):
        SA.require(g, o.filter("false"), "sample_id")
    assert SA.manifest(s).first()["path"] == "samples/1.parquet" and VA.forbidden_columns(s, ["gt", "points"]) == ["points"]


def test_validation_summary_and_raise(spark):
    v, f = mesh(spark, *cube())
    bad = f.withColumn("i1", F.when(F.col("fid") == 0, F.col("i0")).otherwise(F.col("i1")))
    issues = VA.geometry_rules(v, bad)
    assert {r["rule"] for r in issues.collect()} == {"repeated_indices_in_face", "non_positive_triangle_area"}
    assert VA.summary(issues, v.select("model_id")).first()["issues"] == "non_positive_triangle_area|repeated_indices_in_face"
    with pytest.raises(ValueError):
        VA.raise_if_any(issues)
    VA.raise_if_any(VA.geometry_rules(v, f))
    assert VA.round_trip_repair(v, v).count() == 0 and VA.round_trip_repair(v, v.filter("vid > 0")).count() == 1


def test_photogram_text(spark, tmp_path):
    lines = ["# comment", "", "1 PINHOLE 1920 1080 1000 1000 960 540", "1 0 0 0 1 2 3 0.5 7 1 8 2 9 3", "2 0 0 0 1 2 3 bad 1 1", "3 0 0 0 1 2 3 nan 1 1 2 2 3 3 4 4"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    q = P.point_quality(df.filter("value NOT LIKE '%PINHOLE%'")).first()
    assert q["num_points"] == 2 and q["reprojection_error_max"] == 0.5 and q["track_length_3"] == 1 and q["track_length_ge4"] == 1
    cam = P.cameras_text(df.filter("value LIKE '%PINHOLE%'")).first()
    assert (cam["width"], cam["params"]) == (1920, [1000, 1000, 960, 540])
    poses = spark.createDataFrame([("1 1 0 0 0 0.1 0.2 0.3 4 a.png",), ("",)], "value string")
    back = P.images_text(P.images_lines(P.images_text(poses))).first()
    assert back["name"] == "a.png" and back["tx"] == 0.1


def test_obj_npz_zip_json_and_splits(spark, tmp_path):
    p = tmp_path / "m.obj"
    p.write_text("# c\nv 0 0 0\nv 1 0 0\nv 1 1 0\nv 0 1 0\ng a\nf 1/1/1 2/2/2 3 4\nf -4 -3 -2\n")
    v, f = FS.read_obj(spark, str(p))
    assert v.count() == 4 and faces_set(f) == {(0, 1, 2), (0, 2, 3), (0, 1, 2)}
    assert f.count() == 3
    cv, cf = mesh(spark, *cube())
    FS.write_obj(cv, cf, f"{tmp_path}/obj")
    again, af = FS.read_obj(spark, f"{tmp_path}/obj/model_id=1")
    assert again.count() == 8 and af.count() == 12
    assert FS.ply_lines(cv, cf).filter("kind = -1").count() == 9
    np.savez(tmp_path / "a.npz", vertices=cube()[0], faces=cube()[1])
    (tmp_path / "b.npz").write_bytes(b"no archive")
    rows = FS.read_npz(spark, f"{tmp_path}/*.npz")
    assert rows.filter("error IS NULL").count() == 1 and rows.count() == 2
    lv, lf = FS.long_form(rows.filter("error IS NULL"))
    assert lv.count() == 8 and lf.count() == 12
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("root/x/raw_model.obj", "v 0 0 0")
        z.writestr("../evil/raw_model.obj", "no")
    (tmp_path / "z.zip").write_bytes(buf.getvalue())
    got = FS.zip_members(spark, f"{tmp_path}/z.zip", ["x/raw_model.obj"]).collect()
    assert [r["member"] for r in got] == ["root/x/raw_model.obj"]
    (tmp_path / "meta.json").write_text('{"furniture": [{"jid": " a ", "x": 1}, {"uid": "b", "model_id": ""}]}')
    assert sorted(r["model_id"] for r in FS.read_metadata(spark, f"{tmp_path}/meta.json").collect()) == ["a", "b"]
    s = spark.createDataFrame([("a", "train"), ("b", "test")], "id string, split string")
    FS.write_splits(s, f"{tmp_path}/splits")
    assert sorted(map(tuple, FS.read_splits(spark, f"{tmp_path}/splits").collect())) == [("a", "train"), ("b", "test")]
    FS.write_splits(s.union(spark.createDataFrame([("a", "test")], s.schema)), f"{tmp_path}/bad")
    with pytest.raises(ValueError):
        FS.read_splits(spark, f"{tmp_path}/bad")
    FS.write_manifest(s, f"{tmp_path}/csv", "id")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == 2


def faces_set(f):
    return {(r["i0"], r["i1"], r["i2"]) for r in f.collect()}


def test_config_and_aliases(spark):
    c = FS.load_config("strata:\n- {name: low, min_faces: 2000, max_faces: 20000, count: 50}\nsplits: {train: 40, val: 5, test: 5}\nimage_size: 960\n")
    assert c.splits["validation"] == 5 and c.image_size == 960
    with pytest.raises(ValueError):
        FS.load_config("strata:\n- {name: low, min_faces: 1, max_faces: 2, count: 51}\n")
    d = spark.createDataFrame([([1.0], None), (None, [2])], "verts array<double>, faces array<int>").withColumn("vertices", F.lit(None).cast("array<double>"))
    assert [r["reason"] for r in mesh_arrays(d).collect()] == ["missing_mesh", "missing_mesh"]
    with pytest.raises(ValueError):
        mesh_arrays(spark.range(1))


def test_streaming_ingest_is_idempotent(spark, tmp_path):
    src, reg, out = (f"{tmp_path}/{n}" for n in ("in", "reg", "out"))
    kind = "model_id bigint, input_hash string, value double"
    work = lambda d: d.select("model_id", "input_hash", (F.col("value") * 2).alias("value"), F.when(F.col("value") < 0, "negative").alias("error"))

    def run():
        ingest(spark, src, kind, reg, out, f"{tmp_path}/ck", "double", {"k": 1}, work).awaitTermination()

    spark.createDataFrame([(1, "a", 1.0), (2, "b", -1.0)], kind).write.mode("append").parquet(src)
    run()
    spark.createDataFrame([(1, "a", 1.0), (2, "b", 3.0), (3, "c", 2.0)], kind).write.mode("append").parquet(src)
    run()
    got = sorted((r["model_id"], r["value"]) for r in spark.read.parquet(out).collect())
    assert got == [(1, 2.0), (2, -2.0), (2, 6.0), (3, 4.0)]  # the failed model is done again, the good one is not
    assert R.cache_complete(spark.createDataFrame([(1,)], "id int"), spark.createDataFrame([(2,)], "id int"), spark.createDataFrame([(1,), (2,)], "id int"))
    assert R.stale(spark.createDataFrame([(1,), (2,)], "model_id int"), spark.createDataFrame([(1,)], "model_id int")).count() == 1


def test_leaves_failures_as_rows(spark):
    from meshquilt.kernels import packed

    v, f = mesh(spark, *cube())
    v2, f2 = mesh(spark, *cube(), model=2)

    def kernel(model, vids, *_):
        if model == 2:
            raise RuntimeError("no")
        return {"n": np.array([len(vids)])}

    got = {r["model_id"]: (r["n"], r["error"]) for r in packed.each_model(packed.pack(v.union(v2), f.union(f2)), kernel, "n bigint").collect()}
    assert got == {1: (8, None), 2: (None, "RuntimeError: no")}


def brute_pairs(rows):
    """All pairs a < b of (id, hash, wd, wh, descriptor, n_faces)."""
    out = set()
    for a in rows:
        for b in rows:
            same = a[1] is not None and a[1] == b[1]
            known = None not in (a[2], b[2], a[3], b[3]) and len(a[4]) == len(b[4]) and None not in (*a[4], *b[4])
            close = known and abs(a[2] - b[2]) <= 0.06 and abs(a[3] - b[3]) <= 0.08 and sum((x - y) ** 2 for x, y in zip(a[4], b[4], strict=True)) ** 0.5 < 0.035 and max(a[5], b[5]) / max(min(a[5], b[5]), 1) < 1.15
            if a[0] < b[0] and (same or close):
                out.add((a[0], b[0]))
    return out


_DUPLICATE = "id long, hash string, wd double, wh double, descriptor array<double>, n_faces long"


def test_near_duplicates_pair_all_rows_of_a_hash(spark):
    """Not only each row with the first; pairs that are close too come once."""
    rows = [(i, "same", float(i), 1.0, [0.0], 1000) for i in range(5)] + [(i, "near", 9.0 + 0.01 * i, 1.0, [0.01 * (i % 2)], 1000) for i in range(5, 10)]
    got = [tuple(r) for r in S.near_duplicates(spark.createDataFrame(rows, _DUPLICATE)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_pairs(rows) and (3, 4) in got


def test_near_duplicates_in_blocks_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_ROWS", 3)
    inf, nan = float("inf"), float("nan")
    odd = [None, inf, -inf, nan, 1e300, -1e300, 2.0, 2.05]
    rows = [(i, None if i % 7 == 0 else f"h{i % 11}", odd[i % 8] if i % 5 == 0 else 1.0 + i % 13 / 100, odd[i // 8 % 8] if i % 6 == 0 else 1.0 + i % 17 / 100, [[0.0, i / 1000], [0.01], [None, 1.0], []][i % 4 if i % 3 == 0 else 0], i % 3) for i in range(60)]
    rows.append((59, "h1", 1.01, 1.01, [0.0, 0.05], 2))  # an id again
    want = brute_pairs(rows)
    for most in (8, 0):  # descriptors as columns, and as arrays
        monkeypatch.setattr(S, "MOST_COLUMNS", most)
        got = [tuple(r) for r in S.near_duplicates(spark.createDataFrame(rows, _DUPLICATE)).collect()]
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 100


def test_near_duplicate_pairs_are_not_shuffled(spark, sf):
    text = entry.queries()["near_duplicate_pairs"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert text.split("\n")[1].strip() == "+- Union" and not [line for line in text.split("\n") if "Aggregate" in line and "a_id" in line]
