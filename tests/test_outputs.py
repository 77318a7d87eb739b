"""Digests, exact quantiles, ordered text, sparse-model files, the ingest protocol."""

import hashlib
import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from meshquilt.operators import digests as DG
from meshquilt.operators import photogram as P
from meshquilt.operators import quantiles as QU
from meshquilt.plans import registry as R
from meshquilt.sources import ordered as OR
from meshquilt.streaming import ingest as IN
from test_mesh import cube, mesh, sphere


# ---- digests --------------------------------------------------------------------------------------------------


def test_checksums_equal_hashlib_over_the_bytes(spark):
    want, frames = {}, []
    for model, (v, f) in enumerate((cube(), sphere(3), (np.array([[-0.0, 1e-300, math.pi]]), np.empty((0, 3), int)))):
        frames.append(mesh(spark, v, f, model) if len(f) else (spark.createDataFrame([(model, i, *map(float, p)) for i, p in enumerate(v)], frames[0][0].schema), None))
        want[model] = hashlib.sha256(np.asarray(v, np.float64).tobytes() + np.asarray(f, np.int64).tobytes()).hexdigest()
    vs = frames[0][0].unionByName(frames[1][0]).unionByName(frames[2][0]).repartition(5)
    fs = frames[0][1].unionByName(frames[1][1]).repartition(5)
    with_small_batches = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert {r["model_id"]: r["checksum"] for r in DG.mesh_checksum(vs, fs).collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", with_small_batches)
    v, f = cube()
    turned = mesh(spark, v[::-1], f, 0)[0]
    assert DG.mesh_checksum(turned, fs.filter("model_id = 0")).first()["checksum"] != want[0]


def test_geometry_hash_equals_its_definition(spark):
    v, f = sphere(2)
    v = v * (1.0, 2.3, 0.7) + 5
    c = v - (v.min(axis=0) + v.max(axis=0)) * 0.5
    q = np.round(c / max(float(np.ptp(c, axis=0).max()), 1e-12), 5)
    q = q[np.lexsort((q[:, 2], q[:, 1], q[:, 0]))]
    want = hashlib.sha256(q.astype(np.float32).tobytes() + struct.pack("<q", len(f))).hexdigest()
    assert DG.geometry_hash(*mesh(spark, v, f)).first()["geometry_hash"] == want
    assert DG.geometry_hash(*mesh(spark, v[np.random.default_rng(1).permutation(len(v))], f)).first()["geometry_hash"] == want


def test_source_checksum_follows_the_source(spark):
    assert DG.source_checksum(DG.mesh_checksum) != DG.source_checksum(DG.geometry_hash) and len(DG.source_checksum(DG)) == 64
    row = R.run_metadata(spark, {"a": 1}, {"seed": 2}, "code", "abc123").first()
    assert row["commit"] == "abc123" and row["code_sha256"] == hashlib.sha256(b"code").hexdigest()


# ---- quantiles ------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["normal", "few", "wide", "equal", "tiny"])
def test_quantiles_are_exact(spark, monkeypatch, kind):
    monkeypatch.setattr(QU, "BUCKETS", 32)
    monkeypatch.setattr(QU, "FEW", 20)
    rng = random.Random(3)
    make = {"normal": lambda: rng.gauss(0, 1), "few": lambda: float(rng.randrange(3)), "wide": lambda: rng.choice([-1, 1]) * 10.0 ** rng.randrange(-300, 300), "equal": lambda: 2.5, "tiny": lambda: rng.choice([5e-324, 0.0, -5e-324])}[kind]
    values = [make() for _ in range(900)]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "x double").repartition(3)
    shares = [0.0, 0.013, 0.5, 0.95, 1.0]
    got, s = QU.quantiles(df, "x", shares), sorted(values)
    for q, g in zip(shares, got, strict=True):
        at = q * (len(s) - 1)
        lo = math.floor(at)
        want = s[lo] + (s[min(lo + 1, len(s) - 1)] - s[lo]) * (at - lo) if at > lo else s[lo]
        assert g == want, (q, g, want)


def test_quantiles_of_nothing(spark):
    assert QU.quantiles(spark.createDataFrame([(None,)], "x double"), "x", [0.5, 0.1]) == [None, None]
    assert P.point_quality(spark.createDataFrame([], "value string")).first()["track_length_median"] is None


# ---- ordered text ---------------------------------------------------------------------------------------------


def test_lines_keep_their_order_over_many_parts(spark, tmp_path):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("at"), F.lit(0).alias("sub"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else so few lines become one part
    try:
        OR.write_lines(rows.withColumn("value", F.concat(F.lit("line "), F.col("at").cast("string"))).repartition(9), f"{tmp_path}/t", "at", "sub")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    parts = sorted(p for p in (tmp_path / "t").iterdir() if p.name.startswith("part-"))
    assert len(parts) > 1 and "".join(p.read_text() for p in parts) == "".join(f"line {i}\n" for i in range(5000))
    assert [r["value"] for r in OR.read_lines(spark, f"{tmp_path}/t").orderBy("part", "line").collect()] == [f"line {i}" for i in range(5000)]


def test_numbers_read_back_and_print_as_in_c(spark):
    values = [0.1, 1 / 3, 1e22, 1e17, 123456789012345680.0, 1e-5, 0.0001, -0.0, 5e-324, 1.7976931348623157e308, float("inf"), None, 100.0, math.pi * 1e-7]
    got = [r["x"] for r in OR.printed(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double"), "x").orderBy("i").collect()]
    assert got == [None if v is None else "%.17g" % v for v in values]
    assert all(v is None or float(t) == v for t, v in zip(got, values, strict=True))


def test_sparse_model_is_read_back_equal(spark, tmp_path):
    rng = random.Random(1)
    cameras = [(i, "PINHOLE", 640, 480, [rng.random() for _ in range(4)]) for i in (3, 1, 2)]
    images = [(i, 1 + i % 3, i + 10, i % 2, f"{i}.png", *(rng.gauss(0, 1) for _ in range(7))) for i in range(40, 0, -1)]
    dc = spark.createDataFrame(cameras, "camera_id long, model string, width int, height int, params array<double>")
    di = spark.createDataFrame(images, "image_id long, camera_id long, frame_id long, rig_id long, name string, qw double, qx double, qy double, qz double, tx double, ty double, tz double")
    obs = spark.createDataFrame([(5, 1, 0.5, 0.25, 9), (5, 0, 1.5, 2.0, -1), (7, 0, 1.0, 1.0, 9)], "image_id long, idx int, x double, y double, point3d_id long")
    pts = spark.createDataFrame([(9, 0.1, 0.2, 0.3, 1, 2, 3, 0.5)], "point3d_id long, x double, y double, z double, r int, g int, b int, error double")
    rigs = spark.createDataFrame([(1, 2), (0, 1)], "rig_id long, camera_id long")
    P.write_sparse_model(f"{tmp_path}/m", cameras=P.cameras_lines(dc), rigs=P.rigs_lines(rigs), frames=P.frames_lines(di), images=P.images_lines(di, obs), points3D=P.points_lines(pts, obs.filter("point3d_id = 9")))
    text = {n: [r["value"] for r in OR.read_lines(spark, f"{tmp_path}/m/{n}.txt").orderBy("part", "line").collect()] for n in P.HEADS}
    assert text["cameras"][2:4] == ["# Number of cameras: 3", "1 PINHOLE 640 480 " + " ".join("%.17g" % p for p in cameras[1][4])]
    assert text["rigs"][3:] == ["0 1 CAMERA 1", "1 1 CAMERA 2"]
    by = {r[0]: r for r in images}
    assert text["frames"][3:] == [f"{r[2]} {r[3]} {' '.join('%.17g' % x for x in r[5:])} 1 CAMERA {r[1]} {i}" for i, r in sorted(by.items())]
    assert text["images"][3] == "# Number of images: 40, mean observations per image: 0.075"
    assert text["images"][4::2] == [f"{i} {' '.join('%.17g' % x for x in r[5:])} {r[1]} {r[4]}" for i, r in sorted(by.items())]
    assert text["images"][5 + 2 * 4] == "1.5 2 -1 0.5 0.25 9" and text["images"][5 + 2 * 6] == "1 1 9" and text["images"][5] == ""
    assert text["points3D"][2:] == ["# Number of points: 1, mean track length: 2", "9 0.10000000000000001 0.20000000000000001 0.29999999999999999 1 2 3 0.5 5 1 7 0"]
    back = P.images_text(spark.read.text(f"{tmp_path}/m/images.txt"))
    assert sorted(tuple(r[c] for c in ("image_id", "qw", "qx", "qy", "qz", "tx", "ty", "tz", "camera_id", "name")) for r in back.collect()) == sorted((r[0], *r[5:], r[1], r[4]) for r in images)
    again = {r["camera_id"]: r["params"] for r in P.cameras_text(spark.read.text(f"{tmp_path}/m/cameras.txt")).collect()}
    assert again == {c[0]: c[4] for c in cameras}
    long = spark.createDataFrame([("1 FULL 2 3 " + " ".join(map(str, range(1500))),)], "value string")
    assert len(P.cameras_text(long).first()["params"]) == 1500


def test_sparse_model_numbers_are_printed_once_and_after_the_sort(spark, tmp_path):
    n = 3000
    k = F.col("id") * 7919 % n
    images = spark.range(n, numPartitions=5).select(k.alias("image_id"), (k % 3).alias("camera_id"), (k + 5).alias("frame_id"), (k % 9).alias("rig_id"), F.concat(F.lit("i"), k.cast("string")).alias("name"), *((k / (i + 3.0)).alias(c) for i, c in enumerate(P.POSE)))
    seen = spark.range(2 * n, numPartitions=3).select((F.col("id") % (n // 2)).alias("image_id"), F.floor(F.col("id") / (n // 2)).cast("int").alias("idx"), (F.col("id") / 7.0).alias("x"), F.lit(0.5).alias("y"), (F.col("id") % 100).alias("point3d_id"))
    points = spark.range(100).select(F.col("id").alias("point3d_id"), *((F.col("id") / 3.0).alias(c) for c in "xyz"), *(F.lit(i).alias(c) for i, c in enumerate("rgb")), F.lit(0.25).alias("error"))
    lines = {"frames": P.frames_lines(images), "images": P.images_lines(images, seen), "points3D": P.points_lines(points, seen)}
    for name, passes in (("frames", 1), ("images", 2), ("points3D", 1)):  # observations are printed too, once
        plan = lines[name]._jdf.queryExecution().optimizedPlan().toString().splitlines()
        at = [i for i, line in enumerate(plan) if "MapInArrow" in line]
        assert len(at) == passes and at[0] < next(i for i, line in enumerate(plan) if "Sort [" in line)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        P.write_sparse_model(f"{tmp_path}/m", **lines)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    rows = {name: OR.read_lines(spark, f"{tmp_path}/m/{name}.txt").orderBy("part", "line").collect() for name in lines}
    assert all(len({r["part"] for r in of}) > 3 for of in rows.values())
    text = {name: [r["value"] for r in of] for name, of in rows.items()}
    assert text["frames"][2] == f"# Number of frames: {n}" and [int(v.split()[-1]) for v in text["frames"][3:]] == list(range(n))
    assert text["images"][3] == f"# Number of images: {n}, mean observations per image: 2" and [int(v.split()[0]) for v in text["images"][4::2]] == list(range(n))
    assert text["images"][4 + 2 * 8] == "8 " + " ".join("%.17g" % (8 / (i + 3.0)) for i in range(7)) + " 2 i8"
    assert text["images"][5 + 2 * 8] == " ".join(f"{'%.17g' % ((8 + i * n // 2) / 7.0)} 0.5 {(8 + i * n // 2) % 100}" for i in range(4)) and text["images"][-1] == ""
    assert text["points3D"][2] == "# Number of points: 100, mean track length: 60" and [int(v.split()[0]) for v in text["points3D"][3:]] == list(range(100))


# ---- ingestion ------------------------------------------------------------------------------------------------


def test_a_crash_between_results_and_registry_leaves_nothing_double(spark, tmp_path, monkeypatch):
    src, reg, out, mark = (f"{tmp_path}/{n}" for n in ("in", "reg", "out", "ck"))
    kind = "model_id bigint, input_hash string, value double"
    work = lambda d: d.select("model_id", "input_hash", (F.col("value") * 2).alias("value"), F.lit(None).cast("string").alias("error"))
    run = lambda: IN.ingest(spark, src, kind, reg, out, mark, "double", {"k": 1}, work).awaitTermination()
    spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], kind).write.mode("append").parquet(src)
    run()
    spark.createDataFrame([(2, "b", 2.0), (3, "c", 3.0)], kind).write.mode("append").parquet(src)
    real = IN._put

    def crash(rows, path, batch):
        if path == reg:
            raise RuntimeError("lost between the two")
        real(rows, path, batch)

    monkeypatch.setattr(IN, "_put", crash)
    with pytest.raises(Exception, match="lost between the two"):
        run()
    seen = lambda: sorted((r["model_id"], r["value"]) for r in IN.published(spark.read.parquet(out), IN.registry(spark, reg)).collect())
    assert spark.read.parquet(out).count() == 3 and seen() == [(1, 2.0), (2, 4.0)]  # what is not registered is not published
    monkeypatch.setattr(IN, "_put", real)
    run()
    assert seen() == [(1, 2.0), (2, 4.0), (3, 6.0)] and spark.read.parquet(out).count() == 3
    assert sorted(r["model_id"] for r in IN.registry(spark, reg).collect()) == [1, 2, 3]
