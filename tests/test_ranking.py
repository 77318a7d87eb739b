"""Global order, next larger rows, chamfer by the grid, cameras around models."""

import random

import numpy as np
from pyspark.sql import functions as F

from meshquilt.kernels import closest
from meshquilt.operators import metrics as M
from meshquilt.operators import nearest as N
from meshquilt.operators import ranking as RK
from meshquilt.operators import samples as SA
from meshquilt.operators import views as VW
from test_mesh import mesh, sphere


def test_ranks_equal_a_global_window(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, *range(40)])) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, v int").repartition(6)
    got = RK.ranked(df, F.col("v").desc_nulls_last(), "id", parts=7).collect()
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert {r["id"]: r["rank"] for r in got} == {i: k for k, (i, _) in enumerate(want, 1)}
    equal = RK.ranked(spark.range(50).withColumn("x", F.lit(1)), "x", parts=4)
    assert sorted(r["rank"] for r in equal.collect()) == list(range(1, 51))
    assert RK.ranked(df.limit(0), "id").count() == 0


def test_next_larger_row_over_parts(spark):
    rng = random.Random(2)
    asked = [(rng.choice("ab"), rng.randrange(60), i) for i in range(150)]
    free = [(rng.choice("abc"), rng.randrange(60), 1000 + i) for i in range(25)]
    a, f = spark.createDataFrame(asked, "g string, at long, who long"), spark.createDataFrame(free, "g string, at long, v long")
    for parts in (1, 5, 40):
        got = {r["who"]: r["next"] and tuple(r["next"]) for r in RK.next_after(a, f, "g", "at", "v", parts).collect()}
        assert got == {w: min(((x, v) for h, x, v in free if h == g and x > at), default=None) for g, at, w in asked}


def test_first_seen_and_manifest_positions(spark):
    d = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), ("c", 4)], "k string, at int")
    assert sorted((r["k"], r["pos"], r["rank"]) for r in M.first_seen(d, "k", "at").collect()) == [("a", 2, 2), ("b", 1, 1), ("c", 4, 3)]
    s = spark.createDataFrame([(3, "test"), (1, "train"), (2, "train"), (9, "validation")], "model_id long, split string")
    assert [(r["model_id"], r["position"], r["path"]) for r in SA.manifest(s).orderBy("position").collect()] == [(1, 1, "samples/1.parquet"), (2, 2, "samples/2.parquet"), (9, 3, "samples/9.parquet"), (3, 4, "samples/3.parquet")]


def test_chamfer_equals_all_pairs(spark):
    v, f = sphere(2)
    w = np.random.default_rng(3).normal(size=(90, 3))
    a, b = mesh(spark, v, f, 4)[0], mesh(spark, w, [(0, 1, 2)], 4)[0]
    got = N.chamfer(a, b).first()
    x, y = closest.nearest(v, w)[1].mean(), closest.nearest(w, v)[1].mean()
    assert abs(got["a_to_b"] - x) < 1e-12 and abs(got["b_to_a"] - y) < 1e-12 and abs(got["chamfer"] - x - y) < 1e-12
    one = N.chamfer(a, b.limit(0)).collect()
    assert not one or one[0]["chamfer"] is None


def test_cameras_around_a_model(spark):
    models = spark.createDataFrame([(7, 1.0, -2.0, 3.0, 2.5)], "model_id long, x double, y double, z double, s double")
    layout = VW.centres(VW.cube_cameras(spark)).collect()
    got = {r["view_id"]: r for r in VW.centres(VW.placed(VW.cube_cameras(spark), models)).collect()}
    for c in layout:
        r = got[c["view_id"]]
        assert np.allclose([r["cx"], r["cy"], r["cz"]], np.array([1, -2, 3]) + 2.5 * np.array([c["cx"], c["cy"], c["cz"]])) and r["r"] == c["r"] and r["k"] == c["k"]
