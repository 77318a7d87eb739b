"""Cameras, projection, rasters, visibility."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshquilt.functions import vec as V
from meshquilt.kernels import packed, raster
from meshquilt.operators import selection as S

#: The order and names of the 14 cube-surface views.
CUBE_VIEWS = (
    ("pos_x", 1, 0, 0), ("neg_x", -1, 0, 0), ("pos_y", 0, 1, 0), ("neg_y", 0, -1, 0), ("pos_z", 0, 0, 1), ("neg_z", 0, 0, -1),
    ("neg_x_neg_y_neg_z", -1, -1, -1), ("neg_x_neg_y_pos_z", -1, -1, 1), ("neg_x_pos_y_neg_z", -1, 1, -1), ("neg_x_pos_y_pos_z", -1, 1, 1),
    ("pos_x_neg_y_neg_z", 1, -1, -1), ("pos_x_neg_y_pos_z", 1, -1, 1), ("pos_x_pos_y_neg_z", 1, 1, -1), ("pos_x_pos_y_pos_z", 1, 1, 1),
)
PAIRS = (7, 14)


def look_at(centre: np.ndarray, target=(0.0, 0.0, 0.0)) -> tuple[np.ndarray, np.ndarray]:
    """World to camera: z forward, y down; up is world z, or y where the view is vertical."""
    forward = np.asarray(target, float) - centre
    forward /= np.linalg.norm(forward)
    up = np.array((0.0, 0.0, 1.0)) if abs(forward[2]) < 0.99 else np.array((0.0, 1.0, 0.0))
    right = np.cross(forward, up)
    right /= np.linalg.norm(right)
    r = np.stack((right, np.cross(forward, right), forward))
    return r, -r @ centre


def _rows(centres, names, size: int, fov: float, target=(0.0, 0.0, 0.0)):
    focal = 0.5 * size / math.tan(math.radians(fov) / 2)
    k = [focal, 0.0, size / 2, 0.0, focal, size / 2, 0.0, 0.0, 1.0]
    out = []
    for i, (c, name) in enumerate(zip(centres, names, strict=True)):
        r, t = look_at(np.asarray(c, float), target)
        out.append((i, name, k, r.ravel().tolist(), t.tolist(), size, size))
    return out


CAMERA = "view_id int, name string, k array<double>, r array<double>, t array<double>, width int, height int"


def cube_cameras(spark: SparkSession, half_extent: float = 1.5, size: int = 128, fov: float = 90.0) -> DataFrame:
    """Six faces, then eight corners of a cube, looking at the origin."""
    return spark.createDataFrame(_rows([np.array(v[1:]) * half_extent for v in CUBE_VIEWS], [v[0] for v in CUBE_VIEWS], size, fov), CAMERA)


def on_cube(direction: np.ndarray, half_extent: float) -> np.ndarray:
    d = direction / max(np.linalg.norm(direction), 1e-12)
    return d * half_extent / np.max(np.abs(d))


def nested_cameras(spark: SparkSession, half_extent: float = 1.5, size: int = 128, fov: float = 90.0, pool: int = 16384) -> DataFrame:
    """The 14 views, then 7 and 14 antipodal pairs, each the farthest from all before: 14, 28 and 56 are prefixes."""
    base = np.array([v[1:] for v in CUBE_VIEWS], float)
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    points = S.fibonacci_directions(spark, pool).orderBy("i").toPandas()[["x", "y", "z"]].to_numpy()  # ``pool`` rows
    more = S.farthest_pairs(base, points, sum(PAIRS))
    names = [v[0] for v in CUBE_VIEWS] + [f"nested_l{1 + (p >= PAIRS[0])}_pair_{p - (PAIRS[0] if p >= PAIRS[0] else 0):02d}_{s}" for p in range(sum(PAIRS)) for s in ("pos", "neg")]
    centres = [np.array(v[1:]) * half_extent for v in CUBE_VIEWS] + [on_cube(d, half_extent) for d in more]
    return spark.createDataFrame(_rows(centres, names, size, fov), CAMERA)


def ring_cameras(spark: SparkSession, radius: float, scale: float = 1.8, size: int = 1920, fov: float = 50.0, target=(0.0, 0.0, 0.0)) -> DataFrame:
    """48 views: three rings of 16 at -25, 0 and 25 degrees, the middle one half a step round."""
    centres, names = [], []
    for ring, el in enumerate((-25.0, 0.0, 25.0)):
        for a in range(16):
            az = a * 22.5 + (11.25 if ring == 1 else 0.0)
            e, z = math.radians(el), math.radians(az)
            centres.append(np.asarray(target) + scale * radius * np.array((math.cos(e) * math.cos(z), math.sin(e), math.cos(e) * math.sin(z))))
            names.append(f"ring{ring}_el{el:+05.1f}_az{az:06.2f}")
    return spark.createDataFrame(_rows(centres, names, size, fov, target), CAMERA)


def placed(layout: DataFrame, models: DataFrame) -> DataFrame:
    """The layout's cameras around every model: ``models`` has model_id, the point x, y, z that they look at and the factor ``s`` of their distance from it. Rotations stay,
    centres are scaled and moved."""
    far = layout.join(models.select("model_id", *(F.col(k).alias(f"o{k}") for k in "xyz"), "s"), F.lit(True))  # a layout: dozens of rows
    r = lambda i: F.col("r")[i]
    # -R (o + s c) with t = -R c
    t = F.array(*(F.col("s") * F.col("t")[i] - (r(3 * i) * F.col("ox") + r(3 * i + 1) * F.col("oy") + r(3 * i + 2) * F.col("oz")) for i in range(3)))
    return far.withColumn("t", t).select("model_id", *layout.columns)


def minimum_separation(directions: DataFrame) -> DataFrame:
    """The smallest angle (degrees) between two of a small set of unit vectors: i, x, y, z."""
    a, b = directions.select("i", *(F.col(k).alias(f"a{k}") for k in "xyz")), directions.select(F.col("i").alias("j"), *(F.col(k).alias(f"b{k}") for k in "xyz"))
    cos = V.dot(V.vec("ax", "ay", "az"), V.vec("bx", "by", "bz"))
    return a.join(b, F.col("i") < F.col("j")).agg(F.degrees(F.acos(F.least(F.lit(1.0), F.max(cos)))).alias("degrees"))


def scaled(cameras: DataFrame, width: int, height: int) -> DataFrame:
    """Intrinsics for another image size: row 0 by the width's factor, row 1 by the height's."""
    sx, sy = F.lit(float(width)) / F.col("width"), F.lit(float(height)) / F.col("height")
    k = F.transform("k", lambda v, i: F.when(i < 3, v * sx).when(i < 6, v * sy).otherwise(v))
    return cameras.withColumn("k", k).withColumn("width", F.lit(width)).withColumn("height", F.lit(height))


def centres(cameras: DataFrame) -> DataFrame:
    """-R^T t, and the 4 by 4 extrinsic matrix row by row."""
    r = lambda i: F.col("r")[i]
    t = lambda i: F.col("t")[i]
    c = [-(r(k) * t(0) + r(3 + k) * t(1) + r(6 + k) * t(2)) for k in range(3)]
    m = F.array(*(x for i in range(3) for x in (r(3 * i), r(3 * i + 1), r(3 * i + 2), t(i))), *(F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)))
    return cameras.select("*", *(x.alias(f"c{k}") for x, k in zip(c, "xyz", strict=True)), m.alias("extrinsic"))


#: Views of a layout at most: layouts go to every task.
MOST_VIEWS = 4096


def layout(cameras: DataFrame) -> DataFrame:
    """The cameras of a layout, to be sent to every task; more than ``MOST_VIEWS`` are an error."""
    n = cameras.limit(MOST_VIEWS + 1).count()
    if n > MOST_VIEWS:
        raise ValueError(f"a layout has {MOST_VIEWS} views at most")
    return F.broadcast(cameras)


def pixel(x, y, z) -> tuple:
    """(px, py, depth) of a point in the camera of the same row (k, r, t)."""
    r, t, k = (lambda i, n=n: F.col(n)[i] for n in "rtk")
    cx, cy, cz = (r(3 * i) * x + r(3 * i + 1) * y + r(3 * i + 2) * z + t(i) for i in range(3))
    safe = F.when(F.abs(cz) > 1e-12, cz).otherwise(F.lit(1e-12))
    return (k(0) * cx + k(1) * cy + k(2) * cz) / safe, (k(3) * cx + k(4) * cy + k(5) * cz) / safe, cz


def projected(vertices: DataFrame, cameras: DataFrame) -> DataFrame:
    """Every vertex in every view: px, py, depth, and clip coordinates (near: half the smallest depth over 1e-8, far: twice
    the largest). Cameras are a layout of at most a few dozen rows; with a model_id they join on it."""
    keys = ["model_id"] if "model_id" in cameras.columns else []
    met = vertices.join(cameras, keys) if keys else vertices.join(layout(cameras), F.lit(True))
    r, t, k = (lambda i, n=n: F.col(n)[i] for n in "rtk")
    cam = [r(3 * i) * F.col("x") + r(3 * i + 1) * F.col("y") + r(3 * i + 2) * F.col("z") + t(i) for i in range(3)]
    out = met.select("model_id", "vid", "view_id", "k", "width", "height", *(c.alias(n) for c, n in zip(cam, ("cx", "cy", "cz"), strict=True)))
    safe = F.when(F.abs("cz") > 1e-12, F.col("cz")).otherwise(F.lit(1e-12))
    px = (k(0) * F.col("cx") + k(1) * F.col("cy") + k(2) * F.col("cz")) / safe
    py = (k(3) * F.col("cx") + k(4) * F.col("cy") + k(5) * F.col("cz")) / safe
    return out.select("model_id", "vid", "view_id", px.alias("px"), py.alias("py"), F.col("cz").alias("depth"), "width", "height")


def clip_range(points: DataFrame) -> DataFrame:
    d = F.when(F.col("depth") > 1e-8, F.col("depth"))
    return points.groupBy("model_id", "view_id").agg((0.5 * F.min(d)).alias("near"), (2 * F.max("depth")).alias("far"))


def in_frame(points: DataFrame) -> DataFrame:
    ok = (F.col("depth") > 1e-8) & (F.col("px") >= 0) & (F.col("px") < F.col("width")) & (F.col("py") >= 0) & (F.col("py") < F.col("height"))
    return points.withColumn("frustum", ok)


def depth_visibility(points: DataFrame, rasters: DataFrame, tolerance: float | str) -> DataFrame:
    """A vertex is visible where it lies in front, its rounded pixel (half to even) is in the image and in the mask, and
    the depth there is finite and within ``tolerance`` (a number or a column) of its own. Pixels meet on an equi-join."""
    tol = F.col(tolerance) if isinstance(tolerance, str) else F.lit(float(tolerance))
    ux, uy = F.rint("px").cast("int"), F.rint("py").cast("int")
    p = points.withColumn("ux", ux).withColumn("uy", uy)
    r = rasters.select("model_id", "view_id", F.col("px").alias("ux"), F.col("py").alias("uy"), "mask", F.col("depth").alias("there"))
    met = p.join(r, ["model_id", "view_id", "ux", "uy"], "left")
    ok = (F.col("depth") > 1e-8) & F.col("mask") & V.finite(F.col("there")) & (F.abs(F.col("depth") - F.col("there")) <= tol)
    return met.select("model_id", "view_id", "vid", F.coalesce(ok, F.lit(False)).alias("visible"))


def mask_support(points: DataFrame, rasters: DataFrame) -> DataFrame:
    p = points.withColumn("ux", F.rint("px").cast("int")).withColumn("uy", F.rint("py").cast("int"))
    r = rasters.filter("mask").select("model_id", "view_id", F.col("px").alias("ux"), F.col("py").alias("uy"), F.lit(True).alias("hit"))
    return p.join(r, ["model_id", "view_id", "ux", "uy"], "left").select("model_id", "view_id", "vid", (F.coalesce("hit", F.lit(False)) & (F.col("depth") > 1e-8)).alias("mask_support"))


def _views(cameras: DataFrame) -> list:
    return [(r["view_id"], np.array(r["k"]).reshape(3, 3), np.array(r["r"]).reshape(3, 3), np.array(r["t"]), r["width"], r["height"]) for r in cameras.orderBy("view_id").collect()]  # a layout: dozens of rows


def rasters(vertices: DataFrame, faces: DataFrame, cameras: DataFrame, cull: bool = False) -> DataFrame:
    """model_id, view_id, py, px, mask, depth (+inf behind), face_id (-1), error: one row a pixel, one model and view at a time. A model that fails is one
    row with its error and nothing else."""
    views = _views(cameras)

    def kernel(_model, _vids, v, fids, f):
        out: dict[str, list] = {n: [] for n in ("view_id", "py", "px", "mask", "depth", "face_id")}
        for view, k, r, t, w, h in views:
            depth, ids = raster.rasterize(v, f, k, r, t, w, h, cull)
            yy, xx = np.mgrid[0:h, 0:w]
            named = np.where(ids >= 0, fids[np.maximum(ids, 0)] if len(fids) else -1, -1)
            for n, c in zip(out, (np.full(w * h, view, np.int32), yy.ravel().astype(np.int32), xx.ravel().astype(np.int32), (ids >= 0).ravel(), depth.ravel(), named.ravel()), strict=True):
                out[n].append(c)
        return {n: np.concatenate(c) for n, c in out.items()}

    return packed.each_model(packed.pack(vertices, faces), kernel, "view_id int, py int, px int, mask boolean, depth double, face_id bigint")


def renderer_visibility(points: DataFrame, faces: DataFrame, face_ids: DataFrame, culled: DataFrame, radius: int = 1) -> DataFrame:
    """frustum, occlusion (a pixel within ``radius`` of the projection shows one of the vertex's faces), backface (such a
    pixel in the culled pass), combined."""
    own = faces.select("model_id", F.explode(F.array("i0", "i1", "i2")).alias("vid"), F.col("fid").alias("face_id")).distinct()
    base = in_frame(points)
    around = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1)))).alias("o")
    near = base.filter("frustum").select("model_id", "view_id", "vid", "px", "py", around)
    near = near.select("model_id", "view_id", "vid", (F.floor("px") + F.col("o.i")).cast("int").alias("ux"), (F.floor("py") + F.col("o.j")).cast("int").alias("uy"))

    def seen(r, name):
        pix = r.filter("face_id >= 0").select("model_id", "view_id", F.col("px").alias("ux"), F.col("py").alias("uy"), "face_id")
        return near.join(pix, ["model_id", "view_id", "ux", "uy"]).join(own, ["model_id", "vid", "face_id"], "left_semi").select("model_id", "view_id", "vid").distinct().withColumn(name, F.lit(True))

    out = base.select("model_id", "view_id", "vid", "frustum").join(seen(face_ids, "occlusion"), ["model_id", "view_id", "vid"], "left").join(seen(culled, "backface"), ["model_id", "view_id", "vid"], "left")
    no = F.lit(False)
    out = out.select("model_id", "view_id", "vid", "frustum", F.coalesce("backface", no).alias("backface"), F.coalesce("occlusion", no).alias("occlusion"))
    return out.withColumn("combined", F.col("frustum") & F.col("backface") & F.col("occlusion"))


def rendered_visibility(vertices: DataFrame, faces: DataFrame, cameras: DataFrame, radius: int = 1) -> DataFrame:
    """``renderer_visibility`` of every model and view from pictures that stay in the task that draws them: model_id, view_id, vid, the four flags, error.
    No pixel is written or shuffled, so what leaves a task is a row for each vertex and view. A model that fails is one row with its error."""
    views = _views(cameras)

    def kernel(_model, vids, v, _fids, f):
        out: dict[str, list] = {n: [] for n in ("view_id", "vid", "frustum", "backface", "occlusion", "combined")}
        for view, k, r, t, w, h in views:
            c = [r[i, 0] * v[:, 0] + r[i, 1] * v[:, 1] + r[i, 2] * v[:, 2] + t[i] for i in range(3)]
            safe = np.where(np.abs(c[2]) > 1e-12, c[2], 1e-12)
            px, py = ((k[i, 0] * c[0] + k[i, 1] * c[1] + k[i, 2] * c[2]) / safe for i in range(2))
            frustum = (c[2] > 1e-8) & (px >= 0) & (px < w) & (py >= 0) & (py < h)
            at = np.flatnonzero(frustum)
            ux, uy = np.floor(px[at]).astype(np.int64) + radius, np.floor(py[at]).astype(np.int64) + radius
            flags = []
            for cull in (True, False):
                ids = np.pad(raster.rasterize(v, f, k, r, t, w, h, cull)[1], radius, constant_values=-1)
                seen = np.zeros(len(v), bool)
                for i in range(-radius, radius + 1):
                    for j in range(-radius, radius + 1):
                        face = ids[uy + j, ux + i]
                        hit = np.flatnonzero(face >= 0)
                        seen[at[hit[(f[face[hit]] == at[hit, None]).any(axis=1)]]] = True
                flags.append(seen)
            for n, column in zip(out, (np.full(len(v), view, np.int32), vids, frustum, *flags, frustum & flags[0] & flags[1]), strict=True):
                out[n].append(column)
        return {n: np.concatenate(column) for n, column in out.items()}

    return packed.each_model(packed.pack(vertices, faces), kernel, "view_id int, vid bigint, frustum boolean, backface boolean, occlusion boolean, combined boolean")


def visibility_stats(visible: DataFrame, column: str = "visible") -> DataFrame:
    """Mean visible views of a vertex, share of vertices never seen, share of (view, vertex) seen."""
    v = visible.groupBy("model_id", "vid").agg(F.sum(F.col(column).cast("int")).alias("n"), F.count("*").alias("views"))
    return v.groupBy("model_id").agg(F.avg("n").alias("mean_views"), F.avg((F.col("n") == 0).cast("double")).alias("never_seen"), (F.sum("n") / F.sum("views")).alias("seen"))


def raster_audit(rasters_: DataFrame) -> DataFrame:
    """Issues of every view: empty mask, mask on the border, depth not finite or not positive inside, finite outside. A model that was not rendered (a row
    with ``error``) has the issue ``raster_failed`` with the reason, and no view."""
    failed = None
    if "error" in rasters_.columns:
        failed = rasters_.filter("error IS NOT NULL").select("model_id", F.lit(None).cast("int").alias("view_id"), F.array(F.concat(F.lit("raster_failed:"), "error")).alias("issues"))
        rasters_ = rasters_.filter("error IS NULL")
    at_edge = (F.col("px") == 0) | (F.col("py") == 0) | (F.col("px") == F.col("mx")) | (F.col("py") == F.col("my"))
    box = rasters_.groupBy("model_id", "view_id").agg(F.max("px").alias("mx"), F.max("py").alias("my"))
    m = rasters_.join(box, ["model_id", "view_id"])
    good = V.finite(F.col("depth"))
    facts = m.groupBy("model_id", "view_id").agg(
        F.count(F.when(F.col("mask"), 1)).alias("n"), F.count(F.when(F.col("mask") & at_edge, 1)).alias("edge"),
        F.count(F.when(F.col("mask") & (~good | (F.col("depth") <= 0)), 1)).alias("inside"), F.count(F.when(~F.col("mask") & good, 1)).alias("outside"),
    )
    out = facts.select("model_id", "view_id", _view_issues().alias("issues"))
    return out if failed is None else out.unionByName(failed)


def _view_issues():
    """The issues of a view, of how many pixels have each: n (in the mask), edge, inside, outside."""
    tag = lambda name, rule: F.when(rule, F.concat(F.lit(f"{name}:view_"), F.col("view_id").cast("string")))
    return F.array_compact(F.array(tag("empty_mask", F.col("n") == 0), tag("mask_touches_image_border", F.col("edge") > 0), tag("invalid_foreground_depth", F.col("inside") > 0), tag("finite_background_depth", F.col("outside") > 0)))


def pixel_facts(mask: np.ndarray, depth: np.ndarray) -> tuple[int, int, int, int]:
    """What ``raster_audit`` counts in one picture: pixels in the mask, of these on the border, of these without a finite positive depth, and pixels outside with a finite one."""
    good = np.isfinite(depth)
    edge = int(mask.sum()) - int(mask[1:-1, 1:-1].sum())
    return int(mask.sum()), edge, int((mask & ~(good & (depth > 0))).sum()), int((~mask & good).sum())


def rendered_audit(vertices: DataFrame, faces: DataFrame, cameras: DataFrame, cull: bool = False) -> DataFrame:
    """``raster_audit`` of every model and view from pictures that stay in the task that draws them: no pixel is written or shuffled, a task returns a row for each
    model and view."""
    views = _views(cameras)

    def kernel(_model, _vids, v, _fids, f):
        out: dict[str, list] = {n: [] for n in ("view_id", "n", "edge", "inside", "outside")}
        for view, k, r, t, w, h in views:
            depth, ids = raster.rasterize(v, f, k, r, t, w, h, cull)
            for n, c in zip(out, (view, *pixel_facts(ids >= 0, depth)), strict=True):
                out[n].append(c)
        return out

    facts = packed.each_model(packed.pack(vertices, faces), kernel, "view_id int, n bigint, edge bigint, inside bigint, outside bigint")
    failed = F.array(F.concat(F.lit("raster_failed:"), "error"))
    return facts.select("model_id", "view_id", F.when(F.col("error").isNull(), _view_issues()).otherwise(failed).alias("issues"))


def resized_nearest(rasters_: DataFrame, width: int, height: int) -> DataFrame:
    """Nearest-pixel resize of raster rows: each target pixel takes floor((p + 1/2) n / m)."""

    box = rasters_.groupBy("model_id", "view_id").agg((F.max("px") + 1).alias("w"), (F.max("py") + 1).alias("h"))
    grid = box.select("model_id", "view_id", "w", "h", F.explode(F.sequence(F.lit(0), F.lit(height - 1))).alias("ty")).select("*", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("tx"))

    sx, sy = F.least(F.floor((F.col("tx") + 0.5) * F.col("w") / width), F.col("w") - 1).cast("int"), F.least(F.floor((F.col("ty") + 0.5) * F.col("h") / height), F.col("h") - 1).cast("int")
    want = grid.select("model_id", "view_id", F.col("tx"), F.col("ty"), sx.alias("px"), sy.alias("py"))
    return want.join(rasters_, ["model_id", "view_id", "px", "py"]).drop("px", "py").withColumnsRenamed({"tx": "px", "ty": "py"})


def projection_audit(a: DataFrame, b: DataFrame, limit: float = 2e-3) -> DataFrame:
    """Largest pixel error between two projections, share in frame, ok."""
    q = b.select("model_id", "view_id", "vid", F.col("px").alias("qx"), F.col("py").alias("qy"))
    met = in_frame(a).join(q, ["model_id", "view_id", "vid"])
    err = F.max(F.greatest(F.abs(F.col("px") - F.col("qx")), F.abs(F.col("py") - F.col("qy"))))
    return met.groupBy("model_id").agg(err.alias("max_error"), F.avg(F.col("frustum").cast("double")).alias("in_frame"), (err <= limit).alias("ok"))


def foreground_luma(pixels: DataFrame, least: float = 5.0) -> DataFrame:
    """Spread, minimum and mean of the luma inside the mask and whether the spread passes. ``pixels``: r, g, b, mask."""
    y = V.luma(F.col("r"), F.col("g"), F.col("b"))
    inside = pixels.filter("mask").withColumn("luma", y)
    return inside.groupBy("model_id", "view_id").agg(F.stddev_pop("luma").alias("std"), F.min("luma").alias("min"), F.avg("luma").alias("mean"), (F.stddev_pop("luma") >= least).alias("ok"))
