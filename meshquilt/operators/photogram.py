"""Relational steps around a photogrammetry run: text readers and writers, identity checks, diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meshquilt.operators.quantiles import quantiles
from meshquilt.sources.ordered import printed, write_lines
from meshquilt.sources.scratch import scratch, stored


def fields(lines: DataFrame, least: int = 1) -> DataFrame:
    """Whitespace fields of the lines (column ``value``) that are neither blank nor comments and have at least ``least``."""
    out = lines.select(F.trim("value").alias("value")).filter((F.col("value") != "") & ~F.startswith("value", F.lit("#")))
    return out.select(F.split("value", r"\s+").alias("f")).filter(F.size("f") >= least)


def point_quality(lines: DataFrame) -> DataFrame:
    """Sparse points (text rows): reprojection errors and track lengths. Short rows and rows without a number are skipped;
    an error that is not finite does not count among the errors."""
    p = fields(lines, 8).select(F.col("f")[7].try_cast("double").alias("e"), F.floor((F.size("f") - 8) / 2).cast("int").alias("t")).filter("e IS NOT NULL")
    e = F.when(~F.isnan("e") & (F.abs("e") < float("inf")), F.col("e"))
    p = p.select(e.alias("e"), "t")
    p = stored(p, scratch(p.sparkSession))
    n = F.count("*")
    (median, p95), (middle,) = quantiles(p, "e", [0.5, 0.95]), quantiles(p, "t", [0.5])
    value = lambda v: F.lit(v).cast("double")
    return p.agg(
        n.alias("num_points"), F.avg("e").alias("reprojection_error_mean"), value(median).alias("reprojection_error_median"), value(p95).alias("reprojection_error_p95"),
        F.max("e").alias("reprojection_error_max"), F.avg("t").alias("track_length_mean"), value(middle).alias("track_length_median"), F.count_if(F.col("t") == 2).alias("track_length_2"),
        F.count_if(F.col("t") == 3).alias("track_length_3"), F.count_if(F.col("t") >= 4).alias("track_length_ge4"),
        F.when(n > 0, F.count_if(F.col("t") == 2) / n).alias("track_length_2_fraction"), F.when(n > 0, F.count_if(F.col("t") >= 4) / n).alias("track_length_ge4_fraction"),
    )


def cameras_text(lines: DataFrame) -> DataFrame:
    f = F.col("f")
    return fields(lines, 5).select(f[0].cast("bigint").alias("camera_id"), f[1].alias("model"), f[2].cast("int").alias("width"), f[3].cast("int").alias("height"), F.transform(F.slice(f, F.lit(5), F.size(f) - 4), lambda x: x.cast("double")).alias("params"))


def images_text(lines: DataFrame) -> DataFrame:
    """Pose rows: image_id, qw..qz, tx..tz, camera_id, name (rows of ten fields or more whose last does not read as a number)."""
    f = F.col("f")
    named = fields(lines, 10).filter(f[9].try_cast("double").isNull())
    return named.select(f[0].cast("bigint").alias("image_id"), *(f[i].cast("double").alias(n) for i, n in enumerate(("qw", "qx", "qy", "qz", "tx", "ty", "tz"), 1)), f[8].cast("bigint").alias("camera_id"), f[9].alias("name"))


def obj_counts(lines: DataFrame) -> DataFrame:
    return lines.agg(F.count_if(F.startswith("value", F.lit("v "))).alias("n_vertices"), F.count_if(F.startswith("value", F.lit("f "))).alias("n_faces"))


#: The comments that head each text file of a sparse model; the last line counts.
HEADS = {
    "cameras": ("# Camera list with one line of data per camera:", "#   CAMERA_ID, MODEL, WIDTH, HEIGHT, PARAMS[]", "# Number of cameras: {n}"),
    "rigs": ("# Rig calib list with one line of data per calib:", "#   RIG_ID, NUM_SENSORS, REF_SENSOR_TYPE, REF_SENSOR_ID, SENSORS[] as (SENSOR_TYPE, SENSOR_ID, HAS_POSE, [QW, QX, QY, QZ, TX, TY, TZ])", "# Number of rigs: {n}"),
    "frames": ("# Frame list with one line of data per frame:", "#   FRAME_ID, RIG_ID, RIG_FROM_WORLD[QW, QX, QY, QZ, TX, TY, TZ], NUM_DATA_IDS, DATA_IDS[] as (SENSOR_TYPE, SENSOR_ID, DATA_ID)", "# Number of frames: {n}"),
    "images": ("# Image list with two lines of data per image:", "#   IMAGE_ID, QW, QX, QY, QZ, TX, TY, TZ, CAMERA_ID, NAME", "#   POINTS2D[] as (X, Y, POINT3D_ID)", "# Number of images: {n}, mean observations per image: {m}"),
    "points3D": ("# 3D point list with one line of data per point:", "#   POINT3D_ID, X, Y, Z, R, G, B, ERROR, TRACK[] as (IMAGE_ID, POINT2D_IDX)", "# Number of points: {n}, mean track length: {m}"),
}
POSE = ("qw", "qx", "qy", "qz", "tx", "ty", "tz")


def _lines(kind: str, rows: DataFrame, key: str, numbers: tuple, *values, counts: DataFrame | None = None) -> DataFrame:
    """at, sub, value, in order: the head (at null), then the lines of ``rows`` by key. ``numbers``: the double columns, which are printed once rows are in order, so the
    sort moves and samples numbers, and every task prints. ``counts``: ids and ``n``, whose mean the head states; it must be cheap, as it is a pass of its own."""
    mean = F.coalesce(F.avg("n"), F.lit(0.0)) if counts is not None else F.lit(0.0)
    facts = (rows.select(key) if counts is None else counts).agg(F.count("*").cast("string").alias("n"), mean.alias("m"))
    m = F.when(F.col("m") == F.floor("m"), F.floor("m").cast("string")).otherwise(F.col("m").cast("string"))
    head = F.array(*(F.replace(F.replace(F.lit(h), F.lit("{n}"), F.col("n")), F.lit("{m}"), m) for h in HEADS[kind]))
    top = facts.select(F.lit(None).cast("bigint").alias("at"), F.posexplode(head).alias("sub", "value"))
    body = rows.orderBy(key)
    body = printed(body, *numbers) if numbers else body
    # a union's parts are those of its sides, one after the other: the head stands first
    return top.unionByName(body.select(F.col(key).alias("at"), F.posexplode(F.array(*values)).alias("sub", "value")))


def _counted(rows: DataFrame, key: str, many: DataFrame | None) -> DataFrame:
    """``key`` of every row, and how many rows of ``many`` have it as n."""
    if many is None:
        return rows.select(key, F.lit(0).alias("n"))
    return rows.select(key).join(many.groupBy(key).agg(F.count("*").alias("n")), key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))


def _joined(*columns):
    return F.concat_ws(" ", *(F.col(c).cast("string") if isinstance(c, str) else c for c in columns))


def cameras_lines(cameras: DataFrame) -> DataFrame:
    """``cameras``: camera_id, model, width, height, params (array of doubles)."""
    n = F.explode(F.transform("params", lambda p, i: F.struct(i.alias("i"), p.alias("p"))))
    text = printed(cameras.select("camera_id", n.alias("e")).select("camera_id", F.col("e.i").alias("i"), F.col("e.p").alias("p")), "p")
    params = text.groupBy("camera_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "p"))), lambda s: s.p), " ").alias("text"))
    rows = cameras.join(params, "camera_id", "left")
    return _lines("cameras", rows, "camera_id", (), _joined("camera_id", "model", "width", "height", "text"), counts=_counted(cameras, "camera_id", None))


def rigs_lines(rigs: DataFrame) -> DataFrame:
    """``rigs``: rig_id, camera_id (its reference sensor)."""
    return _lines("rigs", rigs, "rig_id", (), _joined("rig_id", F.lit("1 CAMERA"), "camera_id"))


def frames_lines(images: DataFrame) -> DataFrame:
    """``images``: image_id, camera_id, frame_id, rig_id and the pose; in image order."""
    return _lines("frames", images.select("frame_id", "rig_id", *POSE, "camera_id", "image_id"), "image_id", POSE, _joined("frame_id", "rig_id", *POSE, F.lit("1 CAMERA"), "camera_id", "image_id"))


def images_lines(images: DataFrame, points: DataFrame | None = None) -> DataFrame:
    """Two lines an image, in image order: the pose, and its points. ``points``: image_id, idx, x, y, point3d_id (-1: none)."""
    rows = images.withColumn("text", F.lit(""))
    if points is not None:
        one = F.struct("idx", _joined("x", "y", "point3d_id").alias("t"))
        by = printed(points.select("image_id", "idx", F.col("x").cast("double"), F.col("y").cast("double"), "point3d_id"), "x", "y").groupBy("image_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(one)), lambda s: s.t), " ").alias("_t"))
        rows = images.join(by, "image_id", "left").withColumn("text", F.coalesce("_t", F.lit("")))
    rows = rows.select("image_id", *POSE, "camera_id", "name", "text")
    return _lines("images", rows, "image_id", POSE, _joined("image_id", *POSE, "camera_id", "name"), F.col("text"), counts=_counted(images, "image_id", points))


def points_lines(points: DataFrame, tracks: DataFrame) -> DataFrame:
    """``points``: point3d_id, x, y, z, r, g, b, error; ``tracks``: point3d_id, image_id, idx. A track is listed by image and index."""
    by = tracks.groupBy("point3d_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("image_id", "idx"))), lambda s: F.concat_ws(" ", s.image_id.cast("string"), s.idx.cast("string"))), " ").alias("text"))
    rows = points.select("point3d_id", "x", "y", "z", "r", "g", "b", "error").join(by, "point3d_id", "left")
    return _lines("points3D", rows, "point3d_id", ("x", "y", "z", "error"), _joined("point3d_id", "x", "y", "z", "r", "g", "b", "error", "text"), counts=_counted(points, "point3d_id", tracks))


def write_sparse_model(path: str, **lines: DataFrame) -> None:
    """cameras, rigs, frames, images, points3D, as the functions above give them, which is in order: each a folder of text parts under ``path``."""
    for name, rows in lines.items():
        if name not in HEADS:
            raise ValueError(f"no file is called {name}")
        write_lines(rows, f"{path}/{name}.txt")


def image_rig_rows(spark: SparkSession) -> DataFrame:
    """images, frame_data, frames and rigs (temporary views), one row per image."""
    return spark.sql(
        "SELECT i.image_id, i.name, i.camera_id, d.frame_id, f.rig_id, r.ref_sensor_id FROM images i JOIN frame_data d ON d.data_id = i.image_id "
        "JOIN frames f ON f.frame_id = d.frame_id JOIN rigs r ON r.rig_id = f.rig_id"
    )


def not_one_to_one(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one value: the functional dependency key -> value is broken there."""
    return rows.groupBy(key).agg(F.count_distinct(value).alias("n")).filter("n > 1")


def name_differences(seed: DataFrame, found: DataFrame) -> DataFrame:
    """Names of one side only, with the side."""
    from meshquilt.operators.selection import set_difference

    return set_difference(seed, found, "name")


def table_diagnostics(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """count(*), coalesce(sum(rows), 0) and count of rows > 0 of named queries; a query that fails gives nulls."""
    from pyspark.errors import PySparkException

    out = []
    for name, sql in tables.items():
        try:
            df = spark.sql(sql)
            has = "rows" in df.columns
            r = df.agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0)) if has else F.lit(None).cast("bigint"), F.count_if(F.col("rows") > 0) if has else F.lit(None).cast("bigint")).first()
            out.append((name, *r))
        except PySparkException:
            out.append((name, None, None, None))
    return spark.createDataFrame(out, "name string, n bigint, total bigint, positive bigint")


def batch_status(runs: DataFrame) -> DataFrame:
    """Latest state of every model and the tally by status."""
    last = runs.withColumn("_r", F.row_number().over(Window.partitionBy("model_id").orderBy(F.desc("at")))).filter("_r = 1")
    return last.groupBy("status").agg(F.count("*").alias("n"))


def reconstruction_rollup(rows: DataFrame) -> DataFrame:
    """Largest displacement and its model, fallback total, range. ``rows``: model_id, max_displacement, n_fallback."""
    return rows.agg(
        F.max("max_displacement").alias("max_displacement"), F.max_by("model_id", F.struct("max_displacement", -F.col("model_id"))).alias("max_model"), F.sum("n_fallback").alias("n_fallback"),
        F.min("max_displacement").alias("least_displacement"), F.count("*").alias("n"),
    )
