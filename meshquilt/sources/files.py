"""Readers and writers: OBJ and PLY text, NPZ and zip archives, metadata JSON, manifests, split lists, configuration."""

from __future__ import annotations

import io
import posixpath
import zipfile
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ID_KEYS = ("model_id", "modelId", "jid", "id", "uid")
LIST_KEYS = ("models", "model_info", "furniture", "data")


# ---- meshes ---------------------------------------------------------------------------------------------------


def read_obj(spark: SparkSession, *paths: str) -> tuple[DataFrame, DataFrame]:
    """(vertices, faces) of OBJ files; model_id is the path. Polygons become fans; negative indices count from the end;
    groups of one file are one mesh."""
    lines = spark.read.text([*paths], wholetext=True).select(F.col("_metadata.file_path").alias("model_id"), F.posexplode(F.split("value", r"\r?\n")).alias("line", "value"))
    parts = lines.select("model_id", "line", F.split(F.trim("value"), r"\s+").alias("f"))
    order = Window.partitionBy("model_id").orderBy("line")
    v = parts.filter(F.col("f")[0] == "v").select("model_id", (F.row_number().over(order) - 1).cast("bigint").alias("vid"), *(F.col("f")[i].cast("double").alias(k) for i, k in enumerate("xyz", 1)))
    n = v.groupBy("model_id").agg(F.count("*").alias("n"))
    f = parts.filter((F.col("f")[0] == "f") & (F.size("f") >= 4)).join(n, "model_id")
    index = F.transform(F.slice("f", 2, 1000), lambda s: F.split(s, "/")[0].cast("bigint"))
    f = f.select("model_id", "line", F.transform(index, lambda i: F.when(i > 0, i - 1).otherwise(F.col("n") + i)).alias("p"))
    fan = F.transform(F.sequence(F.lit(1), F.size("p") - 2), lambda k: F.struct(F.col("p")[0].alias("i0"), F.element_at("p", (k + 1).cast("int")).alias("i1"), F.element_at("p", (k + 2).cast("int")).alias("i2")))
    f = f.select("model_id", "line", F.posexplode(fan).alias("k", "t"))
    return v, f.select("model_id", (F.row_number().over(Window.partitionBy("model_id").orderBy("line", "k")) - 1).cast("bigint").alias("fid"), "t.*")


def obj_lines(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """model_id, kind, at, value: the text lines of OBJ files, to be ordered by kind and at."""
    v = vertices.select("model_id", F.lit(0).alias("kind"), F.col("vid").alias("at"), F.concat_ws(" ", F.lit("v"), *(F.col(k).cast("string") for k in "xyz")).alias("value"))
    f = faces.select("model_id", F.lit(1).alias("kind"), F.col("fid").alias("at"), F.concat_ws(" ", F.lit("f"), *((F.col(k) + 1).cast("string") for k in ("i0", "i1", "i2"))).alias("value"))
    return v.unionByName(f)


def write_obj(vertices: DataFrame, faces: DataFrame, path: str) -> None:
    """One folder model_id=... per model with its OBJ text (dense vertex ids from 0)."""
    lines = obj_lines(vertices, faces)
    lines.repartition("model_id").sortWithinPartitions("model_id", "kind", "at").select("model_id", "value").write.mode("overwrite").partitionBy("model_id").text(path)


def ply_lines(vertices: DataFrame, faces: DataFrame, colour: str | None = None) -> DataFrame:
    """model_id, kind, at, value of ASCII PLY files; ``colour`` names a scalar column of the vertices written as quality."""
    n = vertices.groupBy("model_id").agg(F.count("*").alias("nv")).join(faces.groupBy("model_id").agg(F.count("*").alias("nf")), "model_id", "left")
    head = ["ply", "format ascii 1.0", None, "property double x", "property double y", "property double z", *(["property double quality"] if colour else []), None, "property list uchar int vertex_indices", "end_header"]
    lines = [F.lit(h) for h in head]
    lines[2] = F.concat(F.lit("element vertex "), F.col("nv").cast("string"))
    lines[-3] = F.concat(F.lit("element face "), F.coalesce("nf", F.lit(0)).cast("string"))
    h = n.select("model_id", F.posexplode(F.array(*lines)).alias("at", "value")).select("model_id", F.lit(-1).alias("kind"), F.col("at").cast("bigint").alias("at"), "value")
    v = vertices.select("model_id", F.lit(0).alias("kind"), F.col("vid").alias("at"), F.concat_ws(" ", *(F.col(k).cast("string") for k in (*"xyz", *([colour] if colour else [])))).alias("value"))
    f = faces.select("model_id", F.lit(1).alias("kind"), F.col("fid").alias("at"), F.concat_ws(" ", F.lit("3"), *(F.col(k).cast("string") for k in ("i0", "i1", "i2"))).alias("value"))
    return h.unionByName(v).unionByName(f)


def read_npz(spark: SparkSession, path: str) -> DataFrame:
    """model_id (path), vertices and faces (arrays of arrays) of NPZ archives; one archive that cannot be read is a row with
    its error."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def rows(batches):
        for b in batches:
            for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    with np.load(io.BytesIO(c)) as z:
                        v, f = z["vertices"].astype(float).tolist(), z["faces"].astype(int).tolist()
                    row = {"model_id": [p], "vertices": [v], "faces": [f], "error": [None]}
                except Exception as e:  # noqa: BLE001  one archive's failure is data
                    row = {"model_id": [p], "vertices": [None], "faces": [None], "error": [str(e)]}
                yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("model_id", pa.string()), ("vertices", pa.list_(pa.list_(pa.float64()))), ("faces", pa.list_(pa.list_(pa.int64()))), ("error", pa.string())]))

    return files.mapInArrow(rows, "model_id string, vertices array<array<double>>, faces array<array<bigint>>, error string")


def long_form(packed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vertices, faces) from arrays of arrays."""
    v = packed.select("model_id", F.posexplode("vertices").alias("vid", "p")).select("model_id", F.col("vid").cast("bigint").alias("vid"), *(F.col("p")[i].alias(k) for i, k in enumerate("xyz")))
    f = packed.select("model_id", F.posexplode("faces").alias("fid", "t")).select("model_id", F.col("fid").cast("bigint").alias("fid"), *(F.col("t")[i].alias(f"i{i}") for i in range(3)))
    return v, f


def zip_members(spark: SparkSession, path: str, wanted: list[str]) -> DataFrame:
    """archive, member, content of the members whose full name, or else whose name's end, is wanted. Names that leave the
    archive's root are refused."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def rows(batches):
        for b in batches:
            for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with zipfile.ZipFile(io.BytesIO(c)) as z:
                    safe = [n for n in z.namelist() if not n.endswith("/") and not posixpath.isabs(n) and ".." not in n.split("/")]
                    for w in wanted:
                        hit = [n for n in safe if n == w] or [n for n in safe if n.endswith("/" + w)]
                        if hit:
                            yield pa.RecordBatch.from_pydict({"archive": [p], "member": [hit[0]], "content": [z.read(hit[0])]})

    return files.mapInArrow(rows, "archive string, member string, content binary")


# ---- records --------------------------------------------------------------------------------------------------


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """One row per entry of a metadata file: model_id (first alias that is not blank) and entry (JSON text). The file is a list
    or an object that holds the list under one of its usual names."""
    raw = spark.read.text(path, wholetext=True)
    lists = F.coalesce(F.from_json("value", "array<string>", {"mode": "PERMISSIVE"}), *(F.from_json(F.get_json_object("value", f"$.{k}"), "array<string>") for k in LIST_KEYS))
    out = raw.select(F.explode(lists).alias("entry"))
    return out.select(F.coalesce(*(F.nullif(F.trim(F.get_json_object("entry", f"$.{k}")), F.lit("")) for k in ID_KEYS)).alias("model_id"), "entry")


def write_manifest(rows: DataFrame, path: str, *order: str, kind: str = "csv") -> None:
    """A manifest in a stable order over its parts (one after another by name), columns sorted by name for JSON."""
    out = rows.orderBy(*order)
    if kind == "csv":
        out.write.mode("overwrite").option("header", True).csv(path)
    else:
        out.select(*sorted(out.columns)).write.mode("overwrite").json(path)


def write_splits(rows: DataFrame, path: str, id_column: str = "id") -> None:
    """split=<name> folders with one id a line, ordered."""
    rows.select("split", F.col(id_column).cast("string").alias("value")).repartition("split").sortWithinPartitions("split", "value").write.mode("overwrite").partitionBy("split").text(path)


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    """id, split; an id with two owners is an error."""
    rows = spark.read.text(path).select(F.trim("value").alias("id"), "split").filter("id <> ''")
    twice = [r["id"] for r in rows.groupBy("id").count().filter("count > 1").limit(10).collect()]
    if twice:
        raise ValueError(f"ids in several splits: {twice}")
    return rows


# ---- configuration --------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Stratum:
    name: str
    min_faces: int
    max_faces: int
    count: int


@dataclass(frozen=True)
class Config:
    """A corpus configuration with its defaults; ``total_models`` must be the strata's and the splits' sum."""

    strata: tuple[Stratum, ...] = ()
    splits: dict = field(default_factory=lambda: {"train": 40, "validation": 5, "test": 5})
    min_vertices: int = 1000
    min_faces: int = 2000
    max_faces: int = 200_000
    coarse_target_vertices: int = 3500
    coarse_min_vertices: int = 1000
    view_count: int = 14
    image_size: int = 128
    seed: int = 1949
    storage_format: str = "lazy_image_paths_v1"

    def __post_init__(self):
        if self.strata and sum(s.count for s in self.strata) != sum(self.splits.values()):
            raise ValueError("strata and splits ask for different totals")


def load_config(text: str) -> Config:
    """From YAML text; ``val`` is read as validation, unknown keys are errors."""
    import yaml

    raw = yaml.safe_load(text) or {}
    strata = tuple(Stratum(**s) for s in raw.pop("strata", ()))
    splits = {("validation" if k == "val" else k): int(v) for k, v in raw.pop("splits", Config().splits).items()}
    return Config(strata=strata, splits=splits, **raw)
