"""A Spark data source of mesh files: NPZ and OBJ, in folders and inside zip archives.

    register(spark)
    spark.read.format("meshfiles").option("part", "models" | "vertices" | "faces").load(path)
    packed.pack(vertices, faces).write.format("meshfiles").mode("overwrite").save(path)

Planning lists the files and reads of a zip archive only its directory of members; every model gets its ``scan_index``, its place in the
order of (path, member), and models are dealt to partitions by their sizes (``partitionBytes``). A task seeks to its own
members, so an archive of any size is read piece by piece. What is held whole is one model's file.

Where a folder or an archive has a ``model_info.json`` beside folders, the shallowest one is the root: models are the folders under it,
each with the first of ``MESH_NAMES`` that it holds, and named by their folder. Elsewhere every mesh file is a model, named
by its stem. A member whose name is absolute or climbs out of its archive is never opened; it is a model with an error, as is a file that cannot be read.

Paths are those of pyarrow's file systems (local or shared folders, hdfs, object stores).
"""

from __future__ import annotations

import io
import posixpath
import sys
import zipfile
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from meshquilt import schema
from meshquilt.kernels import packed
from meshquilt.sources.corpus import Mesh

NAME = "meshfiles"
#: The mesh files of a model's folder, the first one there is taken; the array names of NPZ files.
MESH_NAMES = ("raw_model.obj", "normalized_model.obj")
VERTEX_KEYS = ("vertices", "verts", "v")
FACE_KEYS = ("faces", "facets", "triangles", "f")
INFO = "model_info.json"
KINDS = (".npz", ".obj")
MODELS = "model_id bigint, model_key string, path string, member string, bytes bigint, n_vertices bigint, n_faces bigint, error string"
SCHEMAS = {"models": MODELS, "vertices": schema.VERTICES, "faces": schema.FACES}
CHUNK = 1 << 16


@dataclass(frozen=True)
class Model:
    scan_index: int
    key: str
    path: str
    member: str | None
    size: int
    error: str | None = None


@dataclass
class Models(InputPartition):
    models: list[Model]


@dataclass
class Written(WriterCommitMessage):
    models: int


def opened(uri: str):
    """(file system, path) of a URI or a local path."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def unsafe(name: str) -> bool:
    return posixpath.isabs(name) or "\\" in name or ".." in name.split("/") or ":" in name.split("/")[0]


def root_of(names: list[str]) -> str | None:
    """The folder of the shallowest model_info.json that has folders beside it."""
    homes = sorted((posixpath.dirname(n) for n in names if posixpath.basename(n) == INFO), key=lambda d: (d.count("/") if d else -1, len(d), d))
    for home in homes:
        inside = f"{home}/" if home else ""
        if any(n.startswith(inside) and "/" in n[len(inside) :] for n in names):
            return home
    return None


def chosen(sizes: dict[str, int]) -> list[tuple[str, str]]:
    """(key, name) of the models among the names of one folder tree or archive."""
    meshes = [n for n in sizes if n.lower().endswith(KINDS)]
    root = root_of([*sizes])
    if root is None:
        return sorted((posixpath.splitext(posixpath.basename(n))[0], n) for n in meshes)
    found: dict[str, str] = {}
    for n in meshes:
        home, base = posixpath.split(n)
        if base in MESH_NAMES and posixpath.dirname(home) == root and (home not in found or MESH_NAMES.index(base) < MESH_NAMES.index(posixpath.basename(found[home]))):
            found[home] = n
    return sorted((posixpath.basename(home), n) for home, n in found.items())


def members(uri: str) -> tuple[list[tuple[str, str, int]], list[str]]:
    """(key, member, bytes) of an archive's models, and the names that are refused. Only the directory at its end is read."""
    fs, path = opened(uri)
    with fs.open_input_file(path) as f, zipfile.ZipFile(f) as z:
        sizes = {i.filename: i.file_size for i in z.infolist() if not i.is_dir()}
    bad = sorted(n for n in sizes if unsafe(n))
    good = {n: s for n, s in sizes.items() if n not in bad}
    return [(key, n, good[n]) for key, n in chosen(good)], bad


def discovered(uri: str) -> list[Model]:
    """The models under a folder, or of one file, in scan order."""
    fs, path = opened(uri)
    prefix = uri[: len(uri) - len(path)] if uri.endswith(path) else ""
    info = fs.get_file_info(path)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(uri)
    files = {path: info.size} if info.type == pafs.FileType.File else {i.path: i.size for i in fs.get_file_info(pafs.FileSelector(path, recursive=True)) if i.type == pafs.FileType.File}
    base = posixpath.dirname(path) if info.type == pafs.FileType.File else path.rstrip("/")
    inner = {p[len(base) :].lstrip("/"): s for p, s in files.items()}
    out = [(f"{base}/{n}", None, key, inner[n], None) for key, n in chosen(inner)]
    zips = sorted(p for p in files if p.lower().endswith(".zip"))

    def listed(p):
        try:
            good, bad = members(prefix + p)
        except Exception as e:  # noqa: BLE001  one archive's failure is data
            return [(p, None, posixpath.basename(p), files[p], f"{type(e).__name__}: {e}")]
        return [(p, n, key, size, None) for key, n, size in good] + [(p, n, posixpath.basename(n), 0, "unsafe member name") for n in bad]

    with ThreadPoolExecutor(16) as pool:
        for found in pool.map(listed, zips):
            out += found
    out.sort(key=lambda m: (m[0], m[1] or ""))
    return [Model(i, key, prefix + p, member, size, error) for i, (p, member, key, size, error) in enumerate(out)]


def content(model: Model):
    """A readable of the model's file."""
    fs, path = opened(model.path)
    f = fs.open_input_file(path)
    if model.member is None:
        return f
    with f, zipfile.ZipFile(f) as z:
        return io.BytesIO(z.read(model.member))


def _three(a, kind) -> np.ndarray:
    a = np.asarray(a)
    if a.ndim != 2 or a.shape[1] != 3:
        raise ValueError(f"array of shape {a.shape}")
    return a.astype(kind)


def parsed(model: Model, want: tuple[str, ...] = ("vertices", "faces")) -> dict[str, np.ndarray]:
    """The wanted arrays of a model. Of an NPZ file only these are read."""
    with content(model) as f:
        if (model.member or model.path).lower().endswith(".npz"):
            out = {}
            with np.load(f if f.seekable() else io.BytesIO(f.read())) as z:
                for name, keys, kind in (("vertices", VERTEX_KEYS, float), ("faces", FACE_KEYS, np.int64)):
                    key = next((k for k in keys if k in z.files), None)
                    if key is None:
                        raise ValueError(f"no {name} among {sorted(z.files)}")
                    if name in want:
                        out[name] = _three(z[key], kind)
            return out
        v, t = [], []
        for line in io.TextIOWrapper(io.BufferedReader(f) if not isinstance(f, io.BytesIO) else f, "utf-8", errors="replace"):
            part = line.split()
            if not part:
                continue
            if part[0] == "v":
                v.append([float(x) for x in part[1:4]])
            elif part[0] == "f" and len(part) > 3:
                at = [int(x.split("/")[0]) for x in part[1:]]
                at = [i - 1 if i > 0 else len(v) + i for i in at]
                t += [[at[0], b, c] for b, c in zip(at[1:], at[2:], strict=False)]
        both = {"vertices": _three(np.array(v, float).reshape(-1, 3), float), "faces": _three(np.array(t, np.int64).reshape(-1, 3), np.int64)}
        return {k: both[k] for k in want}


class Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.part, self.bytes = options["path"], options.get("part", "models"), int(options.get("partitionbytes", options.get("partitionBytes", 64 << 20)))

    def partitions(self):
        out, now, held = [], [], 0
        for m in discovered(self.path):
            if now and held + m.size > self.bytes:
                out.append(Models(now))
                now, held = [], 0
            now.append(m)
            held += m.size + 4096
        return [*out, Models(now)]

    def read(self, partition):
        for m in partition.models:
            if self.part == "models":
                n, error = [None, None], m.error
                if error is None:
                    try:
                        n = [len(a) for a in parsed(m).values()]
                    except Exception as e:  # noqa: BLE001  one model's failure is data
                        error = f"candidate_load_failure: {type(e).__name__}: {e}"
                yield (m.scan_index, m.key, m.path, m.member, m.size, *n, error)
                continue
            if m.error is not None:
                continue
            try:
                both = parsed(m) if not m.path.lower().endswith(".npz") else parsed(m, (self.part,))
            except Exception:  # noqa: BLE001  it is reported among the models
                continue
            a = both[self.part]
            names = ["model_id", "vid", "x", "y", "z"] if self.part == "vertices" else ["model_id", "fid", "i0", "i1", "i2"]
            for i in range(0, len(a), CHUNK):
                piece = a[i : i + CHUNK]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(piece), m.scan_index)), pa.array(np.arange(i, i + len(piece))), *(pa.array(np.ascontiguousarray(piece[:, k])) for k in range(3))], names)


class Writer(DataSourceArrowWriter):
    """One NPZ file a model, named by its id; a task that runs again writes the same files."""

    def __init__(self, uri: str, overwrite: bool):
        self.uri = uri
        fs, path = opened(uri)
        fs.create_dir(path, recursive=True)
        if overwrite:
            fs.delete_dir_contents(path)

    def write(self, batches):
        fs, path = opened(self.uri)
        n = 0
        for b in batches:
            for i in range(b.num_rows):
                model, _, v, _, f = packed.arrays(b, i)
                out = io.BytesIO()
                np.savez_compressed(out, vertices=v, faces=f)
                with fs.open_output_stream(f"{path}/{model}.npz") as to:
                    to.write(out.getvalue())
                n += 1
        return Written(n)


class MeshFiles(DataSource):
    @classmethod
    def name(cls):
        return NAME

    def schema(self):
        return SCHEMAS[self.options.get("part", "models")]

    def reader(self, schema):
        return Reader(self.options)

    def writer(self, schema, overwrite):
        return Writer(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(MeshFiles)


def corpus(spark: SparkSession, path: str, **options) -> tuple[Mesh, DataFrame]:
    """(mesh, models) of the files under ``path``: what every operator takes, with model_id the scan index; and a row for each
    model, also those that cannot be read."""
    register(spark)
    parts = [spark.read.format(NAME).options(part=p, **options).load(path) for p in ("vertices", "faces", "models")]
    return Mesh(*parts[:2]), parts[2]


def save(mesh: Mesh, path: str) -> None:
    """One NPZ file for each model."""
    rows = packed.pack(mesh.vertices, mesh.faces)
    register(rows.sparkSession)
    rows.write.format(NAME).mode("overwrite").save(path)


def keyed(df: DataFrame, models: DataFrame) -> DataFrame:
    """``df`` with the model's key as a number in place of its scan index."""
    key = models.select("model_id", F.col("model_key").cast("bigint").alias("_key"))
    return df.join(key, "model_id").withColumn("model_id", F.col("_key")).drop("_key")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
