"""The data source of mesh files: folders, archives, roots, failures, partitions."""

import io
import zipfile

import numpy as np
import pytest

from meshquilt.operators import geometry as G
from meshquilt.plans import queries as Q
from meshquilt.sources import meshfiles as MF
from meshquilt.sources.corpus import Mesh, orders_mesh

V = np.array([[0.0, 0, 0], [1, 0, 0], [0, 1, 0], [1, 1, 0.5]])
F = np.array([[0, 1, 2], [1, 3, 2]])
OBJ = "# text\no first\nv 0 0 0\nv 1 0 0\nv 0 1 0\ng second\nv 1 1 0.5\nf 1/1 2/2 4/3 3/4\nf -4 -3 -2\n"


def npz(v=V, f=F, **names):
    out = io.BytesIO()
    np.savez(out, **(names or {"verts": v, "facets": f}))
    return out.getvalue()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def zipped(path, entries):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in entries.items():
            z.writestr(name, data)


def test_folders_archives_and_failures(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.npz").write_bytes(npz())
    (tmp_path / "a" / "two.obj").write_text(OBJ)
    (tmp_path / "a" / "broken.npz").write_bytes(b"no archive")
    (tmp_path / "a" / "flat.npz").write_bytes(npz(vertices=np.zeros(5), faces=F))
    (tmp_path / "bad.zip").write_bytes(b"PK nothing")
    zipped(tmp_path / "more.zip", {"x/three.npz": npz(), "../out.npz": npz(), "/abs.obj": OBJ, "notes.txt": "-"})
    mesh, models = MF.corpus(spark, f"file://{tmp_path}")
    got = {r["model_key"]: r for r in models.collect()}
    assert sorted(r["model_id"] for r in got.values()) == list(range(8))
    assert {k for k, r in got.items() if r["error"] is None} == {"one", "two", "three"}
    assert got["out.npz"]["error"] == got["abs.obj"]["error"] == "unsafe member name" and "load_failure" in got["broken"]["error"] and "shape" in got["flat"]["error"]
    assert (got["two"]["n_vertices"], got["two"]["n_faces"]) == (4, 3) and got["three"]["member"] == "x/three.npz"
    one, two = got["one"]["model_id"], got["two"]["model_id"]
    assert rows(mesh.vertices.filter(f"model_id = {one}")) == sorted(((one, i, *map(float, p)) for i, p in enumerate(V)), key=str)
    assert [r[2:] for r in rows(mesh.faces.filter(f"model_id = {two}"))] == [(0, 1, 3), (0, 3, 2), (0, 1, 2)]
    assert {r["model_id"] for r in mesh.vertices.select("model_id").distinct().collect()} == {got[k]["model_id"] for k in ("one", "two", "three")}


def test_root_is_found_by_its_contents(spark, tmp_path):
    entries = {"top/set/model_info.json": "[]", "top/set/m1/raw_model.obj": OBJ, "top/set/m1/normalized_model.obj": "v 0 0 0", "top/set/m2/normalized_model.obj": OBJ, "top/set/m2/deep/raw_model.obj": "v 9 9 9", "top/other.obj": OBJ, "top/set/m1/sub/model_info.json": "[]"}
    zipped(tmp_path / "set.zip", entries)
    _, models = MF.corpus(spark, f"{tmp_path}/set.zip")
    assert [(r["model_key"], r["member"], r["n_vertices"]) for r in models.orderBy("model_id").collect()] == [("m1", "top/set/m1/raw_model.obj", 4), ("m2", "top/set/m2/normalized_model.obj", 4)]
    for name, text in entries.items():
        p = tmp_path / "tree" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    _, models = MF.corpus(spark, f"file://{tmp_path}/tree")
    assert sorted(r["model_key"] for r in models.collect()) == ["m1", "m2"]
    assert MF.root_of(["model_info.json", "a/b.obj"]) == "" and MF.root_of(["x/model_info.json"]) is None


def test_planning_reads_the_directory_of_members_only(tmp_path, monkeypatch):
    big = np.random.default_rng(1).bytes(1 << 22)
    zipped(tmp_path / "big.zip", {f"m{i}.npz": big for i in range(4)})
    read = []
    real = MF.opened

    def counting(uri):
        fs, path = real(uri)

        class Fs:
            def __getattr__(self, name):
                return getattr(fs, name)

            def open_input_file(self, p):
                f = fs.open_input_file(p)

                class File(io.RawIOBase):
                    seekable = lambda self: True
                    readable = lambda self: True
                    seek = lambda self, *a: f.seek(*a)
                    tell = lambda self: f.tell()

                    def read(self, n=-1):
                        data = f.read(n if n >= 0 else None)
                        read.append(len(data))
                        return data

                return File()

        return Fs(), path

    monkeypatch.setattr(MF, "opened", counting)
    plan = MF.Reader({"path": str(tmp_path), "partitionBytes": str(5 << 20)}).partitions()
    assert [len(p.models) for p in plan] == [1, 1, 1, 1] and sum(read) < 1 << 17
    read.clear()
    MF.content(plan[2].models[0])
    assert sum(read) < 3 * (1 << 21) + (1 << 17)  # one member of four


def test_empty_folder_and_missing_path(spark, tmp_path):
    mesh, models = MF.corpus(spark, str(tmp_path))
    assert mesh.vertices.count() == mesh.faces.count() == models.count() == 0
    with pytest.raises(Exception, match="nothing_here"):
        MF.corpus(spark, f"{tmp_path}/nothing_here")[1].collect()


def test_files_feed_the_operators(spark, sf, tmp_path, monkeypatch):
    """Written by the sink and read by the source, the corpus gives every query the results of the table it comes from."""
    from meshquilt.sources.scratch import stored

    made = orders_mesh(spark, sf)
    for _ in range(2):  # again: the same files
        MF.save(made, f"file://{tmp_path}/npz")
    files, models = MF.corpus(spark, f"file://{tmp_path}/npz")
    assert models.filter("error IS NOT NULL").isEmpty() and models.count() == 5
    back = Mesh(*(stored(MF.keyed(df, models).select(*own.columns), f"file://{tmp_path}/{n}") for n, df, own in (("v", files.vertices, made.vertices), ("f", files.faces, made.faces))))
    names = ["unique_edges", "mesh_metrics", "represented_area", "laplacian", "edge_scale", "normals_and_variation", "shape_descriptor"]
    want = {n: rows(Q.QUERIES[n](spark, sf)) for n in names}
    monkeypatch.setattr(Q, "orders_mesh", lambda *_: back)
    assert {n: rows(Q.QUERIES[n](spark, sf)) for n in names} == want
    own, other = (rows(G.face_areas(m.faces, m.vertices).drop("fid")) for m in (made, back))  # files number their faces from 0
    assert own == other
