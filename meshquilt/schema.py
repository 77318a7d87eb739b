"""Long-form schemas: the single source of column names and types."""

VERTICES = "model_id bigint, vid bigint, x double, y double, z double"
FACES = "model_id bigint, fid bigint, i0 bigint, i1 bigint, i2 bigint"
EDGES = "model_id bigint, u bigint, w bigint"
CAMERAS = "model_id bigint, view_id int, name string, k array<double>, r array<double>, t array<double>, width int, height int"
CANDIDATES = (
    "file_id bigint, thing_id bigint, license string, author string, category string, tags string, source_variant string, "
    "orig_vertices int, orig_faces int, open_closed string, stratum string, scan_index bigint"
)
SPLITS = "model_id string, split string"
SPLIT_ORDER = ("train", "validation", "test")
