"""The two jobs: growing input, reruns, failures, command line."""

import hashlib
import json
import logging
import os
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from jobs import catalogue, common, prepare_targets
from meshquilt.operators import geometry as G
from meshquilt.operators import topology as T
from meshquilt.sources.corpus import orders_mesh

WORD = re.compile(catalogue.WORD)


def rows_of(df, *drop):
    return sorted((tuple(r) for r in df.drop(*drop).collect()), key=str)


def split_of(key, seed, validation, test):
    place = int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:8], 16) % 10_000
    return "validation" if place < validation * 10_000 else "test" if place < (validation + test) * 10_000 else "train"


# ---- catalogue ------------------------------------------------------------------------------------------------

CONFIG = catalogue.Config(min_words=3, max_words=40, validation=0.3, test=0.3)
FIRST = [
    (1, "a fine leather sofa for three", "en", "shop"), (2, "A Sectional couch with a chaise", "en", "shop"), (3, None, "en", "shop"), (4, "two", "de", "web"), (5, "some loveseat of one maker", "en", None),
    (6, "word " * 60, None, "web"), (1, "a fine leather sofa for three", "en", "shop"), (None, "an unnamed settee stands here", "en", "web"),
]
SECOND = [(1, "a fine leather sofa for three", "en", "shop"), (1, "a fine leather sofa, revised text", "en", "shop"), (7, "a fine leather sofa for three", "de", "web"), (None, "an unnamed settee stands here", "en", "web"), (8, "", "en", "web")]


def brute(rows):
    out = {}
    for i, t, lang, source in rows:
        t = t or ""
        n, low = len(WORD.findall(t)), t.lower()
        digest = hashlib.sha256(t.encode()).hexdigest()
        bad = any(w in low for w in catalogue.S.EXCLUDED)
        reason = "empty_description" if not n else "too_short" if n < 3 else "too_long" if n > 40 else "excluded_sofa_subtype_keyword" if bad else "unknown_source" if source is None else None
        wanted = any(w in low for w in catalogue.S.SOFA_WORDS) and "sofastool" not in low
        out.setdefault((i, digest), (i, lang, source, digest, n, wanted, any(w in low for w in catalogue.S.PREFERRED), "short" if n else "out_of_range", reason, split_of(digest, 1949, 0.3, 0.3)))
    return sorted(out.values(), key=str)


def land(spark, rows, folder):
    spark.createDataFrame(rows, catalogue.TAKEN).withColumn("other", F.lit(1)).coalesce(1).write.mode("append").parquet(folder)


def test_two_runs_over_growing_input(spark, tmp_path, caplog):
    src, out, mark = (f"file://{tmp_path}/{n}" for n in ("in", "out", "mark"))
    land(spark, FIRST, src)
    ledger, _ = catalogue.run(spark, src, out, mark, CONFIG)
    assert rows_of(ledger, "batch") == brute(FIRST)
    land(spark, SECOND, src)
    with caplog.at_level(logging.INFO, "meshquilt.jobs"):
        ledger, summary = catalogue.run(spark, src, out, mark, CONFIG)
    assert rows_of(ledger, "batch") == brute(FIRST + SECOND)
    assert "wrote 3 rows of batch 1" in caplog.text and f"read {len(SECOND)} new rows" in caplog.text  # only what is new
    assert {r["batch"] for r in ledger.collect()} == {0, 1}
    assert summary.agg(F.sum("n")).first()[0] == len(brute(FIRST + SECOND))
    assert ledger.groupBy("digest").agg(F.count_distinct("split").alias("n")).filter("n > 1").isEmpty()  # copies never part
    before = rows_of(ledger)
    ledger, _ = catalogue.run(spark, src, out, mark, CONFIG)  # nothing new
    assert rows_of(ledger) == before


def test_a_batch_that_is_run_again_adds_nothing(spark, tmp_path):
    src, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    land(spark, FIRST, src)
    ledger, _ = catalogue.run(spark, src, out, f"file://{tmp_path}/mark", CONFIG)
    before = rows_of(ledger)
    for _ in range(2):
        catalogue.take(spark.createDataFrame(FIRST, catalogue.TAKEN), 0, f"{out}/ledger", CONFIG)
    assert rows_of(spark.read.schema(catalogue.LEDGER).parquet(f"{out}/ledger")) == before
    land(spark, SECOND, src)
    ledger, _ = catalogue.run(spark, src, out, f"file://{tmp_path}/mark", CONFIG)
    before = rows_of(ledger, "batch")
    ledger, _ = catalogue.run(spark, src, out, f"file://{tmp_path}/lost-mark", CONFIG)  # a lost checkpoint: all files come again as batch 0
    assert rows_of(ledger, "batch") == before == brute(FIRST + SECOND)


def test_a_batch_that_fails_is_taken_whole_by_the_next_run(spark, tmp_path, monkeypatch):
    src, out, mark = (f"file://{tmp_path}/{n}" for n in ("in", "out", "mark"))
    land(spark, FIRST, src)
    real = common.write

    def fails(*a, **k):
        real(*a, **k)
        raise RuntimeError("lost after the write")

    monkeypatch.setattr(common, "write", fails)
    with pytest.raises(Exception, match="lost after the write"):
        catalogue.run(spark, src, out, mark, CONFIG)
    monkeypatch.setattr(common, "write", real)
    ledger, _ = catalogue.run(spark, src, out, mark, CONFIG)
    assert rows_of(ledger, "batch") == brute(FIRST)


def test_catalogue_of_empty_input(spark, tmp_path):
    src = f"file://{tmp_path}/in"
    land(spark, [], src)
    ledger, summary = catalogue.run(spark, src, f"file://{tmp_path}/out", f"file://{tmp_path}/mark")
    assert ledger.isEmpty() and summary.isEmpty()


# ---- targets --------------------------------------------------------------------------------------------------


def test_targets_twice_and_by_configuration(spark, sf, tmp_path, caplog):
    caplog.set_level(logging.INFO, "meshquilt.jobs")
    out = f"file://{tmp_path}/out"
    config = prepare_targets.Config(min_vertices=10, min_faces=10, validation=0.3, test=0.2)
    manifest, targets = prepare_targets.run(spark, sf, out, config)
    first = rows_of(manifest), rows_of(targets)
    assert f"read {len(first[0])} models of {len(first[1])} vertices" in caplog.text and f"wrote {len(first[1])} rows of targets" in caplog.text
    manifest, targets = prepare_targets.run(spark, sf, out, config)
    assert (rows_of(manifest), rows_of(targets)) == first
    strict, none = prepare_targets.run(spark, sf, out, prepare_targets.Config(min_vertices=10**6))
    assert none.isEmpty() and {r["reason"] for r in strict.collect()} == {"below_minimum_complexity"}
    assert rows_of(spark.read.parquet(f"{out}/targets/config={common.config_name(config)}")) == sorted(first[1], key=str)  # the other one's are still there
    mesh = orders_mesh(spark, sf)
    lap = {(r["model_id"], r["vid"]): r["lz"] for r in G.laplacian(mesh.vertices, T.unique_edges(mesh.faces)).collect()}
    got = targets.collect()
    assert len(got) == len(lap) and all(abs(r["lz"] - lap[r["model_id"], r["vid"]]) < 1e-12 for r in got)
    assert all(r["split"] == split_of(r["model_id"], 1949, 0.3, 0.2) for r in manifest.collect())


def test_configuration_and_command_line(spark, tmp_path):
    folder = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    assert common.configured(spark, catalogue.Config, f"file://{folder}/jobs/catalogue.json") == catalogue.Config()
    assert common.configured(spark, prepare_targets.Config, f"file://{folder}/jobs/prepare_targets.json") == prepare_targets.Config()
    (tmp_path / "bad.json").write_text(json.dumps({"no_such": 1}))
    with pytest.raises(TypeError):
        common.configured(spark, catalogue.Config, f"file://{tmp_path}/bad.json")
    land(spark, FIRST, f"file://{tmp_path}/in")
    done = subprocess.run(
        [sys.executable, "-m", "jobs.catalogue", "--descriptions", f"{tmp_path}/in", "--output", f"{tmp_path}/out", "--checkpoint", f"{tmp_path}/mark", "--config", f"{folder}/jobs/catalogue.json"],
        cwd=folder, env=os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] pyspark-shell"}, capture_output=True, text=True, timeout=240,
    )
    assert done.returncode == 0 and f"read {len(FIRST)} new rows" in done.stderr, done.stderr[-2000:]
    assert len(spark.read.parquet(f"file://{tmp_path}/out/ledger").collect()) == len(brute(FIRST))
