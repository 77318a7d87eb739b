"""Exact deduplication and centroid clustering: brute force, small tables, edge cases."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meshquilt.llm import centroid_clustering as clustering
from meshquilt.llm import exact_dedup


def brute_groups(rows):
    by = {}
    for i, t in rows:
        by.setdefault(t or "", []).append(i)
    out = []
    for t, ids in by.items():
        known = [i for i in ids if i is not None]
        keep, sha = (max(known) if known else None), hashlib.sha256(t.encode()).hexdigest()
        stays = ids.index(keep)
        out += [(i, keep, len(ids), at == stays, sha) for at, i in enumerate(ids)]
    return sorted(out, key=str)


def found(df):
    return sorted(((r["row"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in df.collect()), key=str)


def texts(n, seed):
    rng = random.Random(seed)
    pool = [None, "", " ", "a", "é日", "x" * 40000, *(f"text {i} " * rng.randrange(1, 9) for i in range(n // 6))]
    out = [(rng.choice([None, *range(n)]), rng.choice(pool)) for _ in range(n)] + [(n + i, "hot") for i in range(n // 2)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"bytes_": 4000, "rows_": 7, "buckets_": 3},  # tables overflow, buckets are partitioned again
        {"bytes_": 500, "rows_": 2, "buckets_": 1, "depth": 1},  # nothing ever fits: the last level goes hash by hash
        {"bytes_": 3000, "rows_": 5, "buckets_": 2, "hashed": lambda text, level: F.length(text).cast("long") % 3},  # contents decide, not hashes
    ],
)
def test_groups_equal_brute_force(spark, options):
    rows = texts(240, 5)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(exact_dedup.groups(df, **options)) == brute_groups(rows)


def test_dedup_keeps_columns_and_one_row_of_repeated_ids(spark):
    rows = [(7, "same", "p", 1), (7, "same", "q", 2), (3, "same", "r", 3), (None, None, None, None), (None, "", "s", 5), (1, "other", "t", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, keep long")
    got = exact_dedup.deduplicated(df)
    assert got.columns == df.columns
    out = [tuple(r) for r in got.collect()]
    assert len(out) == 3 and sum(r[0] == 7 for r in out) == 1 and (1, "other", "t", 6) in out and set(out) <= set(rows)


def test_dedup_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.groups(df).count() == 0 and exact_dedup.deduplicated(df).columns == ["doc_id", "text"]


def test_open_table_survives_equal_slots():
    table = exact_dedup.OpenTable(4)
    names = [table.add(5 << 40, b"%d" % (i % 50)) for i in range(200)]
    assert names == [i % 50 for i in range(200)]


# ---- clustering -----------------------------------------------------------------------------------------------


def brute_clusters(rows, dims, k, rounds, seed=1):
    use = [(i, [math.floor(64 * x) if abs(x) < 2**53 else int(x) * 64 for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    c = [v for _, _, v in sorted((hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest(), n, v) for n, (i, v) in enumerate(sorted(use, key=lambda r: r[1])))][:k]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), j) for j, m in enumerate(c))
    for _ in range(rounds):
        to = [near(v)[1] for _, v in use]
        for j in range(len(c)):
            mine = [v for (_, v), t in zip(use, to, strict=True) if t == j]
            if mine:
                c[j] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    last = [(i, *near(v)[::-1]) for i, v in use]
    cap = lambda x: min(x, 2**63 - 1)
    by, sha = [sum(d for _, t, d in last if t == j) for j in range(len(c))], [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return sorted(((i, t, cap(d), cap(by[t]), cap(sum(by)), sha[t]) for i, t, d in last), key=str)


def check(spark, rows, dims, k, rounds=3):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3).withColumn("cluster", F.lit("x"))
    got = sorted((tuple(r) for r in clustering.clustered(df, k=k, rounds=rounds, dims=dims).collect()), key=str)
    assert got == brute_clusters(rows, dims, k, rounds)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_clusters_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(i % 7, 0.3) for _ in range(4)]) for i in range(300)]
    check(spark, rows, 4, 9, rounds=5)


def test_ties_copies_and_rows_that_take_no_part(spark):
    grid = [(10 * a + b, [a / 64, b / 64]) for a in range(9) for b in range(9)]  # many vectors lie between two centroids
    bad = [(900, None), (901, []), (902, [1.0]), (903, [1.0, None]), (904, [float("nan"), 1.0]), (905, [float("inf"), 0.0])]
    check(spark, grid + grid[:20] + [(None, [0.5, 0.5]), (None, [0.0, 0.0])] + bad, 2, 8)


def test_huge_components(spark):
    rng = random.Random(4)
    check(spark, [(i, [rng.choice([1e300, -1e18, 3.0, 0.25]) * rng.random() for _ in range(3)]) for i in range(40)], 3, 4)
    check(spark, [(i, [rng.uniform(-6e8, 6e8) for _ in range(2)]) for i in range(60)], 2, 5)


def test_few_or_no_vectors(spark):
    check(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])], 2, 16)
    check(spark, [(1, [1.0, 2.0])], 2, 1)
    df = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert clustering.clustered(df).count() == 0 and clustering.clustered(df).columns[0] == "vec_id"


def test_search_scans_few_centroids_and_bounds_hold():
    rng = np.random.default_rng(3)
    at = rng.integers(-4000, 4000, (64, 3))
    v = at[rng.integers(0, 64, 4000)] + rng.integers(-300, 300, (4000, 3))
    c = clustering.Centroids.of([[int(x) for x in row] for row in at])
    *state, every = clustering.assign(v, c, None)
    moved = clustering.Centroids.of([[int(x) for x in row] for row in at + rng.integers(-60, 60, at.shape)], c)
    a, u, low, made = clustering.assign(v, moved, tuple(state))
    d = clustering.distances(v, moved.at)
    assert (a == d.argmin(axis=1)).all() and made < every / 4
    own, rest = np.sqrt(d[np.arange(len(v)), a]), d.copy()
    rest[np.arange(len(v)), a] = rest.max()
    assert (u >= own).all() and (low <= np.sqrt(rest.min(axis=1))).all()


# ---- long blank runs, repeated labels ---------------------------------------------------------------------------


@pytest.mark.parametrize("text", ["abc" + " " * 2_000_000 + "def", "\n" * 2_000_000, "a \t" + " \n" * 500_000 + " b", (" " * 65_000 + "x") * 30], ids=["blanks", "newlines", "mixed", "runs"])
def test_long_blank_runs_get_the_ids_of_the_library(text):
    from tokenizers import Tokenizer

    from meshquilt.llm import packing

    path = packing.tokenizer_path()
    assert packing.encoder(path).ids(text) == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_long_blank_runs_are_packed(spark):
    from meshquilt.llm import packing

    d = spark.createDataFrame([(1, "abc" + " " * 2_000_000 + "def"), (None, "\n" * 1_500_000), (3, "word")], "doc_id long, text string")
    got = packing.pack(d, packing.tokenizer_path()).collect()
    ids = len(packing.encoder(packing.tokenizer_path()).ids("abc" + " " * 2_000_000 + "def"))
    assert sum(r["length"] for r in got if r["doc_id"] == 1) == ids + 1 and sum(r["length"] for r in got if r["doc_id"] is None) > 0


def test_the_labelled_sample_is_bounded_whatever_repeats(spark, tmp_path):
    from meshquilt.llm import shared

    for hot in (2, 3, 7, 11, 13):
        rows = spark.range(200_000).select(F.when(F.col("id") % 4 > 0, hot).otherwise(F.col("id")).alias("doc_id"))
        some = shared.stored(shared.drawn(shared.stored(rows, f"file://{tmp_path}/{hot}"), 200_000, 20_000, "doc_id"), f"file://{tmp_path}/{hot}-drawn")
        n, same = some.count(), some.filter(F.col("doc_id") == hot).count()
        assert 17_000 < n <= 20_000 and 0.7 * n < same < 0.8 * n


def test_repeated_ids_in_labels_and_documents(spark, monkeypatch):
    from meshquilt.llm import quality_classifier, toxicity

    rng = random.Random(2)
    text = lambda bad: " ".join(rng.choice(["vile", "scum", "awful"] if bad and rng.random() < 0.5 else ["plain", "kind", "stone", "river"]) for _ in range(40))
    rows = [(i, text(i % 2)) for i in range(400)] + [(7, text(1)) for _ in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(400)] + [(7, 1, 1)] * 3000 + [(None, 1, 1)], "doc_id long, toxic int, quality int")
    monkeypatch.setattr(quality_classifier, "FIT_ROWS", 200)
    monkeypatch.setattr(toxicity, "FIT_ROWS", 200)
    trained = []
    real = quality_classifier.Network.train
    monkeypatch.setattr(quality_classifier.Network, "train", lambda self, x, y: (trained.append(len(x)), real(self, x, y))[1])
    vectors, network = quality_classifier.learn(docs, labels.select("doc_id", F.col("quality").alias("label")))
    assert 50 < trained[0] <= 260
    got = quality_classifier.score(docs.limit(400), vectors, network, "doc_id").collect()
    assert len(got) == 400 and all(0 <= r["score"] <= 1 for r in got)
    joined = toxicity.labelled(docs, labels)
    assert joined.count() <= len(rows)  # a label that is given 3,001 times counts once
    scored = toxicity.score(docs, toxicity.learn(joined), "doc_id").collect()
    right = sum((r["score"] >= 0.5) == bool(r["doc_id"] % 2) for r in scored)
    assert right > 0.9 * len(scored)
