"""Jaccard join, packing, mixing, top-k search, pipeline: brute force and edge cases."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meshquilt.llm import jaccard_join, mixing, packing, quality_rules, shared, topk_search, toxicity
from test_text_operators import DOCS, ODD, WORD, docs

SF = "/root/testdata/sf0.001"


# ---- Jaccard join ---------------------------------------------------------------------------------------------


def shingle_set(text):
    ws = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(ws[i : i + 5]) for i in range(len(ws) - 4)) if len(ws) >= 5 else frozenset([tuple(ws)] if ws else [])


def brute(rows):
    ids, sets = [i for i, _ in rows], [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    by = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            by[x].append(k)
    for k, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in by[x] if j < k).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                root[find(k)] = find(j)
    least = defaultdict(lambda: 1 << 60)
    for k, i in enumerate(ids):
        least[find(k)] = min(least[find(k)], i)
    return sorted((i, len(s), least[find(k)] if s else i) for k, (i, s) in enumerate(zip(ids, sets, strict=True)))


def joined(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.join(df).collect())


def near_copies(rng, sizes=(3, 12, 40, 90, 200, 600), copies=6):
    out = []
    for n in sizes:
        base = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        for c in range(copies):
            t = list(base)
            for _ in range(c * max(1, n // 60)):
                t[rng.randrange(n)] = f"e{rng.randrange(10**6)}"
            out.append(" ".join(t))
    return out


def test_join_equals_brute_force(spark):
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(50))
    texts = ODD + near_copies(rng) + [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(60)) for _ in range(30)] + ["Same Words here please now", "same words HERE please now"]
    d = docs(spark, texts, extra=True).withColumn("name", F.lit("clash")).withColumn("set_name", F.lit(1))
    assert joined(d) == brute(list(enumerate(texts)))
    assert joined(d.unionByName(d)) == brute(list(enumerate(texts)) * 2)
    assert joined(d.limit(0)) == []


def test_join_in_giant_groups_and_with_short_sets(spark, monkeypatch):
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for c in range(60):
        t = list(base)
        for _ in range(c % 9):
            t[rng.randrange(120)] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(t))
    want = brute(list(enumerate(texts)))
    assert joined(docs(spark, texts)) == want
    monkeypatch.setattr(jaccard_join, "GROUP_SETS", 8)
    assert joined(docs(spark, texts)) == want  # blocks
    real = jaccard_join.Allocation._one

    def short(self, owner, token, *a):  # every second set is declared to have too few segments
        found, rest = real(self, owner, token, *a)
        return found, np.unique(np.concatenate((rest, owner[owner % 2 == 0])))

    monkeypatch.setattr(jaccard_join.Allocation, "_one", short)
    assert joined(docs(spark, texts)) == want


def test_near_copies_meet_once_a_task_however_many_parts(spark, monkeypatch):
    rng, made, real = random.Random(8), [], jaccard_join._buckets
    texts = near_copies(rng)
    monkeypatch.setattr(jaccard_join, "_buckets", lambda packed, *a: made.append(real(packed, *a).localCheckpoint()) or made[-1])
    want = brute(list(enumerate(texts)))
    for size in (1 << 30, 14 * sum(max(1, len(t.split()) - 4) for t in texts) // 24):  # one part, and some two dozen
        monkeypatch.setattr(jaccard_join, "PART_BYTES", size)
        assert joined(docs(spark, texts)) == want
    few, many = (df.filter("kind = 1") for df in made)
    assert sorted(few.distinct().collect()) == sorted(many.distinct().collect())
    assert many.count() <= spark.sparkContext.defaultParallelism * many.distinct().count()
    assert many.groupBy("a", "b").count().agg({"count": "max"}).first()[0] <= spark.sparkContext.defaultParallelism


def test_join_holds_at_exactly_the_threshold(spark):
    # a and b words apart at one end: 3 of 4 shingles shared is 0.75; one less is not linked
    w = [f"w{i}" for i in range(200)]
    texts = [" ".join(w[0:104]), " ".join(w[0:79]), " ".join(w[0:78]), " ".join(w[5:12])]
    assert 100 * 75 >= 75 * 100
    assert joined(docs(spark, texts)) == brute(list(enumerate(texts)))


def test_pigeonhole_needs_are_met():
    rng = np.random.default_rng(7)
    for s in (64, 90, 150, 400, 1500):
        for _ in range(20):
            union = rng.integers(1, 2**63, 2 * s).astype(np.uint64)
            k = rng.integers(0, s // 7 + 1)
            a, b = np.sort(union[:s]), np.sort(np.concatenate((union[k:s], union[s : s + k])))
            sizes = np.array([s, s])
            alloc = jaccard_join.Allocation(np.empty(0, np.uint64), np.empty(0, np.int64))
            o, sign, short = alloc.signatures(np.repeat([0, 1], s), np.concatenate((a, b)), sizes)
            assert not len(short)
            look = {int(x) >> 2 for x in sign[(o == 0) & (sign & np.uint64(1) > 0)]}
            held = {int(x) >> 2 for x in sign[(o == 1) & (sign & np.uint64(2) > 0)]}
            if 100 * (s - k) >= 75 * (s + k):
                assert look & held


def test_frequent_tokens_use_deletion_neighbourhoods():
    rng = np.random.default_rng(8)
    token = np.sort(rng.integers(1, 2**63, 400).astype(np.uint64))
    hot = token[rng.permutation(400)[:150]]
    alloc = jaccard_join.Allocation(np.sort(hot), np.full(150, 100))
    plain = jaccard_join.Allocation(np.empty(0, np.uint64), np.empty(0, np.int64))
    for a in (alloc, plain):
        o, sign, short = a.signatures(np.zeros(400, np.int64), token, np.array([400]))
        assert not len(short)
    looks = lambda a: int((a.signatures(np.zeros(400, np.int64), token, np.array([400]))[1] & np.uint64(1) > 0).sum())
    assert looks(alloc) >= looks(plain)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sets(st.integers(1, 60), min_size=1, max_size=40), min_size=2, max_size=14))
def test_settle_connects_what_links_connect(groups):
    sets = [np.array(sorted(g), np.uint64) for g in {frozenset(g) for g in groups}]
    names = np.arange(1, len(sets) + 1)

    def parts(edges):
        root = {int(n): int(n) for n in names}

        def find(a):
            while root[a] != a:
                a = root[a]
            return a

        for a, b in edges:
            root[find(a)] = find(b)
        return {frozenset(k for k in root if find(k) == find(n)) for n in root}

    every = [(int(names[i]), int(names[j])) for i in range(len(sets)) for j in range(i) if jaccard_join.linked(sets[i], sets[j])]
    for centre in (0, len(sets) - 1):
        got = jaccard_join.settle(names, sets, centre)
        assert parts(got) == parts(every) and len(got) < max(2, len(sets))


@pytest.mark.parametrize("few", [0, 100])
def test_sketches_let_every_link_pass(monkeypatch, few):
    monkeypatch.setattr(jaccard_join.Sketched, "FEW", few)
    rng = np.random.default_rng(13)
    sets = []
    for s in (40, 63, 64, 65, 100, 127, 128, 129, 200, 300):
        base = rng.integers(0, 2**63, s).astype(np.uint64)
        for k in range(0, s // 4, max(1, s // 25)):
            sets.append(np.unique(np.concatenate((base[k:], rng.integers(0, 2**63, k // 2).astype(np.uint64)))))
    size = np.array([len(s) for s in sets])
    sketch = jaccard_join.sketches(np.repeat(np.arange(len(sets)), size), np.concatenate(sets), size)
    assert all(len(k) * 8 >= n for k, n in zip(sketch, size, strict=True))
    table = jaccard_join.Sketched(size, sketch)
    label, passed = jaccard_join.parts(size, sketch, 3), 0
    for i in range(len(sets)):
        near = table.near(i)
        passed += int(near.sum())
        for j in range(len(sets)):
            if jaccard_join.linked(sets[i], sets[j]):
                assert near[j] and label[i] == label[j]
    assert passed < len(sets) ** 2 / 4


def test_names_that_two_sets_share_are_made_anew(spark, monkeypatch):
    real = jaccard_join.set_ids

    def weak(owner, token, n, salt=0):  # under salt 0 all sets of one size have one name
        size, name = real(owner, token, n, salt)
        return size, np.where(size > 0, size.astype(np.uint64), np.uint64(0)) if salt == 0 else name

    monkeypatch.setattr(jaccard_join, "set_ids", weak)
    texts = [" ".join(f"{w}{i}" for i in range(30)) for w in ("a", "b", "c")] + [thue_morse_text(64, "ab"), thue_morse_text(64, "ba")]
    assert joined(docs(spark, texts)) == brute(list(enumerate(texts)))


def thue_morse_text(n, letters):
    return "".join(letters[bin(i).count("1") & 1] for i in range(n)) + " and four words more"


def test_deduplicated_keeps_one_of_each(spark):
    texts = [None, "", *near_copies(random.Random(9)), "a b c d e f g", "a b c d e f g"]
    d = docs(spark, texts, extra=True)
    out = jaccard_join.deduplicated(d.unionByName(d.limit(1)))
    heads = {c for i, n, c in brute(list(enumerate(texts))) if n}
    assert out.columns == d.columns
    assert {r["doc_id"] for r in out.collect()} == heads | {0, 1}
    assert out.filter("text IS NOT NULL AND text <> ''").count() == len(heads)


def test_deduplicated_keeps_unlinked_texts_without_an_id_or_with_the_same_one(spark):
    apart = [" ".join(f"{w}{i}" for i in range(30)) for w in ("a", "b", "c", "d", "e")]
    rows = [(None, apart[0]), (None, apart[1]), (None, apart[1]), (7, apart[2]), (7, apart[3]), (None, apart[4]), (9, apart[4])]
    out = jaccard_join.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(None, apart[0]), (None, apart[1]), (7, apart[2]), (7, apart[3]), (9, apart[4])], key=str)


# ---- packing --------------------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_packer_is_valid_and_no_worse_than_best_fit(lengths):
    counts = np.bincount(lengths, minlength=65)
    plan = packing.complete(counts, 64, 500)
    used = Counter()
    for p, times in plan:
        assert sum(k * u for k, u in p.items()) <= 64 and times > 0
        for k, u in p.items():
            used[k] += u * times
    assert used == Counter(lengths)
    assert -(-sum(lengths) // 64) <= sum(t for _, t in plan) <= sum(t for _, t in packing.best_fit(counts, 64))


def test_bin_completion_beats_best_fit_where_it_can():
    counts = np.bincount([6, 6, 5, 5, 4, 4, 3, 3, 2, 2], minlength=11)  # 40 places: four sequences of ten
    assert sum(t for _, t in packing.complete(counts, 10)) == 4


def fewest(lengths, size):
    """The least number of sequences, by trying every place of every piece."""
    best = len(lengths)

    def put(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= lengths[i]}.values():
            put(i + 1, [*rooms[:j], rooms[j] - lengths[i], *rooms[j + 1 :]])
        put(i + 1, [*rooms, size - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    put(0, [])
    return best


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=11))
def test_packer_finds_the_optimum_of_small_histograms(lengths):
    counts, least = np.bincount(lengths, minlength=31), fewest(lengths, 30)
    assert packing.least_sequences(counts, 30) <= least
    assert sum(t for _, t in packing.complete(counts, 30)) == least
    assert packing.search(counts, 30, least - 1, packing.Steps(10**6)) is None


def test_packer_meets_the_bound_where_best_fit_does_not():
    rng = np.random.Generator(np.random.PCG64(14))
    counts = np.bincount(np.minimum(rng.lognormal(6, 0.8, 20_000).astype(int) + 1, 1024), minlength=1025)
    ours = sum(t for _, t in packing.complete(counts))
    assert packing.least_sequences(counts, 1024) <= ours <= sum(t for _, t in packing.best_fit(counts, 1024))
    hard = np.bincount([512 + k for k in range(1, 200)] + [300] * 150 + [212 - k for k in range(1, 150)], minlength=1025)
    assert sum(t for _, t in packing.complete(hard)) <= sum(t for _, t in packing.best_fit(hard, 1024))


def test_texts_go_to_the_library_where_the_file_is_not_plain(tmp_path):
    import json

    with open(packing.tokenizer_path(), encoding="utf-8") as f:
        whole = json.load(f)
    whole["normalizer"] = {"type": "Lowercase"}
    path = str(tmp_path / "lower.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(whole, f)
    assert packing.encoder(path).fast is None
    assert packing.encoder(path).ids("ABC Def") == packing.encoder(packing.tokenizer_path()).ids("abc def")


def test_encoder_equals_the_tokenizers_library(spark):
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    slow = Tokenizer.from_file(path)
    texts = [t or "" for t in ODD if len(t or "") < 5000] + ["it's we'll  don't\n\n  x\t9²³ ﷽ 👩‍👩‍👧 \x00\x7f\u200b", "ÀÉ ß ǅ ١٢٣ 〇", "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|> \n<|endoftext|", "lone \ud83d".encode("utf-8", "replace").decode()] + [r["text"] for r in shared.table(spark, SF, "documents").select("text").limit(100).collect()]
    assert [packing.encoder(path).ids(t) for t in texts] == [slow.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.fixture(scope="module")
def packed_texts(spark):
    return [None, "", "word", *(t for t in ODD if t), " ".join(f"tok{i}" for i in range(2500))] * 2


def test_packing_round_trip(spark, packed_texts):
    d = docs(spark, packed_texts, extra=True).withColumn("piece", F.lit("clash"))
    got = packing.pack(d, packing.tokenizer_path()).collect()
    enc = packing.encoder(packing.tokenizer_path())
    by, bins = defaultdict(list), defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t in enumerate(packed_texts):
        ids = np.array([*enc.ids(t or ""), 2], "<u4")
        parts = sorted(by[i], key=lambda r: r["piece"])
        assert [p["piece"] for p in parts] == list(range(len(parts))) and sum(p["length"] for p in parts) == len(ids)
        assert all(p["length"] == 1024 for p in parts[1:])
        for p in parts:
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes())
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(d.limit(0), packing.tokenizer_path()).count() == 0


# ---- mixing ---------------------------------------------------------------------------------------------------


def filled(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """The targets by bisection on the water level."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, lo, hi = share * sum(sizes.values()), 0.0, 1e12
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if sum(min(most * sizes[s], mid * w[s]) for s in sizes) > total else (mid, hi)
    return {s: min(most * sizes[s], lo * w[s]) for s in sizes}


def test_mix_targets_and_takes(spark):
    rng = random.Random(10)
    rows = [(i, " ".join("w" for _ in range(rng.randrange(0, 60))), "en", rng.choice(["b", "a", None, "z", "é", "B"]), 0) for i in range(400)]
    rows += [(1000 + i, "x y z", "en", "hot", 0) for i in range(300)] + [(1000, "x y z", "en", "hot", 0), (2000, None, "en", "only null", 0), (2001, "five words in one text", "en", "one", 0)]
    d = spark.createDataFrame(rows, DOCS).withColumn("target", F.lit("clash")).withColumn("taken", F.lit("clash"))
    sizes = mixing.sized(d)
    got = mixing.taken(sizes, mixing.targets(sizes)).collect()
    own = Counter()
    for _, t, _, s, _ in rows:
        own[s] += len(WORD.findall(t or ""))
    want, took = filled(own), Counter()
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == own[r["source"]] and r["target"] == pytest.approx(want[r["source"]], rel=1e-9, abs=1e-6)
        assert 0 <= r["taken"] <= 2 * r["size"]
        took[r["source"]] += r["taken"]
    for s in own:
        assert abs(took[s] - want[s]) <= 1
    again = mixing.taken(sizes.repartition(7), mixing.targets(sizes)).collect()
    key = lambda r: (r["doc_id"], r["source"] or "", r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mix_with_many_buckets_and_a_hot_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKETS", 4)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 16)
    rng = random.Random(20)
    rows = [(i if i % 9 else None, " ".join("w" for _ in range(rng.randrange(1, 40))), "en", "hot" if i % 3 else f"s{i % 4}", 0) for i in range(900)]
    sizes = mixing.sized(spark.createDataFrame(rows, DOCS))
    goal = mixing.targets(sizes)
    assert mixing._plan(sizes, goal, 1)[1] == 64
    want = {r["source"]: r["target"] for r in goal.collect()}
    took = Counter()
    for r in mixing.taken(sizes, goal).collect():
        assert 0 <= r["taken"] <= 2 * r["size"]
        took[r["source"]] += r["taken"]
    assert all(abs(took[s] - t) <= 1 for s, t in want.items())


def test_mix_repeats_whole_rows(spark):
    d = docs(spark, ["a b c"] * 30 + [None, ""], extra=True).withColumn("z", F.lit(1))
    out = mixing.mix(d)
    assert out.columns == d.columns
    times = Counter(r["doc_id"] for r in out.collect())
    assert max(times.values()) <= 2 and abs(sum(times.values()) - 45) <= 4
    assert mixing.mix(d.limit(0)).count() == 0
    sizes = mixing.sized(d.limit(0))
    assert mixing.taken(sizes, mixing.targets(sizes)).count() == 0


# ---- top-k ----------------------------------------------------------------------------------------------------


def best_of(rows, k):
    clean = [(i, [int(np.floor(64.0 * x)) for x in v]) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in clean:
        if q % 20 == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in clean if i != q and len(a) == len(b))[:k]
            out += [(q, r, i, -x) for r, (x, i) in enumerate(s, 1)]
    return sorted(out)


def test_top_k_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK", 100)
    monkeypatch.setattr(topk_search, "QUERIES", 5)
    monkeypatch.setattr(topk_search, "TASK_BLOCKS", 2)
    rng = np.random.default_rng(11)
    rows = [(i, [float(x) for x in np.float32(rng.normal(0, 0.3, 8))]) for i in range(330)]
    rows += [(400 + i, rows[0][1]) for i in range(40)] + [(1000, None), (1001, []), (1020, [float("nan")] * 8), (1040, [float("inf")] + [0.0] * 7), (1060, [0.0] * 8), (1080, [1.0, None] + [0.0] * 6), (1100, [0.5] * 3), (1101, [0.25] * 3)]
    rows += [(60, rows[60][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    v = topk_search.vectors(df)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk_search.search(v, v.filter("vec_id % 20 = 0"), 20).collect())
    assert got == best_of(rows, 20)
    assert topk_search.search(v, v.limit(0)).count() == 0 and topk_search.search(v.limit(0), v.limit(0)).count() == 0


def test_top_k_with_components_of_any_size(spark):
    rng = np.random.default_rng(15)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 4) * 10.0 ** rng.choice([-3, 0, 5, 9, 17, 30, 200])]) for i in range(120)]
    rows += [(20, [2.0, 3.0, 0.0, 0.0]), (201, [1e30, 1.0, 0.0, 0.0]), (202, [1e30, 1.5, 0.0, 0.0]), (203, [-1e308, 0.0, 0.0, 0.0]), (240, [1.7e308] * 4)]

    def times(x):
        return [int(e) * 64 if abs(e) >= 2.0**53 else int(np.floor(e * 64)) for e in x]

    clean = [(i, times(x)) for i, x in rows]
    want = []
    for q, a in clean:
        if q % 20 == 0:
            own = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in clean if i != q)[:20]
            want += [(q, r, i, topk_search.longest(-n)) for r, (n, i) in enumerate(own, 1)]
    v = topk_search.vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk_search.search(v, v.filter("vec_id % 20 = 0"), 20).collect())
    assert got == sorted(want)


def test_bitmap_sums_are_exact():
    rng = np.random.default_rng(12)
    values, queries = rng.integers(-70, 70, (130, 6)), rng.integers(-70, 70, (9, 6))
    block = topk_search.Slices(values)
    total, base = block.sums(queries)
    score = np.tile(base[:, None], (1, 130))
    for b, s in enumerate(total):
        score += topk_search._bits(s)[:, :130].astype(np.int64) << b
    assert (score == queries @ values.T).all()


# ---- pipeline -------------------------------------------------------------------------------------------------


def test_pipeline_stages_against_brute_force(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "ngram_jaccard_join", "mixing_sources", "best_fit_packing"]
    sf = "/root/testdata/sf0.01"
    d = shared.table(spark, sf, "documents")
    columns, before = d.columns, d
    for name, stage in corpus_pipeline.STAGES:
        after = shared.stored(stage(spark, before, sf), shared.scratch(spark))
        old, new = Counter(r["doc_id"] for r in before.select("doc_id").collect()), Counter(r["doc_id"] for r in after.select("doc_id").collect())
        if name != "best_fit_packing":
            assert after.columns == columns
        if name == "toxicity":
            model = toxicity.learn(toxicity.labelled(before, shared.table(spark, sf, "labels")))
            assert set(new) == {r["doc_id"] for r in toxicity.score(before, model, "doc_id").filter("score < 0.5").collect()}
        if name == "quality_rules":
            assert set(new) == {r["doc_id"] for r in quality_rules.verdict(quality_rules.ledger(before)).filter("kept").collect()}
        if name == "ngram_jaccard_join":
            rows = [(r["doc_id"], r["text"]) for r in before.select("doc_id", "text").collect()]
            assert set(new) == {c for _, n, c in brute(rows) if n} and max(new.values()) == 1
        if name == "mixing_sources":
            sizes = mixing.sized(before)
            want = {r["doc_id"]: round(r["taken"] / r["size"]) for r in mixing.taken(sizes, mixing.targets(sizes)).collect() if r["size"]}
            assert set(new) <= set(old) and sum(abs(new.get(i, 0) - n) for i, n in want.items()) <= 20
        if name == "best_fit_packing":
            assert set(new) == set(old) and Counter(r["doc_id"] for r in after.filter("piece = 0").collect()) == old
        before = after


def test_pipeline_on_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
