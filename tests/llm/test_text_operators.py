"""Toxicity, language ID, quality rules and classifier, URL filters, license scan: brute force and edge cases."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meshquilt.llm import language_id, license_scan, quality_classifier, quality_rules, shared, textkit, toxicity, url_filters

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \n\t ", "a", "Émile ñ 日本語 слово", "x " * 3000, "same line\nsame line\n\nsame line", "#|a <b>", "one two three one two three"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, extra=False):
    rows = [(i, t, "en", f"src{i % 3}" if i % 4 else None, len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumn("score", F.lit(1)).withColumn("fail_bits", F.lit("x")).withColumn("n", F.lit(0)) if extra else df


# ---- kernels --------------------------------------------------------------------------------------------------


def test_words_and_hashes_follow_the_definition():
    rng = random.Random(1)
    texts = ["".join(rng.choice(["a", "é", " ", "\n", "\x1f", "日", "\x0b"]) for _ in range(rng.randrange(40))) for _ in range(300)] + [None, ""]
    got, seen = [[] for _ in texts], {}
    for at, data, offs in textkit.slices(pa.array(texts, pa.string())):
        start, end, row = textkit.words(data, offs)
        for s, e, r, h in zip(start, end, row, textkit.Spans(data).hash(start, end), strict=True):
            w = bytes(data[s:e]).decode()
            got[at + r].append(w)
            assert seen.setdefault(w, int(h)) == int(h)
    assert got == [WORD.findall(t or "") for t in texts]
    assert len(set(seen.values())) == len(seen)


def test_slices_cut_between_rows_only(monkeypatch):
    monkeypatch.setattr(textkit, "SLICE", 16)
    texts = ["a" * 40, None, "bb", "", "c" * 15, "d" * 17]
    back = {}
    for at, data, offs in textkit.slices(pa.chunked_array([texts[:3], texts[3:]], pa.string())):
        for i in range(len(offs) - 1):
            back[at + i] = bytes(data[offs[i] : offs[i + 1]]).decode()
    assert [back[i] for i in range(len(texts))] == [t or "" for t in texts]


def thue_morse(n, letters="ab"):
    return "".join(letters[bin(i).count("1") & 1] for i in range(n))


@pytest.mark.parametrize("size", [64, 512, 2048, 4096])
def test_structured_strings_do_not_collide(size):
    pair = [thue_morse(size), thue_morse(size, "ba")]
    data = np.frombuffer("".join(pair).encode(), np.uint8)
    a, b = textkit.Spans(data).hash(np.array([0, size]), np.array([size, 2 * size]))
    assert a != b
    assert quality_rules.measure(pa.array(["\n".join(pair)]))[0, 3] == 0


def test_spans_of_equal_bytes():
    data = np.frombuffer(b"abcabcabd", np.uint8)
    a = (np.array([0, 0, 0, 4]), np.array([3, 3, 2, 4]))
    b = (np.array([3, 6, 3, 5]), np.array([6, 9, 6, 5]))
    assert textkit.same(data, a, b).tolist() == [True, False, False, True]


# ---- quality rules --------------------------------------------------------------------------------------------


def measured(text):
    ws = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    wins = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    cover = {i + j for i, w in enumerate(wins) if wins.count(w) > 1 for j in range(3)}
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(cover))


def test_quality_measurements_against_brute_force(spark):
    rng = random.Random(2)
    texts = ODD + [" ".join(rng.choice("ab|#é") * rng.randrange(1, 4) for _ in range(rng.randrange(90))).replace("b b", "b\nb") for _ in range(60)]
    got = {r["doc_id"]: r for r in quality_rules.ledger(docs(spark, texts, extra=True)).collect()}
    for i, t in enumerate(texts):
        if len(t or "") < 4000:
            assert tuple(got[i][m] for m in quality_rules.MEASURES[:5]) == measured(t), t


def test_quality_measurements_hold_where_hashes_collide(monkeypatch):
    texts = ["a b c\nb c d\na b c\nx", "one two three one two three four", "p q\nr s\nq p"]
    want = [measured(t)[3:5] for t in texts]
    real = textkit.Spans.hash
    monkeypatch.setattr(textkit.Spans, "hash", lambda self, s, e: real(self, s, e) & np.uint64(1))
    assert [tuple(r[3:5]) for r in quality_rules.measure(pa.array(texts))] == want


def test_quality_policies_and_ablation(spark):
    book = quality_rules.ledger(docs(spark, ODD + ["word " * 60, " ".join(f"w{i}" for i in range(60))]))
    v = quality_rules.verdict(book)
    kept = {r["doc_id"] for r in v.filter("kept").collect()}
    assert kept == {len(ODD) + 1}
    ab = {r["rule"]: r for r in quality_rules.ablation(book).collect()}
    assert ab["short"]["n_failed"] == len(ODD) - 1 and ab["repeats"]["n_failed"] >= 2
    assert {r["n_rejected"] for r in ab.values()} == {v.filter("NOT kept").count()}
    again = quality_rules.stored_ledger(docs(spark, ODD))
    assert "MapInArrow" not in again._jdf.queryExecution().toString() and again.columns == book.columns


def test_quality_keep_keeps_columns_repeats_and_empty(spark):
    d = docs(spark, [" ".join(f"w{i}" for i in range(60)), None], extra=True)
    twice = d.unionByName(d)
    assert quality_rules.keep(twice).count() == 2 and quality_rules.keep(twice).columns == d.columns
    assert quality_rules.keep(d.limit(0)).count() == 0 and quality_rules.ledger(d.limit(0)).count() == 0


# ---- language ID ----------------------------------------------------------------------------------------------

TALK = {"en": "the quick brown fox and the lazy dog were thinking about nothing", "de": "der schnelle braune Fuchs und der faule Hund dachten über nichts nach", "xx": "日本語 の 文章 は ここ に あります"}


def test_language_learns_and_keeps_edges(spark):
    rows = [(i, TALK[k], k, None, 0) for i, k in enumerate(list(TALK) * 6)] + [(100, None, "en", None, 0), (101, "no label", None, None, 0)]
    model = language_id.learn(spark.createDataFrame(rows, DOCS))
    assert model.langs == ["de", "en", "xx"]
    asked = ["the dog and the fox", "der Hund und der Fuchs", "日本語 の 文章", None, "", "123 ... !!", "Ж"]
    got = [r for r in language_id.identify(docs(spark, asked, extra=True), model, "doc_id", "n").orderBy("doc_id").collect()]
    assert [r["lang_pred"] for r in got][:3] == ["en", "de", "xx"]
    assert [r["lang_pred"] for r in got][3:6] == ["und"] * 3 and got[6]["lang_pred"] in model.langs
    assert all(0 <= r["score"] <= 1 for r in got)
    none = language_id.learn(spark.createDataFrame([], DOCS))
    assert {r["lang_pred"] for r in language_id.identify(docs(spark, asked), none, "doc_id").collect()} == {"und"}


def test_language_filter_names_all_languages_of_each_gram():
    rng = np.random.default_rng(3)
    langs = [f"l{j}" for j in range(70)]  # more than a word of bits
    members = {k: np.unique(rng.integers(0, 2**32, 300)) for k in langs}
    members["l69"] = np.union1d(members["l69"], members["l3"][:50])
    f = language_id.Filter.of(langs, members, {k: m[:100] for k, m in members.items()}, np.full(70, 1 / 70))
    wrong = 0
    for j, k in enumerate(langs):
        masks = f.look(members[k].astype(np.uint32))
        for i, other in enumerate(langs):
            for bit, listed in ((2 * i, members[other]), (2 * i + 1, members[other][:100])):
                got, want = (masks[bit // 64] >> np.uint64(bit % 64) & np.uint64(1)).astype(bool), np.isin(members[k], listed)
                assert got[want].all()
                wrong += int((got & ~want).sum())
        total, hits = f.counts(members[k].astype(np.uint32), np.zeros(len(members[k]), np.int64), 1)
        assert hits[0, j, 0] == total[0]
    assert wrong < 0.01 * 70 * 300 * 140


def test_language_learning_equals_brute_force(spark):
    rng = random.Random(17)
    rows = [(i, " ".join(rng.choice(TALK[k].split()) for _ in range(12)) + (" und der" if i % 7 == 0 else ""), k, None, 0) for i, k in enumerate(list(TALK) * 20)]
    model = language_id.learn(spark.createDataFrame(rows, DOCS))
    counts = {k: Counter() for k in TALK}
    for _, t, k, _, _ in rows:
        data = np.frombuffer(t.encode(), np.uint8)
        counts[k].update(language_id.grams(data, np.array([0, len(data)]))[0].tolist())
    langs = sorted(TALK)
    total = {k: sum(c.values()) for k, c in counts.items()}
    top = {g: max(counts[k][g] / total[k] for k in langs) for k in langs for g in counts[k]}
    own = {k: np.array([g for g in counts[k] if counts[k][g] / total[k] >= top[g] * language_id.MIN_RATIO]) for k in langs}
    want = language_id.Filter.of(langs, {k: np.array([*counts[k]]) for k in langs}, own, model.prior)
    assert model.langs == langs and (model.table == want.table).all() and np.allclose(model.false, want.false)


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = language_id.op2_language_id(spark, sf).join(shared.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.filter("lang = lang_pred").count() >= 0.97 * got.count()


# ---- toxicity -------------------------------------------------------------------------------------------------


def test_toxicity_finds_expressions_and_spares_clean(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        ws = ["".join(rng.choice(["an", "th", "er", "on", "in"]) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(20, 120))]
        if toxic:
            for _ in range(max(2, len(ws) // 30)):
                ws[rng.randrange(len(ws))] = rng.choice(["grobian", "grobiante!", "Mistkram"])
        rows.append((i, " ".join(ws), "en", None, 0))
        labels.append((i, 1, int(toxic)))
    d = spark.createDataFrame([*rows, (900, None, None, None, 0), (901, "", None, None, 0), (902, "a grobiano here", None, None, 0)], DOCS).withColumn("toxic", F.lit("clash"))
    lab = spark.createDataFrame([*labels, (900, 1, None), (12345, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(toxicity.labelled(d, lab))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(d, model, "doc_id").collect()}
    wrong = [i for i in range(400) if (got[i] >= 0.5) != (i % 5 == 0)]
    assert len(wrong) <= 8 and got[900] == got[901] < 0.5 <= got[902]
    clean = toxicity.keep_clean(d.unionByName(d), model)
    assert clean.columns == d.columns and clean.filter("doc_id = 1").count() == 2


def test_toxicity_kneser_ney_against_brute_force(spark):
    rng = random.Random(16)
    rows = []
    for i in range(1500):
        toxic = i % 3 == 0
        ws = [rng.choice(["here", "plain", "words", "this", "that", "so"]) for _ in range(rng.randrange(1, 14))]
        for _ in range(rng.randrange(1, 4)):
            ws[rng.randrange(len(ws))] = rng.choice(["vilez", "scumx"]) if toxic else rng.choice(["kindq", "nicey", "plain"])
        rows.append((i, " ".join(ws), int(toxic), i % 4))
    model = toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string, label int, part int"))

    def hashed(word):
        data = np.frombuffer(word.encode(), np.uint8)
        return [int(x) for x in toxicity.expressions(data, np.array([0, len(data)]))[1][:, 0]]

    units = model.units.tolist()
    name = {w: max([units.index(h) + 1 for h in hashed(w) if h in units][-1:], default=0) for w in "here plain words this that so vilez scumx kindq nicey".split()}
    assert name["vilez"] and name["scumx"] and (name["kindq"] or name["nicey"]) and not name["this"]
    size, start = len(units) + 1, len(units) + 1
    count, follows = [{}, {}], [set(), set()]
    for _, text, label, part in rows:
        if part:
            ws = text.split()
            for left, w in zip([None, *ws], ws):
                pair = (start if left is None else name[left], name[w])
                count[label][pair] = count[label].get(pair, 0) + 1
                follows[label].add((left, name[w]))
    contexts = [[sum(u == k for _, u in f) for k in range(size)] for f in (*follows, follows[0] | follows[1])]
    share = [(t + 0.5) / sum(t + 0.5 for t in contexts[2]) for t in contexts[2]]
    for c in (0, 1):
        total = sum(contexts[c])
        low = [max(t - 0.75, 0) / total + 0.75 * sum(t > 0 for t in contexts[c]) / total * s for t, s in zip(contexts[c], share)]
        low = [x / sum(low) for x in low]
        for left in range(size + 1):
            all_ = sum(n for (u, _), n in count[c].items() if u == left)
            kinds = sum(u == left for u, _ in count[c])
            for w in range(size):
                want = (max(count[c].get((left, w), 0) - 0.75, 0) + 0.75 * kinds * low[w]) / all_ if all_ else low[w]
                assert model.probability(c, np.array([left]), np.array([w]))[0] == pytest.approx(want)
            if all_ and min((n for (u, _), n in count[c].items() if u == left)) >= 1:
                assert sum(model.probability(c, np.full(size, left), np.arange(size))) == pytest.approx(1)


def test_toxicity_keeps_every_expression_and_bigram(spark):
    bad = [f"{a}{b}x" for a in "bcdfgh" for b in "aeiou"]  # no longer than the shortest stem: one expression a word
    rows = [(i, " ".join(bad[(i + k * (1 + i % 3)) % 30] for k in range(6)), 1, 1) for i in range(90)]
    rows += [(100 + i, "plain words of no harm", 0, 1) for i in range(900)]
    model = toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string, label int, part int"))
    ordinary = 5  # words of the ordinary class that no toxic document has
    assert len(model.units) >= 30 + ordinary
    size = len(model.units) + 1
    moves = {p for _, t, label, _ in rows for p in zip([None, *t.split()], t.split(), strict=False)}
    assert len(model.pairs) == len(moves)
    for c in (0, 1):
        mass = np.bincount(model.pairs // size, weights=model.seen[c], minlength=size + 1)
        assert np.allclose(mass + model.free[c], 1)


def test_rows_without_an_id_are_in_no_fold(spark, tmp_path):
    rows = [(None if i % 10 == 0 else i, "some vile scumbag here" if i % 4 == 0 else "some kind words here", "en", None, 0) for i in range(200)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 > 0), int(i % 4 == 0)) for i in range(200)] + [(None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for query in (toxicity.op1_toxicity, language_id.op2_language_id, quality_classifier.op6_quality_classifier):
        got = query(spark, str(tmp_path)).collect()
        assert len(got) == 200 and not any(r["held_out"] for r in got if r["doc_id"] is None) and all(r["held_out"] is not None for r in got)


def test_toxicity_without_labels(spark):
    d = docs(spark, ["a b", None])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.score(d, toxicity.learn(toxicity.labelled(d, none)), "doc_id").collect()} == {0.0}
    one = spark.createDataFrame([(i, 1, 1) for i in range(9)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.score(d, toxicity.learn(toxicity.labelled(docs(spark, ["x"] * 9), one)), "doc_id").collect()} == {1.0}
    assert toxicity.score(d.limit(0), toxicity.Model(), "doc_id").count() == 0


def test_folds_are_crc32(spark):
    got = {r["i"]: r["f"] for r in spark.range(50).select(F.col("id").alias("i"), shared.fold("id", 5).alias("f")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 for i in range(50)}


# ---- quality classifier ---------------------------------------------------------------------------------------


def test_quality_classifier_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = quality_classifier.op6_quality_classifier(spark, sf).join(shared.table(spark, sf, "labels"), "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in got) >= 0.9 * len(got)


def test_quality_classifier_with_words_alone_and_without(spark, monkeypatch):
    sf = "/root/testdata/sf0.01"
    real, right = quality_classifier.pooled, {}
    truth = {r["doc_id"]: r["quality"] for r in shared.table(spark, sf, "labels").collect()}
    for name, cut in (("words", slice(quality_classifier.DIMS, None)), ("rest", slice(0, quality_classifier.DIMS))):

        def part(column, vectors, cut=cut):
            x = real(column, vectors)
            x[:, cut] = 0
            return x

        monkeypatch.setattr(quality_classifier, "pooled", part)
        got = [r for r in quality_classifier.op6_quality_classifier(spark, sf).collect() if r["held_out"] and r["doc_id"] in truth]
        right[name] = sum(r["predicted"] == truth[r["doc_id"]] for r in got) / len(got)
    assert min(right.values()) >= 0.85, right


def test_quality_classifier_edges(spark):
    d = docs(spark, ODD, extra=True)
    for labels in ([], [(0, 1), (1, None)]):
        marks = spark.createDataFrame(labels, "doc_id long, label int")
        v, n = quality_classifier.learn(d, marks)
        got = quality_classifier.score(d, v, n, "doc_id").collect()
        assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert quality_classifier.score(d.limit(0), v, n, "doc_id").count() == 0


def test_context_vectors_and_pooling_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(quality_classifier, "FAN", 2)
    monkeypatch.setattr(quality_classifier, "FLUSH", 16)
    q = quality_classifier
    rng = random.Random(18)
    texts = [" ".join(rng.choice(["a", "b", "c", "Dog", "e,"]) for _ in range(rng.randrange(1, 9))) for _ in range(40)] + ["b b", None, "d", "once seen"]
    vectors = q.contexts(docs(spark, texts).repartition(7))
    told = {}

    def token(w):
        if w not in told:
            data = np.frombuffer(w.encode(), np.uint8)
            told[w] = [int(x[0]) for x in q.tokens(data, np.array([0, len(data)]))[1:]]
        return told[w]

    count = Counter(w for t in texts for w in WORD.findall(t or ""))
    assert set(vectors.own.tolist()) == {token(w)[0] for w, n in count.items() if n >= q.MIN_COUNT}
    place = {h: q.SLOTS + i for i, h in enumerate(vectors.own.tolist())}
    words, shapes = np.zeros((q.SLOTS + len(place), q.DIMS)), np.zeros((q.SHAPES, q.DIMS))

    def add(table, at, h):
        for k in range(q.NONZERO):
            table[at, (h >> (7 * k)) % q.DIMS] += 1 - 2 * (h >> (40 + k) & 1)

    slot = lambda h: place.get(h, (h >> 50) % q.SLOTS)
    for t in texts:
        ws = WORD.findall(t or "")
        for i in range(len(ws)):
            for j in range(max(0, i - q.REACH), min(len(ws), i + q.REACH + 1)):
                if i != j:
                    add(words, slot(token(ws[i])[0]), token(ws[j])[0])
                    add(shapes, token(ws[i])[1], int(textkit.mix(np.uint64([token(ws[j])[1] + 977]))[0]))
    unit = lambda m: m / np.maximum(np.sqrt((m**2).sum(axis=1, keepdims=True)), 1e-9)
    assert np.allclose(vectors.words, unit(words), atol=1e-6) and np.allclose(vectors.shapes, unit(shapes), atol=1e-6)
    got = q.pooled(pa.array(texts), vectors)
    for t, x in zip(texts, got, strict=True):
        ws = WORD.findall(t or "")
        if not ws:
            assert not x.any()
            continue
        wins = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
        want = [*np.mean([unit(words)[slot(token(w)[0])] for w in ws], axis=0), *np.mean([unit(shapes)[token(w)[1]] for w in ws], axis=0)]
        want += [(len(ws) - len(set(ws))) / len(ws), (len(wins) - len(set(wins))) / len(ws), sum(token(w)[1] // 8 % 4 for w in ws) / len(ws), np.log1p(len(ws))]
        assert np.allclose(x, want, atol=1e-5)


def test_network_learns_and_is_calibrated():
    rng = np.random.Generator(np.random.PCG64(19))
    x = rng.normal(size=(3000, quality_classifier.WIDTH))
    y = (rng.random(3000) < 1 / (1 + np.exp(-(3 * x[:, 0] + x[:, 2])))).astype(float)
    net = quality_classifier.Network()
    net.train(x[:2000], y[:2000])
    p = net.probability(x[2000:])
    assert np.mean((p >= 0.5) == y[2000:]) > 0.75
    bins = np.digitize(p, [0.2, 0.4, 0.6, 0.8])
    gap = sum(abs(p[bins == k].mean() - y[2000:][bins == k].mean()) * np.mean(bins == k) for k in range(5) if (bins == k).any())
    assert gap < 0.12
    a, b, c, d = net.layers
    z = np.clip((x[2000:] - net.mean) / net.spread, -8, 8)
    assert np.allclose(p, 1 / (1 + np.exp(-(np.tanh(z @ a + b) @ c + d) / net.heat)))


# ---- URL filters ----------------------------------------------------------------------------------------------


def judged(url, rules=url_filters.RULES, default=url_filters.DEFAULT):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]) if m else ("", "")
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[2] if fits else None, max(fits)[3] if fits else default)


URLS = [
    None, "", "no scheme", "http://", "https://A.Example.COM/en/71?x#y", "http://example.com/en/7", "http://myexample.com/en/7", "http://x.net/de/", "http://example.net/de/88",
    "ftp://example.org/es/#a", "http://example.org?/es/", "http://com/en/", "a://b://c.com/en/", "http://user:p@x.com:80/en/", "http://x.com\n/en/", "http://x..com/en/", "http://É.com/en/a",
]


def test_url_filters_against_brute_force(spark):
    pages = spark.createDataFrame([*enumerate(URLS), (4, URLS[4]), (0, URLS[5])], "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("n", F.lit(1))
    got = sorted((r["page_id"], r["host"], r["path"], r["rule"] or "", r["verdict"]) for r in url_filters.judge(pages.select("page_id", "url"), url_filters.rule_table(spark)).collect())
    want = sorted((i, h, p, r or "", v) for i, u in [*enumerate(URLS), (4, URLS[4]), (0, URLS[5])] for h, p, r, v in [judged(u)])
    assert got == want


def test_url_filters_on_very_long_urls(spark):
    urls = ["http://" + "a." * 50_000 + "example.COM/en/7" + "x" * 1000, "http://" + "a." * 2000 + "net/de/" + "y/" * 50_000, "http://" + "b" * 100_000 + "/en/", "x" * 100_000, "a://" + "." * 40_000 + "com/en/"]
    rules = (*url_filters.RULES, ("a.B.example.com", "/", "block"), ("", "/en", "block"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filters.judge(spark.createDataFrame([*enumerate(urls)], "page_id long, url string"), url_filters.rule_table(spark, rules)).collect()}
    lowered = tuple((h.lower(), p, v) for h, p, v in rules)
    for i, u in enumerate(urls):
        assert got[i] == judged(u, lowered)


def test_url_filters_without_rules_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://x.com/a"), (2, None)], "page_id long, url string")
    none = url_filters.rule_table(spark, [])
    assert {(r["rule"], r["verdict"]) for r in url_filters.judge(pages, none, "block").collect()} == {(None, "block")}
    assert url_filters.judge(pages.limit(0), url_filters.rule_table(spark)).count() == 0


# ---- license scan ---------------------------------------------------------------------------------------------


def test_license_whole_text_and_notices(spark):
    mit = dict(license_scan.TEXTS)["MIT"]
    texts = [
        mit, "Copyright (c) 2020 Some Body\n\n" + mit.upper().replace(",", " ,"), mit + " extra", "Some text.\nreleased under the mit licence", "Licensed under the Apache License, Version 2.0.",
        None, "", "---", "Copyright 2021 x\nAll rights reserved.", "Released under the MIT License.\nReleased under the MIT License.\nLicensed under the Apache Licence version 2.0",
    ]
    d = docs(spark, texts, extra=True)
    got = {r["doc_id"]: (r["license"], r["notices"]) for r in license_scan.scan(d, license_scan.known(spark)).collect()}
    assert got[0][0] == "MIT" and got[1][0] == "MIT" and got[2] == (None, None)
    assert got[3] == (None, "MIT") and got[4] == ("Apache-2.0", "Apache-2.0")
    assert all(got[i] == (None, None) for i in (5, 6, 7, 8)) and got[9] == (None, "Apache-2.0,MIT")
    assert license_scan.scan(d.unionByName(d), license_scan.known(spark)).count() == 2 * len(texts)
    assert license_scan.scan(d.limit(0), license_scan.known(spark)).count() == 0


def test_license_forms_of_adjacent_spellings_and_very_long_texts(spark):
    texts = ["Licence licence LICENCE per cent per cent sub licence", "license license license percent percent sublicense", "x licence " * 40_000, "x license " * 40_000, "y" * 200_000, "Copyright 2020 a\n" * 20_000]
    d = docs(spark, texts)
    got = {r["doc_id"]: r for r in license_scan.scan(d, license_scan.known(spark)).collect()}
    assert got[0]["digest"] == got[1]["digest"] and got[2]["digest"] == got[3]["digest"] != got[4]["digest"] and got[5]["digest"] is None
    form = spark.createDataFrame([(texts[0],)], "t string").select(license_scan.canonical(F.col("t"))).first()[0]
    assert form == " license  license  license  percent  percent  sublicense "


def test_license_lines_found_in_documents_and_long_texts(spark):
    known = dict(license_scan.TEXTS)
    names = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0")
    lines = {
        "Some text.\nLicensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Distributed under the Mozilla Public License 2.0": "MPL-2.0",
    }
    d = docs(spark, [*lines, *("Copyright (c) 2020 Some Body\n\n" + known[n] for n in names)])
    got = {r["doc_id"]: r for r in license_scan.scan(d, license_scan.known(spark)).collect()}
    assert [got[i]["notices"] for i in range(len(lines))] == [*lines.values()]
    assert [got[len(lines) + i]["license"] for i in range(len(names))] == [*names]
