"""N-gram Jaccard join (9): universe-partition pigeonhole, verified exactly.

A document is the set of its different 5-word shingles (64-bit hashes). Two sets of sizes a and b reach a
Jaccard similarity of 0.75 only if they differ in at most H = (a + b) / 7 tokens. Sets fall into size bands;
a band hashes the token universe into segments, and among any H + 1 of them at least one holds the same
tokens in both sets, so a set looks for partners by H + 1 segments of its own (its segment subsets) in an
index that holds all segments of all sets of the band; it does so in its own band and the next smaller one.
Which segments to use is allocated by cost: segments of nothing but frequent tokens are left out as long
as others are enough; where they are not, a cheap segment of the class ``WIDE`` may stand for two, because
the index also holds these segments' one-deletion neighbourhoods (a segment of it differs by at most one
token from the partner's); frequent ones come last, by frequency. Bands of small sets have one token a segment. A
set with too few segments (its tokens fell together; hardly ever) is compared with all sets, in blocks.

Equal sets are one class, looked up once. Buckets are not expanded into pairs. Each bucket picks one of its
sets as centre (the one whose name has the least hash, so the buckets of a group of copies mostly agree) and
every other set of the bucket joins that centre's group; all sets of a bucket are then in one group, and a
group's rows are as many as its sets.

A group is first looked at through odd sketches: one bit a token, the parity of the tokens that fall there. Two
sets differ in at least as many tokens as their sketches differ in bits, so a pair whose sketches are too far
apart is no link, and what is left of a group falls into parts (equal parts of different groups are one). Only
sets in a part of two or more are shipped whole, and settled in memory: each set is held as its difference from
the part's head, common tokens are counted by posting lists, a union-find skips what is connected already, and
only edges that connect go out. Groups over ``GROUP_SETS`` sets or ``GROUP_BYTES`` first link sets to the centre
by a join, dealt over as many tasks as the group has blocks; only those left over are compared with the group,
in blocks of that size.

Names of sets are 64-bit hashes; a second one of 64 bits is held beside them, and where two sets of one name
differ in it all names are made anew with another salt. Tokens are 64-bit hashes: a chance collision of two
shingles of one pair of sets would count as one common token.

Defined results: null and empty texts, and texts without words, have the empty set and are linked with
nothing; fewer than five words give one shingle; repeated rows are copies; ids may repeat; an empty
table gives no rows. Only doc_id and text are read, so other columns can have any names.
"""

from __future__ import annotations

import gc
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared, textkit

WORDS, NUM, DEN = 5, 75, 100
SINGLE = 64  # sets smaller than this have one token a segment
WIDE = 16  # every so many segments, one has its one-deletion neighbourhoods in the index
HOT_TOKENS, HOT_SHARE, HOT_LEAST = 1 << 14, 0.002, 8
GROUP_SETS, GROUP_BYTES = 1024, 24 << 20  # of one block of a group
FLUSH = 1 << 20
SIGN_BYTES, PART_BYTES = 6, 24 << 20  # a signature's bytes beside its part; signatures of one part
TASK_PARTS = 8  # parts that one task works one after the other, so that a pair of near copies comes once from all of them
BLOOM_LEAST, BLOOM_MOST = 20, 28  # log2 of the bits of the bitmap over wanted documents
REST_BLOCK = 256
SALTS = 8
_BANDS: dict = {}


def bands(top: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower ends of the size bands up to ``top``, and the segments of each (0: one token a segment)."""
    if _BANDS.get("top", -1) < top:
        low, segments = [1], []
        while low[-1] <= 2 * top + 8:
            low.append(max(low[-1] + 1, -(-4 * low[-1] // 3)))
        for a, b in zip(low, low[1:]):
            segments.append(0 if b <= SINGLE else _segments(a, b - 1))
        _BANDS.update(top=top, low=np.array(low[:-1], np.int64), segments=np.array(segments, np.int64), high=np.array(low[1:], np.int64) - 1)
    return _BANDS["low"], _BANDS["segments"]


def _segments(low: int, high: int) -> int:
    """So many that sets of the band and of the next have enough segments with tokens, six deviations apart."""
    m = low // 3
    while True:
        ok = True
        for s in {low, (low + high) // 2, high, high + 1, 4 * high // 3}:
            empty = (1 - 1 / m) ** s
            if m * (1 - empty) - 6 * math.sqrt(m * empty * (1 - empty)) < (s + min(s, high)) // 7 + 1:
                ok = False
        if ok:
            return m
        m += max(1, m // 100)


def shingles(data: np.ndarray, offs: np.ndarray):
    """(row, token), sorted by row and token, without repeats: the shingle sets of the slice's rows."""
    n = len(offs) - 1
    start, end, row = textkit.words(data, offs)
    h = textkit.Spans(textkit.lowered(data)).hash(start, end)
    token, at = textkit.windows(h, row, WORDS)
    owner = row[at]
    count = np.bincount(row, minlength=n)
    few = np.flatnonzero((count > 0) & (count < WORDS))
    if len(few):
        first = np.searchsorted(row, few)
        total = np.zeros(len(few), np.uint64)
        odd = textkit._tables()["odd"]
        with np.errstate(over="ignore"):
            for j in range(WORDS - 1):
                has = count[few] > j
                total[has] = total[has] + h[first[has] + j] * odd[8 + j]
            total = textkit.mix(total + count[few].astype(np.uint64))
        token, owner = np.concatenate((token, total)), np.concatenate((owner, few))
    order = np.lexsort((token, owner))
    token, owner = token[order], owner[order]
    if len(token):
        new = np.concatenate(([True], (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])))
        token, owner = token[new], owner[new]
    return owner, token


def set_ids(owner: np.ndarray, token: np.ndarray, n: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, 64-bit names of the sets); the empty set is 0."""
    size = np.bincount(owner, minlength=n)
    name = np.zeros(n, np.uint64)
    full = size > 0
    if len(token):
        first = (np.cumsum(size) - size)[full]
        with np.errstate(over="ignore"):
            name[full] = textkit.mix(np.add.reduceat(textkit.mix(token + np.uint64(0xA5A5 + 0x10000 * salt)), first) + size[full].astype(np.uint64))
    return size, name


def _merged(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.empty(0, np.int64)
    return k[first], np.add.reduceat(c, first) if len(first) else c


def sketches(owner: np.ndarray, token: np.ndarray, size: np.ndarray) -> list[bytes]:
    """Odd sketches: at bit (token modulo width) the parity of the tokens there; the width is a power of two, at
    least 64 and the set's size. One of twice the width becomes the narrower one when its halves are XORed."""
    width = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))
    stop = np.cumsum(width)
    at = (stop - width)[owner] + (token & (width[owner] - 1).astype(np.uint64)).astype(np.int64)
    bits = np.packbits((np.bincount(at, minlength=int(stop[-1]) if len(stop) else 0) & 1).astype(np.uint8), bitorder="little").tobytes()
    return [bits[e - w >> 3 : e >> 3] for w, e in zip(width.tolist(), stop.tolist(), strict=True)]


def _describe(texts: DataFrame, salt: int = 0) -> DataFrame:
    """kind 0: doc_id (null kept), set size, set name, a second name, sketch. kind 1: a token frequent in part of the
    table, its count, the documents there."""
    names = ["kind", "a", "b", "c", "d", "sketch"]

    def batch(kind, a, b, c, d, sketch):
        n = len(b)
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), a, pa.array(b), pa.array(c), d, sketch], names)

    def rows(batches):
        held, docs, tokens = [], 0, 0

        def hot():
            k, c = _merged(held, [np.ones(len(t), np.int64) for t in held])
            use = c >= max(HOT_LEAST, HOT_SHARE * docs)
            n = int(use.sum())
            return batch(1, pa.array(k[use].view(np.int64)), c[use], np.full(n, docs, np.int64), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()))

        for b in batches:
            size, name, other, sketch = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.uint64), np.zeros(b.num_rows, np.uint64), []
            for at, data, offs in textkit.slices(b.column(1)):
                n = len(offs) - 1
                owner, token = shingles(data, offs)
                size[at : at + n], name[at : at + n] = set_ids(owner, token, n, salt)
                other[at : at + n] = set_ids(owner, token, n, salt + 0x5EED)[1]
                sketch += sketches(owner, token, size[at : at + n])
                held.append(token)
                docs, tokens = docs + n, tokens + len(token)
                if tokens > FLUSH:
                    yield hot()
                    held, docs, tokens = [], 0, 0
            yield batch(0, b.column(0), size, name.view(np.int64), pa.array(other.view(np.int64)), pa.array(sketch, pa.binary()))
        if held:
            yield hot()
        held = None
        shared.trim()

    return texts.mapInArrow(rows, "kind int, a long, b long, c long, d long, sketch binary")


class Allocation:
    """Signatures of sets: which segments are looked for, which are only held."""

    def __init__(self, hot: np.ndarray, often: np.ndarray):
        order = np.argsort(hot)
        self.hot, self.often = hot[order], often[order]

    def _cost(self, token: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.zeros(len(token), np.int64)
        at = np.minimum(np.searchsorted(self.hot, token), len(self.hot) - 1)
        return np.where(self.hot[at] == token, self.often[at], 0)

    def signatures(self, owner: np.ndarray, token: np.ndarray, size: np.ndarray):
        """(set index, signature with its role in the low bits: 1 looks, 2 is held, 3 both) and the sets that have too few."""
        low, segments = bands(int(size.max(initial=1)))
        own = np.searchsorted(low, size, "right") - 1
        cost = self._cost(token)
        out, short = [], []
        for below in (0, 1):
            band = own - below
            use = (size > 0) & (band >= 0)
            if below:  # the smallest partner must reach the band below
                use &= 4 * _BANDS["high"][np.maximum(band, 0)] >= 3 * size
            part = use[owner]
            if part.any():
                o, rest = self._one(owner[part], token[part], cost[part], size, band, segments, below)
                out.append(o)
                short.append(rest)
        return np.concatenate([o for o, _ in out] or [np.empty(0, np.int64)]), np.concatenate([s for _, s in out] or [np.empty(0, np.uint64)]), np.unique(np.concatenate(short or [np.empty(0, np.int64)]))

    def _one(self, owner, token, cost, size, band, segments, below):
        salt = textkit.mix(band[owner].astype(np.uint64) + np.uint64(7919))
        m = segments[band[owner]]
        spread = textkit.mix(token ^ salt) >> np.uint64(32)
        segment = np.where(m > 0, (spread * m.astype(np.uint64) >> np.uint64(32)).astype(np.int64), 0)
        single = m == 0
        if single.any():  # the token's place in its set
            first = np.concatenate(([0], np.flatnonzero(owner[1:] != owner[:-1]) + 1))
            begin = np.repeat(first, np.diff(np.concatenate((first, [len(owner)]))))
            segment = np.where(single, np.arange(len(owner)) - begin, segment)
        key = owner << 32 | segment
        order = np.argsort(key, kind="stable")
        key, token, cost, salt = key[order], token[order], cost[order], salt[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        with np.errstate(over="ignore"):
            total = np.add.reduceat(token, first)
        count = np.diff(np.concatenate((first, [len(key)])))
        price = np.minimum.reduceat(cost, first)
        set_, segment, salt_ = key[first] >> 32, key[first] & 0xFFFFFFFF, salt[first]
        wide = (segment % WIDE == 0) & (segments[band[set_]] > 0) & (count >= 2)
        high = np.minimum(_BANDS["high"][np.maximum(band, 0)], size)
        need = (size + high) // 7 + 1

        def rank(mask, *by):  # place of the masked segments within their set
            at = np.flatnonzero(mask)
            at = at[np.lexsort(tuple(b[at] for b in by[::-1]) + (set_[at],))]
            place = np.full(len(set_), 1 << 40, np.int64)
            s = set_[at]
            place[at] = np.arange(len(at)) - np.searchsorted(s, s)
            return place

        cold = price == 0
        n_cold = np.bincount(set_[cold], minlength=len(size))
        value = (cold & (rank(cold, -count) < need[set_])).astype(np.int64)
        lack = np.maximum(need - n_cold, 0)
        if (lack[set_] > 0).any():
            twice = cold & wide & (lack[set_] > 0)
            up = twice & (rank(twice, -count) < lack[set_])
            value[up] = 2
            lack = np.maximum(lack - np.bincount(set_[up], minlength=len(size)), 0)
            warm = ~cold & (lack[set_] > 0)
            once = warm & (rank(warm, price, -count) < lack[set_])
            value[once] = 1
            lack = np.maximum(lack - np.bincount(set_[once], minlength=len(size)), 0)
            twice = warm & wide & (lack[set_] > 0)
            up = twice & (rank(twice, price, -count) < lack[set_])
            value[up] = 2
            lack = np.maximum(lack - np.bincount(set_[up], minlength=len(size)), 0)
        used = np.zeros(len(size), bool)
        used[set_] = True
        short = np.flatnonzero(used & (lack > 0))
        held = 0 if below else 2
        role = held + (value > 0)
        with np.errstate(over="ignore"):
            whole = textkit.mix(total + salt_)
        keep = role > 0
        owners, signs = [set_[keep]], [whole[keep] & ~np.uint64(3) | role[keep].astype(np.uint64)]
        near = wide & ((value == 2) | (held > 0))  # one-deletion neighbourhoods
        near_t = np.repeat(near, count)
        if near_t.any():
            seg = np.repeat(np.arange(len(set_)), count)[near_t]
            with np.errstate(over="ignore"):
                less = textkit.mix(total[seg] - token[near_t] + salt_[seg])
            owners.append(set_[seg])
            signs.append(less & ~np.uint64(3) | (held + (value[seg] == 2)).astype(np.uint64))
        return (np.concatenate(owners), np.concatenate(signs)), short


def _signatures(texts: DataFrame, alloc: Allocation, labels: np.ndarray, each: int, salt: int) -> DataFrame:
    """task (of ``labels``), part (of ``each`` a task), and packed signatures and set names; part -1: names of sets that have too few segments."""
    columns = ["task", "part", "signs", "names"]

    def rows(batches):
        seen: set = set()
        held, waiting = [], 0
        n_parts = len(labels) * each

        def flush():
            sign, name = np.concatenate([s for s, _ in held]), np.concatenate([k for _, k in held])
            part = ((sign >> np.uint64(34)) % np.uint64(n_parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            sign, name, part = sign[order], name[order], part[order]
            ends = np.searchsorted(part, np.arange(n_parts + 1))
            some = np.flatnonzero(np.diff(ends))
            cut = [slice(ends[p], ends[p + 1]) for p in some]
            sign = sign.view(np.uint8).reshape(-1, 8)[:, :SIGN_BYTES]
            return pa.RecordBatch.from_arrays([pa.array(labels[some // each].astype(np.int32)), pa.array(some.astype(np.int32)), pa.array([sign[c].tobytes() for c in cut]), pa.array([name[c].tobytes() for c in cut])], columns)

        for b in batches:
            for _, data, offs in textkit.slices(b.column(0)):
                n = len(offs) - 1
                owner, token = shingles(data, offs)
                size, name = set_ids(owner, token, n, salt)
                new = np.zeros(n, bool)
                for i, k in enumerate(name.tolist()):
                    if k and k not in seen:
                        seen.add(k)
                        new[i] = True
                keep = new[owner]
                if not keep.any():
                    continue
                set_, sign, short = alloc.signatures(owner[keep], token[keep], np.where(new, size, 0))
                held.append((sign, name[set_]))
                waiting += len(sign)
                if len(short):
                    yield pa.RecordBatch.from_arrays([pa.array(labels[:1].astype(np.int32)), pa.array(np.full(1, -1, np.int32)), pa.array([b""]), pa.array([name[short].tobytes()])], columns)
                if waiting > FLUSH:
                    yield flush()
                    held, waiting = [], 0
        if held:
            yield flush()
        held, seen = [], set()
        shared.trim()

    return texts.select("text").mapInArrow(rows, "task int, part int, signs binary, names binary")


def _stars(key: np.ndarray, name: np.ndarray, role: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(centre, set), without repeats, of the buckets with two sets or more, one of them looking; the centre is a set too."""
    order = np.argsort(key, kind="stable")
    key, name, role = key[order], name[order], role[order]
    same = key[1:] == key[:-1]
    shared_ = np.zeros(len(key), bool)
    shared_[1:] |= same
    shared_[:-1] |= same
    key, name, role = key[shared_], name[shared_], role[shared_]
    if not len(key):
        return key, name
    order = np.lexsort((textkit.mix(name), key))
    key, name, role = key[order], name[order], role[order]
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    count = np.diff(np.concatenate((start, [len(key)])))
    ok = (np.bitwise_or.reduceat(role, start) & 1 > 0) & (name[start] != name[start + count - 1])
    centre, name = np.repeat(name[start], count)[np.repeat(ok, count)], name[np.repeat(ok, count)]
    return _once(centre, name)


def _once(centre: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs without repeats."""
    order = np.lexsort((name, centre))
    centre, name = centre[order], name[order]
    new = np.concatenate(([True], (centre[1:] != centre[:-1]) | (name[1:] != name[:-1]))) if len(name) else np.empty(0, bool)
    return centre[new], name[new]


def _buckets(packed: DataFrame, n: int) -> DataFrame:
    """kind 1: centre a, set b. kind 2: set a with too few segments. A signature comes in ``SIGN_BYTES`` bytes, enough
    to tell those of one part apart: two that fall together make a needless bucket. A task holds one part's signatures at a time, and
    the pairs of all its parts: two near copies share buckets in every part, however many parts there are."""

    def pairs(part, held):
        signs = []
        own = textkit.mix(np.uint64([part + 1]))
        for s in (s for b in held for s in b.column(2)):
            s = s.as_buffer()
            whole = np.zeros((len(s) // SIGN_BYTES, 8), np.uint8)
            whole[:, :SIGN_BYTES] = np.frombuffer(s, np.uint8).reshape(-1, SIGN_BYTES)
            sign = whole.reshape(-1).view(np.uint64)
            signs.append(textkit.mix((sign >> np.uint64(2)) ^ own) & ~np.uint64(3) | sign & np.uint64(3))
        sign, name = np.concatenate(signs), np.concatenate([np.frombuffer(k.as_buffer(), np.uint64) for b in held for k in b.column(3)])
        return _stars(sign >> np.uint64(2), name, (sign & np.uint64(3)).astype(np.int32))

    def rows(batches):
        def put(kind, a, b):
            for i in range(0, len(a), 1 << 16):
                c, d = (v[i : i + (1 << 16)].view(np.int64) for v in (a, b))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), kind, np.int32)), pa.array(c), pa.array(d)], ["kind", "a", "b"])

        short, centre, name = [], np.empty(0, np.uint64), np.empty(0, np.uint64)
        for (_, part), held in _runs(batches, 2):
            if part < 0:
                short += [np.frombuffer(k.as_buffer(), np.uint64) for b in held for k in b.column(3)]
                continue
            found = pairs(part, held)
            centre, name = _once(np.concatenate((centre, found[0])), np.concatenate((name, found[1])))
            del held, found
            shared.trim()
            if len(centre) > FLUSH:
                yield from put(1, centre, name)
                centre, name = centre[:0].copy(), name[:0].copy()
        if short:
            a = np.unique(np.concatenate(short))
            yield from put(2, a, a)
        yield from put(1, centre, name)

    return packed.repartition(n, "task").sortWithinPartitions("task", "part").mapInArrow(rows, "kind int, a long, b long")


def _even_labels(spark, n: int) -> np.ndarray:
    """n int labels of which repartition(n, label) puts one in each partition."""
    at = spark.range(n * 40).select(F.col("id").cast("int").alias("x")).select("x", F.expr(f"pmod(hash(x), {n})").alias("p")).groupBy("p").agg(F.min("x").alias("x")).collect()
    return np.array(sorted(r["x"] for r in at), np.int64)


def _sets(texts: DataFrame, wanted: np.ndarray, salt: int) -> DataFrame:
    """name, tokens (sorted) of the documents whose ids pass the bitmap (the first of each set's, and few others)."""

    def rows(batches):
        for b in batches:
            ok = shared.passes(wanted, b.column(1).to_numpy(zero_copy_only=False))
            if not ok.any():
                continue
            some = pa.array(b.column(0).filter(pa.array(ok)))
            for _, data, offs in textkit.slices(some):
                n = len(offs) - 1
                owner, token = shingles(data, offs)
                size, name = set_ids(owner, token, n, salt)
                stop = np.cumsum(size)
                full = np.flatnonzero(size)
                if len(full):
                    yield pa.RecordBatch.from_arrays([pa.array(name[full].view(np.int64)), pa.array([token[stop[i] - size[i] : stop[i]].tobytes() for i in full], pa.binary())], ["name", "tokens"])

    return texts.select("text", F.xxhash64("doc_id")).mapInArrow(rows, "name long, tokens binary")


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted token arrays reach the threshold."""
    if DEN * min(len(a), len(b)) < NUM * max(len(a), len(b)):
        return False
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int(np.count_nonzero(large[at] == small))
    return DEN * both >= NUM * (len(a) + len(b) - both)


def settle(names: np.ndarray, sets: list[np.ndarray], centre: int) -> list[tuple[int, int]]:
    """Links that connect the group: all its links, up to what they connect. ``centre``: the centre's place."""
    k, c = len(sets), sets[centre]
    size = np.array([len(s) for s in sets], np.int64)
    apart = [np.setxor1d(s, c, assume_unique=True) for s in sets]
    lost = (len(c) - size + np.array([len(d) for d in apart], np.int64)) // 2  # tokens of the centre that a set lacks
    root = np.arange(k)
    out = []

    def join_(i, j):
        out.append((int(names[i]), int(names[j])))
        root[root == root[j]] = root[i]

    def near(both, i):
        return DEN * both >= NUM * (size[i] + size - both)

    hits = near(len(c) - lost, centre)
    for j in np.flatnonzero(hits):
        if j != centre:
            join_(centre, j)
    left = np.flatnonzero(root != root[centre])
    if k < 3 or not len(left):
        return out

    def posting(lists):
        token = np.concatenate(lists)
        owner = np.repeat(np.arange(k), [len(x) for x in lists])
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        start = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        count = np.diff(np.concatenate((start, [len(token)])))
        place = np.empty(len(token), np.int64)
        place[order] = np.repeat(np.arange(len(start)), count)
        return owner, start, count, place

    plans = [posting(apart), posting(sets)]
    by_apart = (plans[0][2] ** 2).sum() <= (plans[1][2] ** 2).sum()
    owner, start, count, place = plans[0 if by_apart else 1]
    stop = np.cumsum([len(x) for x in (apart if by_apart else sets)])
    for i in left:
        own = place[(stop[i - 1] if i else 0) : stop[i]]
        own = own[count[own] > 1]
        n = count[own]
        if n.sum():
            at = np.repeat(start[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            both = np.bincount(owner[at], minlength=k)
        else:
            both = np.zeros(k, np.int64)
        if by_apart:
            both = both + len(c) - lost[i] - lost
        ok = near(both, i) & (root != root[i])
        while ok.any():
            join_(i, int(np.argmax(ok)))
            ok &= root != root[i]
    return out


def _ints(size: list[int], sketch: list[bytes]) -> list[dict[int, int]]:
    """Each sketch as an integer, in its own width and, where it has one, in half of it."""
    out = []
    for k in sketch:
        whole, half = int.from_bytes(k, "little"), len(k) * 4
        out.append({half * 2: whole} | ({half: (whole >> half) ^ (whole & ((1 << half) - 1))} if half >= 64 else {}))
    return out


class Sketched:
    """The sketches of some sets; ``near(i)``: which of them may be linked with the i-th."""

    FEW = 24

    def __init__(self, size: np.ndarray, sketch: list[bytes]):
        self.size, self.width = size, np.array([len(k) * 8 for k in sketch], np.int64)
        self.few = _ints(size.tolist(), sketch) if len(sketch) <= self.FEW else None
        if self.few is None:
            self.at = {int(w): np.flatnonzero(self.width == w) for w in np.unique(self.width)}
            self.whole = {w: np.frombuffer(b"".join(sketch[i] for i in at), np.uint64).reshape(len(at), -1) for w, at in self.at.items()}
            self.half = {w: m[:, : m.shape[1] // 2] ^ m[:, m.shape[1] // 2 :] for w, m in self.whole.items() if w >= 128}
            self.place = np.empty(len(sketch), np.int64)
            for at in self.at.values():
                self.place[at] = np.arange(len(at))

    def near(self, i: int) -> np.ndarray:
        n, w = int(self.size[i]), int(self.width[i])
        total = self.size + n
        far = np.full(len(self.size), 1 << 60, np.int64)
        if self.few is not None:
            own = self.few[i]
            for j, other in enumerate(self.few):
                v = next((v for v in own if v in other), 0)  # the widest that both have
                if v:
                    far[j] = (own[v] ^ other[v]).bit_count()
        else:
            own = self.whole[w][self.place[i]]
            for v, table in ((w, self.whole), (2 * w, self.half)):
                if v in table:
                    far[self.at[v]] = np.bitwise_count(table[v] ^ own).sum(axis=1, dtype=np.int64)
            if w >= 128 and w // 2 in self.whole:
                far[self.at[w // 2]] = np.bitwise_count(self.whole[w // 2] ^ self.half[w][self.place[i]]).sum(axis=1, dtype=np.int64)
        alike = DEN * np.minimum(self.size, n) >= NUM * np.maximum(self.size, n)
        return alike & (far <= total * (DEN - NUM) // (DEN + NUM))


def parts(size: np.ndarray, sketch: list[bytes], centre: int) -> np.ndarray:
    """A label for every set; sets that are linked have one label."""
    sketched, root = Sketched(size, sketch), np.arange(len(size))
    root[sketched.near(centre)] = centre
    root[centre] = centre
    for i in np.flatnonzero(root != centre):
        for r in np.unique(root[sketched.near(int(i))]):
            root[root == r] = root[i]
    return root


def _runs(batches, keys: int):
    """(key, batches of its rows) for rows sorted by their first ``keys`` columns."""
    last, held = None, []
    for b in batches:
        columns = [b.column(k).to_numpy() for k in range(keys)]
        change = np.zeros(max(b.num_rows - 1, 0), bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), b.num_rows]
        for s, e in zip(cuts, cuts[1:]):
            if s == e:
                continue
            key = tuple(int(c[s]) for c in columns)
            if key != last and held:
                yield last, held
                held = []
            last = key
            held.append(b.slice(s, e - s))
    if held:
        yield last, held


def _parted(blocks: DataFrame) -> DataFrame:
    """part, x of the sets (c, i, j, x, n, sketch) that may be linked with another one of their block."""

    def rows(batches):
        out, waiting = [], 0
        for key, held in _runs(batches, 3):
            x = np.concatenate([b.column(3).to_numpy() for b in held])
            x, one = np.unique(x, return_index=True)
            if len(x) < 2:
                continue
            size = np.concatenate([b.column(4).to_numpy() for b in held])[one]
            sketch = [k for b in held for k in b.column(5).to_pylist()]
            centre = np.flatnonzero(x == key[0])
            root = parts(size, [sketch[i] for i in one], int(centre[0]) if len(centre) else 0)
            label, count = np.unique(root, return_counts=True)
            for r in label[count > 1]:
                own = x[root == r]
                with np.errstate(over="ignore"):
                    part = textkit.mix(textkit.mix(own.view(np.uint64)).sum(keepdims=True)).view(np.int64)
                out.append((np.repeat(part, len(own)), own))
                waiting += len(own)
            if waiting > 1 << 14:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["part", "x"])
                out, waiting = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["part", "x"])

    ordered = blocks.select("c", "i", "j", "x", "n", "sketch").repartition("c", "i", "j").sortWithinPartitions("c", "i", "j")
    return ordered.mapInArrow(rows, "part long, x long").distinct()


def _maximal(refined: DataFrame, tables: shared.Tables) -> DataFrame:
    """The parts (part, x) without those whose sets all have one and the same other part as their largest: that one
    holds them all, and every link among them."""
    ranked = tables.stored(refined.join(refined.groupBy("part").agg(F.count("*").alias("k")), "part"))
    best = ranked.groupBy("x").agg(F.max(F.struct("k", "part")).alias("m")).select("x", F.col("m.part").alias("m"))
    stay = ranked.join(best, "x").groupBy("part").agg(F.min("m").alias("low"), F.max("m").alias("high")).filter("low <> high OR low = part")
    return tables.stored(refined.join(stay.select("part"), "part", "left_semi"))


def _settled(shipped: DataFrame) -> DataFrame:
    """a, b: links that connect the sets (part, x, tokens) of each part as its links do."""

    def rows(batches):
        for _, held in _runs(batches, 1):
            names = np.concatenate([b.column(1).to_numpy() for b in held])
            names, one = np.unique(names, return_index=True)
            blobs = [k for b in held for k in b.column(2)]
            members = [np.frombuffer(blobs[i].as_py(), np.uint64) for i in one]
            found = settle(names, members, head(members)) if len(members) > 1 else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"])

    return shipped.select("part", "x", "tokens").repartition("part").sortWithinPartitions("part").mapInArrow(rows, "a long, b long")


def head(members: list[np.ndarray]) -> int:
    """The set with the largest share of tokens that others of the part have too (the first of such)."""
    token = np.concatenate(members)
    _, place, count = np.unique(token, return_inverse=True, return_counts=True)
    size = np.array([len(m) for m in members])
    return int(np.argmax(np.add.reduceat(count[place], np.cumsum(size) - size) / size))


def _linked_in(both: DataFrame) -> DataFrame:
    """a, b of the rows a, b, s, t (token sets) that are links."""

    def rows(batches):
        for b in batches:
            ok = [linked(np.frombuffer(s.as_py(), np.uint64), np.frombuffer(t.as_py(), np.uint64)) for s, t in zip(b.column(2), b.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.select("a", "b", "s", "t").mapInArrow(rows, "a long, b long")


def _bits(n: int) -> int:
    """Bits of a bitmap over n ids: 16 an id, between the two bounds."""
    return 1 << min(BLOOM_MOST, max(BLOOM_LEAST, (16 * n - 1).bit_length() if n else 0))


def links_of(texts: DataFrame, classes: DataFrame, groups: DataFrame, tables: shared.Tables, salt: int = 0) -> DataFrame:
    """a, b, stored: links that connect whatever the groups' links connect. ``classes``: set_name, least, n_shingles, sketch."""
    # merge joins where texts or sketches move: the same plan, and the same disk for each GB, at every size
    sized = groups.join(classes.select(F.col("set_name").alias("x"), "least", F.col("n_shingles").alias("n"), "sketch").hint("merge"), "x")
    sized = tables.stored(sized)
    weight = sized.groupBy("c").agg(F.count("*").alias("k"), F.sum("n").alias("t"))
    weight = tables.stored(weight.select("c", F.greatest(F.ceil(F.col("k") / GROUP_SETS), F.ceil(F.col("t") * 8 / GROUP_BYTES), F.lit(1)).cast("int").alias("g")))
    placed = sized.join(weight, "c")
    zero = F.lit(0)
    refined = tables.stored(_parted(placed.filter("g = 1").select("c", zero.alias("i"), zero.alias("j"), "x", "n", "sketch")))
    large = tables.stored(placed.filter("g > 1"))
    wanted = refined.select("x").join(classes.select(F.col("set_name").alias("x"), "least"), "x").select("least").unionByName(large.select("least"))
    wanted = tables.stored(wanted.distinct())
    sets, near = _sets(texts, shared.bloom(wanted, "least", _bits(wanted.count())), salt), None
    if large.limit(1).count():  # the sets are read three times then
        sets = tables.stored(sets)
        salts = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        own = lambda n: F.pmod(F.xxhash64(F.lit(7), "x"), F.col(n)).cast("int")
        heads = tables.stored(large.filter("c = x").select("c", "g", F.col("n").alias("cn"), F.col("sketch").alias("cs")))
        whole = tables.stored(heads.join(sets.select(F.col("name").alias("c"), F.col("tokens").alias("s")), "c").dropDuplicates(["c"]).select("c", "s", salts("g").alias("_y")))
        first = _may_be(large.filter("c <> x").select("c", "x", "n", "sketch", own("g").alias("_y")).join(heads.select("c", "cn", "cs", salts("g").alias("_y")), ["c", "_y"]))
        first = first.join(sets.select(F.col("name").alias("x"), F.col("tokens").alias("t")), "x").join(whole, ["c", "_y"])
        near = tables.stored(_linked_in(first.select(F.col("c").alias("a"), F.col("x").alias("b"), "s", "t")))
        rest = large.join(near.select(F.col("a").alias("c"), F.col("b").alias("x")), ["c", "x"], "left_anti").filter("c <> x")
        rest = tables.stored(rest.select("c", "x", "n", "sketch", "g"))
        # left-over sets in blocks of a share of g, each with every block of the whole group
        share = rest.groupBy("c").agg(F.count("*").alias("r")).select("c", F.greatest(F.ceil(F.col("r") / GROUP_SETS), F.lit(1)).cast("int").alias("q"))
        share = tables.stored(share)
        block = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "x"), F.col(n)).cast("int")
        asks = rest.join(share, "c").select("c", block("q", 1).alias("i"), salts("g").alias("j"), "x", "n", "sketch")
        told = large.filter("c <> x").join(share, "c").select("c", salts("q").alias("i"), block("g", 2).alias("j"), "x", "n", "sketch")
        middle = large.filter("c = x").join(share, "c").select("c", "x", "n", "sketch", "q", salts("g").alias("j")).select("c", salts("q").alias("i"), "j", "x", "n", "sketch")
        refined = tables.stored(refined.unionByName(_parted(asks.unionByName(told).unionByName(middle))).distinct())
    found = tables.stored(_settled(_maximal(refined, tables).join(sets.hint("merge"), F.col("x") == F.col("name"))))
    return found if near is None else found.unionByName(near)


def _may_be(both: DataFrame) -> DataFrame:
    """c, x, _y of the rows whose sketches (n, sketch; cn, cs) are near enough."""

    def rows(batches):
        for b in batches:
            ok = [bool(Sketched(np.array([n, m], np.int64), [s, t]).near(0)[1]) for n, s, m, t in zip(*(b.column(k).to_pylist() for k in (3, 4, 5, 6)), strict=True)]
            yield pa.RecordBatch.from_arrays(b.columns[:3], ["c", "x", "_y"]).filter(pa.array(ok, pa.bool_()))

    return both.select("c", "x", "_y", "n", "sketch", "cn", "cs").mapInArrow(rows, "c long, x long, _y int")


def components(links: DataFrame, tables: shared.Tables) -> DataFrame:
    """name, root for every name in a link: alternating large and small stars, every step stored, until every
    name has one edge and no root has an edge of its own."""
    edges = tables.stored(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    ends = F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
    both = F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))
    while True:
        uses = edges.select(ends.alias("e")).groupBy("e.x").agg(F.sum("e.up").alias("up"), F.max("e.down").alias("down"))
        if not uses.filter("up > 1 OR (up > 0 AND down > 0)").limit(1).count():
            return edges.select(F.col("u").alias("name"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("name"), F.col("v").alias("root")).distinct())
        near = edges.select(both.alias("e")).select("e.*")
        least = tables.stored(near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        wide = near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = tables.stored(wide.filter("u <> v").distinct())
        least = tables.stored(edges.groupBy("u").agg(F.min("v").alias("m")))
        narrow = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = tables.stored(narrow.filter("u <> v").distinct())


def _rest(texts: DataFrame, classes: DataFrame, short: DataFrame, tables: shared.Tables, salt: int) -> DataFrame | None:
    """Links of the sets that have too few segments, each compared with every set, in blocks of ``REST_BLOCK`` names;
    no more than a block of them is on the driver at a time."""
    spark, out, block = texts.sparkSession, None, []

    def compared(block):
        names = spark.createDataFrame([(k,) for k in block], "set_name long")
        wanted = shared.bloom(classes.join(names, "set_name"), "least", 1 << 16)
        own = {r["name"]: np.frombuffer(r["tokens"], np.uint64) for r in _sets(texts, wanted, salt).join(names.withColumnRenamed("set_name", "name"), "name").toLocalIterator()}

        def rows(batches):
            for b in batches:
                for _, data, offs in textkit.slices(b.column(0)):
                    owner, token = shingles(data, offs)
                    size, name = set_ids(owner, token, len(offs) - 1, salt)
                    stop = np.cumsum(size)
                    hit = [(k, int(name[j].view(np.int64))) for j in np.flatnonzero(size) for k, s in own.items() if linked(s, token[stop[j] - size[j] : stop[j]])]
                    if hit:
                        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in hit]), pa.array([y for _, y in hit])], ["a", "b"])

        return tables.stored(texts.select("text").mapInArrow(rows, "a long, b long").filter("a <> b").distinct())

    for r in short.toLocalIterator():
        block.append(r[0])
        if len(block) == REST_BLOCK:
            out, block = compared(block) if out is None else out.unionByName(compared(block)), []
    if block:
        out = compared(block) if out is None else out.unionByName(compared(block))
    return out


def _release(spark) -> None:
    """Let Spark drop the shuffle files of finished steps now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _classes(texts: DataFrame, tables: shared.Tables) -> tuple[DataFrame, DataFrame, int]:
    """The description of all documents, its classes of equal sets, and the salt under which no two different sets have one name."""
    salt = 0
    while True:
        told = tables.stored(_describe(texts, salt))
        full = told.filter("kind = 0 AND b > 0").groupBy(F.col("c").alias("set_name"))
        classes = tables.stored(full.agg(F.min("a").alias("least"), F.max("b").alias("n_shingles"), F.min("d").alias("d0"), F.max("d").alias("d1"), F.max("sketch").alias("sketch")))
        if not classes.filter("d0 <> d1").limit(1).count():
            return told, classes, salt
        salt += 1


def _placed(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """doc_id, n_shingles, set_name of every row; set_name, least, component and root (a set name that only this component
    has) of every class; the salt of the names."""
    spark = docs.sparkSession
    shared.small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kept, tables = shared.Tables(spark), shared.Tables(spark)
    told, classes, salt = _classes(texts, kept)
    rows = told.filter("kind = 0").select(F.col("a").alias("doc_id"), F.col("b").alias("n_shingles"), F.col("c").alias("set_name"))
    often = shared.largest(told.filter("kind = 1").groupBy("a").agg(F.sum("b").alias("n")), "n", HOT_TOKENS).toPandas()
    alloc = Allocation(often["a"].to_numpy(np.int64).view(np.uint64), often["n"].to_numpy(np.int64))
    total = classes.agg(F.sum("n_shingles")).first()[0] or 0
    parts = max(1, -(-total * (SIGN_BYTES + 8) // PART_BYTES))
    n = max(spark.sparkContext.defaultParallelism, -(-parts // TASK_PARTS))
    kinds = tables.stored(_buckets(_signatures(texts, alloc, _even_labels(spark, n), -(-parts // n), salt), n))
    _release(spark)
    groups = kinds.filter("kind = 1").select(F.col("a").alias("c"), F.col("b").alias("x")).distinct()
    links = links_of(texts, classes, groups, tables, salt)
    rest = _rest(texts, classes, kinds.filter("kind = 2").select("a").distinct(), tables, salt)
    if rest is not None:
        links = links.unionByName(rest)
    _release(spark)
    roots = tables.stored(components(links, tables))
    placed = tables.stored(classes.join(roots, classes["set_name"] == roots["name"]).select("set_name", "least", "root"))
    heads = tables.stored(placed.groupBy("root").agg(F.min("least").alias("component")))
    grouped = placed.join(heads, "root").select("set_name", "component", "root")
    final = classes.select("set_name", "least").join(grouped, "set_name", "left")
    final = final.select("set_name", "least", F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component")).alias("component"), F.coalesce("root", "set_name").alias("root"))
    final = kept.stored(final)
    tables.drop()
    _release(spark)
    return rows, final, salt


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_name, component_id (the smallest doc_id of the component; null if all are null), for every
    row. Rows are dealt over ``SALTS`` places of their class, so a class of many copies is not one task's."""
    rows, final, _ = _placed(docs)
    final = final.select("set_name", F.col("component").alias("_c"), F.explode(F.array(*(F.lit(k) for k in range(SALTS)))).alias("_y"))
    own = rows.withColumn("_y", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    met = own.filter("n_shingles > 0").join(final, ["set_name", "_y"], "left").select("doc_id", "n_shingles", "set_name", F.col("_c").alias("component_id"))
    return met.unionByName(rows.filter("n_shingles = 0").select("doc_id", "n_shingles", "set_name", F.col("doc_id").alias("component_id")))


def _named(docs: DataFrame, salt: int) -> DataFrame:
    """d (the whole row), _i, _null (the id, and whether it is null), _e (no shingles), _s (the set's name; without
    shingles a number that no other row has)."""
    schema = f"d {docs.schema.simpleString()}, _i long, _null boolean, _e boolean, _s long"
    packed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("d"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def rows(batches):
        done = TaskContext.get().partitionId() << 40
        for b in batches:
            size, name = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.uint64)
            for at, data, offs in textkit.slices(b.column(2)):
                n = len(offs) - 1
                size[at : at + n], name[at : at + n] = set_ids(*shingles(data, offs), n, salt)
            name = np.where(size > 0, name.view(np.int64), done + np.arange(b.num_rows))
            done += b.num_rows
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1).fill_null(0), b.column(1).is_null(), pa.array(size == 0), pa.array(name)], ["d", "_i", "_null", "_e", "_s"])

    return packed.mapInArrow(rows, schema)


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest id (one row, if that id is repeated there; one without
    an id only where no document of the component has one); documents without shingles all stay. Components are told
    apart by their sets, so null or repeated ids never join them. All columns as they were."""
    _, final, salt = _placed(docs)
    stay = final.filter("least <=> component").groupBy("root").agg(F.min("set_name").alias("_s"), F.min("component").alias("_c"))
    stay = stay.select(F.coalesce("_c", F.lit(0)).cast("long").alias("_i"), F.col("_c").isNull().alias("_null"), F.lit(False).alias("_e"), "_s", F.lit(True).alias("_stay"))
    stay = shared.stored(stay, shared.scratch(docs.sparkSession))
    keys = ["_i", "_null", "_e", "_s"]
    met = _named(docs, salt).join(stay, keys, "left").filter("_e OR _stay")
    return met.dropDuplicates(keys).select("d.*")


def op9_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return join(shared.table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


shared.by_value(__name__)
