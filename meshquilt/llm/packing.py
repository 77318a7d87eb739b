"""Best-fit packing (4): bin completion branch-and-bound over a length histogram.

Token sequences have at most ``size`` places, so a corpus is described, for packing, by ``size`` counts
whatever its number of documents. The packer works on those counts: it takes the largest waiting length,
enumerates the undominated fillings of the rest of its sequence (none of whose lengths fit together into one
longer length that is there), least waste first, and uses the chosen filling as often as the counts allow, or
once. Choices are searched depth first, over all lengths; a branch ends when its waste is more than the wanted
number of sequences has to spare. The first incumbent is best-fit decreasing. What the search over the whole
histogram leaves is searched on: sequences that are not full, with some full ones, are packed anew into one
less. It ends at the lower bound, or after ``NODES`` steps (one or two seconds, whatever the input).

The plan (one row per pattern and length) is then dealt out: pieces are numbered within their length, by
the write task that made them plus a running number there, so no length is ever gathered in one task.

Defined results: a null or empty text is its end id alone; rows of a null doc_id are packed as any; a text of more than ``size`` tokens is cut into
pieces of ``size``, the first one shorter; repeated rows are packed each; an empty table gives no rows;
only doc_id and text are read, so other columns can have any names.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared

SIZE, END = 1024, 2
NODES, ROUNDS, SEED = 200_000, 64, 5
BLANKS = 1 << 16
#: The pre-tokenisation pattern of byte-level BPE vocabularies of this kind (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ENCODERS: dict = {}


class Encoder:
    """``ids(text)``: those of the tokenizers library for a JSON file, without its added special tokens.

    The library is asked for texts that hold a token added to the vocabulary (as an end-of-text mark) or more than ``BLANKS`` blanks
    in a run (the other's pattern steps back blank by blank and runs out of stack at about a million), and for all texts
    where the file is not a plain byte-level BPE whose merges stand in the order of their ids. Elsewhere merging by id
    gives the same ids in a quarter of the time, which a test holds against the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.added = [t["content"] for t in whole["added_tokens"]]
        self.fast = self._by_ids(whole)

    @staticmethod
    def _by_ids(whole: dict):
        model, before = whole["model"], whole["pre_tokenizer"] or {}
        odd = [model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")]
        plain = model["type"] == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        if not plain or any(odd) or whole["normalizer"] or whole["truncation"] or whole["padding"]:
            return None
        import tiktoken

        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        order = [model["vocab"][a + b] for a, b in merges]
        if any(x >= y for x, y in zip(order, order[1:])):
            return None
        made = {a + b for a, b in merges}
        ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t in made or len(t) == 1}
        return tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast is None or any(t in text for t in self.added) or len(text) > BLANKS and any(len(r) > BLANKS for r in re.findall(r"\s+", text)):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def best_fit(counts: np.ndarray, size: int) -> list[tuple[dict, int]]:
    """Best-fit decreasing on a histogram: [(length -> uses, times)]."""
    waiting: dict[int, list] = {}  # room -> [(pattern, times)]
    rooms = np.zeros(size + 1, bool)
    done: list = []

    def put(room, pattern, times):
        if room == 0:
            done.append((pattern, times))
        else:
            waiting.setdefault(room, []).append((pattern, times))
            rooms[room] = True

    for length in range(size, 0, -1):
        c = int(counts[length])
        while c:
            fits = np.flatnonzero(rooms[length:])
            if not len(fits):
                each = size // length
                if c >= each:
                    put(size - each * length, {length: each}, c // each)
                if c % each:
                    put(size - (c % each) * length, {length: c % each}, 1)
                break
            room = length + int(fits[0])
            pattern, times = waiting[room].pop()
            # one bin is filled as far as it goes before the next one is touched
            each = min(room // length, c)
            use = min(times, c // each)
            if times > use:
                waiting[room].append((pattern, times - use))
            rooms[room] = bool(waiting[room])
            put(room - each * length, pattern | {length: pattern.get(length, 0) + each}, use)
            c -= each * use
    return done + [p for ps in waiting.values() for p in ps]


def least_sequences(counts: np.ndarray, size: int) -> int:
    """A lower bound: for every k, lengths over size - k fill a sequence alone, and what lengths from k to half a
    sequence do not find room for beside the other long ones needs more."""
    at = np.arange(size + 1)
    number, volume = np.concatenate(([0], np.cumsum(counts))), np.concatenate(([0], np.cumsum(counts * at)))  # below an index
    best = -(-int(volume[-1]) // size)
    for k in range(1, size // 2 + 1):
        alone = int(number[size + 1] - number[size - k + 1])
        long = int(number[size - k + 1] - number[size // 2 + 1])
        room = long * size - int(volume[size - k + 1] - volume[size // 2 + 1])
        rest = int(volume[size // 2 + 1] - volume[k])
        best = max(best, alone + long + max(0, -(-(rest - room) // size)))
    return best


class Steps:
    """A budget of search steps."""

    def __init__(self, left: int):
        self.left = left

    def take(self) -> bool:
        self.left -= 1
        return self.left >= 0


def fillings(left: list[int], room: int, waste: int, steps: Steps):
    """The undominated fillings of ``room`` with the lengths counted in ``left`` that waste no more than ``waste``, least waste
    first, then fewest and largest lengths first, one at a time. One is dominated if some of its lengths fit together
    into a longer one that is there and fits in their place."""
    lengths = [x for x in range(min(room, len(left) - 1), 0, -1) if left[x]]
    there, whole = 0, (1 << (room + 1)) - 1
    for x in lengths:
        there |= 1 << x
    sums = [1]  # bit s of sums[k]: s is a sum of k lengths at most
    while True:
        more = sums[-1]
        for x in lengths:
            more |= sums[-1] << x
        more &= whole
        if more == sums[-1]:
            break
        sums.append(more)

    def dominated(pick: dict[int, int], slack: int) -> bool:
        lows = [(0, 0, 0)]  # sum, lengths, the largest of them
        for x, u in pick.items():
            lows = [(s + x * k, n + k, max(m, x if k else 0)) for s, n, m in lows for k in range(min(u, 2) + 1)]
            if len(lows) > 256:
                break
        for s, n, m in lows:
            if n and s + slack > m:
                low = max(s, m + 1)
                window = there >> low & ((1 << (s + slack - low + 1)) - 1)
                while window:
                    y = low + (window & -window).bit_length() - 1
                    if left[y] > pick.get(y, 0):
                        return True
                    window &= window - 1
        return False

    def exactly(total: int, k: int, most: int, pick: dict[int, int]):
        if not steps.take():
            return
        if not total:
            yield dict(pick)
            return
        for x in lengths:
            if x <= most and x <= total and x * k >= total and sums[k - 1] >> (total - x) & 1 and left[x] > pick.get(x, 0):
                pick[x] = pick.get(x, 0) + 1
                yield from exactly(total - x, k - 1, x, pick)
                if pick[x] == 1:
                    del pick[x]
                else:
                    pick[x] -= 1
                if steps.left < 0:
                    return

    for total in range(room, max(room - waste, 0) - 1, -1):
        if not sums[-1] >> total & 1:
            continue
        for k in range(len(sums)):
            if sums[k] >> total & 1 and (not k or k <= total):
                for pick in exactly(total, k, total, {}):
                    if sum(pick.values()) == k and not dominated(pick, room - total):
                        yield pick
        if steps.left < 0:
            return


def search(counts: np.ndarray, size: int, most: int, steps: Steps) -> list[tuple[dict, int]] | None:
    """A packing into ``most`` sequences or fewer, or None where the search ends without one. Depth first: the largest
    length opens a sequence, its undominated fillings are tried in turn, each as often as the counts allow and
    then once, and a branch ends when its waste is more than ``most`` sequences have to spare."""
    left = [int(c) for c in counts]
    spare = most * size - int((np.asarray(counts) * np.arange(size + 1)).sum())
    if spare < 0 or least_sequences(np.asarray(counts), size) > most:
        return None
    done: list[tuple[dict, int]] = []

    def choices(top, spare):
        left[top] -= 1
        for pick in fillings(left, size - top, spare, steps):
            pattern = {top: 1}
            for x, u in pick.items():
                pattern[x] = pattern.get(x, 0) + u
            left[top] += 1
            lost = size - sum(x * u for x, u in pattern.items())
            times = min(left[x] // u for x, u in pattern.items())
            if lost:
                times = min(times, spare // lost)
            for n in (times, 1) if times > 1 else (1,):
                if n:
                    yield pattern, n, lost * n
            left[top] -= 1
        left[top] += 1

    def top_of(start):
        while start and not left[start]:
            start -= 1
        return start

    top = top_of(size)
    if not top:
        return []
    stack = [(choices(top, spare), top, spare)]
    while stack:
        options, top, now = stack[-1]
        if len(done) == len(stack):  # come back: undo
            pattern, n = done.pop()
            for x, u in pattern.items():
                left[x] += n * u
        pick = next(options, None) if steps.left >= 0 else None
        if pick is None:
            if steps.left < 0:
                return None
            stack.pop()
            continue
        pattern, n, lost = pick
        for x, u in pattern.items():
            left[x] -= n * u
        done.append((pattern, n))
        below = top_of(top)
        if not below:
            return list(done)
        stack.append((choices(below, now - lost), below, now - lost))
    return None


def complete(counts: np.ndarray, size: int = SIZE, nodes: int = NODES) -> list[tuple[dict, int]]:
    """Patterns and how often each is used, for ``counts`` (index: length, 0 to ``size``). The incumbent is best fit; the search
    asks for a sequence less, first in the whole histogram, from far below down to one less, then among the
    sequences that are not full and a share of the full ones, until the lower bound is met or ``nodes`` steps are spent."""
    counts = np.asarray(counts, np.int64)
    if not counts[1:].any():
        return []
    best = best_fit(counts, size)
    fewest, bound, steps = sum(t for _, t in best), least_sequences(counts, size), Steps(nodes)
    goal = bound
    while goal < fewest and steps.left > 0:  # halving the distance to the incumbent after each failure
        part = Steps(min(steps.left, max(nodes // 16, 64)))
        before = part.left
        found = search(counts, size, goal, part)
        steps.left -= before - max(part.left, 0)
        if found is not None:
            best, fewest = found, sum(t for _, t in found)
        elif part.left >= 0:
            bound = max(bound, goal + 1)  # proven
        goal = max(goal + 1, (goal + fewest) // 2) if found is None else bound
        if goal >= fewest:
            break
    rng = np.random.Generator(np.random.PCG64(SEED))
    idle = 0
    while bound < fewest and steps.left > 0 and idle < ROUNDS:
        room = lambda p: size - sum(x * u for x, u in p.items())
        loose = [(p, t) for p, t in best if room(p)]
        full = [(p, t) for p, t in best if not room(p)]
        taken: list[tuple[dict, int]] = []
        waste, enough = 0, int(size * rng.uniform(1, 4))
        for i in rng.permutation(len(loose)):  # open sequences until they could save one
            p, t = loose[i]
            n = min(t, max(1, -(-(enough - waste) // room(p))))
            taken.append((p, n))
            waste += n * room(p)
            if waste >= enough:
                break
        if waste < size:
            break
        for i in rng.permutation(len(full))[: int(rng.integers(1, 1 << int(rng.integers(1, 9))))]:
            taken.append((full[i][0], int(min(full[i][1], rng.integers(1, 5)))))
        own = np.zeros(size + 1, np.int64)
        for p, n in taken:
            for x, u in p.items():
                own[x] += u * n
        part = Steps(min(steps.left, max(nodes // 64, 64)))
        before = part.left
        found = search(own, size, sum(n for _, n in taken) - 1, part)
        steps.left -= before - max(part.left, 0)
        idle += 1
        if found is not None:
            rest = {}
            for p, t in best:
                key = tuple(sorted(p.items()))
                rest[key] = rest.get(key, 0) + t
            for p, n in taken:
                rest[tuple(sorted(p.items()))] -= n
            for p, n in found:
                key = tuple(sorted(p.items()))
                rest[key] = rest.get(key, 0) + n
            best = [(dict(k), t) for k, t in rest.items() if t]
            fewest, idle = sum(t for _, t in best), 0
    return best


def pieces(docs: DataFrame, path: str, size: int = SIZE, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and task, place: the writing task and a running number, there,
    among the pieces of this length."""
    shared.small_batches(docs.sparkSession)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "place"]

    def rows(batches):
        enc, task, seen = encoder(path), TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for b in batches:
            out = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = np.array([*enc.ids(text or ""), end], "<u4")
                cuts = [0, *range(len(ids) % size or size, len(ids), size), len(ids)]
                for j in range(len(cuts) - 1):
                    n = cuts[j + 1] - cuts[j]
                    out.append((doc, j, cuts[j], n, zlib.crc32(ids[cuts[j] : cuts[j + 1]].tobytes()), task, int(seen[n])))
                    seen[n] += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == 1 else pa.int64()) for k, c in enumerate(zip(*out, strict=True))], names)
        enc = None
        _ENCODERS.clear()  # a quarter of a second to load, and 70 MB that an idle worker would keep
        shared.trim()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows, "doc_id long, piece int, start long, length long, ids_crc32 long, task long, place long")


def pack(docs: DataFrame, path: str, size: int = SIZE, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    cut = shared.stored(pieces(docs, path, size, end), shared.scratch(spark))
    per = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begun = shared.stored(per.withColumn("begin", F.coalesce(F.sum("n").over(before), F.lit(0))), shared.scratch(spark))
    counts = np.zeros(size + 1, np.int64)
    for r in begun.groupBy("length").agg(F.sum("n").alias("n")).collect():  # ``size`` rows at most
        counts[r["length"]] = r["n"]
    plan = deal(complete(counts, size))

    def rows(batches):
        length0, first0, uses, sequence0, offset0 = plan
        key0 = length0 * (1 << 48) + first0
        for b in batches:
            length, number = (b.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            at = np.searchsorted(key0, length * (1 << 48) + number, "right") - 1
            rest = number - first0[at]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(sequence0[at] + rest // uses[at]), pa.array(offset0[at] + rest % uses[at] * length)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            )

    numbered = cut.join(begun.select("task", "length", "begin"), ["task", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("begin") + F.col("place")).alias("number"))
    return numbered.mapInArrow(rows, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def deal(patterns: list[tuple[dict, int]]) -> tuple[np.ndarray, ...]:
    """Runs of pieces of one length: length, first number, uses in a sequence, first sequence, offset; sorted."""
    runs, sequence, number = [], 0, {}
    for pattern, times in patterns:
        offset = 0
        for length in sorted(pattern, reverse=True):
            uses = pattern[length]
            runs.append((length, number.get(length, 0), uses, sequence, offset))
            number[length] = number.get(length, 0) + uses * times
            offset += uses * length
        sequence += times
    runs.sort()
    return tuple(np.array(c, np.int64) for c in zip(*runs, strict=True)) if runs else tuple(np.empty(0, np.int64) for _ in range(5))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(shared.table(spark, sf_dir, "documents"), tokenizer_path())


shared.by_value(__name__)
