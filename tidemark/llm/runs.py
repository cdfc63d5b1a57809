"""Periodic runs of words, found in a Re-Pair grammar of the word ids.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends keeping period q.
Reported are runs of at least ``min_length`` words and ``min_exponent`` (4 or more) periods.

1. *Grammar.* The word ids of a batch of documents, kept apart by separators, are compressed by Re-Pair. A round counts
   all pairs of neighbours and replaces every pair that occurs twice or more, wherever it is more frequent than the
   pairs that overlap it; equal counts are told apart by an arbitrary but fixed order. When no pair occurs twice,
   what is left is a start rule, which neighbours of a document are paired into as a balanced tree. Documents of
   a batch share the nonterminals, so copies are compressed together.
2. *Boundaries.* Each nonterminal Y Z is looked at once, in its first place. A run crossing the boundary has, with four
   periods, two of them on one side: Z begins or Y ends with a square of its period. All such squares are found by
   comparing words and a prefix hash, then compared word by word, from the shortest period up (squares that a shorter
   period explains are passed over, so periods are smallest), and extended to the ends of the nonterminal.
3. *Positions.* The runs of a nonterminal are moved to every place where it is derived. Each run of the text lies whole in
   the lowest nonterminal that holds it and crosses its boundary; a nonterminal may also hold a part of a longer run.
   Intervals of equal period that overlap in a period or more are merged, which leaves the maximal runs.

A task takes the documents of its scan partition in batches of ``BATCH_WORDS`` words, without a shuffle; a
longer document is a batch of its own, and is never cut.

Defined cases: a null text, an empty one and one of white space have no words and no runs; rows that repeat a
doc_id, and a null doc_id, are rows like any other; an empty table gives an empty result. Columns other than doc_id and
text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let

MIN_LENGTH, MIN_EXPONENT = 6, 4
BATCH_WORDS = 300_000
#: Base of the prefix hash (odd).
_BASE = 0x9E3779B97F4A7C15
_SHIFT = np.int64(32)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of integers."""
    z = x.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(_BASE)
    z ^= z >> np.uint64(31)
    z *= np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(29))


class _Text:
    """Word ids with a separator after each document, and the squares and extensions asked of them."""

    def __init__(self, words: np.ndarray):
        self.w = words
        n = len(words)
        power = np.full(n + 1, _BASE, np.uint64)
        power[0] = 1
        self.power = np.cumprod(power)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(_mix(words) * self.power[:n], out=self.prefix[1:])

    def squares(self, at: np.ndarray, most: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``at``, q) for squares of period q <= most that begin at ``at`` (``back``: that end there)."""
        w, s = self.w, self.prefix
        i = np.repeat(np.arange(len(at)), most)
        q = np.arange(1, len(i) + 1) - np.repeat(np.cumsum(most) - most, most)
        a = at[i]
        near = w[a - 1] == w[a - 1 - q] if back else w[a] == w[a + q]
        i, q, a = i[near], q[near], a[near]
        x = a - 2 * q if back else a
        same = (s[x + q] - s[x]) * self.power[q] == s[x + 2 * q] - s[x + q]
        return i[same], q[same]

    def equal(self, x: int, q: int) -> bool:
        return bool(np.array_equal(self.w[x:x + q], self.w[x + q:x + 2 * q]))

    def reach(self, x: int, q: int, low: int, high: int) -> tuple[int, int]:
        """The longest stretch of period q around [x, x + 2q) inside [low, high)."""
        w, end, step = self.w, x + 2 * q, 64
        while end < high:
            stop = min(high, end + step)
            bad = np.flatnonzero(w[end:stop] != w[end - q:stop - q])
            if len(bad):
                end += int(bad[0])
                break
            end, step = stop, step * 2
        step = 64
        while x > low:
            stop = max(low, x - step)
            bad = np.flatnonzero(w[stop:x] != w[stop + q:x + q])
            if len(bad):
                x = stop + int(bad[-1]) + 1
                break
            x, step = stop, step * 2
        return x, end


def _crossing(text: _Text, s: np.ndarray, m: np.ndarray, e: np.ndarray, min_length: int, min_exponent: int):
    """(index, start - s, end - s, q) of the runs that cross the boundary m of each nonterminal [s, e)."""
    most = np.where(e - s >= min_length, (e - s) // min_exponent, 0)
    found = {}
    for back, side in ((False, e - m), (True, m - s)):
        for k, q in zip(*(x.tolist() for x in text.squares(m, np.minimum(most, side // 2), back))):
            found.setdefault(k, ([], []))[back].append(q)
    out = []
    for k, (right, left) in found.items():
        low, at, high = int(s[k]), int(m[k]), int(e[k])
        for back, periods in ((False, np.array(right, np.int64)), (True, np.array(left, np.int64))):
            while len(periods):
                q = int(periods[0])
                x = at - 2 * q if back else at
                periods = periods[1:]
                if not text.equal(x, q):
                    continue
                x, end = text.reach(x, q, low, high)
                # squares of a multiple of q inside this stretch have q as their period
                inside = (at - 2 * periods >= x) if back else (at + 2 * periods <= end)
                periods = periods[~((periods % q == 0) & inside)]
                if end - x >= max(min_length, min_exponent * q):
                    out.append((k, x - low, end - low, q))
    return out


def _merge(parts: list[np.ndarray]) -> list[tuple[int, int, int]]:
    """Maximal (start, end, q) from parts of runs."""
    if not parts:
        return []
    rows = np.unique(np.concatenate(parts)[:, [2, 0, 1]], axis=0)
    out = []
    for q, start, end in rows.tolist():
        if out and out[-1][2] == q and start + q <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end, q])
    return [tuple(r) for r in out]


def word_runs(words: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple]:
    """(start, end, period) of all runs. ``words``: non-negative ids, and a negative id of its own after each document."""
    if min_exponent < 4:
        raise ValueError("a run needs four periods for two of them to lie on one side of a boundary")
    text = _Text(words)
    n = len(words)
    sym, pos = words.copy(), np.arange(n + 1)   # a last entry closes the last symbol
    next_id = int(words.max(initial=-1)) + 1
    rules, names = np.zeros(0, np.int64), np.zeros(0, np.int64)   # pairs, sorted, and their nonterminals
    held: dict[int, list[tuple]] = {}                             # runs of nonterminals that have any
    parts: list[np.ndarray] = []

    def replace(chosen: np.ndarray, new: np.ndarray) -> None:
        nonlocal sym, pos
        gone = np.zeros(len(sym), bool)
        gone[chosen + 1] = True
        sym[chosen] = new
        sym, pos = sym[~gone], pos[np.append(~gone, True)]

    def emit(at: np.ndarray, runs: list[tuple]) -> None:
        for x, y, q in runs:
            parts.append(np.stack([at + x, at + y, np.full(len(at), q)], 1))

    while len(sym) > 1:
        a, b = sym[:-1], sym[1:]
        valid = np.flatnonzero((a >= 0) & (b >= 0))
        if not len(valid):
            break
        pair = (a[valid] << _SHIFT) | b[valid]
        kinds, which, counts = np.unique(pair, return_inverse=True, return_counts=True)
        if counts.max() < 2:
            break
        # priority: count, then a fixed order of the pairs; one number per kind of pair
        order = np.zeros(len(kinds), np.int64)
        often = np.flatnonzero(counts > 1)
        order[often[np.lexsort((_mix(kinds[often]), counts[often]))]] = np.arange(1, len(often) + 1)
        rank = np.zeros(len(sym) + 1, np.int64)
        rank[valid + 1] = order[which]
        here = rank[1:-1]
        best = np.flatnonzero((here > 0) & (here >= rank[:-2]) & (here >= rank[2:]))
        # neighbours among these are one symbol repeated: every other of them
        first = np.append(True, np.diff(best) > 1)
        chosen = best[(best - np.maximum.accumulate(np.where(first, best, 0))) % 2 == 0]
        keys = (sym[chosen] << _SHIFT) | sym[chosen + 1]
        kinds, first, which = np.unique(keys, return_index=True, return_inverse=True)
        slot = np.searchsorted(rules, kinds)
        known = np.zeros(len(kinds), bool)
        in_range = slot < len(rules)
        known[in_range] = rules[slot[in_range]] == kinds[in_range]
        ids = np.empty(len(kinds), np.int64)
        ids[known] = names[slot[known]]
        fresh = np.flatnonzero(~known)
        ids[fresh] = next_id + np.arange(len(fresh))
        next_id += len(fresh)
        at = chosen[first[fresh]]
        for k, x, y, q in _crossing(text, pos[at], pos[at + 1], pos[at + 2], min_length, min_exponent):
            held.setdefault(int(ids[fresh[k]]), []).append((x, y, q))
        new = ids[which]
        if held:
            with_runs = np.isin(new, np.fromiter(held, np.int64, len(held)))
            where, own = pos[chosen[with_runs]], new[with_runs]
            for i in np.unique(own).tolist():
                emit(where[own == i], held[i])
        both = np.concatenate([rules, kinds[fresh]])
        by = np.argsort(both, kind="stable")
        rules, names = both[by], np.concatenate([names, ids[fresh]])[by]
        replace(chosen, new)
    # the start rule: neighbours of a document in twos, level by level
    while True:
        inside = sym >= 0
        starts = np.append(True, ~inside[:-1]) & inside
        offset = np.arange(len(sym)) - np.maximum.accumulate(np.where(starts, np.arange(len(sym)), 0))
        chosen = np.flatnonzero(inside[:-1] & inside[1:] & (offset[:-1] % 2 == 0))
        if not len(chosen):
            break
        at = pos[chosen]
        for k, x, y, q in _crossing(text, at, pos[chosen + 1], pos[chosen + 2], min_length, min_exponent):
            emit(at[k:k + 1], [(x, y, q)])
        replace(chosen, np.zeros(len(chosen), np.int64))
    return _merge(parts)


def _of_batch(texts: list[str | None]) -> list[tuple[list[tuple], str]]:
    """([(start, length, period)], collapsed text) of each text."""
    vocabulary: dict[bytes, int] = {}
    split = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]
    ids = np.empty(sum(map(len, split)) + len(split), np.int64)
    starts, at = [], 0
    for d, words in enumerate(split):
        starts.append(at)
        ids[at:at + len(words)] = [vocabulary.setdefault(w, len(vocabulary)) for w in words]
        at += len(words) + 1
        ids[at - 1] = -1 - d
    runs: list[list[tuple]] = [[] for _ in split]
    found = word_runs(ids)
    owner = np.searchsorted(np.array(starts + [at]), [r[0] for r in found], side="right") - 1
    for d, (start, end, q) in zip(owner.tolist(), found):
        runs[d].append((start - starts[d], end - start, q))
    out = []
    for own, words in zip(runs, split):
        own.sort(key=lambda r: (r[0], r[2]))
        if own:
            kept = np.ones(len(words), bool)
            for start, length, q in own:
                kept[start + q:start + length] = False
            words = [words[i] for i in np.flatnonzero(kept).tolist()]
        out.append((own, b" ".join(words).decode("utf-8", "surrogatepass")))
    return out


def find(docs: DataFrame) -> DataFrame:
    """doc_id, ``runs`` (array of start, length, period; by start, then period) and ``collapsed``, the words without
    those that a run holds after its first period, joined by one space. One row per row of ``docs``."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        texts: list[str | None] = []
        size = 0

        def done():
            found = _of_batch(texts)
            doc_id = pa.concat_arrays(ids)
            step = 2000
            for i in range(0, len(found), step):
                part = found[i:i + step]
                runs = pa.array([[{"start": a, "length": b, "period": q} for a, b, q in r] for r, _ in part], kind)
                yield pa.RecordBatch.from_arrays([doc_id.slice(i, step), runs, pa.array([t for _, t in part], pa.string())],
                                                 names=["doc_id", "runs", "collapsed"])

        for batch in batches:
            own = batch.column("text").to_pylist()
            from_row = 0
            for i, t in enumerate(own):
                size += (len(t) if t else 0) // 6 + 1   # about a word
                if size >= BATCH_WORDS:
                    ids.append(batch.column("doc_id").slice(from_row, i + 1 - from_row))
                    texts += own[from_row:i + 1]
                    yield from done()
                    ids, texts, size, from_row = [], [], 0, i + 1
            if from_row < len(own):
                ids.append(batch.column("doc_id").slice(from_row))
                texts += own[from_row:]
        if texts:
            yield from done()

    id_kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def longest(runs: Column) -> Column:
    """The run of greatest length (ties: smallest start, then period); null if there is none."""
    return F.array_min(F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"),
                                                             r["period"].alias("period"))))


def digest(found: DataFrame) -> DataFrame:
    """The figures and hashes of :func:`find`: n_runs, the longest run, runs_sha256 and collapsed_sha256."""
    line = lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
    listed = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(""))
    top = F.col("_top")
    return found.withColumn("_top", longest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"), (-top["l"]).alias("length"),
        top["period"].alias("period"), F.floor(-1000 * top["l"] / top["period"]).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``; every tenth (by h = crc32 of the decimal doc_id) becomes periodic from a word on: with
    n words and g = floor(h / 10), word i >= a = g % n is word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8))."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def rebuilt(words: Column) -> Column:
        def at(place: Column) -> Column:
            a, p = place["a"], place["p"]
            return F.transform(F.sequence(F.lit(0).cast("long"), F.size(words) - F.lit(1).cast("long")), lambda i: F.get(
                words, F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")))

        n = F.size(words)
        a = F.pmod(g, n)
        place = F.struct(a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).alias("p"))
        return F.when(n > 0, F.array_join(let(place, at), " ")).otherwise(F.lit(""))

    words = F.filter(F.split("text", "[ \t\n\x0b\f\r]+"), lambda w: w != "")
    return docs.select("doc_id", F.when((h % 10 == 0) & F.col("text").isNotNull(), let(words, rebuilt))
                       .otherwise(F.col("text")).alias("text"))
