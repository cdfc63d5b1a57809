"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` tokenises every document and stores the postings of all its words as a Parquet table of
segments, one row each: some documents' postings, sorted by term and position. Segments are document-partitioned,
so an intersection never needs a posting of another segment and matching moves no posting through a shuffle.
Positions are offsets in the segment; documents are ``GAP`` apart, so that no match can reach over two.

``phrase_matches`` and ``proximity_matches`` answer a set of queries on each segment. A query starts from its
rarest term there: the term's positions less its offset in the phrase are the candidate starts; the next
rarest terms' offset-adjusted postings are intersected with them one by one, until the phrase is exact. All
queries of a segment are intersected together: (term, position) pairs are one sorted list that is searched.

The queries are a stated set. Tasks cut them into pieces of a bounded number of windows, and pieces are dealt into
blocks of about ``block_windows`` windows by a hash; a long item is in several. One block at a time is on the driver
and sent to all tasks; its matches are written and its broadcast is released before the next, and the matches
of the blocks are put together per document (those of a single block are not written). Within a block a window that
several items share is matched once. Without windows an item is one phrase, and never cut.

Words are compared by 64-bit hashes.

Defined cases: a null or empty text, and one without words, has no postings and gets a row without matches; a
null or wordless query matches nothing; rows that repeat an item_id are one item, and a null item_id is the
item with the empty name; rows that repeat a doc_id are documents of their own. A document of any length is
one segment at most; extra columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WordHashes, binary_values
from tidemark.session import materialize, release, scratch_path

WINDOW = 10
#: Words of a segment (a longer document is a segment of its own), and words between two documents.
SEGMENT_WORDS = 1 << 18
GAP = 64
#: Candidate positions that are intersected at once, about.
CANDIDATES = 1 << 21
#: Query windows that are sent to the tasks at once, about (20 MB of hashes for windows of ten words).
BLOCK_WINDOWS = 1 << 18

#: The contract's words, [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z, in UTF-8: every byte of
#: another character becomes a space.
_TO_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                  for b in range(256))

INDEX_SCHEMA = ("segment string, doc_ids array<{id}>, starts array<int>, n_words array<int>, "
                "terms binary, offsets binary, positions binary")


def tokens(raw: bytes | None) -> list[bytes]:
    return raw.translate(_TO_WORDS).split() if raw else []


def _segment(ids: list, starts: list, counts: list, parts: list[np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
    terms = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    where = np.concatenate([np.arange(s, s + n, dtype=np.int32) for s, n in zip(starts, counts)] or
                           [np.zeros(0, np.int32)])
    order = np.argsort(terms, kind="stable")
    terms = terms[order]
    first = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]]) if len(terms) else np.zeros(0, np.int64)
    row = [uuid.uuid4().hex, ids, starts, counts, terms[first].tobytes(), np.r_[first, len(terms)].astype(np.int32).tobytes(),
           where[order].tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)


def build_index(docs: DataFrame, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Write the postings of doc_id, text under the shared checkpoint folder; the table of segments. It goes when the driver
    ends."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, schema = WordHashes(), None
        ids, starts, counts, parts, at = [], [], [], [], 0
        for batch in batches:
            if schema is None:
                i32 = pa.list_(pa.int32())
                schema = pa.schema([("segment", pa.string()), ("doc_ids", pa.list_(batch.schema.field("doc_id").type)), ("starts", i32),
                                    ("n_words", i32), ("terms", pa.binary()), ("offsets", pa.binary()),
                                    ("positions", pa.binary())])
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), binary_values(batch.column("raw"))):
                t = tokens(raw)
                if ids and at + len(t) > segment_words:
                    yield _segment(ids, starts, counts, parts, schema)
                    ids, starts, counts, parts, at = [], [], [], [], 0
                ids.append(doc_id)
                starts.append(at)
                counts.append(len(t))
                if t:
                    parts.append(hashes.of(t))
                at += len(t) + GAP
        if ids:
            yield _segment(ids, starts, counts, parts, schema)

    path = scratch_path(spark, f"postings-{uuid.uuid4().hex}")
    (docs.select("doc_id", F.col("text").cast("binary").alias("raw"))
     .mapInArrow(run, INDEX_SCHEMA.format(id=kind)).write.parquet(path))
    return spark.read.parquet(path)


class Segment:
    """One segment's postings with the two searches."""

    def __init__(self, starts, n_words, terms: bytes, offsets: bytes, positions: bytes):
        self.starts = np.asarray(starts, np.int64)
        self.n_words = np.asarray(n_words, np.int64)
        self.terms = np.frombuffer(terms, np.uint64)
        self.offsets = np.frombuffer(offsets, np.int32).astype(np.int64)
        self.positions = np.frombuffer(positions, np.int32).astype(np.int64)
        self.span = int(self.starts[-1] + self.n_words[-1] + GAP) if len(self.starts) else 1
        term_of = np.repeat(np.arange(len(self.terms)), np.diff(self.offsets))
        self.keys = term_of * self.span + self.positions

    def lookup(self, queries: np.ndarray) -> np.ndarray:
        """Number of each term here, -1 if it has no postings."""
        i = np.searchsorted(self.terms, queries)
        if not len(self.terms):
            return np.full(queries.shape, -1)
        i = np.minimum(i, len(self.terms) - 1)
        return np.where(self.terms[i] == queries, i, -1)

    def phrases(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query row, start position) of every exact occurrence; ``queries`` is a matrix of term hashes."""
        ids = self.lookup(queries)
        rows = np.flatnonzero((ids >= 0).all(1))
        if not len(rows):
            return rows, rows
        ids = ids[rows]
        counts = self.offsets[ids + 1] - self.offsets[ids]
        order = np.argsort(counts, axis=1, kind="stable")  # rarest term first
        n = np.take_along_axis(counts, order[:, :1], 1)[:, 0]
        # queries of common words alone have many candidates; these are intersected some queries at a time
        parts = np.split(np.arange(len(rows)), np.flatnonzero(np.diff(np.cumsum(n) // CANDIDATES)) + 1)
        found = [(rows[part], *self._intersect(ids[part], order[part])) for part in parts]
        return np.concatenate([own[q] for own, q, _ in found]), np.concatenate([start for _, _, start in found])

    def _intersect(self, ids: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pick = lambda a, j: np.take_along_axis(a, order[:, j:j + 1], 1)[:, 0]
        term = pick(ids, 0)
        n = self.offsets[term + 1] - self.offsets[term]
        # the postings of each query's rarest term, less its offset in the phrase
        q = np.repeat(np.arange(len(ids)), n)
        nth = np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n)
        start = self.positions[self.offsets[term][q] + nth] - order[q, 0]
        ok = start >= 0
        q, start = q[ok], start[ok]
        for j in range(1, ids.shape[1]):
            want = pick(ids, j)[q] * self.span + start + order[q, j]
            at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            ok = self.keys[at] == want
            q, start = q[ok], start[ok]
        return q, start

    def near(self, queries: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
        """(query row, start) of every span of ``within`` words, one that begins with a term of the query, that
        holds all distinct terms of the query in any order. ``within`` is at most GAP."""
        found_q, found_s = [], []
        ids = self.lookup(queries)
        for row in np.flatnonzero((ids >= 0).all(1)):
            own = np.unique(ids[row])
            lists = sorted((self.positions[self.offsets[t]:self.offsets[t + 1]] for t in own), key=len)
            rare = lists[0]
            # a span that holds the rarest term begins at most within - 1 words before it
            starts = np.unique((rare[:, None] - np.arange(within)).ravel())
            begins = np.zeros(len(starts), bool)
            for p in lists:
                i = np.minimum(np.searchsorted(p, starts), len(p) - 1)
                begins |= p[i] == starts
            starts = starts[begins]
            for p in lists:
                i = np.searchsorted(p, starts)
                ok = (i < len(p)) & (p[np.minimum(i, len(p) - 1)] < starts + within)
                starts = starts[ok]
            found_q.append(np.full(len(starts), row))
            found_s.append(starts)
        none = np.zeros(0, np.int64)
        return (np.concatenate(found_q), np.concatenate(found_s)) if found_q else (none, none)


def windows_of(words: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    """All runs of ``size`` consecutive words; of fewer words, but not none, the whole."""
    if not words:
        return []
    return [tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]


def _pieces(items: DataFrame, size: int | None, most: int) -> DataFrame:
    """(name, words, windows): each item's words, joined by blanks, in pieces of at most ``most`` windows. Neighbouring
    pieces share the size - 1 words that keep every window whole in one of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, raw in zip(batch.column("name").to_pylist(), binary_values(batch.column("raw"))):
                words = tokens(raw)
                n = max(1, len(words) - size + 1) if size else 1
                for at in range(0, n if words else 0, most):
                    held = min(most, n - at)
                    piece = words[at:at + held + size - 1] if size else words
                    out.append((name, b" ".join(piece), held))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.binary(), pa.int64()))],
                names=["name", "words", "windows"])

    own = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"),
                       F.col("text").cast("binary").alias("raw"))
    return own.mapInArrow(run, "name string, words binary, windows long")


def _blocks(items: DataFrame, size: int | None, block_windows: int) -> Iterator[tuple[dict, bool]]:
    """The query set in blocks of bounded size: {length: (matrix of term hashes, item names of each row)}, last or not.
    ``size``: cut each item into windows of so many words; None: each item is one phrase."""
    pieces = materialize(_pieces(items, size, max(1, block_windows // 16)), "query-pieces")
    n = -(-(pieces.agg(F.sum("windows")).first()[0] or 0) // block_windows) or 1
    for i in range(n):
        part = pieces.where(F.pmod(F.xxhash64("name", "words"), F.lit(n)) == i) if n > 1 else pieces
        hashes, by = WordHashes(), {}
        for r in part.select("name", "words").collect():  # about block_windows windows
            words = bytes(r["words"]).split()
            for w in windows_of(words, size or len(words)):
                by.setdefault(len(w), {}).setdefault(w, set()).add(r["name"])
        if i == n - 1:
            release(pieces)
        yield {k: (np.array([hashes.of(list(w)) for w in ws], np.uint64), [sorted(names) for names in ws.values()])
               for k, ws in by.items()}, i == n - 1


def _covered(starts: np.ndarray, lengths: np.ndarray) -> list[dict]:
    """Disjoint spans, in order, that cover the given ones."""
    out: list[list[int]] = []
    for s, e in sorted(zip(starts.tolist(), (starts + lengths).tolist())):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [{"from": s, "to": e} for s, e in out]


def _match(index: DataFrame, items: DataFrame, size: int | None, within: int | None, block_windows: int) -> DataFrame:
    spark = index.sparkSession
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    schema = (f"doc_id {kind}, row string, n_words long, spans array<struct<`from`:long,`to`:long>>, "
              "items array<string>")
    parts = []
    for block, last in _blocks(items, size, block_windows):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    got = {c: batch.column(c)[k] for c in batch.schema.names}
                    seg = Segment(got["starts"].as_py(), got["n_words"].as_py(), got["terms"].as_py(),
                                  got["offsets"].as_py(), got["positions"].as_py())
                    hits: dict[int, tuple[list, list, set]] = {}
                    for length, (matrix, names) in sent.value.items():
                        q, start = seg.near(matrix, within) if within else seg.phrases(matrix)
                        doc = np.searchsorted(seg.starts, start, side="right") - 1
                        # equal starts belong to documents without words; the last of them holds the words
                        for d, qi, s in zip(doc.tolist(), q.tolist(), start.tolist()):
                            h = hits.setdefault(d, ([], [], set()))
                            h[0].append(s - int(seg.starts[d]))
                            h[1].append(min(within, int(seg.n_words[d]) - h[0][-1]) if within else length)
                            h[2].update(names[qi])
                    ids = batch.column("doc_ids")[k].values
                    n = len(ids)
                    none = ([], [], ())
                    rows = [hits.get(d, none) for d in range(n)]
                    name = got["segment"].as_py()
                    spans = [_covered(np.array(r[0], np.int64), np.array(r[1], np.int64)) for r in rows]
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array([f"{name}-{d}" for d in range(n)]), pa.array(seg.n_words),
                         pa.array(spans, pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))),
                         pa.array([sorted(r[2]) for r in rows], pa.list_(pa.string()))],
                        names=["doc_id", "row", "n_words", "spans", "items"])

        matches = index.mapInArrow(run, schema)
        if last and not parts:
            return matches
        # every document once, with the first block; with the others those that they hit
        parts.append(materialize(matches.where(F.size("spans") > 0) if parts else matches, "block-matches"))
        sent.destroy()
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


def phrase_matches(index: DataFrame, items: DataFrame, window: int | None = WINDOW,
                   block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Per document: doc_id, row (its name in the index), n_words, spans (of words that exact occurrences of a
    window cover) and items (names, sorted). ``window`` None: each item is one phrase."""
    return _match(index, items, window, None, block_windows)


def proximity_matches(index: DataFrame, items: DataFrame, within: int, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """As ``phrase_matches``, for spans of ``within`` words that hold all distinct words of an item."""
    if not 0 < within <= GAP:
        raise ValueError(f"within must lie between 1 and {GAP}")
    return _match(index, items, None, within, block_windows)


def span_words(spans: str = "spans") -> Column:
    """Number of words that the spans cover, also where spans of several blocks overlap."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def step(acc: Column, s: Column) -> Column:
        end = F.greatest(acc["end"], s["to"])
        return F.struct((acc["n"] + F.greatest(F.lit(0).cast("long"), s["to"] - F.greatest(acc["end"], s["from"])))
                        .alias("n"), end.alias("end"))

    return F.aggregate(F.array_sort(spans), start, step, lambda acc: acc["n"])


def digest(matches: DataFrame) -> DataFrame:
    return matches.select(
        "doc_id", "n_words", span_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without a hit, all columns kept. A document is known by its doc_id and an md5 of its text,
    so rows that share a doc_id, or have none, are decided each by their own text."""
    key = F.struct(F.col("doc_id").alias("id"), F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("md5"))
    index = build_index(docs.select(key.alias("doc_id"), "text"))
    bad = phrase_matches(index, items, window).where(F.size("spans") > 0).select(
        F.col("doc_id.id").alias("_bad_id"), F.col("doc_id.md5").alias("_bad_md5")).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("_bad_id"))
                     & (F.md5(F.coalesce(F.col("text"), F.lit(""))) == F.col("_bad_md5")), "left_anti")
