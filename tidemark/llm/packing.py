"""Documents packed into token windows by best-fit decreasing.

A document is the ids of its text and an end id. Each task packs the documents of its scan partition, without a shuffle:

1. A document longer than a window is cut into full windows; what is left of it, and every shorter document, is a rest.
2. Rests are packed in blocks of ``BLOCK`` ids, longest first, each into the open window with the least room that still
   takes it. A segment tree over the remaining capacities 1..window, each node holding the number of open windows below
   it, finds that window in log2(window) steps; if there is none, a window is opened.
3. A window with at most ``SLACK`` ids of room is done. Among the others of a block, the emptiest give their pieces to
   the fullest, the last of them cut to fit, until one is left; it stays open for the next block.
4. At the end of the partition the open window is cut into sequences whose lengths are powers of two, as those need
   no padding. So a sequence is a full window but for ``SLACK`` ids, or as long as a power of two.

A task holds a block of ids and one window at a time. Ids are those of the ``tokenizers`` library for the given vocabulary
file. For byte-level BPE without a normalizer, ``tiktoken`` with the same vocabulary gives the same ids in a quarter of the
time and is used instead (tests hold both together over every code point). The file is read by the driver
(``MOST_FILE`` bytes at most) and broadcast.

Defined cases: a null text is an empty one, whose document is the end id alone; rows that repeat a doc_id, and rows with
a null one, are documents of their own; an empty table gives no piece. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 1024
SLACK = 4
BLOCK = 4 << 20
END_ID = 0
MOST_FILE = 64 << 20
#: Sequences of a partition are numbered from its number times this.
_PER_PARTITION = 1 << 33
#: Pieces in a result batch.
_ROWS = 2000
#: Fixed value: how byte-level BPE vocabularies of this kind split a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_vocabulary(path: str) -> str:
    if os.path.getsize(path) > MOST_FILE:
        raise ValueError(f"{path} is larger than {MOST_FILE} bytes")
    with open(path, encoding="utf-8") as f:
        return f.read()


def _byte_of() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable Latin-1 stands for itself, the others for
    code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def encoder(vocabulary: str):
    """A function from a text to the ids that ``Tokenizer.encode(text, add_special_tokens=False)`` gives."""
    spec = json.loads(vocabulary)
    split, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = (model["type"] == "BPE" and not spec.get("normalizer") and split.get("type") == "ByteLevel"
             and not split.get("add_prefix_space") and split.get("use_regex", True) and not model.get("ignore_merges")
             and all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in spec["added_tokens"]))
    if not plain:
        from tokenizers import Tokenizer
        known = Tokenizer.from_str(vocabulary)
        return lambda text: np.array(known.encode(text, add_special_tokens=False).ids, np.uint32)
    import tiktoken
    byte = _byte_of()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    known = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: np.asarray(known.encode_to_numpy(text, allowed_special="all"), np.uint32)


class Capacities:
    """Open windows by remaining capacity: a segment tree of counts over 0..window, and a stack of windows per leaf."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.stacks: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, capacity: int, number: int) -> None:
        self.stacks[capacity].append(number)
        node = self.size + capacity
        while node:
            self.count[node] += 1
            node >>= 1

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Take out the window with the least capacity of at least ``length``: (capacity, window)."""
        count, node = self.count, self.size + length
        while not count[node]:
            while node & 1:          # a right child: nothing larger below this parent
                node >>= 1
            if not node:
                return None
            node += 1                # the right sibling: the next larger capacities
        while node < self.size:
            node = 2 * node if count[2 * node] else 2 * node + 1
        capacity = node - self.size
        number = self.stacks[capacity].pop()
        while node:
            count[node] -= 1
            node >>= 1
        return capacity, number


#: A piece: (row, start, length), row being the document's place in the block.
Piece = tuple


def best_fit(rests: list[Piece], window: int, opened: list[list[Piece]]) -> list[list[Piece]]:
    """Windows (lists of pieces) with all ``rests``, longest first, and the pieces of the ``opened`` windows."""
    windows = [list(w) for w in opened]
    room = Capacities(window)
    for i, w in enumerate(windows):
        room.add(window - sum(p[2] for p in w), i)
    for piece in sorted(rests, key=lambda p: -p[2]):
        found = room.tightest(piece[2])
        if found is None:
            found = (window, len(windows))
            windows.append([])
        capacity, i = found
        windows[i].append(piece)
        if capacity > piece[2]:
            room.add(capacity - piece[2], i)
    return windows


def fill_up(windows: list[list[Piece]], window: int, slack: int) -> tuple[list[list[Piece]], list[list[Piece]]]:
    """(done, open): windows with at most ``slack`` ids of room, and at most one other. The emptiest windows give their
    pieces, the last one cut to fit, to the fullest."""
    sized = sorted(((sum(p[2] for p in w), w) for w in windows), key=lambda x: -x[0])
    done = [w for n, w in sized if window - n <= slack]
    under = [(n, list(w)) for n, w in sized if window - n > slack]
    first, last = 0, len(under) - 1
    while first < last:
        n, target = under[first]
        while window - n > slack and first < last:
            m, giver = under[last]
            row, start, length = giver.pop()
            take = min(length, window - n)
            target.append((row, start, take))
            if take < length:
                giver.append((row, start + take, length - take))
            n += take
            under[last] = (m - take, giver)
            if not giver:
                last -= 1
        under[first] = (n, target)
        if window - n <= slack:
            done.append(target)
            first += 1
    return done, [w for _, w in under[first:last + 1] if w]


def powers_of_two(pieces: list[Piece]) -> list[list[Piece]]:
    """One window's pieces cut into sequences whose lengths are powers of two, the longest first."""
    left, out = sum(p[2] for p in pieces), []
    pieces = list(reversed(pieces))
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        own: list[Piece] = []
        while size:
            row, start, length = pieces.pop()
            take = min(length, size)
            own.append((row, start, take))
            if take < length:
                pieces.append((row, start + take, length - take))
            size -= take
        out.append(own)
    return out


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, slack: int = SLACK, end_id: int = END_ID,
         block: int = BLOCK) -> DataFrame:
    """One row per piece: doc_id, start (ids of the document before it), length, ids (little-endian 32-bit), doc_tokens,
    sequence_id, offset (of the piece in its sequence). ``vocabulary`` is the path of a tokenizers file."""
    held = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        next_id = TaskContext.get().partitionId() * _PER_PARTITION
        docs_of: list[tuple] = []        # (doc_id, ids, doc_tokens, ids before these) of the block
        rests: list[Piece] = []
        opened: list[list[Piece]] = []
        out: list[tuple] = []
        kind, size = None, 0

        def put(sequence: list[Piece]) -> None:
            nonlocal next_id
            at = 0
            for row, start, length in sequence:
                doc_id, ids, total, before = docs_of[row]
                out.append((doc_id, start, length, ids[start - before:start - before + length].tobytes(), total, next_id, at))
                at += length
            next_id += 1

        def taken() -> pa.RecordBatch:
            kinds = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            got = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)
            out.clear()
            return got

        def close() -> Iterator[pa.RecordBatch]:
            """Pack the block; only the documents of the open window are kept."""
            nonlocal docs_of, rests, opened, size
            done, opened = fill_up(best_fit(rests, window, opened), window, slack)
            for w in done:
                put(w)
                if len(out) >= _ROWS:
                    yield taken()
            kept: dict[int, int] = {}
            opened = [[(kept.setdefault(row, len(kept)), start, n) for row, start, n in w] for w in opened]
            docs_of, rests, size = [docs_of[row] for row in kept], [], 0

        for batch in batches:
            encode = encode or encoder(held.value)
            kind = batch.column("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.append(encode(text or "").astype("<u4", copy=False), np.uint32(end_id)).astype("<u4", copy=False)
                total, full = len(ids), len(ids) // window * window
                for start in range(0, full, window):
                    out.append((doc_id, start, window, ids[start:start + window].tobytes(), total, next_id, 0))
                    next_id += 1
                if full < total:
                    rests.append((len(docs_of), full, total - full))
                    docs_of.append((doc_id, ids[full:].copy(), total, full))
                    size += total - full
                if len(out) >= _ROWS:
                    yield taken()
                if size >= block:
                    yield from close()
        if rests or opened:
            yield from close()
            for w in opened:
                for sequence in powers_of_two(w):
                    put(sequence)
        if out:
            yield taken()

    id_kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, `offset` long")


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the checksum of their ids in place of them."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
