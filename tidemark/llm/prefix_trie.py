"""A trie of conversation prefixes, with a count-min sketch that spares unshared prefixes the grouping.

A node is a distinct sequence of first d turns (role, text) of a conversation; conversations that begin with it are its
members. ``build`` takes turns (conv_id, d, t1, t2, n_words), d counting from 1 without gaps and (t1, t2) being a hash of
the turn, and a row with d = 0 for every conversation, and returns a row per node.

1. *Prefix digests.* A prefix has as digest the exclusive or of the 128-bit hashes of (d, turn) of its turns: a running
   aggregate along a conversation, in chunks of turns where a conversation is very long. No text is shuffled.
2. *Screening.* Every task counts its digests in a count-min sketch of ``ROWS`` rows, where a cell only tells 0, 1 and
   more; the sketches are added up block by block, and the cells with more are broadcast (``MOST_CELLS`` / 8 bytes a row
   at most). A cell never tells less than the truth, so a prefix with any cell at one belongs to a single conversation:
   its node is emitted where it stands. The number of cells follows the number of turns up to ``MOST_CELLS``; above
   some ``MOST_CELLS`` prefixes the sketch fills up and proves less, and more goes to the exact grouping.
3. *Exact grouping.* Prefixes that may be shared are grouped by depth and digest, with partial aggregation, so a prefix of
   all conversations is no hot spot. The sums over subtrees come from each node's smallest member: a node's weight is put
   on that member's row, summed up from the deepest row of the conversation, and the grouping adds it to all prefixes.
4. *Ends.* The ids of the conversations that end at a node are listed in pieces of ``END_RANGE`` ids, and one hash runs
   over the pieces of a node in order, holding one piece at a time.

Every table between the steps is written to the shared checkpoint folder and deleted when the driver ends.

Defined cases: a null role or text is empty; turns are ordered by turn (null first), then by the hash of role and text,
and rows that repeat a turn are turns of their own; rows with a null conv_id belong to no conversation; an empty table
gives no node, not even a root. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES
from tidemark.operators import sequence as seq
from tidemark.session import materialize

ROWS = 4
MOST_CELLS = 1 << 25
LEAST_CELLS = 1 << 12
#: Bytes of a block of the sketch (8 cells each).
BLOCK = 4096
END_RANGE = 8192
#: Turns of a conversation in a chunk.
CHUNK = 1 << 16
TURN = ["t1", "t2"]
KEY = ["d", "p1", "p2"]


def numbered(turns: DataFrame, rows_per_chunk: int = 1 << 20) -> DataFrame:
    """conv_id, pos (from 1), t1, t2, n_words of turns (conv_id, turn, role, text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    words = F.regexp_count(text, F.lit(f"[^{SPACES}]+"))
    own = turns.where("conv_id is not null").select(
        "conv_id", "turn", F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit("turn"), role, text).alias("t2"),
        words.cast("long").alias("n_words"))
    own, chunk = seq.chunk_by(own, ["conv_id"], "turn", "balanced", target_rows=rows_per_chunk)
    return seq.rank(own, ["conv_id"], ["turn", *TURN], chunk, out="pos").select("conv_id", "pos", *TURN, "n_words")


def rebuilt(turns: DataFrame, block: int = 20, most: int = 3) -> DataFrame:
    """Conversations that share beginnings, from numbered turns: conversation c gets the first h turns of conversation
    c - c % block (all if it has fewer), then its own after the first h; h = crc32 of the decimal c, modulo most + 1.
    conv_id, d, t1, t2, n_words, and a row with d = 0 (the rest null) for every conversation."""
    turns = materialize(turns, "trie-turns")
    c = F.col("conv_id")
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "n", (c - c % block).alias("base"), F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(most + 1)).alias("h"))
    heads = turns.where((c % block == 0) & (F.col("pos") <= most)).groupBy(c.alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("pos", *TURN, "n_words"))).alias("head"))   # at most ``most`` turns
    convs = convs.join(heads, "base", "left").withColumn(
        "head", F.filter("head", lambda t: t["pos"] <= F.col("h"))).withColumn(
        "n_head", F.coalesce(F.size("head"), F.lit(0)).cast("long"))
    convs = materialize(convs.select("conv_id", "h", "n_head", "head"), "trie-convs")
    first = convs.select("conv_id", F.explode("head").alias("t")).select(
        "conv_id", F.col("t.pos").alias("d"), *[f"t.{t}" for t in TURN], "t.n_words")
    rest = turns.join(convs.select("conv_id", "h", "n_head"), "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("n_head")).alias("d"), *TURN, "n_words")
    none = F.lit(None).cast("long")
    roots = convs.select("conv_id", F.lit(0).cast("long").alias("d"), none.alias("t1"), none.alias("t2"), none.alias("n_words"))
    return first.unionByName(rest).unionByName(roots)


def _chunk(rows: DataFrame, chunk_turns: int) -> str | None:
    """The chunk column ``_at``, or None where no conversation is longer than a chunk."""
    return "_at" if (rows.agg(F.max("d")).first()[0] or 0) >= chunk_turns else None


def prefixes(turns: DataFrame, chunk_turns: int = CHUNK) -> DataFrame:
    """conv_id, d, p1, p2 (digest of the first d turns), q1, q2 (of the first d - 1), n_words, last (no turn follows)."""
    chunk = _chunk(turns, chunk_turns)
    own = turns.select("conv_id", "d", "n_words", F.floor(F.col("d") / chunk_turns).alias("_at"),
                       *[F.when(F.col("d") > 0, F.xxhash64("d", t)).otherwise(F.lit(0)).alias(f"m{t[1]}") for t in TURN])
    for i in ("1", "2"):
        own = seq.running_agg(own, ["conv_id"], ["d"], chunk, f"m{i}", f"p{i}", "xor", next_of="d" if i == "1" else None)
    return own.select("conv_id", "d", "p1", "p2", F.col("p1").bitwiseXOR(F.col("m1")).alias("q1"),
                      F.col("p2").bitwiseXOR(F.col("m2")).alias("q2"), "n_words", F.col("next_d").isNull().alias("last"))


def _cells(p1: np.ndarray, p2: np.ndarray, cells: int) -> list[np.ndarray]:
    """The cell of each digest in each row of the sketch: double hashing of its halves."""
    a, b = p1.view(np.uint64), p2.view(np.uint64) | np.uint64(1)
    return [((a + np.uint64(r) * b) >> np.uint64(17)) & np.uint64(cells - 1) for r in range(ROWS)]


class Sketch:
    """Count-min cells that tell 0, 1 and more, as two bitmaps a row: at least one, at least two."""

    def __init__(self, cells: int):
        self.cells = cells
        self.one = np.zeros((ROWS, cells // 8), np.uint8)
        self.two = np.zeros((ROWS, cells // 8), np.uint8)

    def add(self, p1: np.ndarray, p2: np.ndarray) -> None:
        for r, at in enumerate(_cells(p1, p2, self.cells)):
            at, n = np.unique(at, return_counts=True)
            byte, bit = (at >> np.uint64(3)).astype(np.int64), np.left_shift(1, (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8)
            again = (n > 1) | ((self.one[r, byte] & bit) > 0)
            np.bitwise_or.at(self.two[r], byte[again], bit[again])
            np.bitwise_or.at(self.one[r], byte, bit)

    def blocks(self) -> Iterator[tuple[int, bytes, bytes]]:
        size = min(BLOCK, self.cells // 8)
        one, two = self.one.reshape(-1, size), self.two.reshape(-1, size)
        for i in np.flatnonzero(one.any(1)).tolist():
            yield i, one[i].tobytes(), two[i].tobytes()


def single(two: np.ndarray, p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
    """Whether the estimate of a counted digest is one: some row's cell has not been counted twice."""
    out = np.zeros(len(p1), bool)
    for r, at in enumerate(_cells(p1, p2, two.shape[1] * 8)):
        out |= (two[r, (at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 0
    return out


def _numpy(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.asarray(batch.column(name).to_numpy(zero_copy_only=False), np.int64)


def sketch_of(rows: DataFrame, cells: int) -> np.ndarray:
    """The cells counted twice or more, as bitmaps by row, over the digests (p1, p2) of all rows."""
    schema = "block long, one binary, two binary"
    names = ["block", "one", "two"]

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in
                                           enumerate((pa.int64(), pa.binary(), pa.binary()))], names=names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Sketch(cells)
        for batch in batches:
            own.add(_numpy(batch, "p1"), _numpy(batch, "p2"))
        out = []
        for block in own.blocks():
            out.append(block)
            if len(out) == 256:
                yield batch_of(out)
                out = []
        yield batch_of(out)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}     # the blocks of this task, two bitmaps each
        for batch in batches:
            for i, one, two in zip(*(c.to_pylist() for c in batch.columns)):
                one, two = np.frombuffer(one, np.uint8), np.frombuffer(two, np.uint8)
                if i in held:
                    a, b = held[i]
                    one, two = a | one, b | two | (a & one)
                held[i] = one, two
        yield batch_of([(i, b"", two.tobytes()) for i, (_, two) in held.items() if two.any()])

    blocks = rows.select("p1", "p2").mapInArrow(count, schema)
    added = blocks.repartition("block").mapInArrow(add, schema)
    size = min(BLOCK, cells // 8)
    out = np.zeros((ROWS * (cells // 8) // size, size), np.uint8)
    for r in added.select("block", "two").collect():    # ROWS * cells / 8 bytes at most
        out[r["block"]] = np.frombuffer(bytes(r["two"]), np.uint8)
    return out.reshape(ROWS, -1)


def screened(rows: DataFrame, cells: int | None = None) -> DataFrame:
    """The prefixes with ``single`` (proven to belong to one conversation) and ``parent_single``."""
    if cells is None:
        cells = min(MOST_CELLS, max(LEAST_CELLS, 1 << (8 * max(rows.count(), 1)).bit_length()))
    two = rows.sparkSession.sparkContext.broadcast(sketch_of(rows.where("d > 0"), cells))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = _numpy(batch, "d")
            own = single(two.value, _numpy(batch, "p1"), _numpy(batch, "p2")) & (d > 0)
            above = single(two.value, _numpy(batch, "q1"), _numpy(batch, "q2")) & (d > 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own), pa.array(above)],
                                             names=[*batch.schema.names, "single", "parent_single"])

    return rows.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in rows.dtypes) + ", single boolean, parent_single boolean")


def _hashed(parts: DataFrame) -> DataFrame:
    """KEY and ends_sha256 from pieces (KEY, piece, ids) of comma-joined ids."""
    names = [*KEY, "ends_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def batch_of(out):
            return pa.RecordBatch.from_arrays([*[pa.array([r[0][i] for r in out], pa.int64()) for i in range(3)],
                                               pa.array([r[1] for r in out], pa.string())], names=names)

        for batch in batches:
            out = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in [*KEY, "ids"])):
                if key != node:
                    if node:
                        out.append((node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield batch_of(out)
        if node:
            yield batch_of([(node, digest.hexdigest())])

    return (parts.repartition(*KEY).sortWithinPartitions(*KEY, "piece").select(*KEY, "ids")
            .mapInArrow(run, "d long, p1 long, p2 long, ends_sha256 string"))


def build(turns: DataFrame, cells: int | None = None, chunk_turns: int = CHUNK) -> DataFrame:
    """A row per node: conv_id (smallest member), depth, parent_conv_id (the parent's; null for the root), n_convs, n_children,
    n_leaves, saved_tokens (over the subtree, (n_convs - 1) * words of the node's last text), ends_sha256."""
    rows = materialize(prefixes(materialize(turns, "trie-rebuilt"), chunk_turns), "trie-prefixes")
    rows = materialize(screened(rows, cells), "trie-screened")
    shared, tails = rows.where("not single"), rows.where("single")
    c = F.col("conv_id")
    nodes = materialize(shared.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("n_words").alias("n_words"),
        F.min("q1").alias("q1"), F.min("q2").alias("q2")), "trie-nodes")

    # the children of grouped nodes: grouped ones, and single ones right below
    parent = [(F.col("d") - 1).alias("d"), F.col("q1").alias("p1"), F.col("q2").alias("p2")]
    below = tails.where("not parent_single")
    children = nodes.where("d > 0").select(*parent).unionByName(below.select(*parent))
    n_children = children.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialize(nodes.join(n_children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))),
                        "trie-inner")

    # weights on the rows of smallest members, summed up from the deepest; the lowest bit tells of a leaf
    saved = (F.col("n_convs") - 1) * F.coalesce("n_words", F.lit(0).cast("long"))
    weight = nodes.select("conv_id", "d", (2 * saved + (F.col("n_children") == 0).cast("long")).alias("weight"))
    ends = tails.where("last").select("conv_id", "d", F.lit(1).cast("long").alias("weight"))
    own = shared.select("conv_id", *KEY).join(weight, ["conv_id", "d"], "left").withColumn("in_trie", F.lit(True))
    own = own.unionByName(ends.withColumn("in_trie", F.lit(False)), allowMissingColumns=True)
    own = own.withColumn("up", -F.col("d")).withColumn("_at", F.floor(F.col("up") / chunk_turns))
    own = seq.running_sum(own, ["conv_id"], ["up"], _chunk(rows, chunk_turns), F.coalesce("weight", F.lit(0).cast("long")), out="total")
    sums = own.where("in_trie and total > 0").groupBy(*KEY).agg(
        F.sum(F.shiftright("total", 1)).alias("saved_tokens"), F.sum(F.col("total").bitwiseAND(F.lit(1))).alias("n_leaves"))

    # ids of the conversations that end at a node, by ranges of ids
    piece = F.floor(c / END_RANGE)
    parts = shared.where("last").groupBy(*KEY, piece.alias("piece")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    zero = F.lit(0).cast("long")

    top = nodes.select(*[F.col(k).alias(f"_{k}") for k in KEY], c.alias("parent_conv_id"))
    grouped = (nodes.join(sums, KEY, "left").join(_hashed(parts), KEY, "left")
               .select(c, "d", "q1", "q2", "n_convs", "n_children", F.coalesce("n_leaves", zero).alias("n_leaves"),
                       F.coalesce("saved_tokens", zero).alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256")))
    one = F.lit(1).cast("long")
    alone = tails.select(c, "d", "q1", "q2", "parent_single", one.alias("n_convs"), F.when(F.col("last"), zero).otherwise(one).alias("n_children"),
                         one.alias("n_leaves"), zero.alias("saved_tokens"),
                         F.when(F.col("last"), F.sha2(c.cast("string"), 256)).otherwise(nothing).alias("ends_sha256"))
    known = alone.where("parent_single").drop("parent_single", "q1", "q2").withColumn("parent_conv_id", c)
    asked = grouped.unionByName(alone.where("not parent_single").drop("parent_single"))
    asked = asked.join(top, (F.col("d") - 1 == F.col("_d")) & (F.col("q1") == F.col("_p1")) & (F.col("q2") == F.col("_p2")), "left")
    # a prefix below a proven single one is single too, whatever its estimate: its parent has the same member
    asked = asked.withColumn("parent_conv_id", F.coalesce("parent_conv_id", F.when(F.col("d") > 0, c))).select(*known.columns)
    return asked.unionByName(known).select("conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children",
                                           "n_leaves", "saved_tokens", "ends_sha256")
