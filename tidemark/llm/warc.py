"""Dictionary-compressed WARC archives.

``write`` turns pages into WARC records and stores them in ``.warc.zst`` layout: a leading skippable frame that
holds the (itself compressed) Zstandard dictionary, then one frame per record, so that a record can be read
alone with the file's dictionary. The dictionary is trained from archived records, a bounded sample: on
average ``SAMPLE`` chosen by a hash, at most twice as many, of at most ``SAMPLE_BYTES`` each.

Of records with equal payloads the one with the largest page_id is a response, the others are revisits that
refer to it and hold no payload (payloads shorter than ``min_revisit`` bytes are always responses). Equal
payloads are found by their SHA-1: the largest page_id of a digest is a partial aggregation, joined back to the
pages, a join that adaptive execution can split. That join is the only shuffle of payloads. Its partitions
become the archives.

Files are written by Spark's own text writer, whose commit protocol keeps retried tasks from leaving parts
behind and which reaches every file system that Spark reaches. Its line separator is an empty skippable frame,
which readers of the format skip. A task closes an archive once its frames reach ``archive_bytes`` (64 MB) and begins
the next with a dictionary frame of its own, so a file exceeds the bound by one record at most, however large the
partition is. ``read`` takes the files with the binaryFile source, a file per row.

Defined cases: a null html is an empty payload; a null url has no target URI, and line ends in one are
written as %0D and %0A; rows that repeat a page_id and payload are records of their own with the same
identifier and type; a null page_id is never referred to, and a payload that only such rows hold is a response
in each of them; an empty table gives no record. Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import binary_values
from tidemark.session import scratch_path

LEVEL = 3
DICT_BYTES = 64 << 10
SAMPLE, SAMPLE_BYTES = 400, 64 << 10
ARCHIVE_BYTES = 64 << 20
#: Fixed values of the Zstandard and .warc.zst formats.
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
DICT_FRAME = b"\x5d\x2a\x4d\x18"
SKIPPABLE = b"\x2a\x4d\x18"
#: An empty skippable frame: magic 0x184D2A50, length 0.
EMPTY_FRAME = b"\x50\x2a\x4d\x18\x00\x00\x00\x00"
WARC_DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:page:"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None, revisit: bool = False,
           length: int | None = None) -> bytes:
    """One WARC/1.1 record. The block is an HTTP response; a revisit's block is its head alone, which still
    tells the payload's length."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % (
        len(payload) if length is None else length)
    if not revisit:
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{_ID}{page_id}>",
            f"WARC-Date: {WARC_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{_ID}{refers_to}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def train(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A dictionary from sample records; from too few or too uniform ones, their text itself."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:] or EMPTY_FRAME


def dictionary_frame(dictionary: bytes) -> bytes:
    body = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return DICT_FRAME + len(body).to_bytes(4, "little") + body


def read_dictionary(archive: bytes) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary in the leading frame of an archive, and where the records begin."""
    if archive[:4] != DICT_FRAME:
        return None, 0
    end = 8 + int.from_bytes(archive[4:8], "little")
    body = archive[8:end]
    if body[:4] == FRAME_MAGIC:
        body = zstandard.ZstdDecompressor().decompress(body)
    return zstandard.ZstdCompressionDict(body), end


def records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive, read one after the other."""
    dictionary, start = read_dictionary(archive)
    stream = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(
        io.BytesIO(memoryview(archive)[start:]), read_across_frames=True), 1 << 16)
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            continue  # the blank lines after a record
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            headers[name] = value
        yield headers, stream.read(int(headers["Content-Length"]))


def build_dictionary(pages: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> bytes:
    """Train on a bounded sample of records of pages (page_id, url, html)."""
    # a share of the pages by hash: no task sends more than its part of the sample to the driver
    share = min(1.0, sample / max(1, pages.count()))
    draw = F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rows = (pages.where((draw < share) & (F.octet_length(F.coalesce("html", F.lit(""))) <= sample_bytes))
            .select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
            .limit(2 * sample).collect())
    return train([record(r["page_id"], r["url"], bytes(r["payload"]), base32_sha1(bytes(r["payload"])))
                  for r in rows])


def plan_records(pages: DataFrame, min_revisit: int = 0) -> DataFrame:
    """page_id, url, payload (null in a revisit), payload_bytes, sha1, revisit, refers_to."""
    own = pages.select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    own = own.withColumn("sha1", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    latest = (pages.select("page_id", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
              .select("page_id", F.sha1("payload").alias("of")).groupBy("of").agg(F.max("page_id").alias("latest")))
    revisit = (F.col("latest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("latest"))
               & (F.col("payload_bytes") >= min_revisit))
    return (own.join(latest, F.col("sha1") == F.col("of")).withColumn("revisit", revisit)
            .select("page_id", "url", F.when(~F.col("revisit"), F.col("payload")).alias("payload"), "payload_bytes",
                    "sha1", "revisit", F.when(F.col("revisit"), F.col("latest")).alias("refers_to")))


def write(pages: DataFrame, path: str | None = None, level: int = LEVEL, min_revisit: int = 0,
          archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Write the archives of pages (page_id, url, html); the folder they are in. Without a ``path`` it goes when the driver
    ends."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    dictionary = build_dictionary(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(
            level=level, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True)
        first = dictionary_frame(dictionary)
        frames, size = [first], len(first)

        def archive():
            return pa.RecordBatch.from_arrays([pa.array([b"".join(frames)], pa.binary())], names=["archive"])

        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in
                           ("page_id", "url", "payload", "payload_bytes", "sha1", "revisit", "refers_to"))):
                page_id, url, payload, length, sha1, revisit, refers_to = r
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                if size >= archive_bytes and len(frames) > 1:
                    yield archive()
                    frames, size = [first], len(first)
                frames.append(compressor.compress(record(page_id, url, payload or b"", digest, refers_to, revisit, length)))
                size += len(frames[-1])
        if len(frames) > 1:
            yield archive()

    # a row is a whole archive, and a file holds one row
    archives = plan_records(pages, min_revisit).mapInArrow(run, "archive binary")
    (archives.select(F.col("archive").cast("string").alias("value")).write
     .option("maxRecordsPerFile", 1).option("lineSep", EMPTY_FRAME.decode("latin-1")).text(path))
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload; one row per record. Length
    and digest of a response are taken from the payload that was read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                              names=names)

        for batch in batches:
            for archive in binary_values(batch.column("content")):
                rows, size = [], 0
                for headers, block in records(archive):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    kind = headers["WARC-Type"]
                    if kind == "revisit":
                        length = int(head.rpartition(b"Content-Length: ")[2])
                        digest, payload = headers["WARC-Payload-Digest"].partition(":")[2], None
                    else:
                        length, digest = len(payload), base32_sha1(payload)
                    rows.append((_number(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), length, digest,
                                 kind, _number(headers.get("WARC-Refers-To")), payload))
                    size += len(payload or b"")
                    if size > 8 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
                yield batch_of(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, "
                                 "record_type string, refers_to long, payload binary")


def _number(identifier: str | None) -> int | None:
    text = identifier.strip("<>").removeprefix(_ID) if identifier else "None"
    return None if text == "None" else int(text)
