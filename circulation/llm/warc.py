"""WARC archives with a two-level capture index.

Writing: every task streams its pages into gzip-member WARC files of a bounded size in shared
storage. Of records with equal payloads the one with the least page id is a response, the others
revisit it. Indexing: (reversed-host URL, page id) keys are range-sorted into lines, ``BLOCK_LINES``
to a compressed block, and a sparse directory keeps the first key, file and byte range of each block.
Reading: a lookup binary-searches the directory, range-reads and binary-searches the block, and then
range-reads its record.

Files get fresh names; only those named in written tables count, so a task that is run again
leaves no half file behind that anyone reads.

Defined results: a null payload is an empty one, a null URL an empty one; a null page id is never the
least of its group, but a group that has none else is all responses; repeated rows of the least id
are all responses; an empty table writes no archive and an empty index. Only the id, URL and payload columns are used.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from circulation.llm.common import bound_memory, shuffle_partitions, written
from circulation.llm.urls import reversed_host_key
from circulation.session import scratch_path

FILE_BYTES = 64 << 20
BLOCK_LINES = 3000
# Rows of the directory, and digests of repeated payloads, that may be broadcast: about 100 bytes each.
BROADCAST_ROWS = 200_000
RECORD_DATE = "1970-01-01T00:00:00Z"

CAPTURES = "key string, page_id long, file string, start long, length long"
RECORDS = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "payload binary")


# --- shared storage -------------------------------------------------------------------------

def storage(uri: str):
    """(file system, path) of a folder or file in shared storage, as Spark names it."""
    from pyarrow import fs

    uri = re.sub(r"^file:/+", "file:///", uri)
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


class _Files:
    """Appends members to files below a folder, starting a new file at ``FILE_BYTES``."""

    def __init__(self, folder: str, suffix: str):
        self.folder, self.suffix, self.out, self.at, self.name = folder, suffix, None, 0, ""

    def add(self, member: bytes) -> tuple[str, int, int]:
        if self.out is None or self.at >= FILE_BYTES:
            self.close()
            self.name, self.at = f"{self.folder}/{uuid.uuid4().hex}{self.suffix}", 0
            system, path = storage(self.name)
            system.create_dir(path.rsplit("/", 1)[0], recursive=True)
            self.out = system.open_output_stream(path, compression=None)
        start = self.at
        self.out.write(member)
        self.at += len(member)
        return self.name, start, len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


class _Ranges:
    """Range reads; keeps the last file open."""

    def __init__(self):
        self.name, self.file = None, None

    def read(self, name: str, start: int, length: int) -> bytes:
        if name != self.name:
            self.close()
            system, path = storage(name)
            self.name, self.file = name, system.open_input_file(path)
        found = self.file.read_at(length, start)
        if len(found) != length:
            raise OSError(f"{name}: {length} bytes wanted at {start}, {len(found)} found")
        return found

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


# --- records --------------------------------------------------------------------------------

def _uuid(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP headers, which state the payload's full length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            "WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"), f"WARC-Date: {RECORD_DATE}",
            f"WARC-Record-ID: {_uuid(page_id)}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_uuid(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple:
    """A ``RECORDS`` row of one record; a record whose lengths or digest do not agree is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    length = int(fields["Content-Length"])
    block, tail = rest[:length], rest[length:]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(re.search(rb"Content-Length: (\d+)", http)[1])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    whole = len(payload) == stated and base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest
    if lines[0] != "WARC/1.1" or tail != b"\r\n\r\n" or len(block) != length or (kind == "response" and not whole):
        raise ValueError("damaged WARC record")
    number = lambda name: int(fields[name]) if name in fields else None
    return (number("X-Page-Id"), fields["WARC-Target-URI"], stated, digest, kind, number("X-Refers-To-Page-Id"),
            payload if kind == "response" else None)


# --- writing --------------------------------------------------------------------------------

def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload) with its SHA-1 (hex) and ``refers_to``: the least id of an equal payload, or null."""
    pages = pages.withColumn("sha1", F.sha1("payload"))
    enough = pages.where(F.length("payload") >= min_bytes)
    firsts = enough.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = written(firsts.select("sha1", "first"), "warc-repeats")
    if firsts.count() <= BROADCAST_ROWS:
        firsts = F.broadcast(firsts)
    joined = pages.join(firsts, "sha1", "left")
    revisit = (F.length("payload") >= min_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.withColumn("refers_to", F.when(revisit, F.col("first"))).drop("first")


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, page_id: str = "page_id",
                   url: str = "url", payload: str = "html") -> DataFrame:
    """Write a record per row of ``pages``; returns the written captures (``CAPTURES``)."""
    bound_memory(pages.sparkSession)
    folder = folder or scratch_path(pages.sparkSession, "warc")
    address = F.coalesce(F.col(f"`{url}`").cast("string"), F.lit(""))
    source = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), address.alias("url"),
                          F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("payload"))
    source = with_revisits(source, min_bytes).select("page_id", "url", "payload", "sha1", "refers_to",
                                                     reversed_host_key(F.col("url")).alias("surt"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder, ".warc.gz")
        try:
            for b in batches:
                out = []
                ids, urls, _, sums, refs, surts = (c.to_pylist() if i != 2 else None for i, c in enumerate(b.columns))
                for i, body in enumerate(b.column(2)):
                    digest = base64.b32encode(bytes.fromhex(sums[i])).decode()
                    data = record(ids[i], urls[i], body.as_py(), digest, refs[i])
                    out.append((capture_key(surts[i], ids[i]), ids[i], *files.add(gzip.compress(data, 6, mtime=0))))
                if out:
                    yield _captures(out)
        finally:
            files.close()

    return written(source.mapInArrow(write, CAPTURES), "warc-captures")


def capture_key(surt: str, page_id: int | None) -> str:
    """Sorts by URL, then by page id (digits of one width; a null id first)."""
    safe = surt.replace("%", "%25").replace(" ", "%20").replace("\n", "%0A").replace("\r", "%0D").replace("\t", "%09")
    return f"{safe} -" if page_id is None else f"{safe} {page_id + (1 << 63):020d}"


def _captures(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      names=["key", "page_id", "file", "start", "length"])


# --- the index ------------------------------------------------------------------------------

DIRECTORY = "first_key string, file string, start long, length long, lines long"


def build_index(captures: DataFrame, folder: str | None = None, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sort the captures into compressed blocks; returns the block directory (one row per block)."""
    spark = captures.sparkSession
    folder = folder or scratch_path(spark, "cdx")
    # The last key deals out captures of one key, should a page be there many times.
    keys = ["key", "file", "start"]
    dealt = captures.select("key", "file", "start", "length").repartitionByRange(
        shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, lines, out = _Files(folder, ".cdx.gz"), [], []

        def flush() -> None:
            place = files.add(zlib.compress("\n".join(lines).encode(), 6))
            out.append((lines[0].split("\t", 1)[0], *place, len(lines)))
            lines.clear()

        try:
            for b in batches:
                for row in zip(*(c.to_pylist() for c in b.columns)):
                    lines.append("\t".join(map(str, row)))
                    if len(lines) == block_lines:
                        flush()
            if lines:
                flush()
        finally:
            files.close()
        if out:
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                             names=["first_key", "file", "start", "length", "lines"])

    return written(dealt.mapInArrow(blocks, DIRECTORY), "cdx-directory")


def look_up(keys: DataFrame, directory: DataFrame, rows_at_once: int = BROADCAST_ROWS) -> DataFrame:
    """All captures (key, file, start, length) of the distinct keys (column ``key``).

    A directory of more than ``rows_at_once`` blocks is searched in several passes, each over a range of keys."""
    spark = keys.sparkSession
    keys = written(keys.select("key").distinct().repartitionByRange(shuffle_partitions(spark), "key").sortWithinPartitions("key"),
                   "cdx-keys")
    total = directory.count()
    if not total:
        return spark.createDataFrame([], "key string, file string, start long, length long")
    bounds: list[str | None] = [None]
    if total > rows_at_once:
        shares = [k / -(-total // rows_at_once) for k in range(1, -(-total // rows_at_once))]
        ordered = directory.select("first_key").orderBy("first_key").rdd.map(lambda r: r[0]).zipWithIndex()
        marks = {int(s * total) for s in shares}
        bounds += [k for k, i in ordered.filter(lambda x: x[1] in marks).sortBy(lambda x: x[1]).collect()]
    found = None
    for i, lo in enumerate(bounds):
        hi = bounds[i + 1] if i + 1 < len(bounds) else None
        mine, blocks = keys, directory
        if lo is not None:
            mine = mine.where(F.col("key") >= lo)
        if hi is not None:
            mine, blocks = mine.where(F.col("key") < hi), blocks.where(F.col("first_key") < hi)
        if lo is not None:  # and the block before, in which the first of these keys may begin
            before = directory.where(F.col("first_key") < lo).agg(F.max("first_key")).first()[0]
            blocks = blocks.where(F.col("first_key") >= (before if before is not None else lo))
        part = _search(mine, blocks)
        found = part if found is None else found.unionAll(part)
    return found


def _search(keys: DataFrame, blocks: DataFrame) -> DataFrame:
    entries = sorted(tuple(r) for r in blocks.select("first_key", "file", "start", "length").collect())
    held = keys.sparkSession.sparkContext.broadcast(entries)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, ranges, loaded = held.value, _Ranges(), {}
        firsts = [e[0] for e in entries]

        def lines(at: int) -> list[list[str]]:
            if at not in loaded:
                if len(loaded) > 4:
                    loaded.clear()
                loaded[at] = [x.split("\t") for x in zlib.decompress(ranges.read(*entries[at][1:])).decode().split("\n")]
            return loaded[at]

        for b in batches:
            out = []
            for key in b.column(0).to_pylist():
                at = max(0, bisect.bisect_left(firsts, key) - 1)
                while at < len(entries) and firsts[at] <= key:
                    block = lines(at)
                    k = bisect.bisect_left(block, key, key=lambda x: x[0])
                    while k < len(block) and block[k][0] == key:
                        out.append((key, block[k][1], int(block[k][2]), int(block[k][3])))
                        k += 1
                    at += 1
            if out:
                kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 names=["key", "file", "start", "length"])
        ranges.close()

    return keys.mapInArrow(search, "key string, file string, start long, length long")


def read_records(places: DataFrame, with_payload: bool = True) -> DataFrame:
    """``RECORDS`` of the captures (file, start, length), by range reads in the order of the files."""
    spark = places.sparkSession
    dealt = written(places.select("file", "start", "length"), "warc-places").repartitionByRange(
        shuffle_partitions(spark), "file", "start").sortWithinPartitions("file", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = _Ranges()
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for b in batches:
            out, held = [], 0
            for name, start, length in zip(*(c.to_pylist() for c in b.columns)):
                row = parse(gzip.decompress(ranges.read(name, start, length)))
                held += row[2] if with_payload else 0
                out.append(row if with_payload else (*row[:-1], None))
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=NAMES)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=NAMES)
        ranges.close()

    return dealt.mapInArrow(read, RECORDS)


NAMES = [x.split()[0] for x in RECORDS.split(", ")]
