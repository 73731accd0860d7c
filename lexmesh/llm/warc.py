"""WARC archives as a chunked record table.

Payloads are rows of (record, chunk number, bytes): each is cut into chunks of at most CHUNK bytes where its
page is read, a task streams its chunks into one gzipped archive with a member per record, and reading back
yields such rows again, with the SHA-1 carried on from chunk to chunk. Behind the scan of the pages, which
hold a payload in one value, no join, sort, writer or reader holds more of a record than a chunk. Archives
lie in the shared folder of spark.checkpoint.dir (any store that pyarrow.fs opens) and get their final name
when whole, so a task that runs again replaces its own file.

Equal payloads: the record with the largest page_id is the response, others are revisits of it. Pages
that tie for the largest id, as repeated rows do, are all responses. A null page_id is below any other.
Nulls: a null html is an empty payload, a null url leaves out the target. Empty tables give no rows;
other columns aren't read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint_dir, cut

CHUNK = 256 << 10
_CUT = b"\r\n\r\n"


def records(pages: DataFrame, size: int = CHUNK) -> DataFrame:
    """The record table: record, chunk_no, page_id, url, payload_bytes, sha1, record_type, refers_to, data.

    A payload is cut where its page is read, so that what is shuffled, sorted and written are chunks of at most
    size bytes; a revisit and an empty payload have one empty chunk. Rows are in the order of (record, chunk_no)
    within a partition, and a record lies in one.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("sha1", F.sha1("payload"))
    # aggregated by the digest alone and joined by two columns: both sides of the join are dealt anew, so a hot payload can be split
    copies = rows.groupBy("sha1").agg(F.max("payload_bytes").alias("payload_bytes"), F.max("page_id").alias("best"), F.count("*").alias("n")).filter("n > 1").drop("n")
    last = F.greatest(F.ceil(F.col("payload_bytes") / size).cast("int") - 1, F.lit(0))
    chunks = rows.withColumn("record", F.monotonically_increasing_id()).withColumn("chunk_no", F.explode(F.sequence(F.lit(0), last)))
    chunks = chunks.withColumn("data", F.substring("payload", F.col("chunk_no") * size + 1, F.lit(size))).drop("payload")
    response = F.col("best").isNull() | F.coalesce(F.col("page_id") == F.col("best"), F.lit(False))
    joined = chunks.join(copies, ["sha1", "payload_bytes"], "left").filter(response | (F.col("chunk_no") == 0))
    data = F.when(response, F.col("data")).otherwise(F.lit(b""))
    named = joined.select("record", "chunk_no", "page_id", "url", "payload_bytes", "sha1", F.when(response, "response").otherwise("revisit").alias("record_type"), F.when(~response, F.col("best")).alias("refers_to"), data.alias("data"))
    return named.sortWithinPartitions("record", "chunk_no")


def _safe(text: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _head(row: dict) -> bytes:
    """The WARC and HTTP headers of a record."""
    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    held = row["payload_bytes"] if row["record_type"] == "response" else 0
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <urn:page:{'' if row['page_id'] is None else row['page_id']}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {_safe(row['url'])}")
    if row["refers_to"] is not None:
        lines += [f"WARC-Refers-To: <urn:page:{row['refers_to']}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {row['payload_bytes']}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + held}"]
    return "\r\n".join(lines).encode() + _CUT + http


def write(table: DataFrame, folder: str) -> DataFrame:
    """Writes chunk rows as archives, one a task: (path, n_records). The table is checkpointed: it is written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        at = f"{base}/part-{TaskContext.get().partitionId():06d}.warc.gz"
        part = f"{at}.{TaskContext.get().taskAttemptId()}.tmp"
        out, n, member = None, 0, None
        for b in batches:
            for row in b.to_pylist():
                if out is None:
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(part, compression=None)
                if row["chunk_no"] == 0:
                    if member is not None:
                        out.write(member.compress(_CUT) + member.flush())
                    member = zlib.compressobj(1, wbits=31)
                    out.write(member.compress(_head(row)))
                    n += 1
                out.write(member.compress(row["data"]))
        if out is not None:
            out.write(member.compress(_CUT) + member.flush())
            out.close()
            store.move(part, at)
            yield pa.RecordBatch.from_pydict({"path": [at], "n_records": pa.array([n], pa.int64())})

    return cut(table.mapInArrow(run, "path string, n_records long"))


class _Stream:
    """Decompressed bytes of an archive, in pieces: gzip members follow each other."""

    def __init__(self, file, piece: int = 64 << 10):
        self.file, self.piece, self.held = file, piece, b""
        self.member, self.rest, self.begun = zlib.decompressobj(31), b"", False

    def more(self) -> bool:
        while True:
            raw = self.rest or self.file.read(self.piece)
            if not raw:
                return False
            self.begun = True
            if self.member.eof:
                self.member = zlib.decompressobj(31)
            got = self.member.decompress(raw, self.piece)
            self.rest = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
            if got:
                self.held += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        while mark not in self.held:
            if not self.more():
                if self.held or self.begun and not self.member.eof:
                    raise ValueError("the archive ends within a record")
                return None
        head, _, self.held = self.held.partition(mark)
        return head

    def take(self, n: int) -> bytes:
        """Exactly n bytes, however the pieces of the archive fall."""
        got = bytearray()
        while len(got) < n:
            if not self.held and not self.more():
                raise ValueError("the archive ends within a record")
            part, self.held = self.held[: n - len(got)], self.held[n - len(got) :]
            got += part
        return bytes(got)


def parse(file, size: int = CHUNK) -> Iterator[dict]:
    """Chunk rows of an open archive; the last chunk of a record carries the digest of its payload."""
    s = _Stream(file)
    while (head := s.until(_CUT)) is not None:
        field = dict(x.split(": ", 1) for x in head.decode().lstrip("\r\n").split("\r\n")[1:])
        http = s.until(_CUT)
        if http is None:
            raise ValueError("the archive ends within a record")
        left = int(field["Content-Length"]) - len(http) - len(_CUT)
        id_of = lambda x: int(x[len("<urn:page:") : -1]) if len(x) > len("<urn:page:>") else None
        row = {"page_id": id_of(field["WARC-Record-ID"]), "url": field.get("WARC-Target-URI"), "record_type": field["WARC-Type"], "refers_to": id_of(field.get("WARC-Refers-To", "")), "payload_bytes": int(field["X-Payload-Length"])}
        stated = field["WARC-Payload-Digest"].removeprefix("sha1:")
        digest, chunk_no = hashlib.sha1(), 0
        while True:
            data = s.take(min(left, size))
            left -= len(data)
            digest.update(data)
            done = left == 0
            if done and row["record_type"] == "response" and base64.b32encode(digest.digest()).decode() != stated:
                raise ValueError(f"record {row['page_id']}: its payload isn't that of its digest")
            yield row | {"chunk_no": chunk_no, "data": data, "payload_digest": stated if done else None}
            chunk_no += 1
            if done:
                break
        if s.take(len(_CUT)) != _CUT:
            raise ValueError("a record doesn't end where its header says")


def read(manifest: DataFrame, folder: str, data: bool = True) -> DataFrame:
    """The chunked record table of the archives: a task streams a file after another."""
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "chunk_no", *["data"] * data, "payload_digest"]
    kinds = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "chunk_no": pa.int32(), "data": pa.binary(), "payload_digest": pa.string()}

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds[c]) for c in names], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        rows, held = [], 0
        for b in batches:
            for path in b.column("path").to_pylist():
                with store.open_input_stream(path, compression=None) as file:
                    for row in parse(file):
                        rows.append(row)
                        held += len(row["data"]) * data + 200
                        if held > 8 << 20:
                            yield batch(rows)
                            rows, held = [], 0
        if rows:
            yield batch(rows)

    kind = {"chunk_no": "int", "page_id": "long", "refers_to": "long", "payload_bytes": "long", "data": "binary"}
    return manifest.select("path").repartition(max(1, manifest.count())).mapInArrow(run, ", ".join(f"{c} {kind.get(c, 'string')}" for c in names))


def new_folder(df: DataFrame) -> str:
    return f"{checkpoint_dir(df.sparkSession)}/warc-{uuid.uuid4().hex}"


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes the pages as archives and reads these back: a row per page, from the last chunk of its record."""
    folder = new_folder(pages)
    manifest = write(records(pages), folder)
    back = read(manifest, folder, data=False).filter(F.col("payload_digest").isNotNull())
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
