"""WARC archives written and read as tables of record chunks.

A payload longer than ``chunk`` bytes travels as several rows of (record, chunk number,
bytes), so that neither the writer nor the reader holds a whole record in Python.  The
reader carries a record's SHA-1 and length along from chunk to chunk; its last row has
those of the whole payload.

Archives are gzipped WARC 1.1, one member per record.  Of records with equal payloads
the one with the largest id is a response and the others revisit it.  Tasks write files
of their own name into the shared folder, and only those that the manifest lists, a
table that Spark commits, are read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import col
from hearthline.session import opened, scratch_path, settle

CHUNK = 1 << 16
READ = 1 << 18
EPOCH = "1970-01-01T00:00:00Z"  # records carry no time of capture
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNKS = (
    "record_type string, page_id long, refers_to long, url string, digest string, payload_bytes long, "
    "chunk int, last boolean, data binary"
)
ARCHIVED = "record_id string, " + CHUNKS.replace("digest string, payload_bytes long", "payload_digest string, payload_bytes long")


def dedup_plan(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 1000) -> DataFrame:
    """Records with their payload, its length and SHA-1, and whether they revisit another.

    Copies are counted per (digest, length) before they are joined back, and only payloads
    that occur twice are; a payload that a third of all rows share is split by Spark's
    skew handling.  A null payload is empty.  A null id revisits, if there is another id;
    rows that share the largest id are all responses.
    """
    # A string's own bytes, which are UTF-8: encoding would take copies of the whole payload.
    payload = F.coalesce(col(payload_col).cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(col(id_col).cast("long").alias("page_id"), col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    large = rows.where(F.col("payload_bytes") >= least)
    copied = large.groupBy("digest", "payload_bytes").agg(F.max("page_id").alias("newest"), F.count("*").alias("n"))
    copied = settle(copied.where("n > 1 and newest is not null").select("digest", "payload_bytes", "newest"), "copied")
    joined = rows.join(copied, ["digest", "payload_bytes"], "left")
    revisit = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    return joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), "page_id", F.when(revisit, F.col("newest")).alias("refers_to"),
        "url", "digest", "payload_bytes", "payload",
    )


def chunk_rows(records: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows of (record, chunk number, bytes); a revisit and an empty payload have one empty chunk.

    Chunk numbers are listed and each cuts its own bytes, so beside the payload itself there
    is one chunk of it at a time.
    """
    response = F.col("record_type") == "response"
    n = F.when(response, F.greatest(F.lit(1), F.ceil(F.col("payload_bytes") / chunk))).otherwise(1).cast("int")
    listed = records.withColumn("_n", n).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    data = F.when(response, F.substring("payload", F.col("chunk") * chunk + 1, F.lit(chunk))).otherwise(F.lit(b""))
    return listed.select(
        "record_type", "page_id", "refers_to", "url", "digest", "payload_bytes", "chunk", (F.col("chunk") == F.col("_n") - 1).alias("last"), data.alias("data")
    )


def record_name(page_id: int | None, digest: str, url: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest} {url}')}>"


def header(row: dict) -> bytes:
    """The header of a record; its text fields are percent-free lines, so line ends in an address are left out."""
    revisit = row["record_type"] == "revisit"
    sha1 = base64.b32encode(bytes.fromhex(row["digest"])).decode()
    fields = [
        ("WARC-Type", row["record_type"]), ("WARC-Record-ID", record_name(row["page_id"], row["digest"], row["url"] or "")),
        ("WARC-Date", EPOCH), ("WARC-Payload-Digest", f"sha1:{sha1}"), ("Content-Length", 0 if revisit else row["payload_bytes"]),
        ("Content-Type", "text/html; charset=utf-8"), ("X-Payload-Length", row["payload_bytes"]),
    ]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", "".join(row["url"].splitlines())))
    if row["page_id"] is not None:
        fields.append(("X-Page-ID", row["page_id"]))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("X-Refers-To-Page-ID", row["refers_to"])]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in fields), "\r\n"]).encode()


def write_archives(chunks: DataFrame, level: int = 3, folder: str | None = None) -> DataFrame:
    """Write the chunks' records; returns the manifest (file, records).

    A record's chunks must follow each other in their partition, as ``chunk_rows`` leaves
    them.  The writer carries each record's SHA-1 and length from chunk to chunk and compares
    them with the record's at its end, so a header never tells of other bytes than follow it.
    """
    folder = folder or scratch_path(chunks.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        out, n, pack, digest, length = None, 0, None, hashlib.sha1(), 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    store, place = opened(file)
                    store.create_dir(place.rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(place, compression=None)
                if row["chunk"] == 0:
                    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                    out.write(pack.compress(header(row)))
                    digest, length = hashlib.sha1(), 0
                out.write(pack.compress(row["data"]))
                digest.update(row["data"])
                length += len(row["data"])
                if row["last"]:
                    if row["record_type"] == "response" and (digest.hexdigest(), length) != (row["digest"], row["payload_bytes"]):
                        raise ValueError(f"the chunks of page {row['page_id']} are not its payload")
                    out.write(pack.compress(b"\r\n\r\n") + pack.flush())
                    n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([n])], ["file", "records"])

    return settle(chunks.mapInArrow(run, "file string, records long"), "manifest")


class Unpacked:
    """The bytes of a gzipped stream, member after member, a bounded number at a time."""

    def __init__(self, source):
        self.source, self.raw, self.ready, self.inflate, self.held = source, b"", b"", None, False

    def more(self) -> bool:
        """Add to what is ready; false at the end."""
        while True:
            if not self.raw and not self.held:
                self.raw = self.source.read(READ)
                if not self.raw:
                    return False
            if self.inflate is None:
                self.inflate = zlib.decompressobj(31)
            found = self.inflate.decompress(self.raw, READ)
            self.raw, self.held = self.inflate.unconsumed_tail, len(found) == READ
            if self.inflate.eof:
                self.raw, self.inflate, self.held = self.inflate.unused_data, None, False
            if found:
                self.ready += found
                return True

    def until(self, mark: bytes) -> bytes | None:
        while (at := self.ready.find(mark)) < 0:
            if not self.more():
                if self.ready.strip():
                    raise ValueError("an archive ends within a header")
                return None
        found, self.ready = self.ready[:at], self.ready[at + len(mark) :]
        return found

    def take(self, most: int) -> bytes:
        if not self.ready and not self.more():
            raise ValueError("an archive ends within a record")
        found, self.ready = self.ready[:most], self.ready[most:]
        return found


def archived(source, chunk: int = CHUNK) -> Iterator[dict]:
    """Chunk rows of an archive, each with the length and SHA-1 of the payload up to its end."""
    stream = Unpacked(source)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        lines = head.decode().lstrip("\r\n").split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
        row = {
            "record_id": fields["WARC-Record-ID"].strip("<>"), "record_type": fields["WARC-Type"], "page_id": None if page is None else int(page),
            "refers_to": None if refers is None else int(refers), "url": fields.get("WARC-Target-URI"),
        }
        told = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        left, running, n, k = int(fields["Content-Length"]), hashlib.sha1(), 0, 0
        while True:
            parts, size = [], 0
            while left and size < chunk:
                parts.append(stream.take(min(left, chunk - size)))
                size, left = size + len(parts[-1]), left - len(parts[-1])
            data = b"".join(parts)
            running.update(data)
            n += len(data)
            if row["record_type"] == "revisit":
                yield row | {"payload_digest": told, "payload_bytes": int(fields["X-Payload-Length"]), "chunk": 0, "last": True, "data": b""}
                break
            yield row | {"payload_digest": running.copy().hexdigest(), "payload_bytes": n, "chunk": k, "last": not left, "data": data}
            if not left:
                if running.hexdigest() != told:
                    raise ValueError(f"the payload of {row['record_id']} doesn't have the digest of its header")
                break
            k += 1
        if stream.until(b"\r\n\r\n") is None:
            raise ValueError("an archive ends within a record")


def read_archives(manifest: DataFrame, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunk table of the archives; a task reads one archive, chunk by chunk.

    A row's payload_digest and payload_bytes are those of the payload up to its end, so
    ``where("last")`` gives one row per record.  A revisit's are of the payload it stands for.
    """
    n = max(1, manifest.count())
    names = [f.split()[0] for f in ARCHIVED.split(", ")]
    batch_rows = 16 if with_data else 512

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file in (f for b in batches for f in b.column("file").to_pylist()):
            store, place = opened(file)
            with store.open_input_stream(place, compression=None) as source:
                waiting: list[dict] = []
                for row in archived(source, chunk):
                    waiting.append(row if with_data else row | {"data": None})
                    if len(waiting) == batch_rows:
                        yield told(waiting)
                        waiting = []
                yield told(waiting)

    def told(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, SHAPE).select(names)

    return manifest.select("file").repartitionByRange(n, "file").mapInArrow(run, ARCHIVED)


SHAPE = pa.schema(
    [
        ("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()), ("url", pa.string()),
        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("chunk", pa.int32()), ("last", pa.bool_()), ("data", pa.binary()),
    ]
)


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 1000) -> DataFrame:
    """Write an archive record for every row; returns the manifest."""
    return write_archives(chunk_rows(dedup_plan(pages, id_col, url_col, payload_col, least)))
