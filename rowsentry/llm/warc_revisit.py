"""WARC archives without repeated payloads: revisit records refer to the one response that holds the payload.

Only headers (page, digest, size) are shuffled by digest; the group of one payload, however large, is counted before the shuffle
to one row. Archives are written by the tasks into the shared folder, one gzip member per record, in files of bounded
size. A retried task writes new files; only the files that the manifest (a Parquet table) names are ever read.

Null pages are empty. Of pages with equal payloads the one with the largest id is the response, null ids being the
smallest; rows that repeat that id with that payload are all responses. Other columns take no part.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsentry.llm.common import settle, shared_folder

FILE_BYTES = 256 << 20
CHUNK = 1 << 20
_NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc:page")
# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n"


def resolve(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
            min_bytes: int = 0) -> DataFrame:
    """One row per page: ``page_id, url, payload, digest`` (hex SHA-1) and, for revisits, the response's id and address."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    headers = rows.filter(F.octet_length("payload") >= min_bytes).select("page_id", "url", "digest")
    originals = headers.groupBy("digest").agg(
        F.max(F.struct("page_id", "url")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    original = originals.select("digest", F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("refers_url"))
    links = headers.select("page_id", "digest").join(original, "digest") \
        .filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).distinct()
    links = links.select(F.col("page_id").alias("link_id"), F.col("digest").alias("link_digest"), "refers_to", "refers_url",
                         F.lit(True).alias("revisit"))
    return rows.join(links, rows["page_id"].eqNullSafe(links["link_id"]) & (rows["digest"] == links["link_digest"]), "left") \
        .select("page_id", "url", "payload", "digest", F.coalesce("revisit", F.lit(False)).alias("revisit"), "refers_to", "refers_url")


def _record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, str(page_id))}>"


def _line(text) -> str:
    """A header value on one line."""
    return " ".join(str(text or "").split())


def record(row: dict, when: str) -> bytes:
    """One WARC record with fresh headers; a revisit has the HTTP headers but no payload."""
    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            + f"Content-Length: {len(row['payload'])}\r\n\r\n".encode())
    block = http if row["revisit"] else http + row["payload"]
    head = [f"WARC-Type: {'revisit' if row['revisit'] else 'response'}", f"WARC-Record-ID: {_record_id(row['page_id'])}",
            f"WARC-Date: {when}", f"WARC-Target-URI: {_line(row['url'])}", f"WARC-Payload-Digest: sha1:{digest}",
            f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if row["page_id"] is not None:
        head.append(f"Page-Id: {row['page_id']}")
    if row["revisit"]:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(row['refers_to'])}",
                 f"WARC-Refers-To-Target-URI: {_line(row['refers_url'])}"]
        if row["refers_to"] is not None:
            head.append(f"Refers-To-Page-Id: {row['refers_to']}")
    return b"WARC/1.1\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(resolved: DataFrame, folder: str | None = None, file_bytes: int = FILE_BYTES,
                   level: int = 3) -> DataFrame:
    """Write the records of ``resolve`` as ``.warc.gz`` files and return the manifest: ``path, records, bytes``."""
    folder = folder or shared_folder(resolved.sparkSession)
    when = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        out, made, path, count, size = None, [], "", 0, 0
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k].as_py() for n in batch.schema.names}
                if out is None:
                    path, count, size = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(path, compression=None)
                member = zlib.compressobj(level, zlib.DEFLATED, 31)
                data = member.compress(record(row, when)) + member.flush()
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= file_bytes:
                    out.close()
                    made.append((path, count, size))
                    out = None
        if out is not None:
            out.close()
            made.append((path, count, size))
        if made:
            yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t) for i, t in enumerate(
                (pa.string(), pa.int64(), pa.int64()))], names=["path", "records", "bytes"])

    manifest = resolved.mapInArrow(run, "path string, records long, bytes long")
    return settle(manifest.withColumn("folder", F.lit(folder)))


class _Reader:
    """Bytes of a gzip archive, member by member, holding little more than one record."""

    def __init__(self, stream):
        self.stream, self.member, self.ready, self.raw = stream, None, bytearray(), b""

    def _more(self) -> bool:
        if not self.raw:
            self.raw = self.stream.read(CHUNK)
            if not self.raw:
                return False
        if self.member is None or self.member.eof:
            self.member = zlib.decompressobj(31)
        self.ready += self.member.decompress(self.raw, CHUNK * 4)
        self.raw = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
        return True

    def exactly(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self._more():
                raise ValueError("an archive ends within a record")
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out

    def head(self) -> bytes | None:
        """The lines up to the empty one; None at the end of the archive."""
        at = 0
        while (end := self.ready.find(b"\r\n\r\n", at)) < 0:
            at = max(0, len(self.ready) - 3)
            if not self._more():
                if self.ready:
                    raise ValueError("an archive ends within a header")
                return None
        return self.exactly(end + 4)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    return {k.lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:] if ":" in x)}


def records(stream) -> Iterator[dict]:
    """The records of one archive; a response whose payload does not fit its digest raises."""
    reader = _Reader(stream)
    while (head := reader.head()) is not None:
        fields = _fields(head)
        block = reader.exactly(int(fields["content-length"]))
        reader.exactly(2 * len(END))
        cut = block.index(b"\r\n\r\n") + 4
        http, payload = _fields(block[:cut]), block[cut:]
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        kind = fields["warc-type"]
        if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload and digest of {fields['warc-record-id']} differ")
        number = lambda name: int(fields[name]) if name in fields else None
        yield {"page_id": number("page-id"), "url": fields["warc-target-uri"], "record_type": kind,
               "payload_digest": digest, "payload_bytes": int(http["content-length"]),
               "refers_to": number("refers-to-page-id"), "record_id": fields["warc-record-id"],
               "payload": payload if kind == "response" else None}


SCHEMA = ("page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, "
          "record_id string, payload binary")


def read_archives(spark: SparkSession, manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of all archives a manifest names, one task per few files."""
    files = manifest.select("path", "folder")
    schema = SCHEMA if payloads else SCHEMA.removesuffix(", payload binary")
    names = [x.split()[0] for x in schema.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    kinds = [types[x.split()[1]] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, folder in zip(batch.column("path").to_pylist(), batch.column("folder").to_pylist()):
                fs, _ = pafs.FileSystem.from_uri(folder)
                rows, size = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for r in records(stream):
                        rows.append(r)
                        size += len(r["payload"] or b"") * payloads
                        if len(rows) >= 2000 or size >= 8 << 20:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([x[n] for x in rows], t) for n, t in zip(names, kinds)], names=names)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[n] for x in rows], t) for n, t in zip(names, kinds)], names=names)

    tasks = max(1, manifest.count())
    return files.repartition(tasks).mapInArrow(run, schema)
