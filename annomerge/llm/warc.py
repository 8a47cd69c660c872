"""WARC archives: a writer of gzip-member records with revisits, and a reader that splits files by bytes.

Each record is one gzip member, as WARC prescribes. The reader cuts every archive into byte ranges; a task
looks for gzip magic in its range, decodes the start of each candidate member and accepts it only if a WARC
header comes out, and owns exactly the records that start inside the range. Whatever follows a good member is
tried first, so magic bytes inside compressed data are never taken for records.

Defined cases: a null payload is empty; a null id is kept (its record has no page number); equal payloads of
at least ``min_bytes`` bytes become one response, with the smallest id, and revisits of it; an empty table
gives no archive and reads back as no rows; extra input columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annomerge.llm.common import materialise

MAGIC = b"\x1f\x8b\x08"
RECORD = "<urn:annomerge:page:{}>"
DATE = "2024-01-01T00:00:00Z"
READ_SCHEMA = "page_id long, record_type string, refers_to long, target_uri string, payload_bytes long, payload_digest string, digest_ok boolean, payload binary, archive string, record_offset long"


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def header_lines(page_id, kind: str, uri: str | None, refers_to, digest: str, length: int, date: str) -> bytes:
    target = "".join(c if c > " " and c != "\x7f" else "%{:02X}".format(ord(c)) for c in uri or "about:blank")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {RECORD.format('none' if page_id is None else page_id)}", f"WARC-Date: {date}", f"WARC-Target-URI: {target}", "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha256:{digest}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {RECORD.format(refers_to)}"]
    return "\r\n".join([*lines, f"Content-Length: {length}", "", ""]).encode("utf-8", "surrogatepass")


def member(row: dict, level: int, date: str) -> bytes:
    """The gzip member of one page. A revisit keeps the HTTP head, which states the length, and leaves the body out."""
    payload = row["payload"] or b""
    kind = "response" if row["refers_to"] is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    head = header_lines(row["page_id"], kind, row["url"], row["refers_to"], row["digest"], len(block), date)
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(head + block + b"\r\n\r\n") + squeeze.flush()


def with_revisits(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """page_id, url, payload, digest, refers_to. Digests alone are grouped and joined: the first page of each payload comes
    from partial minima, and pages meet the list of revisits by digest and page, so a payload that a third of all pages
    share is spread like any other. Where that list is small pages are not shuffled at all."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.encode(F.col(html_col), "utf-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    keys = rows.where((F.octet_length("payload") >= min_bytes) & F.col("page_id").isNotNull()).select("digest", "page_id")
    first = materialise(keys.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last_id")).where("refers_to < last_id").drop("last_id"), "payloads")
    revisits = materialise(keys.join(first, "digest").where("page_id != refers_to").distinct(), "revisits")
    return rows.join(revisits, ["digest", "page_id"], "left").select("page_id", "url", "payload", "digest", "refers_to")


def write_warc(pages: DataFrame, uri: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 100, level: int = 1, date: str = DATE) -> DataFrame:
    """Write one archive per task under ``uri``; returns (archive, n_records, n_bytes), which must be consumed to write.

    A task writes under a name of its own attempt and renames it at the end, so a retry or a second attempt
    leaves one whole archive per partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, folder = open_fs(uri)
        store.create_dir(folder, recursive=True)
        name = f"{folder}/part-{context.partitionId():06d}.warc.gz"
        part = f"{folder}/_attempt-{context.taskAttemptId()}-{context.partitionId()}"
        n = size = 0
        sink = None
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for i in range(batch.num_rows):
                data = member({k: c[i].as_py() for k, c in zip(batch.schema.names, columns)}, level, date)
                sink = sink or store.open_output_stream(part)
                sink.write(data)
                n, size = n + 1, size + len(data)
        if sink:
            sink.close()
            store.move(part, name)
            yield pa.RecordBatch.from_pydict({"archive": [name], "n_records": [n], "n_bytes": [size]})

    return with_revisits(pages, id_col, url_col, html_col, min_bytes).mapInArrow(run, "archive string, n_records long, n_bytes long")


class RangeReader:
    """The records of one archive that start in [start, end)."""

    CHUNK = 1 << 18

    def __init__(self, source, start: int, end: int, size: int):
        self.source, self.start, self.end, self.size = source, start, end, size
        self.buffer, self.base = b"", start

    def at(self, offset: int, n: int) -> bytes:
        """n bytes from offset, fewer at the end of the file. Keeps one buffer, which moves forward."""
        if offset < self.base or offset + n > self.base + len(self.buffer):
            self.source.seek(offset)
            self.buffer, self.base = self.source.read(max(n, self.CHUNK)), offset
        return self.buffer[offset - self.base : offset - self.base + n]

    def header_at(self, offset: int) -> bool:
        """Whether a gzip member whose content begins with a WARC version line starts at offset."""
        data = self.at(offset, 4096)
        if not data.startswith(MAGIC):
            return False
        try:
            return zlib.decompressobj(31).decompress(data, 64).startswith(b"WARC/1.")
        except zlib.error:
            return False

    def whole(self, offset: int) -> tuple[bytes, int]:
        """Content of the member at offset, and the offset behind it. zlib checks its CRC and length."""
        inflate, out, at = zlib.decompressobj(31), [], offset
        while not inflate.eof:
            data = self.at(at, 1 << 16)
            if not data:
                raise EOFError(f"the member at {offset} ends early")
            out.append(inflate.decompress(data))
            at += len(data)
        return b"".join(out), at - len(inflate.unused_data)

    def next_magic(self, offset: int) -> int:
        """The first magic at or after offset and before the end, else the end."""
        while offset < self.end:
            data = self.at(offset, min(self.CHUNK, self.end - offset + len(MAGIC) - 1))
            found = data.find(MAGIC)
            if found >= 0:
                return offset + found
            offset += max(1, len(data) - len(MAGIC) + 1)
        return self.end

    def records(self) -> Iterator[tuple[int, bytes]]:
        at = self.start
        while at < min(self.end, self.size):
            if self.header_at(at):
                content, behind = self.whole(at)
                yield at, content
                at = behind
            else:
                at = self.next_magic(at + 1)


def parse_record(content: bytes) -> dict:
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        fields[key.strip().lower()] = value.strip().decode("utf-8", "replace")
    block = rest[: int(fields.get(b"content-length", len(rest)))]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), len(payload))
    number = lambda x: int(t) if (t := (x or "").rstrip(">").rpartition(":")[2]).lstrip("-").isdigit() else None
    kind, digest = fields.get(b"warc-type"), fields.get(b"warc-payload-digest", "").removeprefix("sha256:")
    whole = kind == "response"
    own = hashlib.sha256(payload).hexdigest() if whole else digest
    return {"page_id": number(fields.get(b"warc-record-id")), "record_type": kind, "refers_to": number(fields.get(b"warc-refers-to")), "target_uri": fields.get(b"warc-target-uri"), "payload_bytes": len(payload) if whole else stated, "payload_digest": own, "digest_ok": own == digest, "payload": payload if whole else None}


def read_warc(spark: SparkSession, uri: str, split_bytes: int = 32 << 20, with_payload: bool = True) -> DataFrame:
    """Rows of all ``*.warc.gz`` below ``uri``, read in ranges of ``split_bytes``; see READ_SCHEMA for the columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kind = _parse_datatype_string(READ_SCHEMA)
    arrow = to_arrow_schema(kind)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(uri).select("path", "length").where("length > 0")
    ranges = files.select("path", "length", F.explode(F.expr(f"sequence(0L, length - 1, {split_bytes}L)")).alias("start"))
    total = ranges.count()
    ranges = ranges.repartition(max(1, total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                store, path = open_fs(r["path"])
                with store.open_input_file(path) as source:
                    for offset, content in RangeReader(source, r["start"], r["start"] + split_bytes, r["length"]).records():
                        row = parse_record(content) | {"archive": r["path"], "record_offset": offset}
                        if not with_payload:
                            row["payload"] = None
                        out.append(row)
                        held += len(row["payload"] or b"")
                        if len(out) >= 5000 or held > 16 << 20:
                            yield pa.RecordBatch.from_pylist(out, arrow)
                            out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, arrow)

    return ranges.mapInArrow(run, kind)
