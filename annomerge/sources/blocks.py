"""Lines of gzip files that consist of blocks (BGZF), read in byte ranges by many tasks.

Such a file is a row of gzip members of at most 64 KB, each of which states its size in its header. A task looks for the
first block that starts in its range, checks it by its header, by its checksum and by the header behind it, and then
goes from block to block. The line that a range begins in or with, unless it is a file's first, belongs to the range before,
which reads on to the end of that line; so each block is also reached by sizes alone, and a broken one is an error wherever the
file was cut. A gzip file without block sizes is one range.

Every line has a place, ``at``: its block's offset and its own within the block, one number that orders the lines of a file and
does not depend on how the file was cut. Lines end with a line feed, with or without a carriage return before it.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: A gzip member with extra fields.
MAGIC = b"\x1f\x8b\x08\x04"
#: The empty block that ends a file.
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
LINES = pa.schema([("file", pa.string()), ("at", pa.int64()), ("line", pa.string())])
BATCH_BYTES = 4 << 20
#: The most ranges that splits below ``SPLIT_BYTES`` are cut into. A range is a task with a Python process, which small ones do not pay for.
RANGES, SPLIT_BYTES = 256, 64 << 20


def range_bytes(total: int, split: int) -> int:
    """The size of ranges: ``split``, more where that would give more than ``RANGES``, but then at most ``SPLIT_BYTES``."""
    return max(split, min(SPLIT_BYTES, -(-total // RANGES)))


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def block_size(head: bytes) -> int | None:
    """The size that a block's header states, None if these bytes are no such header."""
    if not head.startswith(MAGIC) or len(head) < 12:
        return None
    at, end = 12, 12 + int.from_bytes(head[10:12], "little")
    while at + 4 <= min(end, len(head)):
        length = int.from_bytes(head[at + 2 : at + 4], "little")
        if head[at : at + 2] == b"BC" and length == 2 and at + 6 <= len(head):
            return int.from_bytes(head[at + 4 : at + 6], "little") + 1
        at += 4 + length
    return None


class Blocks:
    """A file's bytes by offset, through one buffer that moves forward, and its blocks."""

    CHUNK, HEAD = 1 << 20, 1 << 9

    def __init__(self, source, size: int):
        self.source, self.size, self.buffer, self.base = source, size, b"", 0

    def bytes_at(self, offset: int, n: int) -> bytes:
        if offset < self.base or offset + n > self.base + len(self.buffer):
            self.source.seek(offset)
            self.buffer, self.base = self.source.read(max(n, self.CHUNK)), offset
        return self.buffer[offset - self.base : offset - self.base + n]

    def content(self, offset: int) -> tuple[bytes, int]:
        """What the block at offset holds, and the offset behind it."""
        size = block_size(self.bytes_at(offset, self.HEAD))
        if size is None:
            raise ValueError(f"no block starts at {offset}")
        inflate = zlib.decompressobj(31)
        out = inflate.decompress(self.bytes_at(offset, size))
        if not inflate.eof or inflate.unused_data:
            raise ValueError(f"the block at {offset} is broken")
        return out, offset + size

    def starts_block(self, offset: int) -> bool:
        """Whether a whole block is here, with another one or the end of the file behind it."""
        size = block_size(self.bytes_at(offset, self.HEAD))
        if size is None or offset + size > self.size:
            return False
        if offset + size < self.size and block_size(self.bytes_at(offset + size, self.HEAD)) is None:
            return False
        try:
            self.content(offset)
        except (ValueError, zlib.error):
            return False
        return True

    def first_block(self, start: int, end: int) -> int:
        """Where the first block of [start, end) starts; ``end`` if none does."""
        while start < end:
            data = self.bytes_at(start, min(self.CHUNK, end - start + len(MAGIC) - 1))
            found = data.find(MAGIC)
            if found < 0:
                start += max(1, len(data) - len(MAGIC) + 1)
            elif start + found < end and self.starts_block(start + found):
                return start + found
            else:
                start += found + 1
        return end

    def lines(self, start: int, end: int) -> Iterator[tuple[int, bytes]]:
        """(place, line) of the lines that belong to [start, end)."""
        at = self.first_block(start, end) if start else 0
        if at >= end:
            return
        rest, rest_at, ours = b"", at << 16, not start
        while at < self.size:
            content, behind = self.content(at)
            parts, first = content.split(b"\n"), at << 16
            if len(parts) == 1:
                rest += content
            else:
                if ours:
                    yield rest_at, rest + parts[0]
                    if at >= end:
                        return
                elif at >= end:
                    return  # the line that was begun before this range ends behind it
                ours = True
                begins = first + len(parts[0]) + 1
                for part in parts[1:-1]:
                    yield begins, part
                    begins += len(part) + 1
                rest, rest_at = parts[-1], begins
            at = behind
            if at >= end and not ours:
                return
        if ours and rest:
            yield rest_at, rest


def plain_lines(source) -> Iterator[tuple[int, bytes]]:
    """(place, line) of a gzip file of any kind, place being that in the text."""
    inflate, rest, at = zlib.decompressobj(31), b"", 0
    source.seek(0)
    while data := source.read(1 << 20):
        while data:
            parts = (rest + inflate.decompress(data)).split(b"\n")
            for part in parts[:-1]:
                yield at, part
                at += len(part) + 1
            rest, data = parts[-1], b""
            if inflate.eof:
                data, inflate = inflate.unused_data, zlib.decompressobj(31)
    if rest:
        yield at, rest


@dataclass
class Range(InputPartition):
    path: str
    size: int
    start: int
    end: int
    blocks: bool
    header: int  # the place of the header line, -1 without one


def lines_of(source, part: Range) -> Iterator[tuple[int, bytes]]:
    return Blocks(source, part.size).lines(part.start, part.end) if part.blocks else plain_lines(source)


class LineReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.split = options["path"], int(options.get("split_bytes", SPLIT_BYTES))
        self.header, self.comment = options.get("header") == "true", options.get("comment", "")

    def files(self) -> list[tuple[str, int]]:
        store, path = open_fs(self.path)
        if store.get_file_info(path).type == pafs.FileType.File:
            return [(self.path, store.get_file_info(path).size)]
        found = store.get_file_info(pafs.FileSelector(path, recursive=True))
        top = self.path.rstrip("/")
        return sorted((top + f.path[len(path.rstrip("/")) :], f.size) for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "._" and f.size)

    def partitions(self) -> list[Range]:
        """Ranges of all files. Of each file the first bytes are read here: whether it has blocks, and where its header is."""
        out, files = [], self.files()
        step = range_bytes(sum(size for _, size in files), self.split)
        for name, size in files:
            store, path = open_fs(name)
            with store.open_input_file(path) as source:
                blocks = block_size(source.read_at(Blocks.HEAD, 0)) is not None
                whole = Range(name, size, 0, size, blocks, -1)
                if self.header:
                    comment = self.comment.encode()
                    whole.header = next((at for at, line in lines_of(source, whole) if not (comment and line.startswith(comment))), -1)
            cuts = range(0, size, step) if blocks else (0,)
            out += [Range(name, size, c, min(size, c + step) if blocks else size, blocks, whole.header) for c in cuts]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        store, path = open_fs(partition.path)
        comment = self.comment.encode()
        with store.open_input_file(path) as source:
            kept = ((at, line) for at, line in lines_of(source, partition) if at > partition.header and not (comment and line.startswith(comment)))
            places, lines, held = [], [], 0
            for at, line in kept:
                places.append(at)
                lines.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
                held += len(line)
                if held > BATCH_BYTES:
                    yield self.batch(partition, places, lines)
                    places, lines, held = [], [], 0
            if places:
                yield self.batch(partition, places, lines)

    def batch(self, partition: Range, places: list[int], lines: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([partition.path] * len(places), pa.string()), pa.array(places, pa.int64()), pa.array(lines, pa.string())], schema=LINES)


class BlockLines(DataSource):
    """``path``, a file or folder; ``split_bytes``, the least size of a range; ``comment``, how lines to leave out begin; ``header``, whether each file's first
    other line is one."""

    @classmethod
    def name(cls) -> str:
        return "block_lines"

    def schema(self) -> str:
        return "file string, at long, line string"

    def reader(self, schema) -> LineReader:
        return LineReader(dict(self.options))


def read_lines(spark: SparkSession, path: str, split_bytes: int, comment: str = "", header: bool = False) -> DataFrame:
    spark.dataSource.register(BlockLines)
    return spark.read.format("block_lines").options(path=path, split_bytes=str(split_bytes), comment=comment, header=str(header).lower()).load()


def read_fields(spark: SparkSession, path: str, schema: str, sep: str, split_bytes: int, comment: str = "", header: bool = False, **options: str) -> DataFrame:
    """The lines' fields by ``schema``, as Spark's CSV reader parses them, and ``ord``, their order."""
    lines = read_lines(spark, path, split_bytes, comment, header).where(F.col("line").rlike(r"[^\x00-\x20]"))
    return lines.select(F.from_csv("line", schema, {"sep": sep, **options}).alias("fields"), F.struct("file", "at").alias("ord")).select("fields.*", "ord")


def write_blocks(lines: DataFrame, path: str, line_col: str = "line", head: tuple = (), level: int = 6) -> DataFrame:
    """One block-gzip file per task, in the order that rows stand in, each with the lines ``head`` first. Returns (file, n_lines),
    which must be consumed to write. A task writes under a name of its own and renames it at the end."""

    def block(data: bytes) -> bytes:
        squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
        body = squeeze.compress(data) + squeeze.flush()
        return END[:16] + (len(body) + 25).to_bytes(2, "little") + body + zlib.crc32(data).to_bytes(4, "little") + len(data).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, folder = open_fs(path)
        store.create_dir(folder, recursive=True)
        part, name = f"{folder}/_attempt-{context.taskAttemptId()}", f"{folder}/part-{context.partitionId():06d}.gz"
        with store.open_output_stream(part) as sink:
            n, held = 0, b"".join(f"{x}\n".encode() for x in head)
            for x in itertools.chain.from_iterable(b.column(0).to_pylist() for b in batches):
                held += f"{x or ''}\n".encode()
                n += 1
                while len(held) > 60_000:
                    sink.write(block(held[:60_000]))
                    held = held[60_000:]
            sink.write((block(held) if held else b"") + END)
        store.move(part, name)
        yield pa.RecordBatch.from_pydict({"file": [name], "n_lines": [n]})

    return lines.select(line_col).mapInArrow(run, "file string, n_lines long")
