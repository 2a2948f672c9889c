"""Block-gzipped text (.bgz): gzip members of at most 64 KB that name their size, so a file can be read from any block on.

A file is cut into byte ranges, one or more a task.  A range's lines are those that begin in its blocks after the first
line end there (from the start in a file's first range); its task reads on into the next range up to the first line end.
So every line is read once, wherever blocks and ranges cut it.  Files are reached through pyarrow.fs.
"""

from __future__ import annotations

import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the format: a member's first bytes up to its extra field, that field's head, the last (empty) member.
MAGIC = b"\x1f\x8b\x08\x04"
EXTRA = b"BC\x02\x00"
LAST = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
#: A block holds so much text, a task's range so many bytes, a batch about so much text.
TEXT, RANGE, BATCH = 65280, 32 << 20, 4 << 20


def place_of(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri) if ":" in uri else (pyarrow.fs.LocalFileSystem(), uri)


def block(text: bytes) -> bytes:
    packed = zlib.compressobj(6, zlib.DEFLATED, -15)
    data = packed.compress(text) + packed.flush()
    return MAGIC + b"\0\0\0\0\0\xff\x06\0" + EXTRA + struct.pack("<H", len(data) + 25) + data + struct.pack("<II", zlib.crc32(text), len(text))


def _size(head: bytes, at: int = 0) -> int:
    """The size of the block that begins there; 0 if none does."""
    if head[at : at + 4] != MAGIC or head[at + 10 : at + 12] != b"\x06\0" or head[at + 12 : at + 16] != EXTRA:
        return 0
    return struct.unpack_from("<H", head, at + 16)[0] + 1 if len(head) >= at + 18 else 0


def _first_block(source: pa.NativeFile, start: int, size: int) -> int:
    """The first place from start on where a block begins that another, or the file's end, follows."""
    window = source.read_at(min(3 << 16, size - start), start)
    at = window.find(MAGIC)
    while at >= 0:
        n = _size(window, at)
        if n and (start + at + n == size or _size(source.read_at(min(18, size - start - at - n), start + at + n))):
            return start + at
        at = window.find(MAGIC, at + 1)
    return size


def _texts(source: pa.NativeFile, at: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(place, text) of each block from `at` on; a plain gzip file is one block."""
    if not at and not _size(source.read_at(min(18, size), 0)):
        unpack = zlib.decompressobj(31)
        place = 0
        while place < size or unpack.unused_data:
            if unpack.eof:  # another member
                rest, unpack = unpack.unused_data, zlib.decompressobj(31)
                yield 0, unpack.decompress(rest)
                continue
            data = source.read_at(min(1 << 20, size - place), place)
            place += len(data)
            yield 0, unpack.decompress(data)
        return
    while at < size:
        n = _size(source.read_at(min(18, size - at), at))
        if not n:
            raise ValueError(f"no block begins at {at}")
        yield at, zlib.decompress(source.read_at(n, at), 31)
        at += n


def _lines(path: str, start: int, end: int) -> Iterator[list[bytes]]:
    files, place = place_of(path)
    with files.open_input_file(place) as source:
        size = source.size()
        at = _first_block(source, start, size) if start else 0
        if at >= end or not size:
            return
        held, skip, over = b"", start > 0, False
        for here, text in _texts(source, at, size):
            over = here >= end
            held += text
            if skip:
                cut = held.find(b"\n")
                if cut < 0:
                    if over:  # no line begins in this range
                        return
                    held = b""
                    continue
                if over:
                    return
                held, skip = held[cut + 1 :], False
            if over:
                cut = held.find(b"\n", len(held) - len(text))
                if cut >= 0:
                    yield held[:cut].split(b"\n")
                    return
            elif len(held) >= BATCH and (cut := held.rfind(b"\n")) >= 0:
                yield held[:cut].split(b"\n")
                held = held[cut + 1 :]
        if held and not skip:
            yield held.removesuffix(b"\n").split(b"\n")


def read_lines(spark: SparkSession, paths: str | list[str], range_bytes: int = RANGE) -> DataFrame:
    """path, start (of the range that the line begins in), line (its number there), value: the lines of .bgz files.

    path, start and line order a file's lines.  Line ends are \\n or \\r\\n.
    """
    files = spark.read.format("binaryFile").load(paths).select("path", "length").where("length > 0")
    ranges = files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("start"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                number = 0
                for lines in _lines(path, start, start + range_bytes):
                    n = len(lines)
                    text = pa.array([x.removesuffix(b"\r").decode(errors="replace") for x in lines], pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array([start] * n, pa.int64()), pa.array(range(number, number + n), pa.int64()), text], names=["path", "start", "line", "value"])
                    number += n

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(n, "path", "start").mapInArrow(read, "path string, start long, line long, value string")


def write_lines(lines: DataFrame, folder: str) -> DataFrame:
    """Write the column `value` as .bgz files, one a partition in its order, each with an index of its blocks (.gzi).

    Returns file, blocks, bytes.  Tasks write under names of their own; only files of the attempts that succeeded are moved
    to the folder, as part-<partition>.bgz.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = place_of(folder)
        name = posixpath.join(root, "_attempts", uuid.uuid4().hex)
        files.create_dir(posixpath.dirname(name), recursive=True)
        held, index, packed, plain = bytearray(), [], 0, 0
        with files.open_output_stream(name, compression=None) as out:

            def put(n: int) -> None:
                nonlocal packed, plain
                data = block(bytes(held[:n]))
                if packed:
                    index.append((packed, plain))
                out.write(data)
                packed, plain = packed + len(data), plain + n
                del held[:n]

            for batch in batches:
                for value in batch.column("value").to_pylist():
                    held += (value or "").encode() + b"\n"
                    while len(held) >= TEXT:
                        put(TEXT)
            if held:
                put(len(held))
            blocks = len(index) + (packed > 0)
            out.write(LAST)
        with files.open_output_stream(f"{name}.gzi", compression=None) as out:
            out.write(struct.pack("<Q", len(index)) + b"".join(struct.pack("<QQ", *x) for x in index))
        yield pa.RecordBatch.from_arrays([pa.array([name.rsplit("/", 1)[1]]), pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([blocks], pa.int64()), pa.array([packed + len(LAST)], pa.int64())], names=["name", "part", "blocks", "bytes"])

    done = lines.select("value").mapInArrow(write, "name string, part int, blocks long, bytes long").collect()  # a row a task
    files, root = place_of(folder)
    out = []
    for r in done:
        name = f"part-{r['part']:05d}.bgz"
        for end in ("", ".gzi"):
            files.move(posixpath.join(root, "_attempts", r["name"] + end), posixpath.join(root, name + end))
        out.append((f"{folder.rstrip('/')}/{name}", r["blocks"], r["bytes"]))
    if done:
        files.delete_dir(posixpath.join(root, "_attempts"))
    return lines.sparkSession.createDataFrame(out, "file string, blocks long, bytes long")
