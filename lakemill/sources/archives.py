"""ZIP archives and xz streams as data sources that tasks share: a task reads a range of an archive's entries, or of a
stream's blocks, never a whole archive. Both can be written too, by all tasks at once, and appear only when all of them
are done.

Paths are those of pyarrow's file systems (local, file://, hdfs://, s3://, gs://), opened by the tasks themselves.
"""

from __future__ import annotations

import lzma
import posixpath
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from lakemill.session import ship, small_batches

#: What a task reads at least, in compressed bytes, unless the option partition_bytes says otherwise.
PARTITION_BYTES = 16 << 20

#: What a batch of rows holds at most, in bytes and rows.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 1000

#: What a file that is written holds at most, in entries, and how many archives a task writes side by side.
FILE_ENTRIES, OPEN_ARCHIVES = 16_384, 8


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path there."""
    return fs.FileSystem.from_uri(path)


def files_below(path: str, suffix: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files below a folder, or of the file itself; names that begin with "_" or "." are skipped."""
    system, at = opened(path)
    info = system.get_file_info(at)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(at, recursive=True))
    own = [f for f in found if f.type == fs.FileType.File and f.path.endswith(suffix)]
    return sorted((f.path, f.size) for f in own if not re.search(r"(^|/)[_.]", f.path[len(at) :] if f is not info else ""))


def batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, (bytes, str)))
        if size >= BATCH_BYTES or len(held) >= BATCH_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


# ---------------------------------------------------------------- writing

@dataclass
class Written(WriterCommitMessage):
    """The files that a task has staged."""

    names: list[str]


class StagedWriter(DataSourceArrowWriter):
    """Tasks write into a hidden folder of the job; only what the tasks that count have named becomes visible."""

    suffix = ""

    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path, self.overwrite, self.job = options["path"], overwrite, uuid4().hex
        self.bytes = int(options.get("block_bytes", PARTITION_BYTES))

    def staged(self, name: str = "part") -> str:
        """The name of a file of this task; every attempt has its own."""
        task = TaskContext.get()
        return f"{name}-{task.partitionId() if task else 0:05d}-{uuid4().hex[:12]}{self.suffix}"

    def folder(self) -> tuple[fs.FileSystem, str, str]:
        system, at = opened(self.path)
        return system, at, posixpath.join(at, f"_staging-{self.job}")

    def commit(self, messages: list[Written | None]) -> None:
        system, at, staging = self.folder()
        before = files_below(self.path, self.suffix) if self.overwrite and system.get_file_info(at).type == fs.FileType.Directory else []
        system.create_dir(at, recursive=True)
        for name in (n for m in messages if m for n in m.names):
            system.move(posixpath.join(staging, name), posixpath.join(at, name))
        for old, _ in before:
            system.delete_file(old)
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        system, _, staging = self.folder()
        if system.get_file_info(staging).type == fs.FileType.Directory:
            system.delete_dir(staging)


# ---------------------------------------------------------------- ZIP

ENTRIES = pa.schema([("archive", pa.string()), ("entry", pa.string()), ("content", pa.binary()), ("error", pa.string())])


def count_of_entries(file: pa.NativeFile, size: int) -> int:
    """How many entries an archive has, from the record at its end."""
    file.seek(max(0, size - 65_557))
    tail = file.read()
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise zipfile.BadZipFile("no end record")
    n = int.from_bytes(tail[at + 10 : at + 12], "little")
    if n == 0xFFFF:  # more than the record can say
        with zipfile.ZipFile(file) as archive:
            n = len(archive.infolist())
    return n


@dataclass
class Range(InputPartition):
    """A part of a file: its entries or blocks from start to stop; error tells why there are none."""

    file: str
    start: int
    stop: int
    error: str | None = None


class ZipReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.suffix = options["path"], options.get("entry_suffix", ".json")
        self.prefix, self.names_only = options.get("entry_prefix", ""), options.get("names_only", "false") == "true"
        self.bytes = int(options.get("partition_bytes", PARTITION_BYTES))

    def partitions(self) -> list[Range]:
        """Ranges of entries of about as many bytes; only the end of an archive is read for it."""
        system, _ = opened(self.path)
        found: list[Range] = []
        for file, size in files_below(self.path, ".zip"):
            try:
                with system.open_input_file(file) as f:
                    n = count_of_entries(f, size)
            except (zipfile.BadZipFile, OSError) as e:
                found.append(Range(file, 0, 0, str(e)))
                continue
            # Parts of equal size: a file of little more than one part is not read twice for the rest.
            step = max(1, n) if self.names_only else max(1, -(-n // max(1, round(size / self.bytes))))
            found += [Range(file, k, min(k + step, n)) for k in range(0, n, step)]
        return found or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        yield from batches(self.rows(partition), ENTRIES)

    def rows(self, part: Range) -> Iterator[tuple]:
        if part.error:
            yield part.file, None, None, part.error
        if part.start == part.stop:
            return
        system, _ = opened(self.path)
        try:
            with system.open_input_file(part.file) as f, zipfile.ZipFile(f) as archive:
                for entry in archive.infolist()[part.start : part.stop]:
                    if entry.filename.startswith(self.prefix) and entry.filename.endswith(self.suffix):
                        yield (part.file, *((entry.filename, None, None) if self.names_only else entry_of(archive, entry.filename)))
        except (zipfile.BadZipFile, OSError) as e:
            yield part.file, None, None, str(e)


def entry_of(archive: zipfile.ZipFile, name: str) -> tuple[str, bytes | None, str | None]:
    """(name, content, error) of an entry; one that cannot be read does not end the rest."""
    try:
        content = plain_content(archive, archive.getinfo(name))
        return name, archive.read(name) if content is None else content, None
    except (zipfile.BadZipFile, OSError, KeyError, NotImplementedError, EOFError, RuntimeError, ValueError, lzma.LZMAError, zlib.error) as e:
        return name, None, str(e)


def plain_content(archive: zipfile.ZipFile, info: zipfile.ZipInfo) -> bytes | None:
    """The content of an entry that is deflated and whole, in one read; None for what zipfile has to look at. It opens a
    stream for each entry, which takes longer than what small entries hold."""
    if info.compress_type != zipfile.ZIP_DEFLATED or info.flag_bits & ~(0x800 | 0x8 | 0x6):
        return None
    name = info.orig_filename.encode("utf-8" if info.flag_bits & 0x800 else "cp437")
    archive.fp.seek(info.header_offset)
    raw = archive.fp.read(30 + len(name) + info.compress_size + 64)  # with what may stand between them
    at = 30 + len(name) + int.from_bytes(raw[28:30], "little")
    if raw[:4] != b"PK\x03\x04" or raw[30 : 30 + len(name)] != name or int.from_bytes(raw[26:28], "little") != len(name) or len(raw) < at + info.compress_size:
        return None
    try:
        content = zlib.decompress(memoryview(raw)[at : at + info.compress_size], -15)
    except zlib.error:
        return None
    return content if len(content) == info.file_size and zlib.crc32(content) == info.CRC else None


class Archive:
    """A ZIP file of less than 65,536 entries and 4 GB as it is written, entry after entry. zipfile opens a stream for
    each entry and writes it in several small parts."""

    def __init__(self, stream: pa.NativeFile) -> None:
        self.stream, self.held, self.directory, self.size = stream, bytearray(), [], 0

    def add(self, name: str, content: bytes) -> None:
        packer, own = zlib.compressobj(-1, zlib.DEFLATED, -15), name.encode("utf-8", "surrogatepass")
        data = packer.compress(content) + packer.flush()
        # Version, names in UTF-8, deflated, the first of January 1980, what the entry holds.
        about = struct.pack("<HHHHHLLLHH", 20, 0x800, zipfile.ZIP_DEFLATED, 0, 0x21, zlib.crc32(content), len(data), len(content), len(own), 0)
        self.directory.append(b"".join((b"PK\x01\x02\x14\x00", about, struct.pack("<HHHLL", 0, 0, 0, 0o600 << 16, self.size), own)))
        for part in (b"PK\x03\x04", about, own, data):
            self.held += part
            self.size += len(part)
        if len(self.held) >= 1 << 20:
            self.flush()

    def flush(self) -> None:
        self.stream.write(bytes(self.held))
        self.held = bytearray()

    def close(self) -> None:
        directory, n = b"".join(self.directory), len(self.directory)
        self.held += directory + b"PK\x05\x06" + struct.pack("<HHHHLLH", 0, 0, n, n, len(directory), self.size, 0)
        self.flush()
        self.stream.close()


class ZipWriter(StagedWriter):
    """Rows of (archive, entry, content), in any order: each task writes its own part of every archive that it has rows of,
    so an archive of many rows is several files, {archive}-{task}-{attempt}.zip.

    A file ends at block_bytes or FILE_ENTRIES: whoever reads a range of entries needs the file's whole directory, so
    that directories which grew with the input would make ranges times entries. Of more than OPEN_ARCHIVES archives at
    once the one that was written to least lately ends its file.
    """

    suffix = ".zip"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, _, staging = self.folder()
        system.create_dir(staging, recursive=True)
        names: list[str] = []
        held: dict[str | None, Archive] = {}
        most = min(self.bytes, 1 << 31)

        def end(archive: str | None) -> None:
            held.pop(archive).close()

        try:
            for batch in iterator:
                for archive, entry, content in zip(*(batch[c].to_pylist() for c in ("archive", "entry", "content")), strict=True):
                    if archive in held:
                        out = held[archive] = held.pop(archive)
                    else:
                        if len(held) == OPEN_ARCHIVES:
                            end(next(iter(held)))
                        names.append(self.staged(re.sub(r"[^\w.-]", "_", archive or "none")))
                        out = held[archive] = Archive(system.open_output_stream(posixpath.join(staging, names[-1])))
                    out.add(entry, content if content is not None else b"")
                    if out.size >= most or len(out.directory) >= FILE_ENTRIES:
                        end(archive)
        finally:
            for archive in list(held):
                end(archive)
        return Written(names)


class Zip(DataSource):
    """spark.read.format("lakemill_zip").load(path): (archive, entry, content, error), error for what cannot be read.

    Options: entry_prefix, entry_suffix (".json"), names_only (contents are not read), partition_bytes.
    """

    @classmethod
    def name(cls) -> str:
        return "lakemill_zip"

    def schema(self) -> str:
        return "archive string, entry string, content binary, error string"

    def reader(self, schema: StructType) -> ZipReader:
        return ZipReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> ZipWriter:
        return ZipWriter(dict(self.options), overwrite)


# ---------------------------------------------------------------- xz

LINES = pa.schema([("file", pa.string()), ("line", pa.string())])
_HEADER, _FOOTER = 12, 12


def _number(data: bytes, at: int) -> tuple[int, int]:
    """A number of seven bits a byte, and where it ends."""
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def xz_blocks(file: pa.NativeFile, size: int) -> list[tuple[int, int, int]]:
    """(start of the stream, start of the block, bytes of the block) of all blocks, from the indexes at the streams'
    ends; the streams themselves are not read."""
    found: list[tuple[int, int, int]] = []
    end = size
    while end > 0:
        file.seek(end - 4)
        if file.read(4) == bytes(4):  # padding between streams
            end -= 4
            continue
        file.seek(end - _FOOTER)
        footer = file.read(_FOOTER)
        if footer[-2:] != b"YZ":
            raise lzma.LZMAError("no stream footer")
        index_bytes = (int.from_bytes(footer[4:8], "little") + 1) * 4
        file.seek(end - _FOOTER - index_bytes)
        index = file.read(index_bytes)
        n, at = _number(index, 1)
        sizes = []
        for _ in range(n):
            own, at = _number(index, at)
            _, at = _number(index, at)
            sizes.append((own + 3) // 4 * 4)
        stream = end - _FOOTER - index_bytes - sum(sizes) - _HEADER
        places, block = [], stream + _HEADER
        for own in sizes:
            places.append((stream, block, own))
            block += own
        found, end = places + found, stream
    return found


class XzReader(DataSourceReader):
    """Lines of xz files. A line belongs to the part in which it begins, so each part but the first leaves out what comes
    before its first line end, and reads on until its last line is whole."""

    def __init__(self, options: dict) -> None:
        self.path, self.suffix, self.bytes = options["path"], options.get("suffix", ".xz"), int(options.get("partition_bytes", PARTITION_BYTES))

    def partitions(self) -> list[Range]:
        system, _ = opened(self.path)
        found: list[Range] = []
        for file, size in files_below(self.path, self.suffix):
            try:
                with system.open_input_file(file) as f:
                    blocks = xz_blocks(f, size)
            except (lzma.LZMAError, IndexError, OSError):
                found.append(Range(file, 0, -1))  # the older format, which has no index: one part
                continue
            start = held = 0
            for k, (_, _, own) in enumerate(blocks):
                held += own
                if held >= self.bytes or k + 1 == len(blocks):
                    found.append(Range(file, start, k + 1))
                    start, held = k + 1, 0
        return found or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if partition.file:
            yield from batches(((partition.file, line.decode("utf-8", "replace")) for line in self.lines(partition)), LINES)

    def chunks(self, file: pa.NativeFile, size: int, start: int) -> Iterator[tuple[int, bytes]]:
        """(block, bytes) from a block on, in pieces of bounded size."""
        header, stream_of = b"", -1
        for k, (stream, block, own) in enumerate(xz_blocks(file, size)):
            if k < start:
                continue
            if stream != stream_of:
                file.seek(stream)
                header, stream_of = file.read(_HEADER), stream
            plain = lzma.LZMADecompressor(lzma.FORMAT_XZ)
            plain.decompress(header)
            file.seek(block)
            packed = file.read(own)
            while True:
                data = plain.decompress(packed, 1 << 20)
                if not data:
                    break
                packed = b""
                yield k, data

    def whole(self, file: pa.NativeFile) -> Iterator[tuple[int, bytes]]:
        with lzma.open(file) as plain:
            while data := plain.read(1 << 20):
                yield 0, data

    def lines(self, part: Range) -> Iterator[bytes]:
        system, _ = opened(self.path)
        with system.open_input_file(part.file) as f:
            chunks = self.whole(f) if part.stop < 0 else self.chunks(f, f.size(), max(0, part.start - 1))
            rest, begun, last = b"", part.start == 0, part.stop - 1 if part.stop >= 0 else 0
            ended_before = True  # whether the block before ends with a line end
            for k, data in chunks:
                if k < part.start:
                    ended_before = data.endswith(b"\n")
                    continue
                if not begun:
                    begun = True
                    if not ended_before:
                        rest = None  # in the middle of a line of the part before
                if k > last and (rest is None or not rest):
                    break
                head, *tail = data.split(b"\n")
                if not tail:
                    rest = None if rest is None else rest + head
                    continue
                if rest is not None:
                    yield from (x for x in [rest + head] if x.strip())
                if k > last:
                    rest = b""
                    break
                yield from (x for x in tail[:-1] if x.strip())
                rest = tail[-1]
            if rest and rest.strip():
                yield rest


class XzWriter(StagedWriter):
    """Rows of (line) as xz files, a stream for each block_bytes of lines, so that readers can share a file."""

    suffix = ".xz"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, _, staging = self.folder()
        system.create_dir(staging, recursive=True)
        name = self.staged()
        with system.open_output_stream(posixpath.join(staging, name)) as out:
            held = bytearray()
            for batch in iterator:
                for line in batch["line"].to_pylist():
                    held += (line or "").encode("utf-8", "surrogatepass") + b"\n"
                    if len(held) >= self.bytes:
                        out.write(lzma.compress(bytes(held), preset=1))
                        held = bytearray()
            out.write(lzma.compress(bytes(held), preset=1))
        return Written([name])


class Xz(DataSource):
    """spark.read.format("lakemill_xz").load(path): (file, line); lines without a sign are left out."""

    @classmethod
    def name(cls) -> str:
        return "lakemill_xz"

    def schema(self) -> str:
        return "file string, line string"

    def reader(self, schema: StructType) -> XzReader:
        return XzReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> XzWriter:
        return XzWriter(dict(self.options), overwrite)


# ---------------------------------------------------------------- one file for each document

class FilesWriter(StagedWriter):
    """Rows of (name, content), each a file. A file is written beside its place and then moved there, so that it is there
    whole or not at all; names may have folders. What a task that failed has moved is whole too and is replaced by the
    next attempt."""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, at, _ = self.folder()
        made: set[str] = set()
        for batch in iterator:
            for name, content in zip(batch["name"].to_pylist(), batch["content"].to_pylist(), strict=True):
                target = posixpath.join(at, name)
                folder = posixpath.dirname(target)
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                draft = posixpath.join(folder, f".{posixpath.basename(name)}.{uuid4().hex}.draft")
                with system.open_output_stream(draft) as out:
                    out.write(content or b"")
                system.move(draft, target)
        return Written([])


class Files(DataSource):
    """df.write.format("lakemill_files").save(path) for rows of (name, content); Spark's own sources read them."""

    @classmethod
    def name(cls) -> str:
        return "lakemill_files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema: StructType, overwrite: bool) -> FilesWriter:
        return FilesWriter(dict(self.options), overwrite)


# ---------------------------------------------------------------- for callers

def register(spark: SparkSession) -> None:
    """Make the sources known to a session, and the package to its workers; entries may be large, so batches are small."""
    ship(spark)
    small_batches(spark)
    for source in (Zip, Xz, Files):
        spark.dataSource.register(source)


def zip_entries(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(archive, entry, content, error) of the archives below path; see Zip for the options."""
    register(spark)
    return spark.read.format("lakemill_zip").options(**options).load(path)


def xz_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(file, line) of the xz files below path."""
    register(spark)
    return spark.read.format("lakemill_xz").options(**options).load(path)


def contents_of(entries: DataFrame, path: str) -> DataFrame:
    """(archive, entry, content, error) of entries(archive, entry), which are read and no others.

    For lists of names_only that a query has narrowed. Entries are dealt by archive and name, so that a large archive is
    shared by several tasks and a task opens few archives. Their number follows the bytes of the archives and is told, as
    adaptive execution would deal names by their own few bytes, all of them to one task.
    """
    context = entries.sparkSession.sparkContext
    parts = max(context.defaultParallelism, -(-sum(size for _, size in files_below(path, ".zip")) // PARTITION_BYTES))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = opened(path)

        def read() -> Iterator[tuple]:
            now = archive = None
            for batch in rows:
                for name, entry in zip(batch["archive"].to_pylist(), batch["entry"].to_pylist(), strict=True):
                    if name != now:
                        if archive:
                            archive.close()
                        now, archive = name, zipfile.ZipFile(system.open_input_file(name))
                    yield (name, *entry_of(archive, entry))

        yield from batches(read(), ENTRIES)

    dealt = entries.select("archive", "entry").repartitionByRange(parts, "archive", "entry").sortWithinPartitions("archive", "entry")
    return dealt.mapInArrow(run, "archive string, entry string, content binary, error string")
