"""``vcf_bgzf``: a Python data source that reads gzip-compressed text as lines, split where it can be.

BGZF is a series of independent gzip members ("blocks", at most 64 KiB each), so a file
can be split at any block start. Each input partition covers a byte range of one file:
it starts at the first block header at or after the range start and owns every line
that starts at or before the end of its range, reading into following blocks to finish
the last one; every partition except the file's first skips its first (partial or
complete) line, which belongs to the previous partition. This is the rule Hadoop uses
for splittable text, applied to decompressed block data.

Whether a file is BGZF is read off its first block header by the task, not off its name. A
plain gzip file does not split: its first partition streams the whole file, the others are
empty. Lines are handed out as Arrow batches of a bounded number of bytes.

Beside file and line there is a column ``contig`` (the line's first field, empty for header lines and those
without fields). A
predicate ``contig IN (...)`` is pushed into the reader: other lines are dropped as bytes, before they are
decoded and become Arrow data.

Files are opened through ``pyarrow.fs``, so local, HDFS and object-store paths work on
executors alike.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

DEFAULT_SPLIT_BYTES = 64 * 1024 * 1024
_MAGIC = b"\x1f\x8b\x08\x04"
HEADER_BYTES = 18 + 64
_SCHEMA = "file string, value string, contig string"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def _open(path: str):
    import pyarrow.fs as pafs

    if path.startswith("file:"):
        # Hadoop-qualified local path: file:/a/b or file:///a/b
        return pafs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if "://" in path:
        scheme, rest = path.split("://", 1)
        # Hadoop's S3 connector scheme names the same store pyarrow calls s3
        return pafs.FileSystem.from_uri(("s3" if scheme in ("s3a", "s3n") else scheme) + "://" + rest)
    return pafs.LocalFileSystem(), path


def _block_size(buf: bytes, off: int) -> int | None:
    """Total size of the BGZF block whose header starts at ``off``, or None if it is not one."""
    if buf[off : off + 4] != _MAGIC or off + 12 > len(buf):
        return None
    xlen = struct.unpack_from("<H", buf, off + 10)[0]
    p, end = off + 12, off + 12 + xlen
    if end > len(buf):
        return None
    while p + 4 <= end:
        si1, si2, slen = buf[p], buf[p + 1], struct.unpack_from("<H", buf, p + 2)[0]
        if si1 == 66 and si2 == 67 and slen == 2:
            return struct.unpack_from("<H", buf, p + 4)[0] + 1
        p += 4 + slen
    return None


def _inflate(block: bytes) -> bytes:
    xlen = struct.unpack_from("<H", block, 10)[0]
    return zlib.decompressobj(-15).decompress(block[12 + xlen : len(block) - 8])


@dataclass
class _Split(InputPartition):
    path: str
    start: int
    end: int
    size: int


class _BlockReader:
    """Sequential BGZF block reader from a byte offset."""

    def __init__(self, f, offset: int, size: int):
        self.f, self.offset, self.size = f, offset, size

    def seek_first_block(self, window: int = 1 << 17) -> None:
        # Find the first offset >= self.offset holding a valid block header followed by another
        # header (or the end of the file), to avoid matching the magic inside compressed data.
        pos = self.offset
        while pos < self.size:
            self.f.seek(pos)
            buf = self.f.read(min(window + (1 << 16) + 32, self.size - pos))
            i = 0
            while True:
                i = buf.find(_MAGIC, i)
                if i < 0 or i >= window:
                    break
                n = _block_size(buf, i)
                if n is not None and (pos + i + n == self.size or buf[i + n : i + n + 4] == _MAGIC):
                    self.offset = pos + i
                    return
                i += 1
            pos += window
        self.offset = self.size

    def next_block(self) -> tuple[int, bytes] | None:
        if self.offset >= self.size:
            return None
        self.f.seek(self.offset)
        head = self.f.read(HEADER_BYTES)
        n = _block_size(head, 0)
        if n is None:
            raise ValueError(f"corrupt BGZF block at offset {self.offset}")
        self.f.seek(self.offset)
        block = self.f.read(n)
        at = self.offset
        self.offset += n
        return at, _inflate(block)


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], split_bytes: int):
        self.paths, self.split_bytes = paths, split_bytes
        self.contigs: frozenset[bytes] | None = None

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, (In, EqualTo)) and f.attribute == ("contig",):
                wanted = {v.encode() for v in (f.value if isinstance(f, In) else (f.value,)) if v is not None}
                self.contigs = frozenset(wanted if self.contigs is None else self.contigs & wanted)
            else:
                yield f

    def partitions(self):
        out = []
        for path in self.paths:
            fs, p = _open(path)
            size = fs.get_file_info(p).size
            start = 0
            while True:
                end = min(start + self.split_bytes, size)
                out.append(_Split(path, start, end, size))
                if end >= size:
                    break
                start = end
        return out

    def read(self, partition: _Split):
        """Stream the split's lines as Arrow batches (bounded memory)."""
        fs, p = _open(partition.path)
        with fs.open_input_file(p) as f:
            out = _Batches(partition.path, self.contigs)
            if _block_size(f.read(HEADER_BYTES), 0) is None:
                if partition.start == 0:
                    yield from out.lines_of(_gzip_chunks(f))
                yield from out.flush()
                return
            r = _BlockReader(f, partition.start, partition.size)
            if partition.start > 0:
                r.seek_first_block()
            if r.offset >= partition.end:
                return
            yield from out.lines_of(_split_chunks(r, partition))
            yield from out.flush()


def _gzip_chunks(f, size: int = 1 << 20):
    """Decompressed pieces of a gzip file of any number of members."""
    f.seek(0)
    member = zlib.decompressobj(31)
    raw = f.read(size)
    while raw:
        while raw:
            yield member.decompress(raw)
            raw = member.unused_data
            if member.eof:
                member = zlib.decompressobj(31)
        raw = f.read(size)


def _split_chunks(r: _BlockReader, partition: _Split):
    """Decompressed pieces with exactly the lines that belong to a split."""
    skip_first = partition.start > 0  # the first line belongs to the previous split
    while r.offset < partition.end:  # blocks that start inside the range
        nb = r.next_block()
        if nb is None:
            return
        data = nb[1]
        if skip_first:
            cut = data.find(b"\n")
            if cut < 0:
                continue
            data, skip_first = data[cut + 1 :], False
        yield data
    # The line that starts at or before the end of the range is ours: finish it from the
    # following blocks (if no line started in the range, there is nothing to add).
    while not skip_first and r.offset < partition.size:
        nb = r.next_block()
        if nb is None:
            return
        cut = nb[1].find(b"\n")
        yield nb[1] if cut < 0 else nb[1][:cut]
        if cut >= 0:
            return


class _Batches:
    """Collects decoded lines and hands them out as Arrow record batches of about ``BYTES``."""

    BYTES = 16 << 20
    ROWS = 8192

    def __init__(self, path: str, contigs: frozenset[bytes] | None = None):
        self.path, self.contigs = path, contigs
        self.lines, self.names, self.held = [], [], 0

    def lines_of(self, chunks):
        """Batches of the lines in consecutive pieces of text; a last line may lack its end."""
        open_line: list[bytes] = []  # pieces of a line not finished yet, joined once
        for chunk in chunks:
            first, *rest = chunk.split(b"\n")
            open_line.append(first)
            if rest:
                yield from self.add([b"".join(open_line), *rest[:-1]])
                open_line = [rest[-1]]
        last = b"".join(open_line)
        if last:
            yield from self.add([last])

    def add(self, raw: list[bytes]):
        for line in raw:
            end = line.find(b"\t")
            contig = b"" if line[:1] == b"#" or end < 0 else line[:end]
            if self.contigs is not None and contig not in self.contigs:
                continue
            self.lines.append(line.rstrip(b"\r").decode("utf-8"))
            self.names.append(contig.decode("utf-8"))
            self.held += len(line)
            if self.held >= self.BYTES or len(self.lines) >= self.ROWS:
                yield from self.flush()

    def flush(self):
        if self.lines:
            import pyarrow as pa

            columns = [pa.array([self.path] * len(self.lines)), pa.array(self.lines), pa.array(self.names)]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "value", "contig"])
            self.lines, self.names, self.held = [], [], 0


class VcfBgzfDataSource(DataSource):
    """Options: ``paths`` (newline-separated) or ``path``; ``splitBytes`` (default 64 MiB)."""

    @classmethod
    def name(cls):
        return "vcf_bgzf"

    def schema(self):
        return _SCHEMA

    def reader(self, schema):
        raw = self.options.get("paths") or self.options.get("path") or ""
        paths = [p for p in raw.split("\n") if p]
        split = int(self.options.get("splitBytes", DEFAULT_SPLIT_BYTES))
        return _Reader(paths, split)


def register(spark: SparkSession) -> None:
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(VcfBgzfDataSource)


FEW_FILES = 32


def sniffed(files: DataFrame) -> list[tuple[str, int, bool]]:
    """(path, length, whether the first bytes are a BGZF block's header) of files (path, length), a row
    for each file as Spark's file index holds it too. Tasks open the files and read those bytes
    only; a few files are looked at on the driver, which is sooner done than a Python worker started."""
    spark = files.sparkSession
    some = files.limit(FEW_FILES + 1).collect()
    if len(some) > FEW_FILES:
        return [(r.path, r.length, r.bgzf) for r in _sniffed_in_tasks(files).toLocalIterator()]
    out = []
    for r in some:
        hp = spark._jvm.org.apache.hadoop.fs.Path(r.path)
        stream = hp.getFileSystem(spark._jsc.hadoopConfiguration()).open(hp)
        try:
            out.append((r.path, r.length, _block_size(bytes(stream.readNBytes(HEADER_BYTES)), 0) is not None))
        finally:
            stream.close()
    return out


def _sniffed_in_tasks(files: DataFrame) -> DataFrame:

    def look(batches):
        for batch in batches:
            found = []
            for path in batch["path"]:
                fs, p = _open(path)
                with fs.open_input_file(p) as f:
                    found.append(_block_size(f.read(HEADER_BYTES), 0) is not None)
            yield batch.assign(bgzf=found)

    return files.mapInPandas(look, "path string, length long, bgzf boolean")


def _bgzf_block(payload: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    data = packer.compress(payload) + packer.flush()
    head = _MAGIC + b"\0\0\0\0\0\xff" + struct.pack("<H", 6) + b"BC" + struct.pack("<HH", 2, len(data) + 25)
    return head + data + struct.pack("<II", zlib.crc32(payload), len(payload))


def write_bgzf_parts(lines: DataFrame, folder: str, block: int = 1 << 15) -> DataFrame:
    """Write (file, value) lines in file order (``in_file_order``) as one folder per file, of BGZF parts that
    are numbered in that order; gives the paths written. BGZF blocks can be joined, so every task packs
    the lines it has, and a file has as many parts as tasks. A part appears under its name only when it is whole; a task
    that runs again writes the same one."""

    def write(batches):
        import pandas as pd
        from pyspark import TaskContext

        context = TaskContext.get()
        fs, root = _open(folder)
        fs.create_dir(root)
        name, out, held, done = None, None, b"", []

        def close():
            if out is not None:
                out.write(_bgzf_block(held) + _bgzf_block(b"") if held else _bgzf_block(b""))
                out.close()
                part = f"{name}/part-{context.partitionId():05d}.bgz"
                fs.move(beside(), f"{root}/{part}")
                done.append(f"{folder}/{part}")

        def beside():
            return f"{root}/{name}/_part-{context.partitionId():05d}-{context.taskAttemptId()}"

        for batch in batches:
            for file, value in zip(batch["file"], batch["value"]):
                if file != name:
                    close()
                    name, held = file, b""
                    fs.create_dir(f"{root}/{name}")
                    out = fs.open_output_stream(beside(), compression=None)
                held += value.encode() + b"\n"
                while len(held) >= block:
                    out.write(_bgzf_block(held[:block]))
                    held = held[block:]
        close()
        yield pd.DataFrame({"path": done}, dtype=object)

    return lines.select("file", "value").mapInPandas(write, "path string")


NAME_FOLDERS = 64


def make_header_files(names: DataFrame, folder: str) -> DataFrame:
    """Create a file with a first header line for every ``name``; gives the names (for listings). They are dealt over
    ``NAME_FOLDERS`` folders in ``folder`` by a hash of the name: tasks that create files in one folder wait for each other."""

    def make(batches):
        fs, root = _open(folder)
        made = set()
        for batch in batches:
            for name, of in zip(batch["name"], batch["of"]):
                if of not in made:
                    fs.create_dir(f"{root}/{of}")
                    made.add(of)
                with fs.open_output_stream(f"{root}/{of}/{name}", compression=None) as f:
                    f.write(b"##fileformat=VCFv4.2\n")
            yield batch[["name"]]

    dealt = names.select("name", F.pmod(F.xxhash64("name"), F.lit(NAME_FOLDERS)).alias("of"))
    return dealt.repartition(NAME_FOLDERS, "of").mapInPandas(make, "name string")
