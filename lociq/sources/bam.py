"""BAM files as a Spark data source.

A BAM file is a chain of gzip members (blocks) of at most 64 KB each, whose header says how long it is. A file is cut into ranges of bytes, each a
partition. A range owns the records whose first byte lies in a block that begins in it: its task finds the first block (by its magic, length and checksum),
then the first record (by fields that fit, for several records on end), and reads on past the range's end to finish the last record. The header is read
in each task. A file must end with the closing empty block, else it was cut off and raises.

Use with spark.dataSource.register(BamSource). Options: split_bytes (64 MiB); push_filters=true, where
spark.sql.python.filterPushdown.enabled is set, to drop records by chrom and flag before they are decoded.
"""
from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from itertools import islice

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from . import schemas

#: Reference-consuming operations, by BAM's operation numbers (MIDNSHP=X), and sizes of tag values.
CONSUMES = {0, 2, 3, 7, 8}
SIZES = {b"A": 1, b"c": 1, b"C": 1, b"s": 2, b"S": 2, b"i": 4, b"I": 4, b"f": 4}
FORMATS = {b"c": "<b", b"C": "<B", b"s": "<h", b"S": "<H", b"i": "<i", b"I": "<I"}
#: Fixed value: the closing block.
CLOSING = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
#: Fixed value: how a block begins. Largest block; records that must fit on end before a place counts as a record's start.
MAGIC, BLOCK, ON_END = b"\x1f\x8b\x08\x04", 1 << 16, 8


class CutOff(ValueError):
    """The file ends before its end."""


def block_length(raw: bytes, at: int = 0) -> int:
    """Bytes of the block whose header begins at a place; 0 if none does."""
    if raw[at : at + 4] != MAGIC or len(raw) < at + 18:
        return 0
    sub, end = at + 12, at + 12 + struct.unpack_from("<H", raw, at + 10)[0]
    while sub + 6 <= min(end, len(raw)):
        name, size = raw[sub : sub + 2], struct.unpack_from("<H", raw, sub + 2)[0]
        if name == b"BC" and size == 2:
            return struct.unpack_from("<H", raw, sub + 4)[0] + 1
        sub += 4 + size
    return 0


def unpacked(block: bytes) -> bytes | None:
    """A whole block's bytes; None if it isn't one."""
    try:
        d = zlib.decompressobj(31)
        out = d.decompress(block)  # checks length and checksum at its end
        return out if d.eof and not d.unused_data else None
    except zlib.error:
        return None


class Blocks:
    """Blocks of an open file from a place on, as one run of bytes that can be taken or looked at; each byte's block is known."""

    def __init__(self, f, size: int, at: int) -> None:
        self.f, self.size, self.next, self.raw, self.raw_at = f, size, at, b"", at
        self.buffer, self.marks = bytearray(), []  # (place in the buffer, block's place in the file)

    def more(self) -> bool:
        """Unpack the next block."""
        if self.next >= self.size:
            return False
        at = self.next - self.raw_at
        if at + BLOCK + 32 > len(self.raw) and self.raw_at + len(self.raw) < self.size:
            self.f.seek(self.next)
            self.raw, self.raw_at, at = self.f.read(16 * BLOCK), self.next, 0
        n = block_length(self.raw, at)
        data = unpacked(self.raw[at : at + n]) if n and at + n <= len(self.raw) else None
        if data is None:
            raise CutOff(f"no whole block at byte {self.next} of a BAM file")
        if data:
            self.marks.append((len(self.buffer), self.next))
            self.buffer += data
        self.next += n
        return True

    def need(self, n: int) -> bool:
        while len(self.buffer) < n:
            if not self.more():
                return False
        return True

    def block(self) -> int:
        """Place in the file of the block that holds the next byte; past the file's end there is none."""
        return self.marks[0][1] if self.need(1) else self.size

    def take(self, n: int) -> bytes:
        if not self.need(n):
            raise CutOff("a BAM file ends within a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        marks = [(max(0, p - n), b) for p, b in self.marks]
        last = max((i for i, (p, _) in enumerate(marks) if p == 0), default=0)  # blocks before it are used up
        self.marks = marks[last:] if self.buffer else []
        return out


class Members(Blocks):
    """The same over gzip members that don't say how long they are: read from the start only, as one range."""

    def __init__(self, f, size: int, at: int = 0) -> None:
        super().__init__(f, size, at)
        self.inflate, self.rest, self.got, self.empty_last = zlib.decompressobj(31), b"", 0, False

    def more(self) -> bool:
        if not self.rest and not (rest := self.f.read(BLOCK)):
            if not self.inflate.eof:
                raise CutOff("a BAM file ends within a member")
            return False
        elif not self.rest:
            self.rest = rest
        if self.inflate.eof:
            self.inflate, self.got = zlib.decompressobj(31), 0
        data = self.inflate.decompress(self.rest)
        self.rest, self.got = self.inflate.unused_data, self.got + len(data)
        if data:
            self.marks.append((len(self.buffer), 0))
            self.buffer += data
        self.empty_last = self.inflate.eof and not self.got
        return True


def first_block(f, size: int, begin: int) -> int:
    """The first block that begins at or after a place; size if none does."""
    at = begin
    while at < size:
        f.seek(at)
        raw = f.read(3 * BLOCK)
        p = raw.find(MAGIC)
        while 0 <= p <= min(BLOCK, len(raw) - 1):
            n = block_length(raw, p)
            if n and p + n <= len(raw) and unpacked(raw[p : p + n]) is not None:
                return at + p
            p = raw.find(MAGIC, p + 1)
        if at + len(raw) >= size:
            return size
        at += BLOCK
    return size


def header(s: Blocks) -> list[tuple[str, int]]:
    """Names and lengths of the references; s is left at the first record."""
    if s.take(4) != b"BAM\x01":
        raise ValueError("not a BAM file")
    s.take(struct.unpack("<i", s.take(4))[0])
    out = []
    for _ in range(struct.unpack("<i", s.take(4))[0]):
        name = s.take(struct.unpack("<i", s.take(4))[0])[:-1].decode()
        out.append((name, struct.unpack("<i", s.take(4))[0]))
    return out


def fits(b: bytearray, at: int, refs: list[tuple[str, int]]) -> int:
    """Where the next record would begin if one begins at a place of b; 0 if none can, -1 if b is too short to tell."""
    if at + 36 > len(b):
        return -1
    size, ref, pos, l_name, _, _, n_cigar, _, l_seq, ref2, pos2 = struct.unpack_from("<iiiBBHHHiii", b, at)
    if size < 34 or l_name < 1 or l_seq < 0 or 32 + l_name + 4 * n_cigar + (l_seq + 1) // 2 + l_seq > size or not (-1 <= ref < len(refs) and -1 <= ref2 < len(refs)):
        return 0
    if pos < -1 or pos2 < -1 or ref >= 0 and pos >= max(1, refs[ref][1]) or ref2 >= 0 and pos2 >= max(1, refs[ref2][1]):
        return 0
    if at + 36 + l_name > len(b):
        return -1
    name = b[at + 36 : at + 36 + l_name]
    if name[-1] or any(not 33 <= c <= 126 for c in name[:-1]):
        return 0
    return at + 4 + size


def to_record(s: Blocks, refs: list[tuple[str, int]]) -> bool:
    """Move to the first place from which records follow on end; False if the file has none."""
    while s.need(1):
        at, n = 0, 0
        while n < ON_END:
            got = fits(s.buffer, at, refs)
            if got == 0:
                break
            if got < 0 or got > len(s.buffer):
                if s.more():
                    continue
                if got < 0 and at < len(s.buffer) or got > len(s.buffer):
                    got = 0
                break
            at, n = got, n + 1
        if n and got != 0:
            return True
        s.take(1)
    return False


def tag_nh(tags: bytes) -> int:
    """The NH tag's value; 1 without one."""
    at = 0
    while at + 3 <= len(tags):
        name, kind = tags[at : at + 2], tags[at + 2 : at + 3]
        at += 3
        if kind in (b"Z", b"H"):
            at = tags.index(b"\0", at) + 1
        elif kind == b"B":
            at += 5 + SIZES[tags[at : at + 1]] * struct.unpack_from("<i", tags, at + 1)[0]
        else:
            if name == b"NH" and kind in FORMATS:
                return struct.unpack_from(FORMATS[kind], tags, at)[0]
            at += SIZES[kind]
    return 1


def records(f, size: int, begin: int = 0, end: int | None = None, wanted: Callable[[str | None, int], bool] | None = None) -> Iterator[tuple]:
    """Rows as in schemas.ALIGNMENTS of the records that a range of an open BAM file owns, and that are wanted by chrom and flag."""
    end = size if end is None else end
    f.seek(0)
    known = block_length(f.read(BLOCK)) > 0
    f.seek(0)
    if not known and begin:
        return
    if known and end >= size:
        f.seek(max(0, size - len(CLOSING)))
        if f.read(len(CLOSING)) != CLOSING:
            raise CutOff("a BAM file lacks its closing block")
    s = (Blocks if known else Members)(f, size, 0)
    refs = header(s)
    if begin > s.block():
        s = Blocks(f, size, first_block(f, size, begin))
        if s.next >= end or not to_record(s, refs):
            return
    while s.need(1) and (not known or s.block() < end):
        b = s.take(struct.unpack("<i", s.take(4))[0])
        ref, pos, l_name, mapq, _, n_cigar, flag, l_seq = struct.unpack_from("<iiBBHHHi", b)
        name = refs[ref][0] if ref >= 0 else None
        if wanted and not wanted(name, flag):
            continue
        at = 32 + l_name
        ops = struct.unpack_from(f"<{n_cigar}I", b, at)
        span = sum(x >> 4 for x in ops if x & 15 in CONSUMES)
        nh = tag_nh(b[at + 4 * n_cigar + (l_seq + 1) // 2 + l_seq :])
        here = not flag & 4 and ref >= 0
        yield b[32 : 31 + l_name].decode(), flag, name, pos if here else None, pos + span if here else None, pos + l_seq - 1 if here else None, mapq, l_seq, nh, "-" if flag & 16 else "+"
    if not known and not s.empty_last:
        raise CutOff("a BAM file lacks its closing block")


def _open(path: str):
    """The file system of a path, and its place there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _files(path: str) -> list[tuple[str, int]]:
    """Files of a path with their sizes."""
    from pyarrow import fs

    system, place = _open(path)
    info = system.get_file_info(place)
    if info.type != fs.FileType.Directory:
        return [(path, info.size or 0)]
    found = sorted((f.base_name, f.size) for f in system.get_file_info(fs.FileSelector(place)) if f.base_name.lower().endswith(".bam"))
    return [(f"{path.rstrip('/')}/{n}", size) for n, size in found]


class _Part(InputPartition):
    def __init__(self, path: str, size: int, begin: int, end: int) -> None:
        self.path, self.size, self.begin, self.end = path, size, begin, end


class _Reader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]], split: int) -> None:
        self.files, self.split, self.only = files, split, {}

    def partitions(self) -> list[_Part]:
        return [_Part(p, size, at, min(size, at + self.split)) for p, size in self.files for at in range(0, max(size, 1), self.split)]

    def read(self, partition: _Part) -> Iterator:
        """Arrow batches of some thousand rows."""
        import pyarrow as pa

        if partition is None:  # no file at all
            return
        system, path = _open(partition.path)
        name, only = path.rsplit("/", 1)[-1], self.only
        wanted = (lambda chrom, flag: all({"chrom": chrom, "flag": flag}[c] in values for c, values in only.items())) if only else None
        schema = pa.schema([("read_id", pa.string()), ("flag", pa.int32()), ("chrom", pa.string()), ("start0", pa.int64()), ("end0", pa.int64()), ("stop0", pa.int64()), ("mapq", pa.int32()), ("read_length", pa.int64()), ("nh", pa.int32()), ("strand", pa.string())])
        with system.open_input_file(path) as f:
            rows = records(f, partition.size, partition.begin, partition.end, wanted)
            while some := list(islice(rows, 8192)):
                columns = [pa.array(c, t) for c, t in zip(zip(*some), schema.types)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([name] * len(some))], [*schema.names, "file"])


class _Choosy(_Reader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for x in filters:
            values = {x.value} if isinstance(x, EqualTo) else set(x.value) if isinstance(x, In) else None
            if values is None or x.attribute not in (("chrom",), ("flag",)):
                yield x
            else:
                name = x.attribute[0]
                self.only[name] = self.only.get(name, values) & values


class BamSource(DataSource):
    """spark.read.format("bam").load("a.bam,b.bam"): a comma-separated list of files, and of folders whose .bam files are read.

    file is the name of an alignment's file.
    """

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return f"{schemas.ALIGNMENTS}, file string"

    def reader(self, schema) -> DataSourceReader:
        kind = _Choosy if self.options.get("push_filters", "false").lower() == "true" else _Reader
        return kind([f for p in self.options["path"].split(",") if p for f in _files(p)], int(self.options.get("split_bytes", 1 << 26)))
