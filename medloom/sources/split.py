"""Large files of records as a Spark data source: byte ranges that find where records begin, plain or gzipped."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a range, bytes that are read at once, and the most bytes that a marker takes.
SPLIT, CHUNK, MARKER = 32 << 20, 1 << 20, 1 << 16
_MEMBER = b"\x1f\x8b\x08"


class Range(InputPartition):
    def __init__(self, file: str, low: int, high: int):
        self.file, self.low, self.high = file, low, high


def plain(file, low: int, high: int) -> Iterator[tuple[bytes, bool]]:
    """The bytes from ``low`` to the end of the file, in pieces that lie before ``high`` (True) or not."""
    file.seek(low)
    at = low
    while data := file.read(min(CHUNK, high - at) if at < high else CHUNK):
        yield data, at < high
        at += len(data)


def _member(file, at: int) -> Iterator[bytes]:
    """The contents of the gzip member at a place; a ValueError if there is none, or a broken one.  ``file.next``: its end."""
    file.seek(at)
    inflate, taken = zlib.decompressobj(31), at
    while True:
        data = file.read(CHUNK)
        if not data:
            raise ValueError("a member ends early")
        taken += len(data)
        try:
            yield inflate.decompress(data)
        except zlib.error as e:
            raise ValueError(str(e)) from e
        if inflate.eof:
            file.next = taken - len(inflate.unused_data)
            return


class _Seeking:
    """A file with a place to note where a member ended."""

    def __init__(self, file):
        self.file, self.next = file, 0
        self.seek, self.read, self.size = file.seek, file.read, file.size


def _first_member(file, low: int, high: int) -> int | None:
    """Where the first whole member begins at or behind ``low`` and before ``high``.  Its mark may stand inside another
    one by chance: then it does not inflate, or its check sum is wrong."""
    at = low
    while at < high:
        file.seek(at)
        data = file.read(min(CHUNK, high - at) + len(_MEMBER) - 1)
        found = data.find(_MEMBER)
        if found < 0 or at + found >= high:
            at += max(1, len(data) - len(_MEMBER) + 1)
            if len(data) < len(_MEMBER):
                return None
            continue
        try:
            for _ in _member(file, at + found):
                pass
            return at + found
        except ValueError:
            at += found + 1
    return None


def gzipped(file, low: int, high: int) -> Iterator[tuple[bytes, bool]]:
    """What the members that begin in the range hold (True), and what follows them."""
    at = 0 if low == 0 else _first_member(file, low, high)
    size = file.size()
    while at is not None and at < size:
        for data in _member(file, at):
            yield data, at < high
        at = file.next


def markers(pieces: Iterator[tuple[bytes, bool]], begin: bytes, end: bytes, context: bytes | None) -> Iterator[tuple[bytes | None, bytes | None]]:
    """Records that begin in the pieces that are own (None, record), and contexts (context, None), in their order.

    ``begin`` and ``context`` are patterns without groups but the context's own, ``end`` is the text that ends a record;
    a record is read to its end, own or not.  One that has no end is left out."""
    mark = re.compile(b"(?P<begin>%s)" % begin + (b"|(?P<context>%s)" % context if context else b""), re.S)
    buffer, own, at, over = bytearray(), 0, 0, False

    def more() -> bool:
        nonlocal own, over
        data = next(pieces, None)
        if data is None:
            over = True
            return False
        if data[1]:
            own = len(buffer) + len(data[0])
        buffer.extend(data[0])
        return True

    while True:
        if at > CHUNK:
            del buffer[:at]
            own, at = max(0, own - at), 0
        m = mark.search(buffer, at)
        if not over and (m is None or m.end() > len(buffer) - MARKER):
            # what stands near the end may be the beginning of a mark, or of a longer one
            least = m.start() if m else max(at, len(buffer) - MARKER)
            if least >= own and len(buffer) > own:
                return
            at = least
            more()
            continue
        if m is None or m.start() >= own:
            return
        start = m.start()
        if m["begin"] is None:
            yield next((bytes(g) for g in m.groups()[2:] if g is not None), b""), None
            at = m.end()
            continue
        looked = m.end()
        while (stop := buffer.find(end, looked)) < 0:
            looked = max(looked, len(buffer) - len(end) + 1)
            if not more():
                break
        if stop < 0:
            return
        stop += len(end)
        yield None, bytes(buffer[start:stop])
        at = stop


def records_of(file, low: int, high: int, begin: bytes, end: bytes, context: bytes | None) -> Iterator[tuple[bytes | None, bytes]]:
    """Context and text of the records that begin in a range.  The context of the first ones may stand in an earlier
    range: it is looked for backwards, a range at a time."""
    file = _Seeking(file)
    file.seek(0)
    pieces = gzipped if file.read(len(_MEMBER)) == _MEMBER else plain
    current, known = None, context is None or low == 0
    for found, record in markers(pieces(file, low, high), begin, end, context):
        if found is not None:
            current, known = found, True
            continue
        if not known:
            to, width = low, high - low
            while to > 0 and current is None:
                back = max(0, to - width)
                for c, _ in markers(pieces(file, back, to), begin, end, context):
                    current = c if c is not None else current
                to = back
            known = True
        yield current, record


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.split = options["path"], int(options.get("split", SPLIT))
        self.begin, self.end = options["begin"].encode(), options["end"].encode()
        self.context = options["context"].encode() if options.get("context") else None

    def partitions(self) -> list[Range]:
        store, base = fs.FileSystem.from_uri(self.path)
        info = store.get_file_info(base)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(base, recursive=True))
        files = [f for f in files if f.type == fs.FileType.File and f.size and not f.base_name.startswith(("_", "."))]
        return [Range(f.path, low, min(f.size, low + self.split)) for f in sorted(files, key=lambda f: f.path) for low in range(0, f.size, self.split)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.path)
        schema = pa.schema([("file", pa.string()), ("low", pa.int64()), ("number", pa.int64()), ("context", pa.string()), ("record", pa.string())])
        rows, held, number = [], 0, 0
        with store.open_input_file(part.file) as file:
            for context, record in records_of(file, part.low, part.high, self.begin, self.end, self.context):
                rows.append({"file": part.file, "low": part.low, "number": number, "context": None if context is None else context.decode(), "record": record.decode()})
                held, number = held + len(record), number + 1
                if held > CHUNK:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


class RecordSource(DataSource):
    """Options: path, begin and context (patterns), end (a text), split (bytes of a range)."""

    @classmethod
    def name(cls) -> str:
        return "medloom_records"

    def schema(self) -> str:
        return "file string, low bigint, number bigint, context string, record string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def records(spark: SparkSession, path: str, begin: str, end: str, context: str | None = None, split: int = SPLIT) -> DataFrame:
    """Records of a file, or of all files of a folder (a URI that Arrow opens): file, low (where their range begins),
    number (in the range, from 0), context and record.

    A record goes from a match of ``begin`` to the next ``end`` and belongs to the range that it begins in; ``context``
    is a pattern whose group is kept for the records behind it.  Plain files are cut anywhere.  Of gzipped ones a range
    has the members that begin in it, so a file of many members is read by several tasks and one of a single member by
    one.  Marks inside of comments count as marks."""
    spark.dataSource.register(RecordSource)
    source = spark.read.format("medloom_records").option("path", path).option("begin", begin).option("end", end).option("split", str(split))
    return (source.option("context", context) if context else source).load()
