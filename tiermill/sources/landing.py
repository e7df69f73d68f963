"""A landing folder of JSON lines as a data source whose lines have a stable place: file and byte position.

Spark's own text scan knows neither, so it can't be told to go on where it ended. Here each line's `part` is its file,
named relative to the folder, and its offset the position of its first byte; a scan takes ranges of positions per file.
A line belongs to the range that holds its first byte, so ranges may cut lines anywhere, and large ones are cut into
pieces that are read in parallel. Tasks yield Arrow batches; no row is handled by itself.

Files are listed and read through pyarrow's file systems (local and mounted folders, hdfs, s3, gs); a store that these
can't reach needs the topic itself or an archive. A file must be whole when it comes. One that grows is read from where
it ended; a last line without an end counts, so what continues such a line later is no line.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from tiermill.sources.ranges import Ranges, merged, rows_of, without

NAME = "landing"
#: Bytes that a task reads at most, and that it holds at once (or one line, if that is longer).
PIECE_BYTES, CHUNK_BYTES = 128 << 20, 4 << 20
#: Endings of files that can't be read from a position on.
COMPRESSED = (".gz", ".bz2", ".zst", ".snappy", ".lz4", ".deflate")
SCHEMA = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int, part string"


@dataclass
class Piece(InputPartition):
    part: str
    first: int
    following: int
    modified: datetime


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    store, place = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return store, place.rstrip("/")


def files(path: str) -> dict[str, tuple[int, datetime]]:
    """Size and time of each file in the folder and those below it, by its name from the folder on; hidden ones aside."""
    store, place = _folder(path)
    found = {}
    for info in store.get_file_info(fs.FileSelector(place, recursive=True, allow_not_found=True)):
        name = info.path.removeprefix(place).lstrip("/")
        if info.type != fs.FileType.File or any(x.startswith((".", "_")) for x in name.split("/")):
            continue
        if name.endswith(COMPRESSED):
            raise ValueError(f"{name}: lines of a compressed file have no position to go on from")
        found[name] = info.size, info.mtime
    return found


def available(path: str) -> Ranges:
    """All bytes of all files."""
    return merged((name, 0, size) for name, (size, _) in files(path).items())


def _pieces(path: str, ranges: Ranges) -> list[Piece]:
    known = files(path)
    if gone := sorted(set(ranges) - set(known)):
        raise ValueError(f"the landing folder has no file {gone[0]!r}")
    return [
        Piece(part, a, min(a + PIECE_BYTES, following), known[part][1])
        for part, first, following in rows_of(ranges)
        for a in range(first, following, PIECE_BYTES)
    ]


def _lines(store: fs.FileSystem, path: str, first: int, following: int) -> Iterator[tuple[list[bytes], list[int]]]:
    """Lines that begin in [first, following) and the positions of their first bytes, some at a time."""
    with store.open_input_file(path) as file:
        size = file.size()
        position = first
        if first:
            # the line that the byte before belongs to began earlier, unless that byte ends it
            file.seek(first - 1)
            while position < following:
                chunk = file.read(CHUNK_BYTES)
                end = chunk.find(b"\n")
                if end >= 0 or not chunk:
                    position = file.tell() - len(chunk) + end + 1 if chunk else following
                    break
                position = file.tell()
            file.seek(min(position, size))
        rest = b""
        while position < following:
            chunk = file.read(CHUNK_BYTES)
            data = rest + chunk
            cut = data.rfind(b"\n") + 1 if chunk else len(data)
            whole, rest = data[:cut], data[cut:]
            lines, places = [], []
            # a last line without an end is a line, nothing after the last end is none
            for line in whole.split(b"\n")[: None if whole and not whole.endswith(b"\n") else -1]:
                if position >= following:
                    break
                lines.append(line.removesuffix(b"\r"))
                places.append(position)
                position += len(line) + 1
            if lines:
                yield lines, places
            if not chunk:
                break


class _Reading:
    path: str
    topic: str

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        store, place = _folder(self.path)
        schema = pa.schema(
            [("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()), ("timestamp", pa.timestamp("us", "UTC")), ("timestampType", pa.int32()), ("part", pa.string())]
        )
        for lines, places in _lines(store, f"{place}/{piece.part}", piece.first, piece.following):
            n = len(lines)
            same = lambda value, kind: pa.repeat(pa.scalar(value, kind), n)
            columns = [pa.nulls(n, pa.binary()), pa.array(lines, pa.binary()), same(self.topic, pa.string()), same(number_of(piece.part), pa.int32()), pa.array(places, pa.int64())]
            time = pc.cast(same(piece.modified, pa.timestamp("ns", "UTC")), pa.timestamp("us", "UTC"), safe=False)
            yield pa.RecordBatch.from_arrays([*columns, time, same(0, pa.int32()), same(piece.part, pa.string())], schema=schema)


def number_of(part: str) -> int:
    """A file as a partition number, for lineage; ranges go by the file itself."""
    return zlib.crc32(part.encode()) & 0x7FFFFFFF


class LandingReader(_Reading, DataSourceReader):
    def __init__(self, path: str, topic: str, ranges: Ranges | None):
        self.path, self.topic, self.ranges = path, topic, ranges

    def partitions(self) -> Sequence[Piece]:
        pieces = _pieces(self.path, available(self.path) if self.ranges is None else self.ranges)
        # a source without partitions would be asked to read None
        return pieces or [Piece("", 0, 0, datetime.fromtimestamp(0))]

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        if piece.first < piece.following:
            yield from super().read(piece)


class LandingStream(_Reading, DataSourceStreamReader):
    """Offsets are the sizes of the files read; files that are gone drop out, so these grow with the folder and not with time."""

    def __init__(self, path: str, topic: str):
        self.path, self.topic = path, topic

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {name: size for name, (size, _) in files(self.path).items()}

    def partitions(self, start: dict, end: dict) -> Sequence[Piece]:
        return _pieces(self.path, without(merged((p, 0, n) for p, n in end.items()), merged((p, 0, n) for p, n in start.items())))


class Landing(DataSource):
    """Options: path, topic, and for a batch `ranges`, JSON of [part, first, next] triples; without them everything is read."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> LandingReader:
        ranges = self.options.get("ranges")
        return LandingReader(self.options["path"], self.options.get("topic", ""), None if ranges is None else merged(map(tuple, json.loads(ranges))))

    def streamReader(self, schema: StructType) -> LandingStream:
        return LandingStream(self.options["path"], self.options.get("topic", ""))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Landing)
