"""A streaming source of files that land in a folder, a message a line, with an offset for
each line: register with ``spark.dataSource.register(LandedLines)`` and read with
``spark.readStream.format("landed_lines").option("topic", ...).load(folder)``."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "value string, topic string, partition int, offset long"


@dataclass
class Piece(InputPartition):
    """Bytes ``start`` to before ``end`` of a file, which begin and end with lines."""

    path: str
    start: int
    end: int


class _Folder:
    def __init__(self, options: dict):
        self.topic, self.most = options.get("topic", "landed"), int(options.get("piecebytes", 64 << 20))
        self.per_batch = int(options.get("maxbytespertrigger", 1 << 60))
        self.store, self.folder = fs.FileSystem.from_uri(options["path"] if "://" in options["path"] else f"file://{options['path']}")

    def sizes(self) -> dict[str, int]:
        """Files and their sizes, in the order of their names; names that begin with a dot or
        an underscore are not there yet."""
        found = self.store.get_file_info(fs.FileSelector(self.folder, allow_not_found=True))
        return {f.path: f.size for f in sorted(found, key=lambda f: f.path) if f.type == fs.FileType.File and f.base_name[0] not in "._"}

    def whole_lines(self, path: str, start: int, end: int) -> int:
        """The end of the last line that is whole before ``end``; ``start`` if there is none."""
        with self.store.open_input_file(path) as f:
            while end > start:
                low = max(start, end - (1 << 16))
                f.seek(low)
                at = f.read(end - low).rfind(b"\n")
                if at >= 0:
                    return low + at + 1
                end = low
        return start

    def next_line(self, path: str, at: int, end: int) -> int:
        """Where the first line after ``at`` begins."""
        with self.store.open_input_file(path) as f:
            f.seek(at)
            while at < end:
                data = f.read(min(1 << 16, end - at))
                if (found := data.find(b"\n")) >= 0:
                    return at + found + 1
                at += len(data)
        return end

    def pieces(self, path: str, start: int, end: int) -> list[Piece]:
        out = []
        while start < end:
            cut = self.next_line(path, start + self.most, end) if end - start > self.most else end
            out.append(Piece(path, start, cut))
            start = cut
        return out

    def read(self, piece: Piece) -> Iterator[tuple]:
        """A row a line: a file is a partition, by the hash of its path, and the place of
        the line's first byte the offset."""
        partition = zlib.crc32(piece.path.encode()) & 0x7FFFFFFF
        with self.store.open_input_file(piece.path) as f:
            f.seek(piece.start)
            at, rest = piece.start, b""
            while at + len(rest) < piece.end:
                rest += f.read(min(1 << 20, piece.end - at - len(rest)))
                *lines, tail = rest.split(b"\n")
                for line in lines:
                    if line.strip():
                        yield line.rstrip(b"\r").decode(errors="replace"), self.topic, partition, at
                    at += len(line) + 1
                rest = tail
            if rest.strip():
                yield rest.rstrip(b"\r").decode(errors="replace"), self.topic, partition, at


class _Batch(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[Piece]:
        folder = _Folder(self.options)
        return [p for path, size in folder.sizes().items() for p in folder.pieces(path, 0, size)] or [Piece("", 0, 0)]

    def read(self, piece: Piece) -> Iterator[tuple]:
        return _Folder(self.options).read(piece) if piece.path else iter(())


class _Stream(DataSourceStreamReader):
    """Offsets are the bytes read of each file; a line counts when its line feed is there.
    What a batch read is told by its two offsets alone, so it is read again as it was."""

    def __init__(self, options: dict):
        self.options, self.folder = options, _Folder(options)
        self.now: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def latestOffset(self) -> dict:
        left = self.folder.per_batch
        done = dict(self.now)
        for path, size in self.folder.sizes().items():
            start = done.get(path, 0)
            if size > start and left > 0:
                limit = size if size - start <= left else self.folder.next_line(path, start + left, size)
                done[path] = self.folder.whole_lines(path, start, limit)
                left -= done[path] - start
        self.now = done
        return {"files": json.dumps(done, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        before, after = json.loads(start["files"]), json.loads(end["files"])
        self.now = {**after, **self.now}  # after a restart, what was read before
        return [p for path, size in after.items() for p in self.folder.pieces(path, before.get(path, 0), size)]

    def read(self, piece: Piece) -> Iterator[tuple]:
        return _Folder(self.options).read(piece)

    def commit(self, end: dict) -> None:
        self.now = {**self.now, **{p: max(n, self.now.get(p, 0)) for p, n in json.loads(end["files"]).items()}}


class LandedLines(DataSource):
    """Lines of the files in a folder, for batches and streams.  Options: ``topic``,
    ``pieceBytes`` (a task's share of a file) and ``maxBytesPerTrigger``.  The folder is on a
    file system that Arrow opens; files only grow, and the checkpoint holds a number for
    each file that is there."""

    @classmethod
    def name(cls) -> str:
        return "landed_lines"

    def schema(self) -> str:
        return SCHEMA

    def _options(self) -> dict:
        return {k.lower(): v for k, v in self.options.items()}

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Batch(self._options())

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Stream(self._options())
