"""A log file and its rotated siblings as a stream of lines.

A file source knows a file by its path: it would read a renamed file again and miss what is appended to one it has read.
Here a file is known by its first line, wherever it is renamed to, and the stream's offset says for each file up to which
byte its lines have been read.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Tasks get this module by value: executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of the first line that make up a file's name, bytes of a task, and bytes read at a time.
HEAD, PART, BLOCK = 4096, 64 << 20, 1 << 20


def _files(path: str) -> list[tuple]:
    """(file system, path) of the log and its siblings: the same name, or that name, a dot and a number."""
    from pyarrow import fs

    system, base = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    folder, name = base.rsplit("/", 1)
    found = []
    for info in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
        rest = info.base_name.removeprefix(name) if info.base_name.startswith(name) else None
        if info.is_file and rest is not None and (not rest or rest[0] == "." and rest[1:].isdigit()):
            found.append((system, info.path))
    return found


def _identity(file) -> str | None:
    """None until the first line is complete (or longer than ``HEAD``)."""
    head = file.read_at(min(HEAD, file.size()), 0)
    end = head.find(b"\n")
    return None if end < 0 and len(head) < HEAD else hashlib.sha256(head[: end if end >= 0 else HEAD]).hexdigest()[:32]


def _complete(file) -> int:
    """The byte after the last line end."""
    high = file.size()
    while high:
        low = max(0, high - BLOCK)
        at = file.read_at(high - low, low).rfind(b"\n")
        if at >= 0:
            return low + at + 1
        high = low
    return 0


def scan(path: str) -> dict[str, int]:
    """Per file the byte up to which it holds complete lines. A file that vanishes meanwhile is passed over."""
    found = {}
    for system, name in _files(path):
        try:
            with system.open_input_file(name) as file:
                identity = _identity(file)
                if identity:
                    found[identity] = max(found.get(identity, 0), _complete(file))
        except FileNotFoundError:
            continue
    return found


class Part(InputPartition):
    def __init__(self, identity: str, start: int, end: int):
        self.identity, self.start, self.end = identity, start, end


def lines(path: str, part: Part) -> Iterator[tuple[int, str]]:
    """(byte, line) of the lines that begin in the part; the last may end beyond it. The file is looked up by its first
    line now, as it may have been renamed since the part was planned. One that was rotated away has no lines left."""
    for system, name in _files(path):
        with system.open_input_file(name) as file:
            if _identity(file) != part.identity:
                continue
            at, size, rest = part.start, file.size(), b""
            if at and file.read_at(1, at - 1) != b"\n":
                while at < size:
                    block = file.read_at(min(BLOCK, size - at), at)
                    end = block.find(b"\n")
                    if end >= 0:
                        at += end + 1
                        break
                    at += len(block)
            begin = at
            while begin < part.end and at < size:
                block = file.read_at(min(BLOCK, size - at), at)
                at += len(block)
                *whole, rest = (rest + block).split(b"\n")
                for line in whole:
                    if begin >= part.end:
                        return
                    yield begin, line.removesuffix(b"\r").decode("utf-8", "replace")
                    begin += len(line) + 1
            return


class Reader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        return {"files": scan(self.path)}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        parts = []
        for identity, high in sorted(end["files"].items()):
            low = start["files"].get(identity, 0)
            while low < high:
                parts.append(Part(identity, low, min(high, low + PART)))
                low += PART
        return parts

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, str]] = []
        for row in lines(self.path, partition):
            rows.append(row)
            if len(rows) == 10_000:
                yield self._batch(partition, rows)
                rows = []
        if rows:
            yield self._batch(partition, rows)

    @staticmethod
    def _batch(partition: Part, rows: list[tuple[int, str]]) -> pa.RecordBatch:
        at, text = zip(*rows)
        columns = [pa.array(text, pa.string()), pa.array([partition.identity] * len(rows), pa.string()), pa.array(at, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["value", "file", "position"])


class RotatedLog(DataSource):
    """Columns ``value``, ``file`` (told by the first line) and ``position`` (the byte where the line begins)."""

    @classmethod
    def name(cls) -> str:
        return "rotated_log"

    def schema(self) -> str:
        return "value string, file string, position long"

    def streamReader(self, schema) -> Reader:
        return Reader(self.options["path"])
