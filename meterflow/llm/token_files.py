"""Token files: ids in independent zstandard frames with a directory of documents and a trailing seek table.

A file holds data frames of little-endian 4-byte ids, then the directory (doc ids and numbers of ids as an Arrow stream,
in a skippable frame), then the seek table of the public seekable zstandard format: per frame its compressed and decompressed size
and the low 32 bits of the XXH64 of its content. Any zstandard tool decompresses the whole file to the ids alone; a
reader here decompresses the frames of the documents it wants.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import running_totals, ship, shuffle_partitions, small_batches, stored, tidy
from meterflow.llm.packing import ID, Tokens

ship(__name__)

# Magic numbers, footer and checksum flag of the seekable format; a skippable frame for the directory.
SKIPPABLE, DIRECTORY, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1, 0x80
ENTRY, FOOTER, HEADER = "<III", "<IBI", "<II"
ENTRY_SIZE, FOOTER_SIZE, HEADER_SIZE = map(struct.calcsize, (ENTRY, FOOTER, HEADER))
#: Bytes of ids in a frame, unless a document is longer, which then takes several frames.
FRAME_BYTES = 256 << 10
#: A file is closed at so many bytes of ids or documents, whichever comes first.
FILE_BYTES, FILE_DOCS = 256 << 20, 1 << 20
LEVEL = 3
MANIFEST = "part int, seq int, file string, docs long, ids long"


def xxh32bits(content: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(content) & 0xFFFFFFFF


def filesystem(path: str):
    """The file system of a path and the path on it; a path without a scheme is local."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


class Writer:
    """One file, written under a name of its own and given its final name when it is complete."""

    def __init__(self, path: str, attempt: str, doc_type: pa.DataType):
        import zstandard

        self.path, self.doc_type = path, doc_type
        self.fs, self.final = filesystem(path)
        folder, name = self.final.rsplit("/", 1)
        self.fs.create_dir(folder, recursive=True)
        self.temporary = f"{folder}/_{name}-{attempt}"
        self.out = self.fs.open_output_stream(self.temporary)
        self.zstd = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.entries: list[tuple[int, int, int]] = []
        self.waiting = bytearray()
        self.docs: list = []
        self.lengths: list[int] = []
        self.ids = 0

    def add(self, doc, ids: bytes) -> None:
        if self.waiting and len(self.waiting) + len(ids) > FRAME_BYTES:
            self._frame()
        self.docs.append(doc)
        self.lengths.append(len(ids) // ID)
        self.ids += len(ids) // ID
        self.waiting += ids
        while len(self.waiting) > FRAME_BYTES:
            self._frame(FRAME_BYTES)

    def full(self) -> bool:
        return self.ids * ID >= FILE_BYTES or len(self.docs) >= FILE_DOCS

    def _frame(self, size: int | None = None) -> None:
        content = bytes(self.waiting[:size])
        del self.waiting[:size]
        packed = self.zstd.compress(content)
        self.out.write(packed)
        self.entries.append((len(packed), len(content), xxh32bits(content)))

    def close(self) -> tuple[str, int, int]:
        if self.waiting:
            self._frame()
        sink = pa.BufferOutputStream()
        table = pa.record_batch([pa.array(self.docs, self.doc_type), pa.array(self.lengths, pa.int64())], names=["doc", "n"])
        with pa.ipc.new_stream(sink, table.schema) as stream:
            stream.write_batch(table)
        packed = self.zstd.compress(sink.getvalue().to_pybytes())
        self.out.write(struct.pack(HEADER, DIRECTORY, len(packed)) + packed)
        self.entries.append((HEADER_SIZE + len(packed), 0, xxh32bits(b"")))
        body = b"".join(struct.pack(ENTRY, *e) for e in self.entries)
        body += struct.pack(FOOTER, len(self.entries), CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack(HEADER, SKIPPABLE, len(body)) + body)
        self.out.close()
        self.fs.move(self.temporary, self.final)
        return self.path, len(self.docs), self.ids


class Reader:
    """The tail of a file is read at once, frames when they are asked for. ``opened`` counts the frames decompressed."""

    def __init__(self, path: str):
        import zstandard

        fs, at = filesystem(path)
        self.path, self.file = path, fs.open_input_file(at)
        self.zstd = zstandard.ZstdDecompressor()
        size = self.file.size()
        count, flags, magic = struct.unpack(FOOTER, self._bytes(size - FOOTER_SIZE, FOOTER_SIZE))
        table = size - FOOTER_SIZE - count * ENTRY_SIZE
        head = struct.pack(HEADER, SKIPPABLE, size - table)
        if magic != SEEKABLE or flags != CHECKSUMS or self._bytes(table - HEADER_SIZE, HEADER_SIZE) != head:
            raise ValueError(f"{path} has no seek table")
        self.entries = list(struct.iter_unpack(ENTRY, self._bytes(table, count * ENTRY_SIZE)))
        self.places, self.begins = [0], [0]
        for packed, content, _ in self.entries:
            self.places.append(self.places[-1] + packed)
            self.begins.append(self.begins[-1] + content)
        if self.places[-1] != table - HEADER_SIZE:
            raise ValueError(f"{path}: frames and seek table differ")
        self.opened, self.kept = 0, (-1, b"")

    def _bytes(self, start: int, size: int) -> bytes:
        return self.file.read_at(size, start)

    def directory(self) -> pa.RecordBatch:
        """Columns ``doc`` and ``n`` in the order of the ids."""
        packed = self._bytes(self.places[-2] + HEADER_SIZE, self.entries[-1][0] - HEADER_SIZE)
        return pa.ipc.open_stream(self.zstd.decompress(packed)).read_next_batch()

    def frame(self, number: int) -> bytes:
        if self.kept[0] != number:
            packed, size, checksum = self.entries[number]
            content = self.zstd.decompress(self._bytes(self.places[number], packed), max_output_size=size)
            if len(content) != size or xxh32bits(content) != checksum:
                raise ValueError(f"{self.path}: frame {number} does not agree with its checksum")
            self.opened += 1
            self.kept = number, content
        return self.kept[1]

    def pieces(self, start: int, ids: int) -> Iterator[bytes]:
        """The bytes of ``ids`` ids from ``start`` on, frame by frame."""
        at, end = start * ID, (start + ids) * ID
        number = bisect_right(self.begins, at, 0, len(self.entries)) - 1
        while at < end:
            offset = at - self.begins[number]
            part = self.frame(number)[offset : offset + end - at]
            yield part
            at += len(part)
            number += 1

    def close(self) -> None:
        self.file.close()


def write(frame: DataFrame, folder: str, tokenizer: str, end_id: int = 1, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Writes the ids of all texts in ascending order of the ids of documents; returns one row per file.

    Columns: part, seq, file, docs, ids and ``before``, the ids of all files before it. Null doc ids come first; rows of
    the same id follow by checksum of their text, and equal rows are interchangeable but all written. A null or empty
    text is its ``end_id`` alone. Other columns are not read. An empty table gives no files.

    Rows are sorted over range partitions; each task encodes and writes its own files to ``folder``, which executors have to
    share. A task that is run again writes the same files once more, each complete before it has its name. A task
    holds one frame, one text and the directory of one file.
    """
    small_batches(frame.sparkSession)
    kind = frame.select(F.col(f"`{id_col}`").alias("id")).schema[0].dataType
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = frame.select(
        F.col(f"`{id_col}`").alias("id"), F.sha2(text.cast("binary"), 256).alias("digest"),
        F.monotonically_increasing_id().alias("uid"), text.alias("text"),
    )
    order = ["id", "digest", "uid"]
    ordered = rows.repartitionByRange(shuffle_partitions(frame.sparkSession), *order).sortWithinPartitions(*order)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt = context.partitionId(), str(context.taskAttemptId())
        tokens, writer, made = Tokens(tokenizer, end_id), None, []
        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), tokens.each(batch.column(1).to_pylist())):
                if writer is None:
                    writer = Writer(f"{folder}/part-{part:06d}-{len(made):05d}.zst", attempt, batch.column(0).type)
                writer.add(doc, ids.tobytes())
                if writer.full():
                    made.append(writer.close())
                    writer = None
        if writer is not None:
            made.append(writer.close())
        if made:
            files, docs, ids = zip(*made)
            columns = [pa.array([part] * len(made), pa.int32()), pa.array(range(len(made)), pa.int32()),
                       pa.array(files, pa.string()), pa.array(docs, pa.int64()), pa.array(ids, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "seq", "file", "docs", "ids"])

    manifest = stored(ordered.select("id", "text").mapInArrow(tidy(work), MANIFEST), "token-manifest")
    files = running_totals(manifest, [], ["part", "seq"], "ids").drop("place")
    # An empty column carries the type of the doc ids to the readers.
    return files.withColumn("id_type", F.lit(None).cast(kind))


def _over_files(files: DataFrame, rows: Callable[[Reader, int], Iterator[list[pa.Array]]], names: list[str], schema: str):
    """Applies ``rows`` to every file (columns ``file`` and ``before``), each by one task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = Reader(path)
                for columns in rows(reader, before):
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                reader.close()

    spread = files.select("file", "before").repartition(max(1, shuffle_partitions(files.sparkSession)), "file")
    return spread.mapInArrow(tidy(work), schema)


def _kind(files: DataFrame) -> str:
    return files.schema["id_type"].dataType.simpleString()


def read(files: DataFrame) -> DataFrame:
    """One row per document of all files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Frames are checked against their checksums; a file whose frames do not agree with them ends the job with an error.
    """

    def rows(reader: Reader, before: int) -> Iterator[list[pa.Array]]:
        directory, at = reader.directory(), 0
        lengths = directory.column(1).to_pylist()
        starts, sums = [], []
        for length in lengths:
            crc = 0
            for piece in reader.pieces(at, length):
                crc = zlib.crc32(piece, crc)
            starts.append(before + at)
            sums.append(crc)
            at += length
        yield [directory.column(0), pa.array(starts, pa.int64()), directory.column(1), pa.array(sums, pa.int64())]

    schema = f"doc_id {_kind(files)}, start long, n_tokens long, ids_crc32 long"
    return _over_files(files, rows, ["doc_id", "start", "n_tokens", "ids_crc32"], schema)


def index(files: DataFrame) -> DataFrame:
    """(doc_id, file, first, n_tokens) of all documents, from the directories alone; ``first`` counts ids within the file."""

    def rows(reader: Reader, before: int) -> Iterator[list[pa.Array]]:
        directory, at, firsts = reader.directory(), 0, []
        for length in directory.column(1).to_pylist():
            firsts.append(at)
            at += length
        path = pa.array([reader.path] * len(firsts), pa.string())
        yield [directory.column(0), path, pa.array(firsts, pa.int64()), directory.column(1)]

    schema = f"doc_id {_kind(files)}, file string, first long, n_tokens long"
    return _over_files(files, rows, ["doc_id", "file", "first", "n_tokens"], schema)


def fetch(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, ids, frames) of the documents whose id is in the first column of ``wanted``; null finds null.

    Only the frames that hold them are decompressed; ``frames`` is how many a document had opened for it, 0 where its frame
    was open already. Ids that no file holds give no row; an id wanted twice is given once, a document stored twice twice.
    """
    ids = wanted.select(F.col(f"`{wanted.columns[0]}`").alias("of")).distinct()
    places = index(files).join(ids, F.col("doc_id").eqNullSafe(F.col("of")))
    places = places.select("doc_id", "file", "first", "n_tokens").repartition("file").sortWithinPartitions("file", "first")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        reader = None
        for batch in batches:
            for n, (path, first, length) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)))):
                if reader is None or reader.path != path:
                    if reader is not None:
                        reader.close()
                    reader = Reader(path)
                before = reader.opened
                content = np.frombuffer(b"".join(reader.pieces(first, length)), "<u4").astype("int64")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(n, 1), pa.array([content], pa.list_(pa.int64())),
                     pa.array([reader.opened - before], pa.int32())], names=["doc_id", "ids", "frames"],
                )
        if reader is not None:
            reader.close()

    return places.mapInArrow(tidy(work), f"doc_id {_kind(files)}, ids array<long>, frames int")
