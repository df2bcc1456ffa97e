"""Token files: round trip against the tokenizer, frames on demand, checksums."""

import glob
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from meterflow.llm import token_files
from meterflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def expected(tokenizer, rows, end=1):
    """(doc, start, n, crc) in ascending order of ids, null first; rows of an id in the order of their texts' checksums."""
    import hashlib

    found, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest())):
        ids = np.asarray([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")
        found.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return found


def test_query_is_the_tokenizers(spark, tokenizer):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op12_token_files"](spark, SF).collect()]
    assert sorted(got) == expected(tokenizer, rows)


def test_nulls_repeats_and_long_texts(spark, tokenizer, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_BYTES", 400)
    monkeypatch.setattr(token_files, "FILE_BYTES", 30_000)
    rows = [(None, "no id"), (None, None), (4, ""), (4, ""), (3, "three words here"), (3, "other"), (-1, "Größe Σ İ!")]
    rows += [(10 + n, f"text number {n} " * (n % 7)) for n in range(60)] + [(200, "very long words " * 9000)]
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, file string, before int")
    files = token_files.write(frame, str(tmp_path / "t"), PATH)
    order = ["doc_id", "start"]
    got = [tuple(r) for r in token_files.read(files).orderBy(*order).collect()]
    assert got == expected(tokenizer, rows)

    wanted = spark.createDataFrame([(200,), (12,), (13,), (999,), (4,), (12,)], "wanted long")
    found = sorted((r.doc_id, list(r.ids), r.frames) for r in token_files.fetch(files, wanted).collect())
    text = dict(rows)
    assert [d for d, *_ in found] == [4, 4, 12, 13, 200]
    assert all(ids == [*tokenizer.encode(text[d], add_special_tokens=False).ids, 1] for d, ids, _ in found)
    # Only the long document needs many frames; all others share or open one.
    assert all(frames <= 1 for d, _, frames in found if d != 200)
    assert found[-1][2] == pytest.approx(27_001 * 4 / 400, abs=2)
    null = token_files.fetch(files, spark.createDataFrame([(None,)], "wanted long")).collect()
    assert len(null) == 2


def test_files_are_plain_zstandard(spark, tokenizer, tmp_path):
    frame = spark.createDataFrame([(n, f"some text {n}") for n in range(30)], "doc_id int, text string").coalesce(1)
    token_files.write(frame, str(tmp_path / "t"), PATH, end_id=2).count()
    ids = []
    for path in sorted(glob.glob(str(tmp_path / "t" / "part-*.zst"))):
        with open(path, "rb") as file:
            content = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read()
        ids += np.frombuffer(content, "<u4").tolist()
    assert ids == [i for n in range(30) for i in [*tokenizer.encode(f"some text {n}", add_special_tokens=False).ids, 2]]
    assert not glob.glob(str(tmp_path / "t" / "_*"))


def test_a_damaged_frame_is_noticed(tmp_path):
    import pyarrow as pa

    writer = token_files.Writer(str(tmp_path / "f.zst"), "0", pa.int64())
    writer.add(1, np.arange(9, dtype="<u4").tobytes())
    path, docs, ids = writer.close()
    assert (docs, ids) == (1, 9)
    reader = token_files.Reader(path)
    assert b"".join(reader.pieces(0, 9)) == np.arange(9, dtype="<u4").tobytes()
    reader.entries[0] = (*reader.entries[0][:2], reader.entries[0][2] ^ 1)
    reader.kept = -1, b""
    with pytest.raises(ValueError, match="checksum"):
        reader.frame(0)
    with open(path, "r+b") as file:
        file.seek(-1, 2)
        file.write(b"\0")
    with pytest.raises(ValueError, match="seek table"):
        token_files.Reader(path)


def test_no_rows_no_files(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id string, text string")
    files = token_files.write(empty, str(tmp_path / "t"), PATH)
    assert files.collect() == [] and token_files.read(files).collect() == []
