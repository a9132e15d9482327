"""Token files: round trip, seek table, checksums, and digests against the library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from llm_support import SMALL, shipped  # noqa: F401
from tokenizers import Tokenizer

from viewlake.llm import token_files as files
from viewlake.llm.queries import QUERIES, WORD_VOCABULARY
from viewlake.llm.scratch import new_folder

PATH = public_tokenizers.path(WORD_VOCABULARY)
ODD = ["", None, "a  b", " lead\n\ttab ", "\x1cfoo \x85 bar\xa0baz", "<|endoftext|>hi", "don't we'll IT'S", "日本語 123 ½", "İstanbul ΟΔΟΣ é é", "foo., 'tis!!", "🙂 a🙂", "x" * 3000, "ab " * 4000]


def library_ids(texts):
    made = Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [[*e.ids, 2] for e in made]


def write(spark, rows, **how):
    folder = new_folder(spark, "test-tokens")
    files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string, ids string"), folder, PATH, **how)
    return folder


def test_query_equals_the_library(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    start, want = 0, {}
    for doc, ids in zip(docs, library_ids([d["text"] for d in docs])):
        want[doc["doc_id"]] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op1_token_files"](spark, SMALL).collect()}
    assert got == want


def test_odd_texts_over_many_files(spark):
    folder = write(spark, [(i, t, "clash") for i, t in enumerate(ODD)], file_bytes=2000)
    want = library_ids(ODD)
    got = {r["doc_id"]: r["ids"] for r in files.read_documents(spark, folder, list(range(len(ODD)))).collect()}
    assert got == dict(enumerate(want))
    some = {r["doc_id"]: r["ids"] for r in files.read_documents(spark, folder, [7, 99]).collect()}
    assert some == {7: want[7]}
    digests = sorted(files.read_digests(spark, folder).collect())
    assert [r["start"] for r in digests] == np.cumsum([0] + [len(w) for w in want[:-1]]).tolist()


def test_files_are_zstandard_with_checksums(spark):
    folder = write(spark, [(1, "one two", ""), (1, "one two", ""), (None, "three", "")])
    content, = [bytes(r["content"]) for r in files._files(spark, folder).collect() if len(r["content"]) > 8]
    names, table, offsets = files.read_directory(content)
    assert names["doc_id"].tolist() == [0, 1, 1] and names["is_null"].tolist() == [1, 0, 0]
    whole = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read()
    assert len(whole) == table["size"].sum()
    broken = bytearray(content)
    broken[int(offsets[1]) + 9] ^= 0xFF
    with pytest.raises((ValueError, zstandard.ZstdError)):
        files.read_frame(bytes(broken), int(offsets[1]), table[1], zstandard.ZstdDecompressor())


def test_empty_table(spark):
    assert files.read_digests(spark, write(spark, [])).count() == 0


def test_rows_without_ids_are_parted_over_files(spark, monkeypatch):
    rows = [(None, f"text number {i} of many", "x") for i in range(400)] + [(i, "some text", "x") for i in range(5)]
    folder = write(spark, rows, file_bytes=1_000)
    sizes = [r["n"] for r in files.read_digests(spark, folder).groupBy("doc_id").count().withColumnRenamed("count", "n").collect()]
    assert sorted(sizes) == [1] * 5 + [400]
    contents = [bytes(r["content"]) for r in files._files(spark, folder).collect()]
    assert len(contents) > 5 and max(len(files.read_directory(c)[0]) for c in contents) < 200
    monkeypatch.setattr(files, "MOST_FILES", 2)
    folder = write(spark, rows, file_bytes=1_000)
    assert files._files(spark, folder).count() == 2
