"""Operator 1: token ids in seekable files of independent zstandard frames.

A file holds one frame for each document, in ascending document id, then a
directory of the ids and a seek table:

    [frame][gap] ... [frame][gap][directory][seek table][gap]

* A frame is a whole zstandard frame with content checksum; it holds the ids of one
  document as little-endian unsigned 32-bit integers.
* A gap is an empty skippable frame of 8 bytes. It is the row separator Spark's text
  writer puts after each row, so Spark's own committer writes the files, on any
  store, once, whatever becomes of executors.
* The directory is a skippable frame: for each document its id and whether the id is
  NULL.
* The seek table is a skippable frame: for each document the compressed size with the
  gap, the size of its ids and the low 32 bits of their XXH64, then the number of
  frames, a flag byte and a magic number.

Any zstandard decoder reads a file from end to end; ``read_documents`` seeks, and
decompresses the frames asked for and no others.

Edge cases: a NULL or empty text has the end id alone. A NULL document id sorts
first. Repeated rows have a frame each. An empty table gives files without frames.
Other columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterable, Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from viewlake.llm.chunks import PieceCache, encode_texts, printable_bytes
from viewlake.llm.scratch import cut, keep_one, text_slices

#: Fixed values of the zstandard frame formats.
SKIPPABLE_GAP = b"P*M\x18\x00\x00\x00\x00"
DIRECTORY_MAGIC = 0x184D2A5D
SEEK_TABLE_MAGIC = 0x184D2A5E
SEEKABLE_FOOTER_MAGIC = 0x8F92EAB1

DIRECTORY = np.dtype([("doc_id", "<i8"), ("is_null", "u1")])
SEEK_TABLE = np.dtype([("stored", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
CHECKSUM_FLAG = 0x80

#: Bytes of text that go to one file, and files at most: beyond 1.6 TB they grow.
FILE_BYTES = 16_000_000
MOST_FILES = 100_000


def _coder(vocabulary: str) -> PieceCache:
    return keep_one(("coder", vocabulary), lambda: _new_coder(vocabulary))


def _new_coder(vocabulary: str) -> PieceCache:
    """Ids of pieces by the tokenizers library.

    Letters with marks after them are the commonest pieces by far. The file's
    normaliser and splitter make two words of such a piece, so they go straight to
    the library's merge model; any other piece goes through its whole chain.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    merge, shown = tokenizer.model.tokenize, printable_bytes()
    direct = _splits_letters_from_marks(tokenizer)

    def merged(word: str) -> list[int]:
        if not word.isascii():
            word = "".join([shown[b] for b in word.encode()])
        return [token.id for token in merge(word)]

    def encode(pieces: list[str]) -> Iterable[list[int]]:
        for piece in pieces:
            word = piece.rstrip(punctuation)
            if direct and word.isalpha() and max(word) < "\u0130":
                ids = merged(word.lower())
                yield ids + merged(piece[len(word):]) if len(word) < len(piece) else ids
            else:
                yield tokenizer.encode(piece, add_special_tokens=False).ids

    return PieceCache(encode)


def _splits_letters_from_marks(tokenizer) -> bool:
    """Whether the tokenizer splits letters and marks apart and drops white space."""
    def encoded(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    probe = [("Ab", "."), ("\u00c9a", "!?"), ("x", "'"), ("a\u00dfo", "&&&")]
    apart = all(encoded(word + marks) == encoded(word.lower()) + encoded(marks) for word, marks in probe)
    if encoded("a b\nc") != encoded("a") + encoded("b") + encoded("c"):
        raise ValueError("this vocabulary's tokenizer does not drop white space")
    return apart


def _encoded(vocabulary: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            # White space is dropped, so line ends part pieces as spaces do.
            ids = encode_texts(pc.replace_substring(batch.column("text"), "\n", " "), _coder(vocabulary))
            bounds = ids.offsets.to_numpy()
            n = len(bounds) - 1
            flat = np.insert(ids.values.to_numpy(), bounds[1:], end_id)
            ends = pa.array(bounds + np.arange(n + 1), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(ends, pa.array(flat, pa.int32()))], ["doc_id", "ids"])

    return run


def encode_documents(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2) -> DataFrame:
    """Each document's id and its token ids with the end id, in the order of ``df``.

    The vocabulary's tokenizer must drop white space, as the word vocabularies do.
    """
    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(_encoded(vocabulary, end_id), "doc_id long, ids array<int>")


def write_token_files(df: DataFrame, folder: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, file_bytes: int = FILE_BYTES) -> None:
    """Encode every document and write the files, in ascending document id.

    Texts are dealt by ranges of the id, about ``file_bytes`` of text to a file; the
    ids are encoded where the sorted texts arrive, so they are never shuffled.
    """
    size = df.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    files = min(MOST_FILES, max(1, -(-size // file_bytes)))
    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # Rows of one id, as of none, are parted by their texts.
    order = ["doc_id", F.xxhash64("text")]
    ordered = slim.repartitionByRange(files, *order).sortWithinPartitions(*order)
    encoded = _encoded(vocabulary, end_id)
    rows = ordered.mapInArrow(lambda batches: _frames(encoded(batches)), "frame binary")
    rows.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SKIPPABLE_GAP.decode()).option("compression", "none").option("maxRecordsPerFile", 0).text(folder)


def _frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compressor = zstandard.ZstdCompressor(level=3, write_checksum=True)
    directory, table = [], []
    for batch in batches:
        lists = batch.column("ids")
        bounds, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        frames = []
        for doc_id, begin, end in zip(batch.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
            ids = flat[begin:end].astype("<u4").tobytes()
            frames.append(compressor.compress(ids))
            directory.append((doc_id or 0, doc_id is None))
            table.append((len(frames[-1]) + len(SKIPPABLE_GAP), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["frame"])
    if table:
        names = _skippable(DIRECTORY_MAGIC, np.array(directory, DIRECTORY).tobytes())
        footer = len(table).to_bytes(4, "little") + bytes([CHECKSUM_FLAG]) + SEEKABLE_FOOTER_MAGIC.to_bytes(4, "little")
        seek = _skippable(SEEK_TABLE_MAGIC, np.array(table, SEEK_TABLE).tobytes() + footer)
        yield pa.RecordBatch.from_arrays([pa.array([names + seek], pa.binary())], ["frame"])


def _skippable(magic: int, content: bytes) -> bytes:
    return magic.to_bytes(4, "little") + len(content).to_bytes(4, "little") + content


def read_directory(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, seek table and frame offsets of one file, from its end alone."""
    end = len(content) - len(SKIPPABLE_GAP)
    if end <= 0:
        return np.empty(0, DIRECTORY), np.empty(0, SEEK_TABLE), np.empty(0, np.int64)
    if int.from_bytes(content[end - 4:end], "little") != SEEKABLE_FOOTER_MAGIC:
        raise ValueError("not a token file: its seek table is missing")
    n = int.from_bytes(content[end - 9:end - 5], "little")
    begin = end - 9 - n * SEEK_TABLE.itemsize
    table = np.frombuffer(content, SEEK_TABLE, n, begin)
    names = np.frombuffer(content, DIRECTORY, n, begin - 8 - n * DIRECTORY.itemsize)
    stored = table["stored"].astype(np.int64)
    return names, table, np.cumsum(stored) - stored


def read_frame(content: bytes, offset: int, entry: np.void, decompressor: zstandard.ZstdDecompressor) -> bytes:
    """The ids of one document; an error if they are not what was written."""
    frame = content[offset:offset + int(entry["stored"]) - len(SKIPPABLE_GAP)]
    ids = decompressor.decompress(frame, max_output_size=int(entry["size"]))
    if len(ids) != entry["size"] or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != entry["checksum"]:
        raise ValueError("a frame does not match its checksum")
    return ids


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def read_documents(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of the documents asked for; other frames stay compressed."""
    wanted = np.array(sorted(doc_ids), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = zstandard.ZstdDecompressor()
        for batch in batches:
            for content in batch.column("content"):
                content = content.as_py()
                names, table, offsets = read_directory(content)
                at = np.flatnonzero(np.isin(names["doc_id"], wanted) & (names["is_null"] == 0))
                ids = [np.frombuffer(read_frame(content, int(offsets[i]), table[i], decompressor), "<u4").astype(np.int64) for i in at]
                yield pa.RecordBatch.from_arrays([pa.array(names["doc_id"][at]), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "ids"])

    return _files(spark, folder).mapInArrow(run, "doc_id long, ids array<long>")


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """For each document in the files: doc_id, start, n_tokens, ids_crc32.

    Counts within a file come from its seek table. The counts of whole files, one
    row each, are all that meets in one task to give the starts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = zstandard.ZstdDecompressor()
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content")):
                content = content.as_py()
                names, table, offsets = read_directory(content)
                n_tokens = table["size"].astype(np.int64) // 4
                crc = [zlib.crc32(read_frame(content, int(o), e, decompressor)) for o, e in zip(offsets, table)]
                columns = [pa.array([file] * len(crc), pa.string()), pa.array(names["doc_id"], mask=names["is_null"] == 1), pa.array(np.cumsum(n_tokens) - n_tokens), pa.array(n_tokens), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["file", "doc_id", "within", "n_tokens", "ids_crc32"])

    rows = cut(_files(spark, folder).mapInArrow(run, "file string, doc_id long, within long, n_tokens long, ids_crc32 long"))
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return rows.join(starts, "file").select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
