"""Operator 12: web archives, each record compressed on its own with one dictionary.

A file is a WARC 1.1 archive in Zstandard frames:

    [dictionary][information][record][record] ... [gap]

* The dictionary stands in a leading skippable frame. It is built once from a bounded
  sample of the records to be archived: the first ``SAMPLE_BYTES`` bytes of up to
  ``SAMPLE_RECORDS`` different payloads, chosen by hash. Records are stored whole.
* Every record is a frame of its own with a checksum, so one record is decompressed
  without the others; ``record_bounds`` walks frames by their headers alone.
* The gap is an empty skippable frame, the row separator of Spark's text writer, which
  commits files on any store. A row is a whole file of about ``FILE_BYTES``, so no file
  outgrows a reader, however large a partition is.

Of records with equal payloads the one with the least page id is the response (ties: the
least url), the others revisit it by its record id and carry no payload. Payloads meet by
digest in an aggregate that combines in every task, so of a payload with very many copies
a task sends one. Revisits are decided on narrow rows without payloads; equal rows are
counted and written out in portions that are dealt over tasks.

Edge cases: a NULL page is an empty payload, and empty payloads are equal to each other.
NULL ids come after all others; an empty url and none differ. Of rows that repeat wholly
one is the response. Too few records for a dictionary give files without one. Control
characters in a url are written percent-encoded. An empty table gives archives without
records. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlake.llm.scratch import drop_folder, new_folder, text_slices

SAMPLE_RECORDS, SAMPLE_BYTES = 1_000, 16_384
DICTIONARY_BYTES = 65_536
LEVEL = 6
FILE_BYTES = 64_000_000
#: Copies of a row that one row stands for until they are written.
PORTION = 1_000

#: Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
GAP = b"P*M\x18\x00\x00\x00\x00"
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


# Records


def _head(fields: list[tuple[str, object]]) -> bytes:
    return VERSION + "".join(f"{name}: {value}\r\n" for name, value in fields).encode() + b"\r\n"


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    return _head([*fields, ("Content-Length", len(block))]) + block + END


def _http(payload_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()


def _urn(*parts: object) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(repr(parts).encode()).digest())}>"


def base32_digest(payload_sha1: str) -> str:
    """The digest as archives write it, from its hex digits."""
    return base64.b32encode(bytes.fromhex(payload_sha1)).decode()


def _plain_url(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in url)


def response_record(date: str, sha1: str, page_id: int | None, url: str | None, copy: int, payload: bytes) -> bytes:
    block = _http(len(payload)) + payload
    return _record([("WARC-Type", "response"), *_common(date, sha1, page_id, url, copy), ("Content-Type", "application/http; msgtype=response")], block)


def revisit_record(date: str, sha1: str, page_id: int | None, url: str | None, copy: int, payload_bytes: int, first_id: int | None, first_url: str | None) -> bytes:
    """A record that holds the headers of its response, and of its payload the digest."""
    refers = [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _urn(sha1, first_id, first_url, 0)), ("WARC-Refers-To-Date", date)]
    if first_url is not None:
        refers.append(("WARC-Refers-To-Target-URI", _plain_url(first_url)))
    if first_id is not None:
        refers.append(("Refers-To-Page-ID", first_id))
    return _record([("WARC-Type", "revisit"), *_common(date, sha1, page_id, url, copy), *refers, ("Content-Type", "application/http; msgtype=response")], _http(payload_bytes))


def _common(date: str, sha1: str, page_id: int | None, url: str | None, copy: int) -> list[tuple[str, object]]:
    fields = [("WARC-Record-ID", _urn(sha1, page_id, url, copy)), ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{base32_digest(sha1)}")]
    if url is not None:
        fields.append(("WARC-Target-URI", _plain_url(url)))
    if page_id is not None:
        fields.append(("Page-ID", page_id))
    return fields


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """The fields of a record and its block; an error if it is not whole."""
    at = record.find(b"\r\n\r\n")
    if not record.startswith(VERSION) or at < 0:
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in record[len(VERSION):at].decode().split("\r\n"))
    block = record[at + 4:-len(END)]
    if record[-len(END):] != END or len(block) != int(fields["Content-Length"]):
        raise ValueError("a record does not have the length it states")
    return fields, block


def payload_of(block: bytes) -> tuple[int, bytes]:
    """The length an HTTP block states for its payload, and what it holds of it."""
    head, _, payload = block.partition(b"\r\n\r\n")
    lengths = [line for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    return int(lengths[0].split(b":")[1]), payload


# Files


def build_dictionary(samples: list[bytes], dictionary_bytes: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of what the samples share, empty if there are too few of them."""
    try:
        return zstandard.train_dictionary(dictionary_bytes, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def _opened(date: str, dictionary: bytes, compressor: zstandard.ZstdCompressor) -> bytearray:
    """The beginning of a file: the dictionary and the record about the archive."""
    opened = bytearray()
    if dictionary:
        opened += DICTIONARY_MAGIC.to_bytes(4, "little") + len(dictionary).to_bytes(4, "little") + dictionary
    about = b"format: WARC File Format 1.1\r\nconformsTo: http://iipc.github.io/warc-specifications/specifications/warc-format/warc-1.1/\r\n"
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _urn("warcinfo", date)), ("WARC-Date", date), ("Content-Type", "application/warc-fields")]
    return opened + compressor.compress(_record(fields, about))


def _codec(kind: type, dictionary: bytes, **options: object):
    return kind(dict_data=zstandard.ZstdCompressionDict(dictionary), **options) if dictionary else kind(**options)


def record_bounds(content: bytes) -> list[tuple[int, int]]:
    """Where each record's frame begins and ends, read from frame and block headers."""
    bounds, at = [], 0
    while at < len(content):
        begin, magic = at, int.from_bytes(content[at:at + 4], "little")
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            at += 8 + int.from_bytes(content[at + 4:at + 8], "little")
            continue
        head = content[at:at + 18]
        at += zstandard.frame_header_size(head)
        last = False
        while not last:
            block = int.from_bytes(content[at:at + 3], "little")
            last, kind = bool(block & 1), block >> 1 & 3
            at += 3 + (1 if kind == 1 else block >> 3)  # a run of one byte is stored as that byte
        at += 4 if zstandard.get_frame_parameters(head).has_checksum else 0
        bounds.append((begin, at))
    return bounds


def read_dictionary(content: bytes) -> bytes:
    """The dictionary a file begins with, empty if it has none."""
    if int.from_bytes(content[:4], "little") != DICTIONARY_MAGIC:
        return b""
    return content[8:8 + int.from_bytes(content[4:8], "little")]


def read_record(content: bytes, begin: int, end: int, decompressor: zstandard.ZstdDecompressor | None = None) -> tuple[dict[str, str], bytes]:
    """One record of a file; no other frame is decompressed."""
    decompressor = decompressor or _codec(zstandard.ZstdDecompressor, read_dictionary(content))
    return parse_record(decompressor.decompress(content[begin:end]))


# Tables


def _payload_rows(df: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    return rows.withColumns({"sha1": F.sha1("html"), "payload_bytes": F.octet_length("html").cast("long")})


def _order(page_id: str = "page_id", url: str = "url") -> list[Column]:
    """Fields whose order puts NULLs last."""
    return [F.isnull(page_id).alias("no_id"), F.col(page_id).alias("page_id"), F.isnull(url).alias("no_url"), F.col(url).alias("url")]


def narrow_rows(rows: DataFrame, sample_records: int = SAMPLE_RECORDS, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """Rows without payloads, equal ones counted: sha1, payload_bytes, page_id, url, copies,
    and of some rows, by their hash, the ``head`` of the payload as a sample.

    About four times the sample is taken, so that enough differ.
    """
    share = min(1.0, 4.0 * sample_records / max(1, rows.count()))
    bound = min(2**63 - 1, int(-(2**63) + share * 2**64))
    head = F.substring(F.col("html").cast("binary"), 1, sample_bytes)
    sampled = rows.withColumn("head", F.when(F.xxhash64("sha1", "page_id", "url") <= bound, head))
    return sampled.groupBy("sha1", "payload_bytes", "page_id", "url").agg(F.count("*").alias("copies"), F.max("head").alias("head"))


def plan_records(rows: DataFrame, narrow: DataFrame, least_bytes: int = 0) -> DataFrame:
    """One row for each record: is_response, sha1, payload_bytes, page_id, url, copy, html
    (of a response) and first_id, first_url (of a revisit's response)."""
    by_payload = ["sha1", "payload_bytes"]
    is_equal = F.col("payload_bytes") >= least_bytes
    none = [F.lit(None).cast("long").alias("first_id"), F.lit(None).cast("string").alias("first_url")]
    first = rows.where(is_equal).groupBy(*by_payload).agg(F.min(F.struct(*_order(), "html")).alias("first"))
    responses = first.select(F.lit(True).alias("is_response"), *by_payload, "first.page_id", "first.url", F.lit(0).cast("long").alias("copy"), "first.html", *none)

    # The same minimum over narrow rows, so that payloads do not pass through a join.
    copies = narrow.drop("head").where(is_equal)
    least = copies.groupBy(*by_payload).agg(F.min(F.struct(*_order())).alias("first"), F.sum("copies").alias("n"))
    least = least.where("n > 1").select(*by_payload, F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"))
    met = copies.join(least, by_payload)
    is_first = F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url"))
    revisits = _written_out(met.withColumn("from", is_first.cast("long")), "sha1", "payload_bytes", "page_id", "url")
    revisits = revisits.select(F.lit(False).alias("is_response"), *by_payload, "page_id", "url", "copy", F.lit("").alias("html"), "first_id", "first_url")

    records = responses.unionByName(revisits)
    if least_bytes > 0:
        small = rows.where(~is_equal).groupBy(*by_payload, "page_id", "url", "html").agg(F.count("*").alias("copies"))
        small = _written_out(small.withColumn("from", F.lit(0).cast("long")), "sha1", "page_id", "url")
        records = records.unionByName(small.select(F.lit(True).alias("is_response"), *by_payload, "page_id", "url", "copy", "html", *none))
    return records


def _written_out(rows: DataFrame, *keys: str) -> DataFrame:
    """A row for each of ``copies`` rows from number ``from`` on, dealt over tasks."""
    portions = rows.where("copies > from").withColumn("portion", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / PORTION))))
    low = F.greatest(F.col("from"), F.col("portion") * PORTION)
    high = F.least(F.col("copies") - 1, F.col("portion") * PORTION + PORTION - 1)
    return portions.repartition(*keys, "portion").where(low <= high).withColumn("copy", F.explode(F.sequence(low, high)))


def write_warc(df: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", file_bytes: int = FILE_BYTES) -> None:
    """Write every row as a record. Payloads under ``least_bytes`` are never revisited;
    ``date`` is the time of the archive, a parameter so that reruns agree.

    Pages are read twice: for narrow rows and the sample, then to be written.
    """
    spark = df.sparkSession
    rows = _payload_rows(df, id_col, url_col, html_col)
    scratch = new_folder(spark, "warc-rows")
    narrow_rows(rows).write.parquet(scratch)
    narrow = spark.read.parquet(scratch)
    heads = narrow.where(F.col("head").isNotNull()).groupBy("sha1", "payload_bytes").agg(F.max("head").alias("head"))
    sample = heads.orderBy(F.xxhash64("sha1"), "sha1").limit(SAMPLE_RECORDS).collect()
    dictionary = build_dictionary([_http(row["payload_bytes"]) + bytes(row["head"]) for row in sample])
    files = plan_records(rows, narrow, least_bytes).mapInArrow(_packed(date, dictionary, file_bytes), "file binary")
    files.select(F.col("file").cast("string").alias("value")).write.option("lineSep", GAP.decode()).option("compression", "none").option("maxRecordsPerFile", 1).text(folder)
    drop_folder(spark, scratch)


def _packed(date: str, dictionary: bytes, file_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = _codec(zstandard.ZstdCompressor, dictionary, level=LEVEL, write_checksum=True)
        opened, file = _opened(date, dictionary, compressor), None
        for batch in text_slices(batches, "html"):
            for row in batch.to_pylist():
                file = bytearray(opened) if file is None else file
                named = (date, row["sha1"], row["page_id"], row["url"], row["copy"])
                if row["is_response"]:
                    record = response_record(*named, row["html"].encode())
                else:
                    record = revisit_record(*named, row["payload_bytes"], row["first_id"], row["first_url"])
                file += compressor.compress(record)
                if len(file) >= file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([bytes(file)], pa.binary())], ["file"])
                    file = None
        if file is not None:
            yield pa.RecordBatch.from_arrays([pa.array([bytes(file)], pa.binary())], ["file"])

    return run


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each record of the archives: page_id, payload_bytes, payload_digest,
    record_type, refers_to, and the file, offset and length of its frame. Digests and
    lengths of responses are worked out again from their payloads and compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                content = content.as_py()
                decompressor = _codec(zstandard.ZstdDecompressor, read_dictionary(content))
                found = [(*described, path, begin, end - begin) for begin, end in record_bounds(content) if (described := _described(*read_record(content, begin, end, decompressor)))]
                yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(list(zip(*found)) or [[]] * len(INDEX), INDEX.types)], schema=INDEX)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")
    return files.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, file string, offset long, length long")


INDEX = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def _described(fields: dict[str, str], block: bytes) -> tuple | None:
    kind = fields["WARC-Type"]
    if kind == "warcinfo":
        return None
    n, payload = payload_of(block)
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != n or base32_digest(hashlib.sha1(payload).hexdigest()) != digest):
        raise ValueError("a payload is not what its record says")
    number = lambda name: int(fields[name]) if name in fields else None
    return number("Page-ID"), n, digest, kind, number("Refers-To-Page-ID")
