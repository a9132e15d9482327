"""Web archives: SQL parity, round trips through frames, awkward rows."""

import base64
import glob
import hashlib
import io

import parity
import pytest
import zstandard
from llm_support import SMALL, shipped  # noqa: F401

from viewlake.llm import warc
from viewlake.llm.queries import ORACLES, QUERIES

PAGES = [
    (3, "http://a/3", "<p>one</p>"), (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>two</p>"), (4, None, "<p>one</p>"),
    (5, "http://a/5", None), (6, "", ""), (None, "http://a/none", "<p>two</p>"), (None, "http://a/alone", "<p>x</p>"),
    (7, "http://a/\r\nEvil: 1", "<p>ünï</p>\r\n\r\nWARC/1.1\r\n"), (8, "http://a/8", "long " * 200_000),
    *[(9, "http://a/9", "<p>nine</p>")] * 12, (9, "http://a/0", "<p>nine</p>"),
]


def archive(spark, tmp_path, rows, **how):
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, sha1 string")
    folder = str(tmp_path / "warc")
    warc.write_warc(df, folder, **how)
    return folder


def expected(rows, least=0):
    """(page_id, bytes, digest, type, refers_to) as the contract says, sorted."""
    found, seen = [], set()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    first = {}
    for row in sorted(rows, key=key):
        first.setdefault((row[2] or "").encode(), row[0])
    for row in sorted(rows, key=key):
        payload = (row[2] or "").encode()
        again = payload in seen and len(payload) >= least
        seen.add(payload)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        found.append((row[0], len(payload), digest, "revisit" if again else "response", first[payload] if again else None))
    return sorted(found, key=str)


def read(spark, folder):
    index = warc.read_index(spark, folder)
    return sorted((tuple(r) for r in index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def contents(folder):
    return [open(f, "rb").read() for f in glob.glob(f"{folder}/part-*")]


def test_query_equals_sql(spark):
    con = parity.connect(SMALL)
    assert parity.difference(QUERIES["op12_warc"](spark, SMALL), con, ORACLES["op12_warc"]) is None


@pytest.mark.parametrize("least", [0, 11, 10_000_000])
def test_records_read_back(spark, tmp_path, monkeypatch, least):
    monkeypatch.setattr(warc, "PORTION", 5)
    folder = archive(spark, tmp_path, PAGES, least_bytes=least)
    assert read(spark, folder) == expected(PAGES, least)


def test_records_are_whole_and_ids_differ(spark, tmp_path):
    folder = archive(spark, tmp_path, PAGES)
    records = [warc.read_record(c, *bounds) for c in contents(folder) for bounds in warc.record_bounds(c)]
    pages = [(fields, block) for fields, block in records if fields["WARC-Type"] != "warcinfo"]
    ids = [fields["WARC-Record-ID"] for fields, _ in pages]
    assert len(pages) == len(set(ids)) == len(PAGES)
    payloads = {warc.payload_of(block)[1].decode() for fields, block in pages if fields["WARC-Type"] == "response"}
    assert payloads == {html or "" for _, _, html in PAGES}
    responses = {fields["WARC-Record-ID"] for fields, _ in pages if fields["WARC-Type"] == "response"}
    revisits = [fields for fields, _ in pages if fields["WARC-Type"] == "revisit"]
    assert revisits and all(fields["WARC-Refers-To"] in responses for fields in revisits)
    assert not any("Evil" in fields for fields, _ in pages)


def many_pages(n=400):
    return [(i, f"http://a/{i}", f"<html><head><title>Page {i}</title></head><body><p>{hashlib.md5(str(i).encode()).hexdigest() * (i % 7)}</p></body></html>") for i in range(n)]


def test_every_file_begins_with_the_dictionary(spark, tmp_path):
    folder = archive(spark, tmp_path, many_pages(), file_bytes=6_000)
    files = contents(folder)
    assert len(files) > 4 and len({warc.read_dictionary(c) for c in files}) == 1
    dictionary = warc.read_dictionary(files[0])
    assert dictionary[:4] == bytes.fromhex("37a430ec")  # the magic number of dictionaries
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    for content in files:
        # Any reader that is given the dictionary sees one archive after the other.
        whole = decompressor.stream_reader(io.BytesIO(content[8 + len(dictionary):]), read_across_frames=True).read()
        single = b"".join(decompressor.decompress(content[a:b]) for a, b in warc.record_bounds(content))
        assert whole == single and whole.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    assert read(spark, folder) == expected(many_pages())


def test_dictionary_makes_records_smaller():
    pages = [warc.response_record("d", "00", i, url, 0, html.encode()) for i, url, html in many_pages()]
    dictionary = zstandard.ZstdCompressionDict(warc.build_dictionary(pages[:200], 4_096))
    plain, helped = zstandard.ZstdCompressor(level=6), zstandard.ZstdCompressor(level=6, dict_data=dictionary)
    assert sum(len(helped.compress(p)) for p in pages[200:]) < 0.7 * sum(len(plain.compress(p)) for p in pages[200:])


def test_damage_is_noticed(spark, tmp_path):
    folder = archive(spark, tmp_path, PAGES)
    content = max(contents(folder), key=len)
    begin, end = warc.record_bounds(content)[-1]
    broken = bytearray(content)
    broken[end - 6] ^= 1
    with pytest.raises((zstandard.ZstdError, ValueError)):
        warc.read_record(bytes(broken), begin, end)


def test_empty_table(spark, tmp_path):
    folder = archive(spark, tmp_path, [])
    assert read(spark, folder) == []
