"""Byte pairs against the tokenizers library, and the exact round trip."""

import hashlib

import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_support import SMALL, shipped  # noqa: F401
from tokenizers import Tokenizer

from viewlake.llm import bpe
from viewlake.llm.queries import BYTE_VOCABULARY, QUERIES

PATH = public_tokenizers.path(BYTE_VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)
ODD = ["", "a  b", "x \n\n y  ", " lead", "tab\t x", "\x1cfoo \x85 bar\xa0baz", "<|endoftext|>hi <|endoftext|>", "don't we'll  IT'S", "日本語 123 ½", "  ", "a   b", "a \n b", "a  \n", "🙂🙂 a🙂", "zz" * 2000]


def test_query_equals_the_library(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for doc_id, text in docs:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        want[doc_id] = (len(ids), digest(",".join(map(str, ids))), digest(LIBRARY.decode(ids, skip_special_tokens=False)))
    assert {r[0]: tuple(r[1:]) for r in QUERIES["op8_bpe"](spark, SMALL).collect()} == want


def test_odd_texts_and_nulls(spark):
    rows = [(i, t, i) for i, t in enumerate([*ODD, None, ODD[1], ODD[1]])] + [(None, "x", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    encoded = bpe.encode(df, PATH)
    got = {r["doc_id"]: r["ids"] for r in encoded.collect()}
    assert got == {i: LIBRARY.encode(t or "", add_special_tokens=False).ids for i, t, _ in rows}
    back = {r["doc_id"]: r["text"] for r in bpe.decode(encoded, PATH).collect()}
    assert back == {i: t or "" for i, t, _ in rows}


def test_broken_bytes_and_null_lists_decode(spark):
    coded = bpe.load(PATH)
    lone = coded.byte_ids[0xE2]
    df = spark.createDataFrame([(1, [lone]), (2, None), (3, [])], "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["text"] for r in bpe.decode(df, PATH).collect()}
    assert got == {1: "�", 2: "", 3: ""}


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert bpe.load(PATH).encode_batch(pa.array([text, "a " + text])).to_pylist() == [LIBRARY.encode(t, add_special_tokens=False).ids for t in (text, "a " + text)]


def test_small_cache_forgets_and_stays_right():
    coded = bpe.Bpe(PATH)
    coded._pieces._limit = coded._cached = 3
    texts = [f"word{i} and more{i % 5}" for i in range(40)] * 2
    for at in range(0, 80, 8):
        part = texts[at:at + 8]
        assert coded.encode_batch(pa.array(part)).to_pylist() == [LIBRARY.encode(t).ids for t in part]
    assert len(coded._pieces._old) < 40


def test_texts_without_spaces_do_not_fill_the_cache():
    coded = bpe.Bpe(PATH)
    coded._pieces._most_bytes = 2_000
    texts = ["".join(chr(0x4E00 + (7 * i + j) % 900) for j in range(300)) for i in range(30)] + [f"短{i}" for i in range(300)]
    for at in range(0, len(texts), 15):
        part = texts[at:at + 15]
        assert coded.encode_batch(pa.array(part)).to_pylist() == [LIBRARY.encode(t).ids for t in part]
        held = [len(p) + len(i) for cache in (coded._pieces._young, coded._pieces._old) for p, i in cache.items()]
        assert sum(held) < 8_000 and all(len(p) <= 64 for p in coded._pieces._young)


def test_empty_table(spark):
    assert bpe.round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
