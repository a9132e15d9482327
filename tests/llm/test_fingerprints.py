"""Fingerprints against hashes worked out in Python."""

import hashlib
import re

import xxhash
from llm_support import SMALL, shipped  # noqa: F401
from pyspark.sql import functions as F

from viewlake.llm import fingerprints as prints
from viewlake.llm.queries import QUERIES


def brute_hashes(text, scale=prints.SCALE):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    hashes = set()
    for at in range(max(1, len(words) - 4) if words else 0):
        seed = 42
        for word in words[at:at + 5]:
            seed = xxhash.xxh64_intdigest(word.encode(), seed)
        hashes.add(seed - 2**64 if seed >= 2**63 else seed)
    low = sorted(h for h in hashes if h < -(2**63) + 2**64 // scale)
    return low or sorted(hashes)[:1]


def shown(hashes):
    return "".join(f"{h % 2**64:016X}" for h in hashes)


def likeness(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0


def expected(rows):
    """From (doc_id, text) rows with different ids."""
    rows = sorted(((i, t or "") for i, t in rows), reverse=True)
    found = {}
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        own, other, after = map(brute_hashes, (text, edited, following))
        found[doc_id] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), shown(own), shown(other), likeness(own, other), likeness(own, after))
    return found


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op10_fingerprints"](spark, SMALL).collect()}
    assert got == expected(rows)


def test_many_buckets_give_the_same_neighbours(spark, monkeypatch):
    monkeypatch.setattr(prints, "BUCKET_BYTES", 9)
    texts = [(i * i, "word " * (i % 7) + str(i)) for i in range(60)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    made = prints.compare_with_edit(df)
    want = expected(texts)
    for row in made.collect():
        assert hashlib.sha256(row["edited"].encode()).hexdigest() == want[row["doc_id"]][1]
    assert made.count() == 60


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(prints, "BUCKET_BYTES", 8)
    rows = [(None, "a b"), (2, None), (2, ""), (5, "same text"), (5, "same text"), (9, "x" * 5000), (None, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, bucket int")
    made = prints.compare_with_edit(df).collect()
    assert len(made) == len(rows)
    lengths = sorted((r["doc_id"] or -1, r["n_chars"]) for r in made)
    assert lengths == sorted((i or -1, len(t or "")) for i, t in rows)
    by_text = {r["n_chars"]: r["hashes"] for r in made}
    assert by_text[0] == [] and len(by_text[3]) == 1
    same = [r for r in made if r["doc_id"] == 5]
    assert same[0]["hashes"] == same[1]["hashes"]


def test_single_row_is_its_own_next(spark):
    row = prints.compare_with_edit(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).first()
    assert row["edited"] == "abcabc" and row["next_hashes"] == row["hashes"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert prints.compare_with_edit(df).count() == 0


def test_merge_and_containment(spark):
    long, part = " ".join(f"w{i}" for i in range(900)), " ".join(f"w{i}" for i in range(300))
    df = spark.createDataFrame([(1, long), (2, part)], "doc_id long, text string")
    hashed = {r["doc_id"]: r["hashes"] for r in prints.fingerprint(df).collect()}
    frame = spark.createDataFrame([(hashed[1], hashed[2])], "a array<long>, b array<long>")
    row = frame.select(prints.containment(F.col("b"), F.col("a")).alias("c"), prints.merged(F.col("a"), F.col("b")).alias("m")).first()
    assert row["c"] == 1.0 and row["m"] == hashed[1]


def test_main_path_runs_no_python(spark):
    plan = QUERIES["op10_fingerprints"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
