"""Importance resampling: SQL parity, brute force over runs of words, awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import parity
import pyarrow as pa
import pytest
from llm_support import SMALL, shipped  # noqa: F401

from viewlake.llm import resampling
from viewlake.llm.queries import ORACLES, QUERIES

TEXTS = ["Hello, World über ÄB x9 x9", "", None, "a b c d", "!!", "日本 語 a", "\x00tab\tnew\nline nbsp", "z" * 100 + " " + "q" * 64 + " a"]


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def features_of(text, most_words):
    words = words_of(text)
    return [zlib.crc32(" ".join(words[i:i + n]).encode()) for n in range(1, most_words + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, percent, least_words, most_words, buckets):
    raw = Counter(f % buckets for _, text in rows for f in features_of(text, most_words))
    wanted = Counter(f % buckets for text in target for f in features_of(text, most_words))
    s, t = sum(raw.values()), sum(wanted.values())
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets))))
    scored = []
    for doc_id, text in rows:
        features = features_of(text, most_words)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(f % buckets) for f in features)
        scored.append([doc_id, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words_of(text))])
    able = sorted((r for r in scored if r[5] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[:percent * len(able) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in scored), key=str)


def test_query_equals_sql(spark):
    con = parity.connect(SMALL)
    assert parity.difference(QUERIES["op13_resampling"](spark, SMALL), con, ORACLES["op13_resampling"]) is None


@pytest.mark.parametrize("most_words", [1, 2, 4])
@pytest.mark.parametrize("most_known", [0, 3, 1000])
def test_payloads_compose_to_the_crc_of_each_run(monkeypatch, most_words, most_known):
    monkeypatch.setattr(resampling, "LEAST_NEW_WORDS", 2)
    scanner = resampling.WordScanner(most_known)
    for _ in range(3):  # nothing known, some words known, all that may be known
        line, begins = resampling._plain_texts(pa.array([t or "" for t in TEXTS]))
        crc, lengths, starts = scanner.scan(line)
        features, ends = resampling.run_crcs(crc, lengths, np.searchsorted(starts, begins), most_words)
        for i, text in enumerate(TEXTS):
            assert sorted(features[ends[i]:ends[i + 1]].tolist()) == sorted(features_of(text, most_words))


@pytest.mark.parametrize("most_words", [1, 3])
def test_equals_brute_force(spark, most_words):
    rng = np.random.default_rng(3)
    rows = [(int(i), " ".join(f"w{w}" for w in rng.zipf(1.6, rng.integers(0, 60)) % 500)) for i in range(300)]
    rows += [(None, t) for t in TEXTS] + [(7, "same words here")] * 40 + [(900 + i, "same words here") for i in range(40)]
    target = ["w1 w2 w3 here", None, "", "w7 words"]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, rank string, weight int")
    aims = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(df, aims, percent=30, least_words=3, most_words=most_words, buckets=97)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, target, 30, 3, most_words, 97)


def test_ranks_cross_partitions(spark):
    rows = [(i, f"{'a ' * (i % 50)}") for i in range(5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = resampling.resample(df, df.limit(10), percent=100, least_words=1).where("rank IS NOT NULL").orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 4901))
    assert [(-r["score"], r["doc_id"]) for r in got] == sorted((-r["score"], r["doc_id"]) for r in got)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert resampling.resample(none, some).count() == 0
    rows = resampling.resample(some, none, least_words=1, percent=100).orderBy("doc_id").collect()
    assert [(r["n_features"], r["rank"]) for r in rows] == [(2, 1), (0, None)]
    assert rows[1]["weight"] == 0
