"""The join against all pairs by brute force."""

import random
import re

from llm_support import SMALL, shipped  # noqa: F401

from viewlake.llm import jaccard
from viewlake.llm.queries import QUERIES


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_force(rows):
    """(doc_id, class_id, n_links) of rows with different ids."""
    sets = {i: shingles(t) for i, t in rows}
    parent, links = {i: i for i in sets}, dict.fromkeys(sets, 0)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for at, a in enumerate(ids):
        for b in ids[at + 1:]:
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {(i, find(i), links[i]) for i in ids}


def corpus(seed, groups=12, copies=30):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    common = [rng.choice(words) for _ in range(30)]
    texts = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.randrange(5, 120))] + common
        for _ in range(rng.randrange(1, copies)):
            made = list(base)
            for _ in range(rng.randrange(0, 4)):
                made[rng.randrange(len(made))] = rng.choice(words)
            texts.append(" ".join(made))
    return list(enumerate(texts))


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert {tuple(r) for r in QUERIES["op3_jaccard_join"](spark, SMALL).collect()} == brute_force(rows)


def test_groups_larger_than_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    monkeypatch.setattr(jaccard, "HALF", 4)
    rows = corpus(3)
    got = {tuple(r) for r in jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_force(rows)


def test_odd_rows(spark):
    long = " ".join(f"t{i}" for i in range(20_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "one  two"), (6, "one two"), (6, "one two"), (None, "one two"), (7, long), (8, long + " end"), (None, None)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, key string, id int")
    got = sorted((tuple(r) for r in jaccard.jaccard_join(df).collect()), key=str)
    want = [(1, 1, 0), (2, 2, 0), (3, 3, 0), *[(i, 4, 4) for i in (4, 5, 6, 6, None)], (7, 7, 1), (8, 7, 1), (None, None, 0)]
    assert got == sorted(want, key=str)
    kept = jaccard.keep_one_per_class(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "2", "3", "4", "7", "None"])


def test_empty_table(spark):
    assert jaccard.jaccard_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_recall_reaches_the_target():
    assert jaccard.recall(jaccard.runs_needed()) >= jaccard.TARGET_RECALL > jaccard.recall(jaccard.runs_needed() - 1)
