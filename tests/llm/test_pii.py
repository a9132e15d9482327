"""Personal data: base spans by the patterns, what the trees add, redaction."""

import hashlib

from llm_support import SMALL, shipped  # noqa: F401

import pytest

from viewlake.llm import boosting, pii
from viewlake.llm.queries import QUERIES

LIMITS = {"ip": lambda m: max(map(int, m.split("."))) <= 255, "email": lambda m: True}


def plain_base(text):
    """The contract's wording, step by step."""
    found = []
    for order, kind in enumerate(pii.KINDS):
        at = 0
        while match := pii.BASE[kind].search(text, at):
            digits = [int(c) for c in match[0] if c.isdigit()]
            doubled = [sum(divmod(2 * d, 10)) for d in digits[-2::-2]]
            good = {"email": True, "ip": kind == "ip" and max(map(int, match[0].split("."))) <= 255, "card": 12 <= len(digits) <= 19 and (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                found.append((match.start(), order, match.end()))
            at = match.end()
    return [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(found)]


def test_query_equals_the_patterns(spark):
    docs = dict(tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    for row in QUERIES["op2_pii"](spark, SMALL).collect():
        want = plain_base(docs[row["doc_id"]] or "")
        assert row["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(w.startswith(k) for w in want) for k in pii.KINDS]
        assert set(want) <= set(row["spans"].split(",")) | {""}


def trained():
    texts = []
    for i in range(300):
        card = f"4{i:03d}56789012{i % 90:03d}"
        card += next(d for d in "0123456789" if pii.luhn(card + d))
        texts.append(f"call +1 ({200 + i}) 555-{1000 + i} now, pay {card} or mail user.{i}@mail{i % 7}.example.com from 10.{i % 250}.3.4 ok version 4.0. order {i * 7919}")
    return pii.Model(texts)


def test_added_spans_stay_off_base_spans():
    model = trained()
    card = next(c for c in (f"404189497460{i:04d}" for i in range(100)) if pii.luhn(c))
    text = f"aa bb +1 (855) 555-4208 {card} an"
    base = pii.base_spans(text)
    assert base == []  # the patterns take both numbers as one and give up
    added = {(text[s:e], k) for s, e, k in model.added(text, base)}
    assert (card, "card") in added and ("+1 (855) 555-4208", "phone") in added
    for clean in ("nothing here", "version 4.0. and 12 apples in 2024", "token = 6d2ca8cc795e02fe1cd4d42fcf2aa517"):
        assert pii.spans_of(clean, model) == []


def test_redaction(spark):
    rows = [(1, "mail a.b@c.de now", "k"), (2, None, None), (3, "", "k"), (4, "no data", "k"), (None, "ip 1.2.3.4, 300.1.1.1", "k"), (5, "x@y.zz " * 20_000, "k"), (1, "mail a.b@c.de now", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted(map(tuple, pii.redact(df).collect()), key=str)
    want = [(1, "mail [EMAIL] now", "k"), (2, None, None), (3, "", "k"), (4, "no data", "k"), (None, "ip [IP], 300.1.1.1", "k"), (5, "[EMAIL] " * 20_000, "k"), (1, "mail [EMAIL] now", "k")]
    assert got == sorted(want, key=str)
    found = {r["doc_id"]: r["spans"] for r in pii.find_pii(df.where("doc_id > 1")).collect()}
    assert found[2] == [] and len(found[5]) == 20_000


def test_written_out_address_without_a_digit(spark):
    rows = [(1, "Ask jane(at)example.org for it"), (2, "ask (at) once"), (3, "no data")]
    got = dict(pii.redact(spark.createDataFrame(rows, "doc_id long, text string"), trained()).collect())
    assert got == {1: "Ask [EMAIL] for it", 2: "ask (at) once", 3: "no data"}
    long = spark.createDataFrame([(1, "word " * 4000 + "jane [AT] example [dot] com"), (2, "no data")], "doc_id long, text string")
    (passage,) = pii.draw_sample(long)
    assert passage.endswith("jane [AT] example [dot] com")
    for text in ("a [at] b.c", "a[At]b.c", "a( at )b.c", "a@b.c", "1.2.3.4"):
        assert any(pii.candidates(text).values()) and pii.re.search(pii.ABLE, text)


def test_overlapping_spans_are_put_out_together():
    spans = [{"kind": "ip", "start": 2, "end": 6}, {"kind": "card", "start": 4, "end": 9}]
    assert pii.redacted("ab1234567xyz", spans) == "ab[IP]xyz"


def test_a_span_that_reaches_far_is_met():
    email = "a" + "".join(f".1.2.3.{i}" for i in range(12)) + "@example.org"
    base = [(s, e) for s, e, _ in pii.base_spans(email)]
    taken = pii.Taken(base)
    assert len(base) > 9 and taken.meets((len(email) - 4, len(email) - 1))
    for span in [(a, b) for a in range(0, len(email) + 4, 3) for b in range(a + 1, len(email) + 6, 5)]:
        assert taken.meets(span) == any(s < span[1] and span[0] < e for s, e in base)
    assert not pii.Taken([]).meets((0, 5))


def test_long_names_are_taken_whole():
    name = "n" * 5000
    (span,) = pii.candidates(f"to {name} [at] {name}.org now")["email"]
    assert span == (3, 3 + 5000 + 6 + 5004)
    assert pii.candidates("x" * 200_000 + " (at) ")["email"] == set()


def test_candidates_with_equal_scores(monkeypatch):
    model = trained()

    class Same:
        def predict(self, x):
            return pii.np.full(len(x), 0.9)

    model.trees = {"phone": (Same(), 0.5), "card": (Same(), 0.5)}
    text = "1234 5678 9012 3456"
    found = model.added(text, [])
    assert found == model.added(text, []) and found[0][0] == 0
    assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))


def test_empty_table(spark):
    assert pii.find_pii(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def numbered(i):
    card = f"4{i:03d}56789012{i % 90:03d}"
    card += next(d for d in "0123456789" if pii.luhn(card + d))
    return f"call +1 ({200 + i}) 555-{1000 + i} now, pay {card} by the 3rd, order {i * 7919} of 12 items"


def learned(model):
    return {kind: (trees.start, trees.weight, [([(f.tolist(), p.tolist()) for f, p in splits], leaves.tolist()) for splits, leaves in trees.trees], threshold) for kind, (trees, threshold) in model.trees.items()}


def test_learns_from_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(boosting, "TREES", 15)
    rows = [(i, "7 " + "word " * 1000 + numbered(i)) for i in range(90)]
    cards = [c for c in (f"404189497460{i:04d}" for i in range(100)) if pii.luhn(c)]
    rows.append((-1, f"call now, pay {cards[0]} {cards[1]} by the 3rd"))
    got = {r["doc_id"]: r["spans"] for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    added = {(s["kind"], s["start"]) for s in got[-1] if not s["is_base"]}
    assert added and added <= {("card", 14), ("card", 31)}


def test_learns_from_every_text_once(spark, monkeypatch):
    monkeypatch.setattr(boosting, "TREES", 2)
    texts = [numbered(i) for i in range(1200)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    seen = []
    monkeypatch.setattr(boosting.SparkExamples, "__init__", lambda self, counted, start=boosting.SparkExamples.__init__: seen.append(counted) or start(self, counted))
    model = pii.learn(df.repartition(3))
    want = pii.Counter()
    for text in texts:
        want.update(pii._counted(text))
    got = pii.Counter()
    for row in seen[0].collect():
        got[row["kind"], bytes(row["levels"]), row["positive"]] += row["n"]
    assert got == want and set(model.trees) == {"card", "phone"}
    # Neither copies nor another division of the rows change anything.
    monkeypatch.setattr(boosting, "TASK_ROWS", 500)
    assert learned(pii.learn(df.union(df).union(df).repartition(7))) == learned(model)
    # Sums over all rows make the same trees here and in Spark.
    split = [{r["text"] for r in df.where(f"pmod(xxhash64(text), 3) {sign} 0").collect()} for sign in ("=", "<>")]
    blocks = []
    for held, of in zip((True, False), split):
        for text in of:
            for (kind, levels, positive), n in pii._counted(text).items():
                blocks.append((kind, boosting.Block(*map(pii.np.array, ([pii.np.frombuffer(levels, "<i2")], [positive], [held], [n])))))
    assert learned(pii.Model(examples=boosting.LocalExamples(blocks))) == learned(model)


def test_levels_and_features():
    x = pii.np.array([[-2, -1, 0, 256, 257, 512, 513, 1e12]])
    assert boosting.levels_of(x).tolist() == [[0, 0, 1, 257, 258, 258, 259, boosting.CELLS - 1]]
    text = numbered(5)
    for kind, spans in pii.candidates(text).items():
        assert all(len(pii.features(text, kind, s)) == pii.N_FEATURES for s in spans)
    assert pii._counted(text) == pii._counted(text) and not pii._counted("no data")


@pytest.mark.parametrize("text", ["", "x", "+1 (855) 555-4208", "1.2.3.4", "a@b.c", "1.2.3.4@b.c " * 3])
def test_examples_of_short_texts(text):
    assert all(levels and n > 0 for (_, levels, _), n in pii._counted(text).items())
