"""Operator 2: personal data by candidate gradient boosting.

Rules find base spans, which always stay. Generators of high recall propose further,
overlapping spans: every run of digit groups that could be a card or phone, also inside
longer runs that the rules give up on, dotted numbers, and written-out email addresses.
Boosted trees score a candidate by its format and context; it is added if the score
reaches the threshold of its kind and nothing better or base overlaps it.

The trees learn from the rules: in every whole text, copies of a text counting once, base
spans and copies of them in changed formats and company are positive, other candidates
negative. Equal examples are counted in Spark and the trees grow from sums over all of
them. A third of the texts, by hash, is held out to set the thresholds: the lowest step of
the score from which ``PRECISION`` of the candidates are positive. A kind with too few
examples adds nothing.

Only texts with a digit, an at sign or a written-out one go through the patterns, as every
span holds one of them. Texts are read twice, to learn and to find, and never shuffled:
only the examples' levels are.

Edge cases: a NULL or empty text has no span. Positions are code points, ends exclusive.
Spans with one start stand by kind as in ``KINDS``; of candidates with equal scores that
overlap the one that starts first is taken, then the longer. Repeated rows are rows of their own.
An empty table gives an empty table. Other columns are not read by ``find_pii`` and pass
through ``redact`` unchanged.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlake.llm.boosting import STEPS, Block, BoostedTrees, Examples, LocalExamples, SparkExamples, boost, class_counts, levels_of
from viewlake.llm.scratch import text_slices

KINDS = ("email", "ip", "card", "phone")
#: The base patterns.
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
SAMPLE_TEXTS = 1000
SAMPLE_CHARS = 4000
PRECISION = 0.95
LEAST_EXAMPLES = 20
N_FEATURES = 25
#: Rows of examples a task hands over at once.
BATCH_ROWS = 10_000

GROUPS = re.compile(r"[0-9]+(?:[ .-][0-9]+)*")
PHONE_RUN = re.compile(r"(?:\+|\b00)?\(?[0-9][ ().0-9-]*[0-9]")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3,}")
#: Names are taken whole, from where they begin, so a long one costs no more than its length.
WRITTEN = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?[\[(] ?at ?[\])] ?|@)[A-Za-z0-9-]++(?:(?: ?[\[(] ?dot ?[\])] ?|\.)[A-Za-z0-9-]++)+", re.I)
DIGITS = re.compile(r"[0-9]+")
#: What every match of a base pattern or generator holds, for Java, RE2 and Python.
ABLE = r"[0-9@]|[\[(] ?[Aa][Tt] ?[\])]"
CONTEXT = {
    "email": re.compile(r"mail|contact|write", re.I),
    "ip": re.compile(r"\bip\b|addr|host|server|login", re.I),
    "card": re.compile(r"card|visa|master|amex|credit|pay", re.I),
    "phone": re.compile(r"phone|call|tel|mobile|fax|\bcell", re.I),
}

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(DIGITS.findall(text))


def _holds(kind: str, found: str) -> bool:
    """What a match of a base pattern must be besides."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in found.split("."))
    if kind == "card":
        digits = _digits(found)
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(_digits(found)) <= 15
    return True


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the rules' matches, by start, then kind as listed."""
    found = []
    for order, kind in enumerate(KINDS):
        if kind == "email" and "@" not in text or kind == "phone" and "+" not in text:
            continue
        found += [(m.start(), order, m.end(), kind) for m in BASE[kind].finditer(text) if _holds(kind, m[0])]
    return [(start, end, kind) for start, _, end, kind in sorted(found)]


def _sub_runs(groups: list[Span], least: int, most: int) -> Iterator[Span]:
    """Runs of neighbouring digit groups with ``least`` to ``most`` digits in all."""
    for first in range(len(groups)):
        digits = 0
        for start, end in groups[first:]:
            digits += end - start
            if digits > most:
                break
            if digits >= least:
                yield groups[first][0], end


def candidates(text: str) -> dict[str, set[Span]]:
    """What could be personal data of each kind; spans may overlap."""
    found: dict[str, set[Span]] = {kind: set() for kind in KINDS}
    found["email"] = {m.span() for m in WRITTEN.finditer(text)}
    for run in DOTTED.finditer(text):
        parts = [(run.start() + m.start(), run.start() + m.end()) for m in DIGITS.finditer(run[0])]
        found["ip"].update((parts[i][0], parts[i + 3][1]) for i in range(len(parts) - 3))
    for run in GROUPS.finditer(text):
        groups = [(run.start() + m.start(), run.start() + m.end()) for m in DIGITS.finditer(run[0])]
        found["card"].update(_sub_runs(groups, 12, 19))
    for run in PHONE_RUN.finditer(text):
        groups = [(run.start() + m.start(), run.start() + m.end()) for m in DIGITS.finditer(run[0])]
        for start, end in _sub_runs(groups, 7, 15):
            while start > run.start() and text[start - 1] in "(+":
                start -= 1
            found["phone"].add((start, end))
    return found


def features(text: str, kind: str, span: Span) -> list[float]:
    """Format and context of one candidate."""
    start, end = span
    found = text[start:end]
    groups = DIGITS.findall(found)
    sizes = [len(g) for g in groups] or [0]
    digits = "".join(groups)
    before, after = text[start - 1:start], text[end:end + 1]
    wide_before, wide_after = text[max(0, start - 2):start], text[end:end + 2]
    return [
        end - start, len(digits), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1], len(set(sizes)),
        float(luhn(digits)) if kind == "card" else 0.0,
        float(digits[:1] or -1), found.startswith("+"), found.startswith("00"), "(" in found, found.count(" "), found.count("-"), found.count("."), "@" in found,
        max((int(g[:6]) for g in groups), default=0) if kind == "ip" else 0,
        before.isalnum(), after.isalnum(), before in ".-+=#/_", after in "-+=#/_" and bool(after),
        # digits go on beyond one separator
        wide_before[:1].isdigit() and len(wide_before) == 2, wide_after[1:].isdigit(),
        bool(CONTEXT[kind].search(text, max(0, start - 40), start)),
    ]


def _examples(text: str) -> Iterator[tuple[str, list[float], bool]]:
    """(kind, features, is positive) from a text the rules have read; the same for its copies."""
    base = base_spans(text)
    yield from _labelled(text, {(s, e, k) for s, e, k in base})
    rng = random.Random(text) if base else None
    for start, end, kind in base:
        # The same span in other company and format.
        changed = _changed(text[start:end], kind, rng)
        company = _company(text, base, rng)
        lead, tail = rng.choice([("", " " + company), (company + " ", ""), ("", ""), ("", ".")])
        left, right = text[max(0, start - 60):start], text[end:end + 60]
        made = left + lead + changed + tail + right
        at = len(left) + len(lead)
        yield from _labelled(made, {(at, at + len(changed), kind)}, only=(at, at + len(changed)))


def _company(text: str, base: list[tuple[int, int, str]], rng: random.Random) -> str:
    """A number, card, phone or address made up, or some base span of the text."""
    start, end, _ = rng.choice(base)
    card = str(rng.randrange(10**14, 10**15))
    card += next(d for d in "0123456789" if luhn(card + d))
    return rng.choice([
        str(rng.randrange(10 ** rng.randrange(1, 17))),
        card,
        f"+{rng.randrange(1, 100)} ({rng.randrange(100, 1000)}) {rng.randrange(100, 1000)}-{rng.randrange(1000, 10000)}",
        ".".join(str(rng.randrange(256)) for _ in range(4)),
        text[start:end],
    ])


def _counted(text: str) -> Counter[tuple[int, bytes, bool]]:
    """How often a text gives each example, features as levels."""
    raw = Counter((KINDS.index(kind), tuple(x), positive) for kind, x, positive in _examples(text))
    if not raw:
        return raw
    # Values of one level make equal examples.
    found: Counter[tuple[int, bytes, bool]] = Counter()
    for ((kind, _, positive), n), row in zip(raw.items(), levels_of(np.array([x for _, x, _ in raw], float))):
        found[kind, row.tobytes(), positive] += n
    return found


def _changed(found: str, kind: str, rng: random.Random) -> str:
    digits = _digits(found)
    if kind == "card" and rng.random() < 0.5:
        return rng.choice(" -").join(digits[i:i + 4] for i in range(0, len(digits), 4))
    if kind == "phone" and rng.random() < 0.5:
        return found[found.index(" ") + 1:] if " " in found else found[1:]
    if kind == "email" and rng.random() < 0.5:
        return found.replace("@", rng.choice([" [at] ", "(at)"])).replace(".", rng.choice([" [dot] ", "."]))
    return found


def _labelled(text: str, positive: set, only: Span | None = None) -> Iterator[tuple[str, list[float], bool]]:
    for kind, spans in candidates(text).items():
        for span in spans:
            is_positive = (*span, kind) in positive
            if only and not (span[0] < only[1] and only[0] < span[1]):
                continue  # what only the company holds is not labelled
            yield kind, features(text, kind, span), is_positive


class Model:
    """Trees and a threshold for each kind that has examples enough.

    ``learn`` makes one from a table; made directly, it learns here, from texts in hand.
    """

    def __init__(self, texts: Iterable[str] = (), examples: Examples | None = None):
        if examples is None:
            found: Counter[tuple[int, bytes, bool, bool]] = Counter()
            for at, text in enumerate(texts):
                for key, n in _counted(text).items():
                    found[(*key, at % 3 == 0)] += n
            rows: dict[int, list] = {}
            for (kind, levels, *rest), n in found.items():
                rows.setdefault(kind, []).append((np.frombuffer(levels, "<i2"), *rest, n))
            blocks = {kind: zip(*of) for kind, of in rows.items()}
            examples = LocalExamples([(kind, Block(np.array(levels), *(np.array(c) for c in rest))) for kind, (levels, *rest) in blocks.items()])
        grown: dict[int, BoostedTrees] = {}
        for kind, ((negative, positive), (_, held)) in examples.total(lambda _, block: class_counts(block), list(range(len(KINDS))), 2).items():
            if min(positive, held, negative + 1) < LEAST_EXAMPLES / 2 or positive + held < LEAST_EXAMPLES:
                continue
            weight = min(1.0, positive / max(1.0, negative) * 4)
            grown[kind] = BoostedTrees(positive / (positive + weight * negative), weight)
        boost(examples, grown, N_FEATURES)
        self.trees: dict[str, tuple[BoostedTrees, float]] = {}
        for kind, steps in sorted(examples.total(lambda kind, block: grown[kind].steps(block), list(grown), STEPS + 1).items() if grown else ()):
            negative, positive = np.cumsum(steps[::-1], 0)[::-1].T
            enough = np.flatnonzero(steps.any(1) & (positive >= PRECISION * (negative + positive)) & (negative + positive >= LEAST_EXAMPLES / 2))
            if len(enough):
                self.trees[KINDS[kind]] = (grown[kind], max(0.5, float(enough[0]) / STEPS))

    def added(self, text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        """Spans that the trees select besides the base ones."""
        taken = Taken((s, e) for s, e, _ in base)
        scored = []
        for kind, spans in candidates(text).items():
            if kind not in self.trees:
                continue
            spans = [s for s in spans if not taken.meets(s)]
            if not spans:
                continue
            trees, threshold = self.trees[kind]
            scores = trees.predict(np.array([features(text, kind, s) for s in spans], float))
            scored += [(-score, start, -end, kind) for score, (start, end) in zip(scores.tolist(), spans) if score >= threshold]
        chosen: list[tuple[int, int, str]] = []
        used: list[Span] = []  # none of these overlap, so the one before is the nearest
        for _, start, end, kind in sorted(scored):
            at = bisect_left(used, (-end, -1))
            if not at or used[at - 1][1] <= start:
                chosen.append((start, -end, kind))
                used.insert(at, (start, -end))
        return chosen


class Taken:
    """Spans that may overlap, and whether another meets one of them."""

    def __init__(self, spans: Iterable[Span]):
        ordered = sorted(spans)
        self._starts = [start for start, _ in ordered]
        # The greatest end so far, as a span that starts early may reach far.
        self._reach = list(accumulate((end for _, end in ordered), max))

    def meets(self, span: Span) -> bool:
        at = bisect_left(self._starts, span[1])
        return at > 0 and self._reach[at - 1] > span[0]


def learn(df: DataFrame, text_col: str = "text") -> Model:
    """The model that all texts of ``df`` give."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in text_slices(batches, "text"):
            for text, hash_ in zip(batch.column("text"), batch.column("hash")):
                rows += [(hash_.as_py(), *key, n) for key, n in _counted(text.as_py()).items()]
                if len(rows) >= BATCH_ROWS:
                    yield from _batches(rows)
                    rows = []
        yield from _batches(rows)

    able = df.select(F.col(text_col).alias("text")).where(F.col("text").rlike(ABLE)).withColumn("hash", F.xxhash64("text"))
    # Copies of a text give equal rows.
    found = able.mapInArrow(run, "hash long, kind int, levels binary, positive boolean, n long").distinct()
    return Model(examples=SparkExamples(found.groupBy("kind", "levels", "positive", (F.pmod("hash", F.lit(3)) == 0).alias("held")).agg(F.sum("n").alias("n"))))


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of examples, some at a time."""
    names = {"hash": pa.int64(), "kind": pa.int32(), "levels": pa.binary(), "positive": pa.bool_(), "n": pa.int64()}
    for begin in range(0, len(rows), BATCH_ROWS):
        columns = zip(*rows[begin:begin + BATCH_ROWS])
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, names.values())], list(names))


def draw_sample(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> tuple[str, ...]:
    """Passages around the first ``ABLE`` place of sampled texts, to look at or to try a
    ``Model`` on; ``find_pii`` and ``redact`` learn from all texts."""
    able = df.select(F.col(text_col).alias("text")).where(F.col("text").rlike(ABLE)).select(F.xxhash64("text").alias("hash"), F.substring("text", F.greatest(F.lit(1), F.regexp_instr("text", F.lit(ABLE)) - chars // 2), F.lit(chars)).alias("passage"))
    distinct = able.select("hash").distinct().orderBy("hash").limit(texts)
    passages = able.join(F.broadcast(distinct), "hash").distinct().collect()
    return tuple(row["passage"] for row in sorted(passages, key=lambda r: (r["hash"], r["passage"])))


SPANS = "array<struct<kind: string, start: int, end: int, is_base: boolean>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("is_base", pa.bool_())]))


def spans_of(text: str, model: Model) -> list[dict]:
    base = base_spans(text)
    every = [(s, KINDS.index(k), e, True) for s, e, k in base] + [(s, KINDS.index(k), e, False) for s, e, k in model.added(text, base)]
    return [{"kind": KINDS[k], "start": s, "end": e, "is_base": b} for s, k, e, b in sorted(every)]


def _spans(texts: pa.Array, model: Model) -> list[list[dict]]:
    able = pc.match_substring_regex(texts, ABLE).to_numpy(zero_copy_only=False)
    found: list[list[dict]] = [[] for _ in range(len(texts))]
    for at in np.flatnonzero(able).tolist():
        found[at] = spans_of(texts[at].as_py(), model)
    return found


def find_pii(df: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every document; the model learns from ``df`` if none is given."""
    model = model or learn(df, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_spans(batch.column("text"), model), _SPAN_TYPE)], ["doc_id", "spans"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id long, spans {SPANS}")


def redacted(text: str, spans: list[dict]) -> str:
    """The text with each span, or run of overlapping ones, as its kind in brackets."""
    pieces, at = [], 0
    for span in spans:
        if span["start"] >= at:
            pieces += [text[at:span["start"]], f"[{span['kind'].upper()}]"]
        at = max(at, span["end"])
    return "".join((*pieces, text[at:]))


def redact(df: DataFrame, model: Model | None = None, text_col: str = "text") -> DataFrame:
    """``df`` with the personal data in its texts put out; NULL texts stay NULL."""
    model = model or learn(df, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_col, fill=False):
            at = batch.schema.get_field_index(text_col)
            texts = batch.column(at)
            found = _spans(pc.fill_null(texts, ""), model)
            changed = np.array([bool(f) for f in found])
            if changed.any():
                made = [redacted(text.as_py(), spans) if spans else text.as_py() for text, spans in zip(texts, found)]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(made, texts.type))
            yield batch

    return df.mapInArrow(run, df.schema)
