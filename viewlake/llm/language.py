"""Operator 7: language identification by cross-parsing entropy.

For each language a suffix automaton is built from a sample of labelled text. A text is
parsed against it into phrases, each the longest run that occurs in the sample; the
fewer phrases, weighed by the bits it takes to point into the sample, the closer the
language. The language with the fewest normalised phrases wins.

The automata are laid out as tables of states and symbols, and all texts of a batch
step through them side by side, one symbol a step. Every letter of the samples has its
own symbol; steps by the rarer ones are kept in a sorted list. A text longer than
``BLOCK_SYMBOLS`` is parsed in blocks, each from the start state; every symbol of every
text is read.

The sample is the only bounded thing: ``SAMPLE_TEXTS`` different texts of each language,
those with the lowest hash, ``SAMPLE_CHARS`` characters of each, fewer if all languages
together would pass ``MOST_SYMBOLS``; ``MOST_LANGUAGES`` languages are learned.

Edge cases: a NULL text, or one without a letter, is ``und`` with score 0. If there is
nothing to learn from, every document is ``und``. Rows without an id are predicted but
not learned from. Repeated texts count once in the sample; ties go to the language
first by name. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from viewlake.llm.scratch import cut, keep_one, text_slices

UNKNOWN = "und"
SAMPLE_TEXTS = 128
SAMPLE_CHARS = 384
#: Languages that are learned, those with most documents first.
MOST_LANGUAGES = 100
#: Characters of all samples: a worker's tables take some 1 kB for each. With more than
#: four languages the passages of each get shorter.
MOST_SYMBOLS = 200_000
#: Letters with a column in the table of steps; steps by rarer ones are looked up.
TABLE_LETTERS = 120
BLOCK_SYMBOLS = 512
#: Lanes that step at once.
LANES = 16_384

#: Not a letter; a letter that no sample holds.
SPACE, OTHER = 0, 1


def held_out(doc_id: Column) -> Column:
    """Whether the id's checksum keeps the document out of the learning."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


def _lowest(distinct: DataFrame, n: int, languages: int) -> DataFrame:
    """The n rows of each language with the lowest hash, of the languages with most rows.

    Hashes are spread evenly, so a language's n lowest are below a bound that follows
    from its number of rows. Some four times n rows of each are left for the ranking,
    whatever a language holds; if a bound was too low it is raised.
    """
    most = distinct.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    counts = cut(most)  # as many rows as languages are learned
    share = 4.0 * n
    while True:
        bounds = counts.withColumn("bound", F.lit(-(2.0**63)) + F.lit(2.0**64) * F.least(F.lit(1.0), F.lit(share) / F.col("n")))
        low = distinct.join(F.broadcast(bounds.drop("n")), "lang").where(F.col("hash").cast("double") <= F.col("bound")).drop("bound")
        held = cut(low)
        found = held.groupBy("lang").agg(F.count("*").alias("held"))
        if counts.join(found, "lang", "left").where(F.coalesce("held", F.lit(0)) < F.least(F.lit(n), F.col("n"))).isEmpty():
            break
        share *= 4
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    return held.withColumn("rank", rank).where(F.col("rank") <= n).drop("rank")


def draw_sample(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS, languages: int = MOST_LANGUAGES) -> tuple[tuple[str, str], ...]:
    """(language, text) pairs to learn from, languages in order.

    The lowest hashes of each language are found on hashes alone; only their texts
    are read again. A long text gives a passage from a place its hash names. Of more
    than ``languages`` different labels those with most documents are learned.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    able = rows.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull())
    able = able.withColumn("hash", F.xxhash64("text"))
    distinct = cut(able.groupBy("lang", "hash").agg(F.min("doc_id").alias("doc_id")))
    chosen = cut(_lowest(distinct, texts, languages))
    learned = max(1, chosen.select("lang").distinct().count())
    chars = min(chars, max(1, MOST_SYMBOLS // (learned * texts)))
    # As many rows as languages times texts: bounded, whatever the table's size.
    start = F.pmod(F.col("hash"), F.greatest(F.char_length("text") - chars, F.lit(0)) + 1) + 1
    passages = able.join(F.broadcast(chosen), ["lang", "hash", "doc_id"]).select("lang", "hash", F.substring(F.col("text"), start.cast("int"), F.lit(chars)).alias("text")).distinct().collect()
    found: dict[str, list[tuple[int, str]]] = {}
    for lang, hashed, passage in passages:
        found.setdefault(lang, []).append((hashed, passage))
    return tuple((lang, " ".join(p for _, p in sorted(found[lang]))) for lang in sorted(found))


class Alphabet:
    """Symbols of the samples' letters, upper and lower case alike."""

    def __init__(self, texts: list[str]):
        lower = _lower()
        seen = Counter(int(lower[ord(c)]) for text in texts for c in text if c.isalpha())
        letters = sorted(seen, key=lambda c: (-seen[c], c))
        self.size = len(letters) + 2
        by_lower = np.full(0x110000, OTHER, np.min_scalar_type(self.size))
        by_lower[letters] = np.arange(2, self.size)
        self._symbols = np.where(_letters(), by_lower[lower], SPACE).astype(by_lower.dtype)

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The texts' symbols in a row, and each text's bounds; white space is one space."""
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        symbols = self._symbols[codes]
        kept = np.ones(len(symbols), bool)
        kept[1:] = (symbols[1:] != SPACE) | (symbols[:-1] != SPACE)
        return symbols[kept], np.concatenate(([0], np.cumsum(kept)))[bounds]


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@cache
def _lower() -> np.ndarray:
    """The code of each character's lower case, or its own where that is not one character."""
    return np.fromiter((ord(low) if len(low := chr(c).lower()) == 1 else c for c in range(0x110000)), np.int32, 0x110000)


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings; state 0 is the start."""
    steps: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols:
        new = len(steps)
        steps.append({})
        link.append(0)
        length.append(length[last] + 1)
        state = last
        while state >= 0 and symbol not in steps[state]:
            steps[state][symbol] = new
            state = link[state]
        if state >= 0:
            target = steps[state][symbol]
            if length[target] == length[state] + 1:
                link[new] = target
            else:
                clone = len(steps)
                steps.append(dict(steps[target]))
                link.append(link[target])
                length.append(length[state] + 1)
                link[target] = link[new] = clone
                while state >= 0 and steps[state].get(symbol) == target:
                    steps[state][symbol] = clone
                    state = link[state]
        last = new
    return steps


class Parser:
    """The automata of all languages in one table of steps.

    An entry is twice the next state, plus one if a phrase ends before the symbol. The
    table has columns for the first symbols; entries of the others that go on in a phrase
    stand in ``rare_entries``, by state and symbol, and those that open one in ``restarts``.
    """

    def __init__(self, sample: tuple[tuple[str, str], ...]):
        self.languages = [lang for lang, _ in sample]
        self.alphabet = Alphabet([text for _, text in sample])
        size = self.alphabet.size
        self.width = width = min(size, TABLE_LETTERS + 2)
        tables, restarts, rare, starts, base = [], [], [], [], 0
        self.bits = []
        for _, text in sample:
            symbols, _ = self.alphabet.symbols([text])
            steps = suffix_automaton(symbols.tolist())
            restart = np.full(size, 2 * base + 1)
            for symbol, state in steps[0].items():
                restart[symbol] = 2 * (base + state) + 1
            table = np.tile(restart[:width].astype(np.int32), (len(steps), 1))
            # from the start every symbol opens a phrase
            flat = (n for state, found in enumerate(steps) if state for symbol, to in found.items() for n in (state, symbol, to))
            moves = np.fromiter(flat, np.int64).reshape(-1, 3)
            near, far = moves[moves[:, 1] < width], moves[moves[:, 1] >= width]
            table[near[:, 0], near[:, 1]] = 2 * (base + near[:, 2])
            rare.append(np.column_stack(((base + far[:, 0]) * size + far[:, 1], 2 * (base + far[:, 2]))))
            tables.append(table.ravel())
            restarts.append(restart.astype(np.int32))
            starts.append(base)
            base += len(steps)
            self.bits.append(math.log2(len(symbols) + 1))
            del steps, moves, near, far, table
        # One table after the other, so that all of them are never held twice.
        self.table = np.empty(sum(map(len, tables)), np.int32)
        end = len(self.table)
        while tables:
            table = tables.pop()
            self.table[end - len(table):end] = table
            end -= len(table)
        self.starts = np.array(starts, np.int32)
        self.restarts = np.array(restarts, np.int32).reshape(len(starts), size)
        entries = np.concatenate([np.empty((0, 2), np.int64), *rare])
        entries = entries[np.argsort(entries[:, 0])]
        self.rare_keys, self.rare_entries = entries[:, 0].copy(), entries[:, 1].astype(np.int32)

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases of each text against each language; symbols; whether it has letters."""
        symbols, bounds = self.alphabet.symbols(texts)
        sizes = np.diff(bounds)
        has_letter = np.concatenate(([0], np.cumsum(symbols != SPACE)))[bounds]
        blocks = -(-sizes // BLOCK_SYMBOLS)
        owner = np.repeat(np.arange(len(texts)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = bounds[owner] + nth * BLOCK_SYMBOLS
        length = np.minimum(bounds[owner + 1] - begin, BLOCK_SYMBOLS)
        order = np.argsort(-length, kind="stable")
        counts = np.zeros((len(self.languages), len(texts)), np.int64)
        for at in range(0, len(order), LANES):
            lanes = order[at:at + LANES]
            found = self._step(symbols, begin[lanes], length[lanes])
            for lang in range(len(self.languages)):
                counts[lang] += np.bincount(owner[lanes], found[lang], len(texts)).astype(np.int64)
        return counts, sizes, np.diff(has_letter) > 0

    def _step(self, symbols: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        width = self.width
        near = symbols if width == self.alphabet.size else np.where(symbols < width, symbols, OTHER)
        states = np.repeat(self.starts[:, None], len(begin), 1)
        counts = np.zeros(states.shape, np.int32)
        active = np.searchsorted(-length, -np.arange(1, (length[0] if len(length) else 0) + 1), "right")
        for step, lanes in enumerate(active.tolist()):
            at = begin[:lanes] + step
            entry = self.table[states[:, :lanes] * width + near[at]]
            if near is not symbols and len(far := np.flatnonzero(symbols[at] >= width)):
                entry[:, far] = self._rare(states[:, far], symbols[at[far]])
            counts[:, :lanes] += entry & 1
            states[:, :lanes] = entry >> 1
        return counts

    def _rare(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The entries of symbols without a column."""
        opened = self.restarts[:, symbols]
        if not len(self.rare_keys):
            return opened
        keys = states.astype(np.int64) * self.alphabet.size + symbols
        found = np.minimum(np.searchsorted(self.rare_keys, keys), len(self.rare_keys) - 1)
        return np.where(self.rare_keys[found] == keys, self.rare_entries[found], opened)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The language and score of each text.

        The score is how far the runner-up's normalised phrases lie above the
        winner's, as a share of the runner-up's.
        """
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        counts, sizes, has_letter = self.phrases(texts)
        bits = counts * np.array(self.bits)[:, None]
        best = np.argmin(bits, 0)
        ranked = np.sort(np.vstack([bits, sizes[None] * max(self.bits)]), 0)
        score = np.where(has_letter, 1 - ranked[0] / np.maximum(ranked[1], 1e-9), 0.0)
        return [self.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), has_letter.tolist())], np.clip(score, 0, 1)


def _parser(sample: tuple[tuple[str, str], ...]) -> Parser:
    return keep_one(("language", sample), lambda: Parser(sample))


def predict_languages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document, learned from ``df``."""
    sample = draw_sample(df, id_col, text_col, lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            langs, scores = _parser(sample).predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores)], ["doc_id", "held_out", "lang_pred", "score"])

    doc_id = F.col(id_col).cast("long").alias("doc_id")
    slim = df.select(doc_id, held_out(doc_id).alias("held_out"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least_score: float = 0.0) -> DataFrame:
    """The rows of ``df``, all columns, whose language could be told.

    Where there is nothing to learn from, only rows without a letter go.
    """
    sample = draw_sample(df, id_col, text_col, lang_col)
    if not sample:
        return df.where(F.col(text_col).rlike(r"\p{L}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_col):
            langs, scores = _parser(sample).predict(batch.column(text_col).to_pylist())
            yield batch.filter(pa.array((np.array(langs) != UNKNOWN) & (scores >= least_score)))

    return df.mapInArrow(run, df.schema)
