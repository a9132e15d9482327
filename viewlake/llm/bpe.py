"""Operator 8: byte-pair encoding and decoding.

A word is merged with a priority queue of merge ranks over a doubly linked list of
symbols: the queue gives the lowest rank, leftmost first; an entry is stale, and
skipped, if either symbol has changed since. Decoding joins the vocabulary's strings.

Words repeat, so each Python worker keeps the ids of pieces and of words it has seen,
up to a bound. Whole texts are encoded; nothing is shuffled.

Edge cases: a NULL or empty text has no ids and decodes to "". Any string is encoded,
by bytes. A special token's own string in a text becomes that token. Repeated rows are
rows of their own. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlake.llm.chunks import PieceCache, encode_texts, printable_bytes
from viewlake.llm.scratch import keep_one, text_slices

#: Fixed value: how byte-level vocabularies split a text into words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


#: Pieces, and words, a worker remembers before it starts afresh.
CACHE_WORDS = 200_000


class Bpe:
    """A byte-level vocabulary read from a tokenizers JSON file."""

    def __init__(self, path: str, cached: int = CACHE_WORDS):
        self._cached = cached
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        shown = printable_bytes()
        self.byte_ids = [vocab[c] for c in shown]
        self.merges = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        raw = {c: b for b, c in enumerate(shown)}
        strings = {i: bytes(raw[c] for c in token) for token, i in vocab.items() if token not in self.special}
        strings |= {i: token.encode() for token, i in self.special.items()}
        self.strings = pa.array([strings.get(i, b"") for i in range(max(strings) + 1)], pa.binary())
        self._special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._words: dict[str, list[int]] = {}
        self._pieces = PieceCache(lambda pieces: map(self.encode_text, pieces), cached)

    def encode_word(self, word: bytes) -> list[int]:
        """The ids of one word, merged lowest rank first."""
        symbols = [self.byte_ids[b] for b in word]
        n, find = len(symbols), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for at in range(n - 1):
            if merge := find((symbols[at], symbols[at + 1])):
                queue.append((merge[0], at, symbols[at], symbols[at + 1], merge[1]))
        heapify(queue)
        while queue:
            _, at, left, right, merged = heappop(queue)
            other = after[at]
            if symbols[at] != left or other >= n or symbols[other] != right:
                continue  # stale
            symbols[at], symbols[other] = merged, -1
            follows = after[at] = after[other]
            if follows < n:
                before[follows] = at
                if merge := find((merged, symbols[follows])):
                    heappush(queue, (merge[0], at, merged, symbols[follows], merge[1]))
            ahead = before[at]
            if ahead >= 0 and (merge := find((symbols[ahead], merged))):
                heappush(queue, (merge[0], ahead, symbols[ahead], merged, merge[1]))
        return [s for s in symbols if s >= 0]

    def encode_text(self, text: str) -> list[int]:
        """The ids of a whole text, word by word."""
        if self._special and (parts := self._special.split(text)) and len(parts) > 1:
            return [i for part in parts for i in ([self.special[part]] if part in self.special else self.encode_text(part))]
        ids, known = [], self._words
        for word in WORDS.findall(text):
            found = known.get(word)
            if found is None:
                found = self.encode_word(word.encode())
                if len(word) < 64:
                    if len(known) >= self._cached:
                        known.clear()
                    known[word] = found
            ids += found
        return ids

    def encode_batch(self, texts: pa.Array) -> pa.ListArray:
        """The ids of each text.

        Between single spaces the pieces of a text split alike on their own, each
        with the space before it. Two spaces in a row may belong to one word, so
        such texts are split whole.
        """
        whole = pc.match_substring(texts, "  ")
        if not pc.any(whole).as_py():
            return encode_texts(texts, self._pieces, lead=" ")
        apart = whole.to_numpy(zero_copy_only=False)
        some = encode_texts(texts.filter(pc.invert(whole)), self._pieces, lead=" ")
        rest = pa.array([self.encode_text(t) for t in texts.filter(whole).to_pylist()], pa.list_(pa.int32()))
        order = np.argsort(np.concatenate((np.flatnonzero(~apart), np.flatnonzero(apart))), kind="stable")
        return pa.concat_arrays([some.cast(pa.list_(pa.int32())), rest]).take(pa.array(order))

    def decode_batch(self, ids: pa.ListArray) -> pa.StringArray:
        """The strings of the ids joined; bytes that are no UTF-8 become U+FFFD."""
        strings = self.strings.take(ids.values)
        lists = pa.ListArray.from_arrays(ids.offsets, strings)
        joined = pc.binary_join(lists, b"")
        try:
            return joined.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([b.decode("utf-8", "replace") for b in joined.to_pylist()], pa.string())


def load(path: str, cached: int = CACHE_WORDS) -> Bpe:
    return keep_one(("bpe", path, cached), lambda: Bpe(path, cached))


def _run(df: DataFrame, columns: list, schema: str, names: list[str], work) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text") if "text" in names else batches:
            yield work(batch)

    return df.select(*columns).mapInArrow(run, schema)


def encode(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every whole text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), load(vocabulary).encode_batch(batch.column("text"))], ["doc_id", "ids"])

    return _run(df, [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")], "doc_id long, ids array<int>", ["text"], work)


def decode(df: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of every list of ids; a NULL list decodes to ""."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column("ids")
        ids = pa.ListArray.from_arrays(ids.offsets, ids.values) if not ids.null_count else pa.array([x or [] for x in ids.to_pylist()], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), load(vocabulary).decode_batch(ids)], ["doc_id", "text"])

    return _run(df, [F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")], "doc_id long, text string", [], work)


def round_trip(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", cached: int = CACHE_WORDS) -> DataFrame:
    """(doc_id, ids, decoded) in one pass: ``encode``, then ``decode`` of its ids.

    ``cached`` is how many pieces and words a worker remembers: less memory, more work.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = load(vocabulary, cached)
        ids = bpe.encode_batch(batch.column("text"))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, bpe.decode_batch(ids)], ["doc_id", "ids", "decoded"])

    return _run(df, [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")], "doc_id long, ids array<int>, decoded string", ["text"], work)
