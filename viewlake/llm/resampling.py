"""Operator 13: importance resampling towards the distribution of a target corpus.

Features of a text are its runs of consecutive words, hashed into buckets. A bucket's
gain is the log of how much likelier it is in the target than in the raw corpus; a
document's weight is the sum of its features' gains, and the documents with the highest
weight plus Gumbel noise are a sample without replacement drawn by importance.

Texts are scanned by an Aho-Corasick automaton of distinct words, each bounded by a
delimiter on both sides, so that a match is a whole word. A word's payload is the CRC and
the length of its bytes. The CRC of a run is composed from the payloads of its words, as
that of two strings in a row follows from their CRCs and the second one's length; no run
is ever put together as a string. A worker's automaton learns the words it meets, up to
``MOST_WORDS`` of at most ``LONGEST_WORD`` bytes; any other word's payload is worked out
where it stands, so what the automaton knows never changes a result.

Texts are scanned once. The buckets go to the shared folder and are read twice: to count
them over the corpus, and to weigh documents. Counts, one row for each bucket, and gains
are bounded by the number of buckets. Ranks come from one range sort of narrow rows: the
place in a partition plus the rows of the partitions before it.

Edge cases: a NULL or empty text, or one without words, has no features, weight 0 and no
rank. A NULL id is seeded like an empty one and comes last among ties. Rows that repeat
share score and weight and have ranks of their own. Empty tables, raw or target, give
gains that the smoothing alone decides, and an empty raw table gives an empty table.
Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from viewlake.llm.scratch import cut, drop_folder, keep_one, new_folder, text_slices

BUCKETS = 10_000
#: Words an automaton knows, and bytes of the longest of them.
MOST_WORDS = 65_536
LONGEST_WORD = 64
#: Words met for the first time before an automaton is built anew.
LEAST_NEW_WORDS = 2_000

#: The polynomial of CRC-32, bits in reverse.
POLYNOMIAL = 0xEDB88320
_LENGTH_BITS = 16


def _plain_bytes() -> bytes:
    """For each byte what a scan sees: small letters, digits, bytes of characters beyond
    ASCII as they are, capital letters as small ones, a space for any other."""
    shown = bytearray(b" " * 256)
    for b in range(256):
        if b >= 0x80 or chr(b).isdigit() or chr(b).islower():
            shown[b] = b
        elif chr(b).isupper():
            shown[b] = b + 32
    return bytes(shown)


PLAIN = _plain_bytes()


class WordScanner:
    """CRC and length of every word of a text, by an automaton that learns its words."""

    def __init__(self, most_words: int = MOST_WORDS):
        self._automaton = ahocorasick.Automaton()
        self._most, self._new = most_words, {}

    def scan(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(CRCs, lengths, starts) of the words of a plain text with a space at both ends."""
        letters = np.frombuffer(text, np.uint8) != ord(" ")
        edges = np.flatnonzero(letters[1:] != letters[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        crc, known = np.zeros(len(starts), np.uint32), np.zeros(len(starts), bool)
        if len(self._automaton):
            # A match ends at the delimiter after its word.
            found = np.fromiter(chain.from_iterable(self._automaton.iter(text.decode("latin-1"))), np.int64).reshape(-1, 2)
            at = np.searchsorted(ends, found[:, 0])
            crc[at], known[at] = found[:, 1] >> _LENGTH_BITS, True
        for at in np.flatnonzero(~known).tolist():
            word = text[starts[at]:ends[at]]
            crc[at] = payload = self._new.get(word) or zlib.crc32(word)
            if len(word) <= LONGEST_WORD and len(self._automaton) + len(self._new) < self._most:
                self._new[word] = payload
        if len(self._new) >= max(LEAST_NEW_WORDS, len(self._automaton) // 4):
            self._learn()
        return crc, ends - starts, starts

    def _learn(self) -> None:
        for word, crc in self._new.items():
            self._automaton.add_word(f" {word.decode('latin-1')} ", crc << _LENGTH_BITS | len(word))
        self._automaton.make_automaton()
        self._new = {}


def _scanner() -> WordScanner:
    return keep_one("word scanner", WordScanner)


@cache
def _shifts(power: int) -> np.ndarray:
    """Four tables, one for each byte of a CRC: its part after 2**power more zero bytes."""
    if power:
        half = _shifts(power - 1)
        return _shifted(_shifted(np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None], half), half)
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, step >> 1 ^ np.uint32(POLYNOMIAL), step >> 1)
    crc = np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]
    return crc >> np.uint32(8) ^ step[crc & 255]


def _shifted(crc: np.ndarray, tables: np.ndarray) -> np.ndarray:
    return tables[0][crc & 255] ^ tables[1][crc >> 8 & 255] ^ tables[2][crc >> 16 & 255] ^ tables[3][crc >> 24]


def joined_crc(left: np.ndarray, right: np.ndarray, right_lengths: np.ndarray) -> np.ndarray:
    """CRCs of strings followed by others, from both CRCs and the lengths of the others."""
    for power in range(int(right_lengths.max(initial=0)).bit_length()):
        left = np.where(right_lengths >> power & 1, _shifted(left, _shifts(power)), left)
    return left ^ right


def run_crcs(crc: np.ndarray, lengths: np.ndarray, bounds: np.ndarray, most_words: int) -> tuple[np.ndarray, np.ndarray]:
    """CRCs of all runs of 1 to ``most_words`` words of each text, and the texts' bounds."""
    if most_words == 1:
        return crc, bounds
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    after_space = joined_crc(np.full(len(crc), zlib.crc32(b" "), np.uint32), crc, lengths)
    runs, owners, run = [crc], [text], crc
    for more in range(1, most_words):
        run = joined_crc(run[:-1], after_space[more:], lengths[more:] + 1)
        whole = text[more:] == text[:len(text) - more]
        runs.append(run[whole])
        owners.append(text[:len(text) - more][whole])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(runs)[order], np.searchsorted(owner[order], np.arange(len(bounds)))


def _plain_texts(texts: pa.StringArray) -> tuple[bytes, np.ndarray]:
    """All texts in a row as a scan sees them, with a space before each and at the end,
    and where each begins."""
    plain = [text.encode().translate(PLAIN) for text in texts.to_pylist()]
    sizes = np.fromiter(map(len, plain), np.int64, len(plain)) + 1
    return b" " + b" ".join(plain) + b" ", np.concatenate(([0], np.cumsum(sizes)))


def hash_features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_words: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, buckets): the bucket of every feature of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            text, begins = _plain_texts(batch.column("text"))
            crc, lengths, starts = _scanner().scan(text)
            bounds = np.searchsorted(starts, begins)
            features, ends = run_crcs(crc, lengths, bounds, most_words)
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(features % np.uint32(buckets), pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(bounds)), listed], ["doc_id", "n_words", "buckets"])

    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_words long, buckets array<int>")


def bucket_counts(hashed: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket; one row for each bucket reaches the driver."""
    counts = np.zeros(buckets, np.int64)
    for bucket, n in hashed.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*")).collect():
        counts[bucket] = n
    return counts


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of the target's smoothed share over the raw corpus's."""
    n = len(raw)
    ratio = (target + 1.0) * float(raw.sum() + n) / ((raw + 1.0) * float(target.sum() + n))
    return np.floor(1000.0 * np.log(ratio)).astype(np.int64)


def weighed(hashed: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the sum of the gains of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("buckets")
            bounds = lists.offsets.to_numpy()
            sums = np.concatenate(([0], np.cumsum(gains[lists.values.to_numpy()[bounds[0]:bounds[-1]]])))
            at = bounds - bounds[0]
            columns = [batch.column("doc_id"), batch.column("n_words"), pa.array(np.diff(at).astype(np.int64)), pa.array(sums[at[1:]] - sums[at[:-1]])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    return hashed.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel_noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of Gumbel noise that the seed and the id decide."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digits = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((digits + 0.5) / F.lit(4294967296.0))))


def resample(documents: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, most_words: int = 1, buckets: int = BUCKETS, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document.

    Of the documents of ``least_words`` words or more ``percent`` in a hundred are drawn,
    by falling score, ties to the smaller id; the others have no rank.
    """
    spark = documents.sparkSession
    folder = new_folder(spark, "resampling")
    hash_features(documents, id_col, text_col, most_words, buckets).write.parquet(f"{folder}/hashed")
    hashed = spark.read.parquet(f"{folder}/hashed")
    wanted = hash_features(target.select(F.lit(0).alias("id"), F.col(target_text_col).alias("text")), "id", "text", most_words, buckets)
    gains = bucket_gains(bucket_counts(hashed, buckets), bucket_counts(wanted, buckets))
    scored = weighed(hashed, gains).withColumn("score", F.col("weight") + gumbel_noise(F.col("doc_id"), seed))
    scored.write.parquet(f"{folder}/scored")
    ranked = _ranked(spark.read.parquet(f"{folder}/scored"), percent, least_words)
    drop_folder(spark, folder)
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


def _ranked(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    able = F.col("n_words") >= least_words
    drawn = scored.where(able).count() * percent // 100
    # The row's number parts rows that repeat, so that no key is too large to be split.
    keys = [able.desc(), F.desc("score"), F.col("doc_id").asc_nulls_last(), F.col("row")]
    rows = scored.withColumn("row", F.monotonically_increasing_id())
    ordered = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("row"))
    # This id holds the partition's number above bit 33 and the place in it below.
    placed = ordered.withColumn("at", F.monotonically_increasing_id()).withColumns({"part": F.shiftright("at", 33), "place": F.col("at").bitwiseAND(F.lit(2**33 - 1))})
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.count("*").alias("n"))  # one row a partition
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("place") + 1
    return placed.join(F.broadcast(offsets), "part").withColumn("rank", F.when(able & (rank <= drawn), rank))
