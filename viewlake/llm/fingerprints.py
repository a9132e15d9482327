"""Operator 10: document fingerprints by a threshold-scaled sketch.

A fingerprint holds every hash of a text's shingles of five words (64 bits, signed)
that lies below a fixed fraction of the hash range, however long the text is. So the sketch of a union
is the union of sketches, and the share of one sketch found in another estimates
containment even between very unequal texts. A text none of whose hashes is that low
keeps its lowest one, so that short texts have fingerprints too; the lowest of a union
is the lower of two, so sketches still merge.

All of it is expressions of Spark: no Python runs on the executors.

Edge cases: a NULL text is empty. A text of fewer than five words is one shingle. A
text without words has an empty fingerprint; two empty ones are alike (1.0), an empty
and another are not (0.0). Documents with one id follow each other by the hash of
their text, then the text; a NULL id comes last. The one row of a table is its own next
document. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHINGLE_WORDS = 5
#: One hash in so many is kept.
SCALE = 8
LOWEST = -(2**63)
#: Bytes of text dealt to one sorted bucket, and buckets at most.
BUCKET_BYTES = 16_000_000
MOST_BUCKETS = 10_000


def words_of(text: Column) -> Column:
    """The words between white space."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")


def sketch(words: Column, scale: int = SCALE) -> Column:
    """The kept hashes of a column of words, in order.

    ``words`` must be a plain column: an expression would be worked out anew for
    each shingle.
    """
    starts = F.when(F.size(words) > 0, F.sequence(F.lit(1), F.greatest(F.size(words) - SHINGLE_WORDS + 1, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(starts, lambda at: F.xxhash64(F.slice(words, at, SHINGLE_WORDS)))
    return _low_or_lowest(hashes, scale)


def _low_or_lowest(hashes: Column, scale: int) -> Column:
    highest = LOWEST + 2**64 // scale - 1

    def kept(made: Column) -> Column:
        low = F.filter(made, lambda h: h <= highest)
        return F.sort_array(F.array_distinct(F.when(F.array_min(made) <= highest, low).otherwise(F.slice(F.sort_array(made), 1, 1))))

    # A transform over one element gives the hashes a name, so they are made once.
    return F.element_at(F.transform(F.array(hashes), kept), 1)


def merged(left: Column, right: Column, scale: int = SCALE) -> Column:
    """The fingerprint of two texts together."""
    return _low_or_lowest(F.array_union(left, right), scale)


def resemblance(left: Column, right: Column) -> Column:
    """Estimate of the Jaccard similarity of two texts' shingles."""
    both, either = F.size(F.array_intersect(left, right)), F.size(F.array_union(left, right))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def containment(part: Column, whole: Column) -> Column:
    """Estimate of the share of a text's shingles that another text holds."""
    both = F.size(F.array_intersect(part, whole))
    return F.when(F.size(part) == 0, F.lit(1.0)).otherwise(both / F.size(part))


def as_string(hashes: Column) -> Column:
    """The hashes as hexadecimal numbers of 16 digits, one after the other."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def fingerprint(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", scale: int = SCALE) -> DataFrame:
    """(doc_id, text, hashes) of every whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).withColumn("words", words_of(F.col("text")))
    return words.select("doc_id", "text", sketch(F.col("words"), scale).alias("hashes"))


def with_next(prints: DataFrame) -> DataFrame:
    """``fingerprint``'s rows with the next document's text and hashes.

    Next means next in descending document id, the first after the last. No task
    sorts the table: rows are dealt to buckets of ids of about equal size, whose
    bounds are quantiles of the ids; the first document of each bucket goes a
    second time to the bucket before, as its end.
    """
    size, = prints.agg(F.sum(F.octet_length("text"))).first()
    buckets = min(MOST_BUCKETS, max(1, -(-(size or 0) // BUCKET_BYTES)))
    cuts = [i / buckets for i in range(1, buckets)]
    found = prints.agg(F.percentile_approx("doc_id", cuts, 100 * buckets)).first()[0] if cuts else []
    bounds = F.array(*map(F.lit, sorted(set(found or [])))).cast("array<bigint>")
    n = len(set(found or []))
    steps = F.array(*(F.lit(2**i) for i in reversed(range(n.bit_length())))).cast("array<int>")
    # Binary search: how many bounds are below the id.
    bucket = F.aggregate(steps, F.lit(0), lambda low, step: F.when((low + step <= n) & (F.try_element_at(bounds, low + step) < F.col("doc_id")), low + step).otherwise(low))
    dealt = prints.withColumn("bucket", bucket)
    firsts = {row[0]: row[1] for row in dealt.groupBy("bucket").agg(F.max("doc_id")).collect()}
    if not firsts:
        return prints.select("*", F.col("text").alias("next_text"), F.col("hashes").alias("next_hashes"))
    filled = sorted(firsts)
    before = dict(zip(filled, filled[1:] + filled[:1]))
    first = F.element_at(F.array(*(F.lit(firsts.get(b)).cast("long") for b in range(n + 1))), F.col("bucket") + 1)
    goes_to = F.element_at(F.array(*(F.lit(before.get(b, 0)) for b in range(n + 1))), F.col("bucket") + 1)
    places = F.when(F.col("doc_id").eqNullSafe(first), F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("is_end")), F.struct(goes_to.alias("bucket"), F.lit(1).alias("is_end")))).otherwise(F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("is_end"))))
    placed = dealt.withColumn("place", F.explode(places)).select("doc_id", "text", "hashes", "place.*")
    order = Window.partitionBy("bucket").orderBy("is_end", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text")
    lined = placed.select("doc_id", "text", "hashes", "is_end", F.lead("text").over(order).alias("next_text"), F.lead("hashes").over(order).alias("next_hashes"))
    return lined.where("is_end = 0").drop("is_end")


def compare_with_edit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", scale: int = SCALE) -> DataFrame:
    """Each document's fingerprint beside that of its text half replaced by the next one.

    Returns (doc_id, n_chars, edited, hashes, edited_hashes, next_hashes).
    """
    lined = with_next(fingerprint(df, id_col, text_col, scale)).withColumn("n_chars", F.char_length("text").cast("long"))
    replaced = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - replaced), F.substring(F.col("next_text"), F.lit(1), replaced))
    made = lined.select("doc_id", "n_chars", "hashes", "next_hashes", edited.alias("edited"))
    words = made.withColumn("edited_words", words_of(F.col("edited")))
    return words.select("doc_id", "n_chars", "edited", "hashes", sketch(F.col("edited_words"), scale).alias("edited_hashes"), "next_hashes")
