"""Language identification: phrases by brute force, held-out accuracy, odd rows."""

import math

from llm_support import SMALL, shipped  # noqa: F401
from pyspark.sql import functions as F

from viewlake.llm import language
from viewlake.llm.queries import QUERIES

SAMPLE = (("x", "the cat sat on the mat and the rat"), ("y", "der hund und die katze auf der matte"))


def phrases(text, sample, block=language.BLOCK_SYMBOLS):
    """Longest matches one after the other, by substring search."""
    clean = lambda t: "".join(c if c.isalpha() else " " for c in t.lower())
    squeeze = lambda t: " ".join(t.split(" ")) if "  " not in t else squeeze(t.replace("  ", " "))
    text, sample = squeeze(clean(text)), squeeze(clean(sample))
    count = 0
    for begin in range(0, len(text), block):
        part, at = text[begin:begin + block], 0
        while at < len(part):
            end = at + 1
            while end < len(part) and part[at:end + 1] in sample:
                end += 1
            count, at = count + 1, end
    return count, len(sample)


def test_phrases_equal_brute_force():
    parser = language.Parser(SAMPLE)
    texts = ["the rat sat", "Die Katze!! und 12 the hund", "", "zzz", "   ", "the mat and " * 200, "q"]
    counts, _, letters = parser.phrases(texts)
    for at, text in enumerate(texts):
        for lang, (_, sample) in enumerate(SAMPLE):
            assert counts[lang][at] == phrases(text, sample)[0], (text, lang)
    assert letters.tolist() == [True, True, False, True, False, True, True]
    assert all(abs(b - math.log2(phrases("", s)[1] + 1)) < 1e-9 for b, (_, s) in zip(parser.bits, SAMPLE))


def test_every_letter_of_the_samples_is_told_apart():
    hangul, han = ([chr(first + i) for i in range(400)] for first in (0xAC00, 0x4E00))
    sample = (("h", "".join(hangul)), ("k", "".join(han)), ("m", "".join(han[::-1]) + "İẞK"), *SAMPLE)
    parser = language.Parser(sample)
    assert not (parser.alphabet.symbols([t for _, t in sample])[0] == language.OTHER).any()
    texts = ["".join(hangul[300:340]), "".join(han[350:390]), "".join(han[390:350:-1]), "the " + "".join(han[5:9]) + "ж", "жщ" * 5]
    counts, _, _ = parser.phrases(texts)
    for at, text in enumerate(texts):
        for lang, (_, known) in enumerate(sample):
            assert counts[lang][at] == phrases(text, known)[0], (text, lang)
    assert parser.predict(texts[:3])[0] == ["h", "k", "m"]


def test_held_out_accuracy_and_shape(spark):
    got = QUERIES["op7_language_id"](spark, SMALL)
    joined = got.join(spark.read.parquet(f"{SMALL}/documents.parquet"), "doc_id")
    held = joined.where("held_out")
    assert held.count() == joined.where("crc32(cast(doc_id as string)) % 3 = 1").count()
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()
    assert got.where("score < 0 or score > 1").count() == 0


def test_labels_of_held_out_rows_are_not_learned(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    hidden = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), "??").otherwise(F.col("lang")))
    assert language.draw_sample(hidden) == language.draw_sample(docs)


def test_odd_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(None, None, "en"), (-1, "", None), (-2, "12 !!", "en"), (-3, "日本", None), (-4, "And the thing " * 9000, None)], docs.schema)
    df = docs.union(odd).withColumn("score", F.lit("clash"))
    got = {r["doc_id"]: r for r in language.predict_languages(df).collect()}
    assert [got[i]["lang_pred"] for i in (None, -1, -2)] == ["und"] * 3
    assert got[None]["score"] == 0 and not got[None]["held_out"]
    assert got[-4]["lang_pred"] == "en"
    kept = language.keep_identified(df)
    assert kept.columns == df.columns and kept.count() == docs.count() + 2


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(2, "some words", None)], "doc_id long, text string, lang string")
    assert language.predict_languages(df).first()["lang_pred"] == "und"
    assert language.predict_languages(df.where("false")).count() == 0


def test_unlabelled_rows_are_kept(spark):
    rows = [(1, "some words", None), (2, "日本", None), (3, "12 !!", None), (4, "", None), (5, None, None), (None, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["text"] for r in language.keep_identified(df).collect()} == {"some words", "日本", "x"}


def test_the_lowest_hashes_of_each_language_are_found(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "big").when(F.col("id") % 1000 == 1, "rare").otherwise(F.concat(F.lit("l"), F.col("id") % 7)).alias("lang"),
        F.xxhash64("id").alias("hash"), F.col("id").alias("doc_id"),
    )
    got = language._lowest(rows, 20, 500).groupBy("lang").agg(F.sort_array(F.collect_list("hash")).alias("h")).collect()
    every = rows.groupBy("lang").agg(F.sort_array(F.collect_list("hash")).alias("h")).collect()
    assert {r["lang"]: r["h"] for r in got} == {r["lang"]: r["h"][:20] for r in every}
    # Hashes that are not spread at all only raise the bound.
    high = rows.withColumn("hash", F.lit(2**62) + F.col("doc_id"))
    assert language._lowest(high, 5, 500).groupBy("lang").count().where("count <> 5").count() == 0
    most = language._lowest(rows, 5, 2).select("lang").distinct().collect()
    assert len(most) == 2 and "big" in {r["lang"] for r in most}
