"""The pipeline against its stages done by brute force."""

import public_tokenizers
from llm_support import SMALL, shipped  # noqa: F401
from test_jaccard import brute_force
from tokenizers import Tokenizer

import corpus_pipeline
from viewlake.llm import mixing, pii


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], SMALL).cache())
    _, told, single, clean, mixed, coded = seen
    for frame in (told, single, clean, mixed):
        assert frame.schema.names == docs.schema.names and frame.dtypes == docs.dtypes

    with_letters = {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}
    assert {r["doc_id"] for r in told.collect()} == with_letters

    rows = [(r["doc_id"], r["text"]) for r in told.collect()]
    firsts = {i for i, c, _ in brute_force(rows) if i == c}
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(firsts)

    before = {r["doc_id"]: r["text"] for r in single.collect()}
    for row in clean.collect():
        assert row["n_chars"] == len(row["text"]) and not pii.base_spans(row["text"])
        if not pii.base_spans(before[row["doc_id"]]):
            assert "[CARD]" in row["text"] or "[PHONE]" in row["text"] or row["text"] == before[row["doc_id"]]

    copies = {r["row"]["doc_id"]: r["copies"] for r in mixing.plan_mix(clean).collect()}
    found = {}
    for row in mixed.collect():
        found[row["doc_id"]] = found.get(row["doc_id"], 0) + 1
    assert found == {i: n for i, n in copies.items() if n}

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    assert coded.count() == mixed.count()
    for row in coded.collect()[:60]:
        assert row["ids"] == library.encode(texts[row["doc_id"]], add_special_tokens=False).ids

    whole = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, whole.select("doc_id", "ids_sha256").collect())) == sorted(map(tuple, coded.select("doc_id", "ids_sha256").collect()))


def write_documents(spark, tmp_path, rows, columns="doc_id long, text string, lang string, source string, n_chars long"):
    folder = tmp_path / "tables"
    spark.createDataFrame(rows, columns).write.mode("overwrite").parquet(str(folder / "documents.parquet"))
    return str(folder)


def test_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, write_documents(spark, tmp_path, [])).count() == 0


def test_null_texts_and_other_columns(spark, tmp_path):
    texts = {1: "The quick brown fox jumps over the lazy dog near the old river bank", 2: "Der schnelle braune Fuchs springt am alten Fluss entlang", 3: "The quick brown fox jumps over the lazy dog near the old river bank", 4: "Write to a.b@example.org about it"}
    rows = [(i, t, ("en", "de")[i == 2], "s", len(t), 1, "x", None) for i, t in texts.items()]
    rows += [(5, None, None, None, None, 1, "x", None), (6, "", "en", "s", 0, 1, "x", None), (7, "12345", "en", "s", 5, 1, "x", None), (None, "A text that has no id but words", "en", None, 31, 1, "x", None)]
    folder = write_documents(spark, tmp_path, rows, "doc_id long, text string, lang string, source string, n_chars long, ids int, spans string, score double")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "spans", "score"]
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {5, 6, 7, 3}.isdisjoint(kept) and "[EMAIL]" in kept.get(4, "[EMAIL]")
    assert corpus_pipeline.run(spark, folder).columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
