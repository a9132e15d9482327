"""The operators' queries over the test tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlake.llm import bpe, chat, fingerprints, html_text, jaccard, language, mixing, pii, resampling, token_files, vectors, warc, whitening
from viewlake.llm.scratch import cut, drop_folder, new_folder
from viewlake.llm.shipping import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"
END_ID = 2


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_files(spark, sf_dir):
    """Write the token files, and return digests of what is read back from them."""
    folder = new_folder(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(WORD_VOCABULARY), end_id=END_ID)
    digests = token_files.read_digests(spark, folder)  # kept apart from the files
    drop_folder(spark, folder)
    return digests


@query
def op2_pii(spark, sf_dir):
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["is_base"])
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def n_base(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["is_base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(n_base, pii.KINDS), F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))


@query
def op3_jaccard_join(spark, sf_dir):
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"))


@query
def op4_chat_formatting(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    both = r"\### Assistant: </turn> ok"
    extra = spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(turn).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(both).alias("text")) for turn, role in enumerate(("user", "assistant"))))).alias("turn")).select("turn.*")
    return chat.read_back(chat.format_conversations(turns.union(extra)))


@query
def op5_exact_top_k(spark, sf_dir):
    return vectors.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op6_mixing(spark, sf_dir):
    planned = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return planned.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query
def op7_language_id(spark, sf_dir):
    return language.predict_languages(table(spark, sf_dir, "documents"))


@query
def op8_bpe(spark, sf_dir):
    made = bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_VOCABULARY))
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op9_html_text(spark, sf_dir):
    pages = html_text.extract(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op10_fingerprints(spark, sf_dir):
    made = fingerprints.compare_with_edit(table(spark, sf_dir, "documents"))
    own, edited, following = F.col("hashes"), F.col("edited_hashes"), F.col("next_hashes")
    return made.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_string(own).alias("fingerprint"), fingerprints.as_string(edited).alias("edited_fingerprint"),
        fingerprints.resemblance(own, edited).alias("near_edited"), fingerprints.resemblance(own, following).alias("near_next"),
    )


@query
def op11_whitening(spark, sf_dir):
    made = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return made.withColumn("deviation", F.col("deviation").cast("long"))


@query
def op12_warc(spark, sf_dir):
    """Write the archives, and return what is read back from them."""
    folder = new_folder(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), folder)
    index = cut(warc.read_index(spark, folder))  # kept apart from the files
    drop_folder(spark, folder)
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op13_resampling(spark, sf_dir):
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op4_chat_formatting"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), made AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>') AS body,
    replace(replace(replace(replace(role, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>'), ':', '\:') AS name
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ' || name || ': ' || body || '</turn>') + 1)::BIGINT AS formatted_chars
FROM made GROUP BY conv_id
"""

ORACLES["op5_exact_top_k"] = """
WITH able AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM able q JOIN able c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored
)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM ranked WHERE n <= 10
"""

ORACLES["op6_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, text, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5.0, 2.0, 1.0][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INTEGER]::DOUBLE AS weight
  FROM sized GROUP BY source
), leveled AS (
  SELECT *, 3.0::DOUBLE * source_size AS stop,
    ((sum(source_size) OVER ())::DOUBLE
      - coalesce(sum(3.0::DOUBLE * source_size) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM sources
  WINDOW before AS (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, least(weight * (SELECT max(level) FROM leveled WHERE level * weight <= stop), stop) AS target FROM leveled
), planned AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size = 0 THEN 0.0::DOUBLE ELSE target / source_size END AS rate,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS draw
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
  (floor(rate)::BIGINT + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) * size AS taken
FROM planned
"""

ORACLES["op12_warc"] = """
WITH hashed AS (
  SELECT page_id, url, sha1(coalesce(html, '')) AS sha1, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY sha1, payload_bytes ORDER BY page_id NULLS LAST, url NULLS LAST) AS n,
    first_value(page_id) OVER (PARTITION BY sha1, payload_bytes ORDER BY page_id NULLS LAST, url NULLS LAST) AS first_id
  FROM hashed
)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(32), lambda i:
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((('0x' || substr(sha1, 1 + (i // 4 * 5)::INTEGER, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER]), 'string_agg', '') AS payload_digest,
  CASE WHEN n = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN n > 1 THEN first_id END AS refers_to
FROM placed
"""

ORACLES["op13_resampling"] = r"""
WITH raw AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), features AS (
  SELECT row, word, count(*) AS n FROM (SELECT row, unnest(words) AS word FROM raw) GROUP BY ALL
), wanted AS (
  SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark) GROUP BY ALL
), steps AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS step
), hashed AS (
  SELECT word, xor(list_reduce(list_transform(range(octet_length(encode(word))), lambda i: ('0x' || substr(hex(encode(word)), (1 + 2 * i)::INTEGER, 2))::BIGINT),
    lambda c, b: xor(c >> 8, step[1 + (xor(c, b) & 255)]), 4294967295::BIGINT), 4294967295::BIGINT) % 10000 AS bucket
  FROM (SELECT word FROM features UNION SELECT word FROM wanted), steps
), buckets AS (
  SELECT bucket, sum(s) AS s, sum(t) AS t FROM (
    SELECT bucket, n AS s, 0 AS t FROM features JOIN hashed USING (word)
    UNION ALL SELECT bucket, 0, n FROM wanted JOIN hashed USING (word))
  GROUP BY 1
), gains AS (
  SELECT bucket, floor(1000.0::DOUBLE * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM buckets
), weights AS (
  SELECT row, sum(n * gain)::BIGINT AS weight FROM features JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY 1
), scored AS (
  SELECT doc_id, coalesce(len(words), 0)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000.0::DOUBLE * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM raw LEFT JOIN weights USING (row)
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= (SELECT count(*) * 10 // 100 FROM scored WHERE n_features >= 20) THEN place END AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored)
"""
