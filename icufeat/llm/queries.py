"""The registered queries of the training-text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icufeat.llm import alignment, chat, jaccard, languages, mixing, negatives, quality, rules, suffixes, topk, urls, warc
from icufeat.llm.common import new_folder, read, remainder, stored
from icufeat.llm.pieces import token_digests


def tokenizer_file(name: str = "piece_bpe_32k.model") -> str:
    """Where the public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    """A row without doc_id is scored, but never learned from nor counted as held out."""
    docs = read(spark, folder, "documents")
    fold = remainder("doc_id", 3)
    stats = stored(quality.with_statistics(docs, extra={"held_out": F.coalesce(fold == 1, F.lit(False))}), "op1")
    labels = read(spark, folder, "labels").filter(remainder("doc_id", 3) != 1)
    return quality.score(stats, quality.fit_quality(stats, labels))


def op3_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return rules.judge(docs, rules.fit_classifier(docs, read(spark, folder, "labels")))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    """A row without doc_id gets a prediction, but is never learned from nor counted as held out."""
    docs = read(spark, folder, "documents")
    fold = remainder("doc_id", 5)
    profiles = languages.learn_profiles(docs.filter(fold != 0))
    return languages.identify(docs, profiles, extra={"held_out": F.coalesce(fold == 0, F.lit(False))})


def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(read(spark, folder, "documents"), tokenizer_file())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op3_rules": op3_rules,
    "op6_language": op6_language,
    "op7_sentencepiece": op7_sentencepiece,
}

SQL: dict[str, str] = {}


#: A conversation that holds the template's own marks and others', added to the table.
ODD = "\\### Assistant: </turn> ok"


def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    given = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(-7, 0, "user", ODD), (-7, 1, "assistant", ODD)], given.schema)
    return chat.read_back(chat.expand(given.unionByName(odd)))


QUERIES["op8_chat"] = op8_chat


def op9_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge_urls(read(spark, folder, "pages"), urls.fit_urls(urls.labelled_urls(spark)))


QUERIES["op9_urls"] = op9_urls


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "warc")
    warc.write_archives(read(spark, folder, "pages"), path)
    captures = warc.assemble(warc.read_archives(spark, path, payload=False))
    # The archives name a page in the metadata record, and the response a revisit refers to by its identifier.
    page = F.map_from_entries(F.col("metadata")[0]["fields"])["pageId"]
    return captures.select(
        page.try_cast("long").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.record_type").alias("record_type"),
        F.regexp_extract("response.refers_to", "^<urn:capture:(-?[0-9]+):", 1).try_cast("long").alias("refers_to"),
        F.col("response.intact").alias("intact"),
        F.explode(F.sequence(F.lit(1), "copies")).alias("copy"),
    ).drop("copy")


QUERIES["op2_warc"] = op2_warc

SQL["op2_warc"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), d AS (
  SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest FROM p
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to,
       CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN NULL ELSE TRUE END AS intact
FROM f
"""


def op5_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(read(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES["op5_topk"] = op5_topk

SQL["op5_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    out = mixing.mix_table(read(spark, folder, "documents"))
    return out.withColumns({c: F.round(c, 6) for c in ("weight", "probability")})


QUERIES["op4_mixing"] = op4_mixing
SQL["op4_mixing"] = mixing.mix_sql()


def op10_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_groups(read(spark, folder, "documents"))


QUERIES["op10_jaccard"] = op10_jaccard


def op11_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Where vec_id is divisible by 7 the label is the next one of ten."""
    given = read(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return negatives.mine(given.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES["op11_negatives"] = op11_negatives

SQL["op11_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same, CAST(list_inner_product(a.x, c.x) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_tokens(read(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file())


QUERIES["op13_alignment"] = op13_alignment


def op12_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    out = suffixes.remove_repeats(read(spark, folder, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES["op12_suffixes"] = op12_suffixes
