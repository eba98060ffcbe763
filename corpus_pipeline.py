"""The training-text pipeline: language, quality rules, near-duplicates, mixing, tokens.

Each stage reads what its predecessor wrote, so a lost executor repeats one stage's
tasks only and no plan grows over the stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from icufeat.llm import jaccard, languages, mixing, rules
from icufeat.llm.common import read, stored
from icufeat.llm.pieces import token_digests
from icufeat.llm.queries import tokenizer_file

#: Texts that are closer to no learned language than this are in none.
LEAST_LANGUAGE_SCORE = 0.35
#: Near-duplicates share this percentage of their shingles of that many words at least.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose text is in a language learned from the stage's own input."""
    profiles = languages.learn_profiles(docs)
    return languages.in_language(docs, profiles, LEAST_LANGUAGE_SCORE)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that pass the base rules and the trained classifier."""
    return rules.kept_rows(docs, rules.fit_classifier(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each linked group."""
    return jaccard.one_of_each(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws the sample that follows the target shares of source, language and topic."""
    return mixing.draw(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes and decodes every text: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return token_digests(docs, tokenizer_file())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("mixing", mixed),
    ("tokens", tokens),
]

#: Not expressible: the first two stages learn models, the last one encodes.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
