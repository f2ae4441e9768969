"""A corpus pipeline: language, quality, near duplicates, mixture, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on all its predecessor kept and, but
for the last, returns the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm import language, mix, ngram_join, pack, quality
from tradelake.llm.common import stored, table

TOKENIZER = "word_bpe_49k.json"


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter or unlike all that was learned go."""
    network = language.fit(docs)
    found = language.identify(docs, network, docs.columns)
    return found.where(~F.col("lang_foreign")).select(docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that rank with the good ones."""
    ranker = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, ranker, docs.columns)
    return scored.where(F.col("quality_score") >= quality.THRESHOLD).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    return ngram_join.keep_one(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as equal shares of bytes for all sources ask, in a global random order."""
    return mix.shuffled(mix.mix(docs)).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All tokens in sequences of 2,048."""
    return pack.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language", keep_languages),
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: Trained models, packing and the tokenizer have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
