"""The corpus pipeline: identified language, no near duplicates, pseudonyms, target mixture, token ids.

Each stage takes the documents its predecessor kept, written as Parquet and read again, and
returns documents with the same columns; the last returns one row of token digests for each
document of the mixture (a document that the mixture repeats has as many rows). Nulls,
empty texts, repeated rows, empty tables and further columns are treated as the operator of
each stage says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyboard.llm import language, mixing, pieces, pseudonyms, simhash
from tallyboard.llm.common import table
from tallyboard.session import scratch_table

# Language scores are mean probabilities; the lowest that counts as identified among four languages.
# At sf0.1, of 1,500 held-out texts 99.8 % scored 0.62 or more, 95 % of symbol texts of their lengths less than 0.59.
MIN_SCORE = 0.6

# Whoever runs this on real data sets spark.tallyboard.pseudonymKey to a key of their own.
DEFAULT_KEY = "corpus pipeline"

# Classifier and hashes make the result no matter of SQL; tests hold each stage against plain versions.
ORACLE_SQL = None


def least_score(languages: int) -> float:
    """Lowest score that counts: as far from chance to certainty, for any number of languages, as MIN_SCORE is for four."""
    chance = 1 / languages
    return chance + (MIN_SCORE - 1 / 4) / (1 - 1 / 4) * (1 - chance)


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network identifies; it learns from the documents' own labels.

    Without any label there is no network, and every text with a letter is kept.
    """
    network = language.learn(docs)
    if network is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return language.keep_identified(docs, network, least_score(len(network.labels)))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one with the smallest doc_id."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def pseudonymised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data, and their length in characters."""
    new = pseudonyms.pseudonymise(docs, spark.conf.get("spark.tallyboard.pseudonymKey", DEFAULT_KEY))
    return new.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else new


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: documents as often as it takes them, in shards that match it."""
    return mixing.mix(docs, mixing.make_plan(mixing.weigh(docs)))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text."""
    return pieces.digests(pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model")))


STAGES = [("language", identified), ("near duplicates", distinct), ("personal data", pseudonymised), ("mixture", mixed),
          ("token ids", encoded)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
