"""A training-data pipeline over the table of documents: toxicity, near duplicates, repeated passages, mixing, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the docs of the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm import bpe, byte_dedup, mixing, simhash, toxicity
from meridian.llm.common import documents, materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained on the labelled ones, scores under one half."""
    net = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, net, tuple(docs.columns), into="__score").where(F.col("__score") < 0.5).drop("__score")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of five words, similarity 0.8."""
    return simhash.drop_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings of 50 that an earlier document has too."""
    return byte_dedup.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight takes them."""
    return mixing.mixed_documents(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and the digest of what they decode to."""
    found = bpe.round_trip(docs, bpe.default_vocabulary(), keep=("doc_id", "lang", "source"))
    return found.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("repeats", cut_repeats), ("mixing", mix_sources), ("tokens", tokenise)]

#: A trained network and similarity of sets are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, name)
    return docs
