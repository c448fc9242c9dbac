"""The corpus pipeline: from raw documents to token files, one operator a stage.

Each stage works on what its predecessor kept: toxic documents go; of near-duplicates the one with the least doc_id
stays; passages of the benchmark are cut out of the texts; sources are mixed, so that a document leaves or comes again;
and the mix is written as token ids and read back. A stage's table is deleted when the next one's is written.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackframe.llm import decontaminate, jaccard, mixing, tokens, toxicity
from trackframe.llm.common import Scratch, read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.7 or more go; null and empty texts score least and stay."""
    lexicon = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, lexicon)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a similarity of 0.8 or more of their five-word shingles, the one with the least doc_id stays.

    The operator's vantage-point trees find the nearest fingerprints; links that fingerprints miss are found by prefixes.
    """
    return jaccard.one_of_each(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; n_chars follows the text."""
    cut = decontaminate.remove_contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return cut.withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document comes as often as the mix takes any of its words, up to twice; without words taken, it goes."""
    return mixing.repeat_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: a row for each document in it."""
    return tokens.token_output(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", cut_benchmark),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]
#: SQL has no learnt lexicon, XXH64 SimHash or tokenizer; tests/llm/test_pipeline.py checks the stages instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = read_table(spark, sf_dir, "documents"), Scratch()
    for _, stage in STAGES:
        before, held = held, Scratch()
        docs = held.written(stage(spark, docs, sf_dir))
        before.clear()
    return docs
