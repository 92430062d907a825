"""The corpus pipeline: documents pass through stages, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept. The first four return the
columns of documents; the last returns what the encoder makes of what is left.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bpe_prefix, decontaminate, minhash_dups, quality_cnn, queries, toxicity
from millrace.llm.common import stored, table


#: What Spark hands to a Python worker at once; both sides hold whole batches, and a text is some kB.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def lean(stage):
    """A stage with small Arrow batches; the setting stays with the session, for stages are computed when they are read."""
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, value in BATCHES.items():
            spark.conf.set(key, value)
        return stage(spark, docs, sf_dir)
    return run_stage


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity lexicon, learned from the labels of these documents, does not reject."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network, learned from the labels of these documents, does not reject."""
    return quality_cnn.keep_good(docs, quality_cnn.fit(docs, table(spark, sf_dir, "labels")))


def one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return minhash_dups.keep_first(docs)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of the ids and the decoded text of each document that is left."""
    return queries.bpe_digests(bpe_prefix.encode_decode(docs, queries.tokenizer_path("word_bpe_49k.json")))


STAGES = [("toxicity", lean(not_toxic)), ("quality", lean(good)), ("near_duplicates", lean(one_of_copies)),
          ("decontamination", lean(not_in_benchmark)), ("bpe", lean(encoded))]

#: Two stages are learned models, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
