"""A training corpus from `documents`: five stages, each on all that the one before it kept.

Each stage is written as Parquet in the shared folder and read again as the next one's documents.

Defined results, for all stages: null texts count as empty where they are judged, and stay null where
they are kept; ids may be null or repeat, rows are judged each; further columns are kept up to the last
stage, whatever they are called; texts of any length are read whole; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import common, decontaminate, ngram_join, packing, quality, secrets
from lodestar.llm.encoding import tokenizer_path


def _bounded(spark: SparkSession) -> None:
    """Fewer rows in an Arrow batch than by default: stages that follow one another in the same executors
    share their memory, and a batch of long texts is held by the JVM and by a worker. The driver hands
    back what the stage before it left."""
    common.trim()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts: a score of 0.7 or more, 0.7 itself too. Equal texts
    score alike. Without labels of both kinds the score is the share of good ones, or 1."""
    _bounded(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~quality.held_out())
    return quality.good_documents(docs, quality.fit(docs, labels))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8 or more: the one of
    the smallest id (of rows that share it, any one; ids that are null come last). Documents without
    words link with nothing and stay."""
    _bounded(spark)
    return ngram_join.unique_documents(docs, k=5, num=80, den=100)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """No benchmark spans; documents of which they are more than half of the words go, half itself stays."""
    _bounded(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets masked, from a probability of 0.5 on; nothing else of a text changes."""
    _bounded(spark)
    return secrets.redact(docs, secrets.fitted(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences of 4096 tokens; null and empty texts are pieces of the end id. A smaller cache of words than alone: executors have other stages behind
    them, whose memory the JVM keeps."""
    _bounded(spark)
    return packing.packed_documents(docs, tokenizer_path("word_bpe_49k.json"), end_id=1, capacity=4096, cache_words=50_000, lean=True)


STAGES = [
    ("quality", good_quality),
    ("near duplicates", one_of_near_duplicates),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: The classifiers and the packing search are beyond SQL; tests/llm/test_registered.py holds each stage
#: against a brute-force version on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed pieces of `documents` after all stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = common.written(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
