"""A training corpus from raw documents, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorframe.llm.common import discard, materialise, remainder, table
from sensorframe.llm.decontamination import decontaminate
from sensorframe.llm.mixing import in_mixed_order
from sensorframe.llm.near_dup import keep_one_of_each
from sensorframe.llm.sharding import shard
from sensorframe.llm.toxicity import drop_toxic, fit_toxicity

TOXIC = 0.3


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that operator 1 predicts to be toxic: a calibrated score of 0.3 or more."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2)
    return drop_toxic(docs, model, TOXIC)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates, by bags of shingles, keep the document of least identifier."""
    return keep_one_of_each(docs, weighted=True)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold an item of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), stored=True)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put all documents in the order of the mix; none is dropped or repeated. The order is that of the files it is written to."""
    return in_mixed_order(docs, stored=True)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deal all documents into shards of equal counts: each is a uniform sample of the mix, in the order of the mix."""
    return shard(docs, in_order=True, stored=True)


STAGES = [
    ("toxicity", toxicity),
    ("near-dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: SQL can express neither the classifier nor the draws; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each over the whole output of the one before, which is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(before)  # nothing reads a stage once the next is stored
    return STAGES[-1][1](spark, docs, sf_dir)
