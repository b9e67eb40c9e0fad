"""From raw documents to token ids: toxic documents go, one of each group of near duplicates stays, documents that hold
passages of the benchmark go, the rest is encoded.

Each stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of ``docs`` as they are. ``run`` writes
what a stage returns to the shared folder and reads it again, so that a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import flowlab
from flowlab.llm import bpe, decontaminate, tensor_minhash, toxicity
from flowlab.llm.tables import read_table, written

# Functions travel to the Python workers with their code, so executors need no installed copy.
cloudpickle.register_pickle_by_value(flowlab)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fitted(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tensor_minhash.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: SQL expresses neither the classifier nor the tokenizer; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
