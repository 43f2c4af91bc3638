"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir), calls one operator of ``pitchside.llm`` on
all rows its predecessor kept, and returns the columns of documents; the last adds
size, text_crc32, shard and slot.  Between stages the rows are written as Parquet,
so each starts without lineage.

Edge cases are those of the operators: null and empty texts are clean, count as one
class of copies, have no words to mix (they stay once) and size 1 in a shard; rows
without doc_id are never dropped as copies; an empty table gives an empty corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitchside.llm.common import held_out, saved, table
from pitchside.llm.decontam import decontaminate
from pitchside.llm.mixing import mixed_documents
from pitchside.llm.sharding import shard_documents
from pitchside.llm.simhash import one_per_group
from pitchside.llm.toxicity import clean_documents

#: The mix's weights by source in code-point order, repeating, and its most epochs.
WEIGHTS, EPOCHS = (1, 2, 3), 3
SHARDS = 16


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return clean_documents(docs, docs, table(spark, sf_dir, "labels"), ~held_out("doc_id", 5, 0))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return one_per_group(docs, words=3, max_bits=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document of a repeated epoch is repeated."""
    return mixed_documents(docs, WEIGHTS, EPOCHS)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Balanced shards, equal texts together."""
    return shard_documents(docs, SHARDS)


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: The stages learn a model, hash with XXH64 and align text: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
