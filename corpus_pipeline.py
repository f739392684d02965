"""A training corpus in five stages; each takes all that the one before it kept.

``STAGES`` lists (name, function); a function takes (spark, docs, folder) and
returns the documents it keeps, in the columns of ``documents`` (the last one
returns the shards).  ``run`` applies them, writing and rereading between two.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillroll.llm.decontaminate import clean_documents
from tillroll.llm.fertility import keep_good
from tillroll.llm.jaccard import one_of_each
from tillroll.llm.mixture import mixed_documents
from tillroll.llm.sharding import shard_documents
from tillroll.llm.tables import Stages


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents within the quality rules' bands."""
    return keep_good(docs, public_tokenizers.path("piece_bpe_32k.model"))


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group linked by 0.8 of its five-word shingles."""
    return one_of_each(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return clean_documents(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Shard and slot of every document taken."""
    return shard_documents(docs, 40)


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

#: The verdicts of a vocabulary and the search for the least capacity can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = Stages(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = stages.write(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
