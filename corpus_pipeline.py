"""A corpus pipeline over ``documents``: language, toxicity, exact and near
duplicates, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
works on all documents the stage before it kept.  All but the last return the
columns of ``docs``.  ``run`` writes the result of every stage as Parquet in the
session's checkpoint folder and hands the table read back to the next stage.

The stages learn from the documents they are given and their labels, so SQL
cannot express them (``ORACLE_SQL`` is None); ``tests/llm`` compares each stage
with a plain version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataform.llm import exact_dedup, language_id, minhash_dedup, packing, toxicity
from strataform.llm.common import read_table, scratch_table, ship_package

ORACLE_SQL = None


def _ready(spark: SparkSession) -> None:
    """The package on the executors, and smaller batches for Python: a batch of
    10,000 long texts on both sides of a worker is what a stage needs most memory
    for."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the documents' own labels define."""
    _ready(spark)
    return language_id.keep_identified(docs, F.lit(True))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic by a chain learned from the labelled ones."""
    _ready(spark)
    chain = toxicity.toxicity_chain(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, chain)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    _ready(spark)
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    _ready(spark)
    return minhash_dedup.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents in sequences of at most 4096 ids."""
    _ready(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("toxicity", clean), ("exact_dedup", exact),
          ("near_dedup", near), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the packed pieces."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
