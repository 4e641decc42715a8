"""From raw documents to packed training sequences, in five stages.

Each stage gets what its predecessor kept, as a table with the columns of
``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.llm import exact_dedup, mixing, near_dedup, packing, quality_rules
from lendspark.llm.common import documents
from lendspark.session import ensure_checkpoint_dir


NEAR_PERCENT = 80  # similarity on five-word shingles; the query op1_near_dedup has its own


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of each group of equal texts that stays."""
    return _kept(docs, exact_dedup.exact_duplicates(docs))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, linked from NEAR_PERCENT on: the smallest doc_id."""
    return _kept(docs, near_dedup.near_duplicates(docs, NEAR_PERCENT))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: repeated, once or not at all."""
    return mixing.repeat(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, as pieces with their places."""
    return packing.pack(docs)


def _kept(docs: DataFrame, verdict: DataFrame) -> DataFrame:
    """Rows whose doc_id the verdict keeps; it leaves only if no row of it is kept."""
    name = f"gone_{uuid.uuid4().hex}"  # no column of docs has it
    gone = verdict.groupBy(F.col("doc_id").alias(name)).agg(F.max("kept").alias("stays")).where("not stays").select(name)
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone[name]), "left_anti")


STAGES = [("quality rules", rules), ("exact dedup", exact), ("near dedup", near), ("mixing", mix), ("packing", pack)]

#: Compression ratios, tokens and near-duplicate links have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    base = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = f"{base}/{k}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
