"""Corpus pipeline: from raw documents to packed training sequences.

Each stage calls one operator on all its predecessor kept.  ``run`` writes a
stage's result as Parquet into the shared folder named by
``spark.checkpoint.dir`` and reads it back as the next one's documents, so a
lost executor costs no more than the stage it worked on.

All stages but the last return the columns of documents.  Null and empty texts
pass the quality classifier, copies of them go with the exact dedup, and the
mix leaves them out, because they have no words to take.  An empty table
gives an empty packing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rankforge.llm import exact_dedup, jaccard_join, mixing, packing, quality
from rankforge.session import ensure_checkpoint_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that the quality classifier rejects go."""
    return quality.drop_poor_texts(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one document of each group of equal texts stays."""
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: one document of each group of near copies stays."""
    return jaccard_join.drop_near_copies(docs, keep_no_id=False)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents as often as the mix takes them."""
    return mixing.mix_sources(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the mix packed into sequences, one row per piece."""
    return packing.pack(docs, packing.tokenizer_path())


STAGES = [("quality classifier", quality_stage), ("exact dedup", exact_stage), ("n-gram jaccard join", near_stage),
          ("mixing sources", mix_stage), ("best-fit packing", pack_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/stage-{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: Tokenisation and the model's thresholds are beyond SQL; the tests hold the
#: pipeline against a brute-force version.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL}
