"""A training-corpus pipeline of five stages over ``documents``.

Each stage is a function of (spark, docs, sf_dir); its rows are written as
Parquet and read again as the next stage's documents.  All stages but the last
return the columns of ``documents``; the last adds ``shard`` and ``slot``.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tapflow.llm import decontaminate, minhash, mixing, quality, sharding
from tapflow.llm.tables import table
from tapflow.session import shared_dir


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on ``labels``, does not reject."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, 0.8)."""
    return minhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no item of ``benchmark``."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the source mix takes them (a copy per round, see ``mix_documents``)."""
    return mixing.mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its place in it."""
    return sharding.shard_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("minhash near-dedup", one_of_each),
    ("benchmark decontamination", decontaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: A trained classifier, MinHash candidates and keyed permutations: not SQL.
#: tests/llm/test_pipeline.py holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage is written to the shared folder
    named by ``spark.checkpoint.dir`` and read again by the next.  A stage's folder
    is deleted when the next one is written; the last one (and, after a failure,
    what is there) when the driver ends."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/corpus-pipeline-{uuid4().hex}")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    files.deleteOnExit(root)
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        path = f"{root.toString()}/{i}-{name.replace(' ', '-')}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(before), True)
        before = path
    return docs
