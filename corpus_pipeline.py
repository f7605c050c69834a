"""Corpus pipeline: stages over ``documents``, each one an operator of ``gridloom.llm``.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; a table is written between stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import decontaminate, mixing, pii, quality
from gridloom.llm.jaccard_join import JaccardJoin, text_hash
from gridloom.llm.rows import one_of_each
from gridloom.llm.scratch import Scratch
from gridloom.session import ship


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier keeps."""
    ship(spark)
    model = quality.train(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.kept(docs, model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts (the smallest id; one without an id only where no other is), once; empty texts stay.

    Different texts of one id are different documents. Of rows that repeat an id and its text the least by the other columns stays.
    """
    ship(spark)
    kept = JaccardJoin(spark, docs).keepers()
    keyed = lambda frame, hashed: frame.select("*", F.coalesce("doc_id", F.lit(0)).cast("long").alias("__id"), F.col("doc_id").isNull().alias("__none"), hashed.alias("__text"))
    on = ["__id", "__none", "__text"]
    rows = keyed(docs, text_hash(F.col("text"))).join(keyed(kept, F.col("text_hash")).select(*on), on)
    return one_of_each(rows, on)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    ship(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked by kind."""
    ship(spark)
    return pii.mask(docs, pii.train_on(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the source mix takes, with the words it takes of them."""
    ship(spark)
    return mixing.mixed_documents(spark, docs)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("personal data", without_personal_data),
    ("source mix", mixed),
]

#: Two of the stages apply trained models, which SQL can't express; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all that its predecessor kept, with a Parquet table between two stages."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.table(docs, name.replace(" ", "-"))
    return docs
