"""The corpus pipeline: five operators over documents, each on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. run()
writes each stage as Parquet in the shared folder and reads it again for the next one. A decision is about a row: rows
that share a doc_id, or have none, are told apart by their texts. Of near-duplicate groups, which are of documents, a
row without a doc_id is none and stays, and rows that share a doc_id go or stay together. Empty tables go through.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate, exact_dedup, mixing, near_dedup, toxicity
from tidewatch.llm.common import saved


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go. The model is learnt from the labelled rows of docs that aren't held out."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group (five words, similarity 0.8) the smallest doc_id stays."""
    gone = near_dedup.near_duplicates(docs, k=5).where("doc_id is not null and not kept").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to equal weights: the columns of documents, copy and shuffle_key, in shuffled order."""
    return mixing.mixed(docs)


STAGES = [("toxicity", toxic), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", clean), ("mixing", mix)]

#: A learnt score, the similarity join and its components have no SQL form that ends in time on whole tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
