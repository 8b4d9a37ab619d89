"""A training corpus from raw documents: five stages, each on all rows that the one before it kept.

Every stage takes (spark, docs, sf_dir); what it returns is written as Parquet in the shared folder and
read again as the next one's documents. All but the last return the columns of documents. Each operator
states what it does with NULLs, empty texts, repeated rows and empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import decontamination, mixing, quality, secret_scan, simhash
from ordermill.llm.common import fold, table
from ordermill.session import materialise


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    learn = F.coalesce(fold("doc_id", 3) != 1, F.lit(False))
    return quality.kept(docs, table(spark, sf_dir, "labels"), learn)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id, whatever ids the others have."""
    return simhash.deduplicated(docs)


def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced; ``n_chars`` counts the new text where it was changed."""
    before = "__before"
    while before in docs.columns:
        before += "_"
    clean = secret_scan.redacted(docs.withColumn(before, F.col("text")))
    counted = F.when(F.col("text") == F.col(before), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return clean.withColumn("n_chars", counted).drop(before)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("simhash near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_filter),
    ("secret scans", secret_removal),
    ("source mix", source_mix),
]

#: The classifier is trained, so SQL cannot give these rows. A test takes each stage's documents from what its operator
#: finds on that stage's input; the operators have tests against plain programs and held-out labels of their own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
