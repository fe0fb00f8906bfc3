"""Training-data pipeline: quality rules, near-duplicates, personal data, source mix, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that the
stage before kept; the result is written as Parquet and read as the next
stage's input. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common as C
from tidemark.llm import jaccard, mixing, outliers, packing, pii


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the robust outlier test keep."""
    return outliers.judge(docs, C.DOC_COLS).filter("kept").select(*C.DOC_COLS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the shingle join: the one with the smallest id.

    Of repeated rows with that id one stays; documents without words stay.
    """
    d = C.stored(docs.select(*C.DOC_COLS, F.monotonically_increasing_id().alias("_row")))
    comp = jaccard.join(d, doc_id="_row").select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group"))
    first = (d.select("_row", "doc_id").join(comp, "_row").groupBy("_group")
             .agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row"))).alias("_first")))
    return d.join(first.select(F.col("_first._row").alias("_row")), "_row", "left_semi").select(*C.DOC_COLS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data replaced by its kind."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the source schedule takes, each as often as it takes them."""
    return mixing.mixed_documents(docs.select(*C.DOC_COLS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their place in a sequence."""
    return packing.pack_documents(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mix", mix), ("pack", pack)]

ORACLE_SQL = None      # outlier estimates, boosted trees and packing are not expressible in SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = C.table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = C.stored(docs)
    return docs
