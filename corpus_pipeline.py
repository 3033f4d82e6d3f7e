"""From raw documents to packed token sequences: quality, language, near-duplicate lines, near-duplicate documents, packing.

Every stage reads the Parquet table that the stage before it wrote, and works on all of it. All columns of a document stay
until the last stage, whatever they are called. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitetally.llm import language, line_dedup, packing, quality, signature_join
from sitetally.llm.common import remainder, saved
from sitetally.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the basic rules or the depletion rule reject go."""
    return quality.kept_documents(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go; a missing ``lang`` becomes the predicted one."""
    model = language.fitted(docs.where(remainder("doc_id", 5) != 0))
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # whatever the columns are called, nothing clashes
    plain = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    rows = language.predicted(plain, model, names["text"], tuple(names.values())).where(F.col("lang_pred") != language.UNKNOWN)
    filled = rows.withColumn(names["lang"], F.coalesce(names["lang"], "lang_pred"))
    return filled.select(*(F.col(n).alias(c) for c, n in names.items()))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicate lines one stays; a document without any line left goes."""
    return line_dedup.deduplicated(docs).where(F.col("text") != "")


def documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return signature_join.one_of_each(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("quality rules", quality_rules), ("language id", language_id), ("line dedup", lines),
          ("n-gram jaccard join", documents), ("packing", sequences)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
