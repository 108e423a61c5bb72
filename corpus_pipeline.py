"""The corpus pipeline: five stages over documents, each one operator of sitefold.llm.

A stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again as the
next one's docs. All but the last return the columns of documents, whatever they are called.

Null and empty texts fail the length rule of the first stage; later stages meet none from it, but take them
as their operators say (nothing to cut, near to nothing, clean, size 0). Repeated rows are judged alike; the
near-duplicate stage keeps one of them. An empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sitefold.llm import decontamination, line_dedup, mixing, near_dedup, quality_rules
from sitefold.llm.common import documents, materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut, but for their first occurrence; documents of which nothing is left go."""
    cut = line_dedup.dedup_lines(docs).where("NOT emptied")
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("n_lines_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(dict(docs.dtypes)["n_chars"]))
    return cut.select(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, similarity 0.8 or more."""
    return near_dedup.keep_first(docs, shingle_words=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontamination.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("NOT leaked").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, with the copy's number and the source's figures."""
    return mixing.emit(mixing.mix(docs))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("decontamination", decontaminate),
    ("source_mixing", mix_sources),
]

#: Rolling hashes, signatures and seeds have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, name)
    return docs
