"""From raw documents to a training mixture: quality rules, line dedup, near-dedup, decontamination, mixing.

Each stage takes what its predecessor kept, written as Parquet and read again, so a lost executor costs one stage's
tasks at most.  All but the last keep the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posttrend.llm import decontaminate, lines, minhash, mixing, quality
from posttrend.llm.common import stored, table


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now, where there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    now = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.select(*[now.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go, and documents that nothing else is in."""
    return _counted(lines.dedup_lines(docs, drop_emptied=True))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    gone = minhash.near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("gone_id")).distinct()
    # What goes grows with the documents, so this is a merge join at every size.
    return docs.join(gone.hint("merge"), F.col("doc_id") == F.col("gone_id"), "left_anti")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages go, and documents made of little else."""
    return _counted(decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn towards the target weights; ``copies`` says how often."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix_sources", mix_sources),
]

# Repeated chunks of lines and chains of near duplicates are beyond SQL; tests compare with a plain-Python pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
