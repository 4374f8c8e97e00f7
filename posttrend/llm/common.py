"""Shared by the corpus operators: reading tables and storing intermediate results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posttrend.session import fresh_path

# What counts as white space between words, and a word, where a contract names byte ranges (fixed values).
SPACE_WORD = r"[^\x20\x09-\x0D]+"
LETTER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Spark's setting for removing the shuffle files of a finished query.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(column):
    """Lower-cases A-Z and nothing else."""
    return F.translate(column, UPPER, LOWER)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` into the shared folder and reads it back: lineage ends there, and lost executors cost nothing.

    The shuffle files behind it have served when it is written, so Spark is told to remove them.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)
