"""Saved models, found again by the time in their name."""

from __future__ import annotations

import datetime as dt
import posixpath

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX = "post_model_"


def model_name(kind: str, at: dt.datetime | None = None, prefix: str = PREFIX) -> str:
    at = at or dt.datetime.now(dt.timezone.utc)
    return f"{prefix}{at:%Y%m%d-%H%M%S}_{kind}"


def save_model(model: PipelineModel, root: str, name: str) -> str:
    path = posixpath.join(root, name)
    model.write().overwrite().save(path)
    return path


def list_models(spark: SparkSession, root: str, prefix: str = PREFIX) -> DataFrame:
    """Names of the complete models below ``root``, read off their metadata files."""
    try:
        files = spark.read.text(posixpath.join(root, f"{prefix}*", "metadata"))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no model named {prefix}* in {root}") from error
        raise
    files = files.select(F.col("_metadata.file_path").alias("f"))
    return files.select(F.element_at(F.split("f", "/"), -3).alias("name")).distinct()


def latest_name(models: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """Names sort by time, so the newest is the largest."""
    return models.where(F.col("name").startswith(prefix)).agg(F.max("name").alias("name"))


def load_model(root: str, name: str) -> PipelineModel:
    """A model by its full name."""
    return PipelineModel.load(posixpath.join(root, name))


def load_latest(spark: SparkSession, root: str, prefix: str = PREFIX) -> tuple[PipelineModel, str]:
    name = latest_name(list_models(spark, root, prefix), prefix).first()["name"]
    return load_model(root, name), name
