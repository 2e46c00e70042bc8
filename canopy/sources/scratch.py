"""Folders for tables that queries write on the way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def folder(spark: SparkSession, name: str) -> str:
    """A new folder in the place that all executors share; a local session without one gets a temporary folder."""
    base = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="canopy-")
        spark.conf.set(SETTING, base)
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def saver(spark: SparkSession, at: str):
    """Writes a DataFrame below a folder and gives it back read from there."""

    def save(df: DataFrame) -> DataFrame:
        path = f"{at}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return save
