"""Shared helpers: the work folder all executors see, and written (lineage-cutting) intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from bizlens.session import ensure_checkpoint_dir


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` written once as Parquet in the shared folder and read back: a stable, recoverable copy."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str = "row_no") -> DataFrame:
    """Adds a row number unique in the table (partition << 33 | position). Write the result before relying on it."""
    return df.withColumn(name, F.monotonically_increasing_id())


def unused(df: DataFrame, prefix: str) -> str:
    """The prefix with as many underscores as no column of the table starts with it (names are compared in small letters)."""
    while any(c.lower().startswith(prefix.lower()) for c in df.columns):
        prefix += "_"
    return prefix


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The ``documents`` table, pruned to the given columns."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df
