"""Warehouse sinks: replace, append and the empty-result guard.

Tables are Parquet directories (or catalog tables when ``as_table``). The guard writes beside the target first, so the
result is computed once; an empty output leaves the current table untouched.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaMismatch(ValueError):
    """A frame does not have the columns or types of the table it is appended to."""


def replace(df: DataFrame, target: str, as_table: bool = False) -> None:
    """``CREATE OR REPLACE TABLE ... AS SELECT``."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if as_table:
        w.saveAsTable(target)
    else:
        w.parquet(target)


def append(df: DataFrame, target: str, as_table: bool = False) -> None:
    """Append by column name. The first append creates the table with the frame's schema, also without rows; later
    frames must have the table's columns, and values must fit their types."""
    spark = df.sparkSession
    if as_table:
        if spark.catalog.tableExists(target):
            df.select(*spark.table(target).columns).write.insertInto(target)
        else:
            df.write.saveAsTable(target)
        return
    try:
        schema = spark.read.parquet(target).schema
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        df.write.parquet(target)
        return
    df.select(*[_as(df, f) for f in fitting(df, schema)]).write.mode("append").parquet(target)


def fitting(df: DataFrame, schema: T.StructType) -> list[T.StructField]:
    """The schema's fields if the frame has exactly these columns, in any order; else an error that names the others."""
    lacking = [f.name for f in schema if f.name not in df.columns]
    extra = [c for c in df.columns if c not in schema.names]
    if lacking or extra:
        raise SchemaMismatch(f"columns lacking: {lacking}, unknown: {extra}; the table has {schema.names}")
    return list(schema)


#: Types that widen to another without loss, in this order.
_WIDER = ("tinyint", "smallint", "int", "bigint")


def _as(df: DataFrame, wanted: T.StructField) -> Column:
    have, want = df.schema[wanted.name].dataType, wanted.dataType
    a, b = have.simpleString(), want.simpleString()
    widens = a in _WIDER and b in _WIDER and _WIDER.index(a) < _WIDER.index(b) or (a, b) in (
        ("float", "double"), ("date", "timestamp")) or (
        isinstance(have, T.DecimalType) and isinstance(want, T.DecimalType) and have.scale <= want.scale
        and have.precision - have.scale <= want.precision - want.scale)
    if a != b and not widens:
        raise SchemaMismatch(f"column {wanted.name} is {a}, the table has {b}")
    return F.col(wanted.name).cast(want).alias(wanted.name)


def replace_if_not_empty(df: DataFrame, target: str, partition_by: list[str] | None = None) -> bool:
    """Replace ``target`` only when ``df`` has rows. Returns whether the table was replaced.

    ``df`` is written once, beside the target; the emptiness test reads the written files' footers, so the upstream
    plan never runs twice. Only then the old folder gives way by two renames, so a job that dies while it writes leaves the
    old table, and one that dies between the renames leaves it in a sibling folder from which :func:`recover` (called
    here first) brings it back. The whole table is replaced, partitions that no longer occur included.
    ``partition_by`` lays the table out by those columns (e.g. month) so period queries prune whole folders.
    Tables that are replaced in parts, or while others read them, are kept in ``sources.snapshots``.
    """
    spark: SparkSession = df.sparkSession
    recover(spark, target)
    fresh = f"{target}{NEW}{uuid.uuid4().hex}"
    if partition_by:  # few files per partition; adaptive execution splits a heavy one over several tasks
        df = df.hint("rebalance", *partition_by)
    try:
        (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(fresh)
        if spark.read.schema(df.schema).parquet(fresh).isEmpty():
            return False
        old = f"{target}{OLD}{uuid.uuid4().hex}"
        replaced = _rename(spark, target, old)
        if not _rename(spark, fresh, target):
            raise OSError(f"{fresh} could not become {target}")
        if replaced:
            remove(spark, old)
        return True
    finally:
        remove(spark, fresh)


#: Name parts of the folders beside a target: its replacement while it is written, and the table that gave way.
NEW, OLD = ".__new-", ".__old-"


def recover(spark: SparkSession, target: str) -> bool:
    """Brings back the table that gave way when a job died between the two renames. Returns whether there was one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path.getParent()):
        return False
    left = sorted(s.getPath().toString() for s in fs.listStatus(path.getParent())
                  if s.getPath().getName().startswith(path.getName() + OLD))
    if left and not fs.exists(path):
        return _rename(spark, left[-1], target)
    for folder in left:  # the new table stands: only the deletion was missing
        remove(spark, folder)
    return False


def _rename(spark: SparkSession, source: str, target: str) -> bool:
    """False if there is nothing to rename."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(path(source)) and fs.rename(path(source), path(target))


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a work folder through the filesystem its path names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
