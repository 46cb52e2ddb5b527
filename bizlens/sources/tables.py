"""Readers for the input Parquet tables (projection is explicit so the scan prunes columns), and the slices in which large ones
are worked on."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


#: Stored bytes that one slice of a job reads. What a slice shuffles is deleted before the next one starts, so a job holds the
#: shuffles of one slice on disk at a time, not of all.
SLICE_BYTES = 512 << 20
#: Slices by the hash of a key read the table again for each slice, so they are few. Slices by month read disjoint folders and are
#: about so many at most (a month is never divided).
MAX_KEY_SLICES, MAX_MONTH_SLICES = 8, 32


def stored_bytes(spark: SparkSession, path: str) -> int:
    """The bytes of the files under a path (a path that does not exist has none)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(folder).getLength() if fs.exists(folder) else 0


def key_slices(size: int) -> int:
    """The number of slices by key for a table of so many bytes."""
    return max(1, min(MAX_KEY_SLICES, -(-size // SLICE_BYTES)))


def in_slice(key: str, k: int, n: int) -> Column:
    """Whether a key belongs to slice k of n: each key, null included, to one. (Not by the hash that deals the shuffles: a slice
    would go to few of their partitions.)"""
    return F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(n)) == k


def month_slices(sizes: dict[str, int]) -> list[list[str]]:
    """The folders (name -> bytes) in groups of neighbours of about the size of a slice."""
    limit = max(SLICE_BYTES, -(-sum(sizes.values()) // MAX_MONTH_SLICES))
    groups, held = [[]], 0
    for name in sorted(sizes):
        if groups[-1] and held + sizes[name] > limit:
            groups.append([])
            held = 0
        groups[-1].append(name)
        held += sizes[name]
    return groups


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan one table, pruned to ``columns``."""
    scan = spark.read.parquet(table_path(sf_dir, name))
    return scan.select(*columns) if columns else scan
