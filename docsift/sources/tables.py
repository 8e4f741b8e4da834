"""Parquet table scans of the landed tables (one file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; projections and filters written on the result are
    pushed into the scan by Catalyst (``ReadSchema`` / ``PushedFilters``)."""
    return spark.read.parquet(table_path(sf_dir, name))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread an under-split scan over the cluster's cores.

    A landed file with one row group scans as one task; CPU-heavy per-row
    operators (chunking, hashing, parsing, scoring) would then run on one
    core.  Only when the scan has fewer partitions than the default
    parallelism is a round-robin repartition added; a large table read from
    many files is left as is, so no shuffle is added at scale.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed listing pages (page_id, url, html): one row per fetched page."""
    return spark.read.parquet(path).select("page_id", "url", "html")
