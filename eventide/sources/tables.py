"""S-9: relational table scans.

Tables are plain Parquet (one file or folder per table).  Callers select the
columns they need right after the scan so Catalyst prunes the read schema
and pushes filters into the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan one table; with ``columns`` only those are read."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_jdbc_table(spark: SparkSession, url: str, table: str, key: str,
                    lower: int, upper: int, num_partitions: int,
                    properties: dict | None = None) -> DataFrame:
    """Snapshot read of a relational table, split into key ranges so the
    read runs as ``num_partitions`` parallel tasks (CDC initial snapshot)."""
    return spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions, properties=properties or {})
