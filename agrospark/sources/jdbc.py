"""Relational sink (A12). Connection options come from the caller; nothing is stored here."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None, batchsize: int = 1000,
               mode: str = "append", num_partitions: int | None = None) -> None:
    """Append rows through JDBC in batches (the platform inserted 1000 rows per batch). Each task
    writes its partition over its own connection; ``num_partitions`` caps concurrent connections.
    Plain append re-inserts rows on re-runs, as the platform did; use
    ``agrospark.operators.reshape.merge_append`` against the current table for an idempotent load."""
    out = df.coalesce(num_partitions) if num_partitions else df
    (out.write.mode(mode).option("batchsize", batchsize)
     .jdbc(url=url, table=table, properties=dict(properties or {})))


def read_jdbc(spark, url: str, table: str, properties: dict | None = None, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int = 8) -> DataFrame:
    """Parallel read: range-split on ``partition_column`` when given."""
    props = dict(properties or {})
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table, properties=props)
