"""File sources and sinks: multi-file CSV with source tagging, latest-version pick, table sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tag_source(df: DataFrame, path_col: str = "file_name", out: str = "source",
               prefix: str = "FAOSTAT_data_", suffix_from: str = "_Senegal") -> DataFrame:
    """Source label parsed from a file name: drop the prefix and everything from ``suffix_from`` on."""
    base = F.regexp_extract(F.col(path_col), r"([^/]*)$", 1)
    s = F.regexp_replace(base, "^" + prefix, "")
    s = F.regexp_replace(s, suffix_from + ".*$", "")
    return df.withColumn(out, s)


def read_fao(spark: SparkSession, glob: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read every matching CSV (header, all columns as text) and tag rows with their source."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", False)
    df = r.csv(glob)
    # the source name may be the file's own name or a folder on its path
    # (_metadata.file_path is a URI: decode it, keeping literal '+' signs)
    path = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))
    name = F.regexp_extract(path, r"(FAOSTAT_data_[^/]*)", 1)
    return tag_source(df.withColumn("file_name", name), "file_name")


def latest_version(df: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Keep rows of the lexicographically greatest file name (a 1-row aggregate joined back)."""
    latest = df.agg(F.max(name_col).alias("_latest"))
    return df.join(F.broadcast(latest), F.col(name_col) == F.col("_latest"), "left_semi")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ("year",),
                mode: str = "overwrite", sort_within: Sequence[str] = ()) -> None:
    """Partitioned sink. ``sort_within`` orders rows inside each output file (no global sort)."""
    w = df
    if sort_within:
        w = w.sortWithinPartitions(*sort_within)
    writer = w.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    parts = [c for c in partition_by if c in df.columns]
    if parts:
        writer = writer.partitionBy(*parts)
    writer.save(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str = "parquet") -> DataFrame:
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)
