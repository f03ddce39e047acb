"""What lies in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """(path, length) of every file below ``root``. Only the listing is read, no content."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).select("path", "length")


def table_files(table: DataFrame) -> DataFrame:
    """(path, length, n_rows) of the files a table is read from; no column is read."""
    return table.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length")).agg(F.count("*").alias("n_rows"))


def file_inventory(files: DataFrame) -> DataFrame:
    """Total bytes, files and folders that hold files."""
    folder = F.regexp_replace("path", r"/[^/]*$", "")
    return files.agg(
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"),
        F.count("*").alias("n_files"),
        F.countDistinct(folder).alias("n_folders"),
    )
