"""Static table scans (batch)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names=STAR_TABLES) -> None:
    """Expose the driver tables as temp views under their plain names."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def with_lineage(df: DataFrame) -> DataFrame:
    """Stamp ``_ingested_at`` (run time) and ``_source_file`` (file path)."""
    return df.withColumns({
        "_ingested_at": F.current_timestamp(),
        "_source_file": F.col("_metadata.file_path"),
    })
