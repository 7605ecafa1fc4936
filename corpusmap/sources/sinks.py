"""Writing tables: sharded appends, versions, tiles and ordered result lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed value: rows per append shard.
SHARD_ROWS = 5000


def append_shards(df: DataFrame, path: str, rows: int = SHARD_ROWS) -> None:
    """Append as zstd parquet files of at most ``rows`` rows."""
    (
        df.write.mode("append")
        .option("maxRecordsPerFile", rows)
        .option("compression", "zstd")
        .parquet(path)
    )


def write_version(df: DataFrame, path: str) -> None:
    """Write a table that must not exist yet. A version is either whole or absent."""
    df.write.mode("error").option("compression", "zstd").parquet(path)


def read_version(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_tiles(df: DataFrame, path: str) -> None:
    """Tiled points, partitioned by level and sorted by tile so that readers can skip files."""
    (
        df.repartitionByRange("level", "tile")
        .sortWithinPartitions("level", "tile")
        .write.mode("error")
        .partitionBy("level")
        .option("compression", "zstd")
        .parquet(path)
    )


def write_lines(df: DataFrame, path: str, ordinal: str = "ordinal") -> None:
    """JSON lines in input order."""
    df.repartitionByRange(F.col(ordinal)).sortWithinPartitions(ordinal).write.mode("error").json(path)
