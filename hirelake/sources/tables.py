"""Catalog tables, day partitions, views and literal frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, name: str, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """A3: a catalog table by name, or a table's files by path."""
    if path is None:
        return spark.table(name)
    return spark.read.format(fmt).load(path)


def read_day(df: DataFrame, year: str, month: str, day: str) -> DataFrame:
    """A4: rows of one day. On a Hive-partitioned scan the equality filters
    on the partition columns become partition filters, so only that day's
    folders are listed and read."""
    return df.where((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day))


def register_views(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """A10: register frames as temp views for ``spark.sql``."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def literal_frame(spark: SparkSession, rows: list, schema) -> DataFrame:
    """Literal rows with an explicit schema (nested struct + array ok)."""
    return spark.createDataFrame(rows, schema)
