"""Sinks (A5-A8). No shuffle into a single partition: partitioned writes
are rebalanced by AQE, ``maxRecordsPerFile`` bounds file size, and a single
file is opt-in for small marts only (``coalesce(1)`` without a shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..schemas import DAY_PARTS


def _rebalanced(df: DataFrame, parts: list[str]) -> DataFrame:
    """Group rows by output partition before writing, via the REBALANCE
    hint: AQE splits a hot day over several writers and coalesces small
    ones, so a partitioned write neither creates tasks x days small files
    nor sends a day holding a third of the rows through one task."""
    return df.hint("rebalance", *parts)


def write_partitioned(df: DataFrame, path: str, parts: list[str] | None = None,
                      max_records_per_file: int | None = None, rebalance: bool = True) -> None:
    """A5: full rewrite as Parquet partitioned by day (snappy by default):
    days that ``df`` lacks go, whatever the session's overwrite mode."""
    parts = parts or DAY_PARTS
    out = _rebalanced(df, parts) if rebalance else df
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*parts)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)


def write_day(df: DataFrame, path: str, parts: list[str] | None = None, rebalance: bool = True) -> None:
    """Rewrite only the partitions present in ``df`` (dynamic partition
    overwrite); other days under ``path`` are left untouched."""
    parts = parts or DAY_PARTS
    out = _rebalanced(df, parts) if rebalance else df
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts).parquet(path))


def write_csv(df: DataFrame, path: str, single_file: bool = False, header: bool = True) -> None:
    """CSV export; ``single_file`` is for small marts (coalesce, no shuffle)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", header).csv(path)


def save_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None) -> None:
    """Write as Parquet and register the table in the catalog."""
    w = df.write.mode("overwrite").format(fmt)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
