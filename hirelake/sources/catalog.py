"""Catalog registration (A13) and tables that are replaced in one step."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from ..schemas import DAY_PARTS
from .landing import discover


def register_prefix(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                    parts: list[str] | None = None) -> DataFrame:
    """Make ``name`` a catalog table over a partitioned prefix, or bring
    it up to date: columns that files brought are added, partitions that
    arrived are recovered and partitions whose folder is gone are dropped.
    Call it after each job, as a crawler would run; only folders are listed
    for partitions, and schemas are read from the files' footers."""
    parts = parts or DAY_PARTS
    found = discover(spark, path, fmt).drop(*parts).schema
    column = lambda f: f"`{f.name}` {f.dataType.simpleString()}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join([column(f) for f in found] + [f"`{p}` string" for p in parts])
        keys = ", ".join(f"`{p}`" for p in parts)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} PARTITIONED BY ({keys}) LOCATION '{path}'")
    known = {f.name for f in spark.table(name).schema}
    if new := [column(f) for f in found if f.name not in known]:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def replace_table(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Build the table beside the old one, then switch: ``name`` is a view
    on the newest version, replaced in one catalog operation. A reader finds a
    table at any time, and one that was opened before keeps its version, which
    is dropped only when the next but one is built. A plain table of that name,
    from before, is dropped once."""
    spark = df.sparkSession
    version = f"{name}__v{time.time_ns():020d}"
    df.write.format(fmt).saveAsTable(version)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    prefix = name.split(".")[-1] + "__v"
    versions = sorted(t.name for t in spark.catalog.listTables(pattern=f"{prefix}*") if t.name.startswith(prefix))
    for old in versions[:-2]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return spark.table(name)
