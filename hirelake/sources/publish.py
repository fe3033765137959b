"""Consistent publishing of day partitions.

Rows are written into folders of their own version, beside what readers use,
and become visible by one manifest file that is put in place by a rename: it
names, for every partition, the version that counts. A reader resolves the
newest manifest once; what it opened stays as it was, since later versions
replace no files. Manifests and folders are small metadata for the driver;
rows are only written and read by tasks.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import DAY_PARTS
from .sinks import _rebalanced

VERSION = "version"


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def manifest(spark: SparkSession, path: str) -> dict:
    """The newest manifest: number, schema, and the version of each partition."""
    jvm, fs, at = _files(spark, path)
    listed = fs.globStatus(at(f"{path}/_manifest/[0-9]*"))
    names = sorted(s.getPath().getName() for s in listed or [])
    if not names:
        return {"number": 0, "schema": None, "parts": {}}
    stream = fs.open(at(f"{path}/_manifest/{names[-1]}"))
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def publish(df: DataFrame, path: str, parts: list[str] | None = None, emptied: list[dict] | None = None) -> None:
    """Replace the partitions that ``df`` holds, all in one step; other
    partitions stay. Partitions in ``emptied`` lose their rows where ``df`` has
    none for them. A second writer that commits in between makes this one fail
    before anything changed; running it again is safe."""
    spark, parts, path = df.sparkSession, parts or DAY_PARTS, path.rstrip("/")
    known = manifest(spark, path)
    version = f"{time.time_ns():020d}"
    jvm, fs, at = _files(spark, path)
    (_rebalanced(df, parts).selectExpr("*", f"'{version}' AS {VERSION}").write.mode("append")
     .partitionBy(*parts, VERSION).parquet(f"{path}/data"))
    found = fs.globStatus(at(f"{path}/data/{'*/' * len(parts)}{VERSION}={version}")) or []
    names = ["/".join(s.getPath().toString().split("/")[-1 - len(parts):-1]) for s in found]
    schema = T.StructType([f for f in df.schema if f.name not in parts] + [T.StructField(p, T.StringType()) for p in parts])
    gone = ["/".join(f"{p}={day[p]}" for p in parts) for day in emptied or []]
    state = {"number": known["number"] + 1, "schema": schema.jsonValue(),
             "parts": {**{k: v for k, v in known["parts"].items() if k not in gone}, **dict.fromkeys(names, version)}}
    draft, final = at(f"{path}/_manifest/.{version}"), at(f"{path}/_manifest/{state['number']:012d}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        raise RuntimeError(f"another writer has published to {path}; run again")


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The table as the newest manifest has it; partition values are strings."""
    path, now = path.rstrip("/"), manifest(spark, path.rstrip("/"))
    if now["schema"] is None:
        raise FileNotFoundError(f"nothing is published in {path}")
    schema = T.StructType.fromJson(now["schema"])
    folders = [f"{path}/data/{part}/{VERSION}={v}" for part, v in sorted(now["parts"].items())]
    if not folders:
        return spark.createDataFrame([], schema)
    full = T.StructType([*schema, T.StructField(VERSION, T.StringType())])
    return spark.read.schema(full).option("basePath", f"{path}/data").parquet(*folders).select(*schema.names)
