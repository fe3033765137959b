"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: The folder that holds this package.
ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let Python workers started from now on import this package from where
    the driver has it (a cluster ships it with ``--py-files``, or has it at the
    same place)."""
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it. Without the
    setting, a session whose executors are threads of this process (tests)
    gets a folder of its own; any other has no shared folder to write to."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set; configure a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="hirelake-shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    survives the loss of executors, and is computed once for all readers. The
    folder is left there, as results may still be read from it lazily; whoever
    owns the shared folder clears it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """At the end of a task: return free memory of the Python worker, which
    Spark keeps for later tasks of other operators, to the system."""
    import ctypes
    from gc import collect

    import pyarrow as pa

    collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library only
    if trim:
        trim(0)


def fold(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo ``n`` (null key: null)."""
    return F.crc32(F.col(key).cast("string")) % n


def bounded_sample(df: DataFrame, n: int, *order: str) -> DataFrame:
    """At most ``n`` of the distinct rows, those with the smallest hashes of
    the ``order`` columns (ties by all columns): the same rows whatever the
    partitioning and however often a row is repeated."""
    return df.distinct().orderBy(F.xxhash64(*order), *df.columns).limit(n)
