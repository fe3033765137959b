"""Global positions of sorted rows (F1-F4) without a one-task window."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_scratch


def with_position(ordered: DataFrame, name: str = "position") -> DataFrame:
    """Rows of a sorted frame (``orderBy``) with their number from 1.

    The sorted rows are written once, one file for each range of the sort, to
    the shared scratch folder: a file's name tells its place among the files,
    and a row's number in its file is known to the reader. Files are counted
    in the tasks that read them; only the counts (a row for each file) meet,
    and are summed up in file order. Rows that tie have some order of their
    own, which the written files keep."""
    spark = ordered.sparkSession
    path = f"{shared_scratch(spark)}/ordered-{uuid.uuid4().hex}"
    ordered.write.option("maxRecordsPerFile", 0).parquet(path)
    rows = spark.read.schema(ordered.schema).parquet(path).select(
        *ordered.columns, F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    files = rows.groupBy("__file").agg(F.count(F.lit(1)).alias("n"))
    listed = files.agg(F.array_sort(F.collect_list(F.struct("__file", "n"))).alias("all"))
    zero = F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<struct<f:string,first:bigint>>").alias("out"))
    summed = F.aggregate("all", zero, lambda s, x: F.struct(
        (s["sum"] + x["n"]).alias("sum"), F.array_append(s["out"], F.struct(x["__file"].alias("f"), s["sum"].alias("first"))).alias("out")),
        lambda s: s["out"])
    first = listed.select(F.explode(summed).alias("o")).select(F.col("o.f").alias("__file"), F.col("o.first").alias("__first"))
    return rows.join(first, "__file").select(*ordered.columns, (F.col("__first") + F.col("__row") + 1).alias(name))
