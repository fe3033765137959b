"""Landing zone: day-partitioned JSON documents of postings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.normalize import landing_rows
from ..schemas import DAY_PARTS, LANDING_SCHEMA, POSTING_COLUMNS, POSTING_SCHEMA


def read_landing(spark: SparkSession, paths: str | list[str], multi_line: bool = True,
                 base_path: str | None = None) -> DataFrame:
    """A1: read many landing documents in one scan with a fixed schema
    (both wrapper keys nullable). Multi-line documents are one task per
    file (not splittable); JSON-lines landing files (A12) split normally.
    Partition columns in the path stay strings (no type inference)."""
    # day parts in the schema as strings: partition values keep their text
    # ("01" stays "01") whatever the session's partition type inference says
    schema = T.StructType(LANDING_SCHEMA.fields + [T.StructField(c, T.StringType()) for c in DAY_PARTS])
    reader = spark.read.schema(schema).option("multiLine", multi_line)
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.json(paths)


def read_landing_rows(spark: SparkSession, paths, multi_line: bool = True, base_path: str | None = None) -> DataFrame:
    """A1 + A2: posting rows of the landing documents."""
    return landing_rows(read_landing(spark, paths, multi_line, base_path))


def read_landing_sites(spark: SparkSession, root: str, sites: list[str], multi_line: bool = True) -> dict[str, DataFrame]:
    """One posting table per site prefix ``root/<site>/year=/month=/day=``
    (each prefix is its own partitioned root, like one catalog table per
    site); the caller unions them (G1)."""
    base = root.rstrip("/")
    return {s: read_landing_rows(spark, f"{base}/{s}", multi_line, base_path=f"{base}/{s}") for s in sites}


def read_posting_lines(spark: SparkSession, path: str) -> DataFrame:
    """Read a JSON-lines landing zone written by :func:`write_landing`;
    platform and day parts come from the partition folders, as strings."""
    schema = T.StructType(POSTING_SCHEMA.fields + [T.StructField(c, T.StringType()) for c in DAY_PARTS])
    df = spark.read.schema(schema).option("basePath", path).json(path)
    return df.select(*POSTING_COLUMNS, *[F.col(c) for c in DAY_PARTS])


def write_landing(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write postings to a landing zone partitioned by
    platform/year/month/day as JSON lines (splittable, unlike one
    pretty-printed document per site and day)."""
    (df.select(*POSTING_COLUMNS, *DAY_PARTS).write.mode(mode)
       .partitionBy("platform", *DAY_PARTS).json(path))


def discover(spark: SparkSession, path: str, fmt: str = "json", multi_line: bool = False) -> DataFrame:
    """Discover schema and partitions under a prefix (what a catalog
    crawler does): inferred, merged schema plus partition columns. JSON is
    read line by line, as :func:`write_landing` writes it; ``multi_line``
    reads one document per file, which would see only the first row of such
    files."""
    reader = spark.read.option("basePath", path).option("mergeSchema", "true")
    if fmt == "json":
        reader = reader.option("multiLine", multi_line)
    return reader.format(fmt).load(path)
