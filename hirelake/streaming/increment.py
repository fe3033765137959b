"""Daily increment (J3): process only the new day of the landing zone.

Batch form: filter the day on the partition columns (partition pruning, only
that day's folders are read), run the first stage, overwrite only that
day's output partition. Both publish through a manifest
(:mod:`..sources.publish`), so readers never see files vanish or half a day;
read the output with ``read_published``. Streaming form: a file-source stream over the
landing zone with ``availableNow`` processes exactly the files not seen
before (the source's checkpoint remembers them) and writes the rows of each
landing file into their own ``batch=<hash of the file's path>`` sub-partition
of the day. So a retried batch, and a new or reset checkpoint that reads the
files again, rewrites what the same files wrote and nothing else.
"""

from __future__ import annotations

from hashlib import sha1

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.pipeline import first_stage
from ..schemas import DAY_PARTS, POSTING_SCHEMA
from ..session import scratch_path
from ..sources.landing import read_posting_lines
from ..sources.publish import publish, read_published
from ..sources.tables import read_day

BATCH_COLUMN = "batch"
LANDING_LINE_SCHEMA = T.StructType(POSTING_SCHEMA.fields + [T.StructField(c, T.StringType()) for c in DAY_PARTS])


def process_day(spark: SparkSession, landing_path: str, out_path: str, day: tuple[str, str, str],
                taxonomy: DataFrame, addresses: DataFrame) -> DataFrame:
    """J3 batch: first stage over one landing day, published as that day's
    partition of ``out_path`` (an empty one when the day has no rows any more).
    Returns the day's rows as published."""
    rows = read_day(read_posting_lines(spark, landing_path), *day)
    cleaned = first_stage([rows], taxonomy, addresses)
    publish(cleaned, out_path, emptied=[dict(zip(DAY_PARTS, day))])
    return read_day(read_published(spark, out_path), *day).select(*cleaned.columns)


def stream_increment(spark: SparkSession, landing_path: str, out_path: str, taxonomy: DataFrame,
                     addresses: DataFrame, checkpoint: str | None = None, query_name: str | None = None,
                     max_files_per_trigger: int = 1000):
    """J3 streaming: new landing files -> first stage -> day partitions.

    Runs with ``availableNow``: everything new is processed in bounded
    micro-batches, then the query stops. ``checkpoint`` defaults to a folder
    under the shared checkpoint directory, named after input and output. Returns the StreamingQuery.
    """
    stream = (spark.readStream.schema(LANDING_LINE_SCHEMA).option("basePath", landing_path)
              .option("maxFilesPerTrigger", max_files_per_trigger).json(landing_path)
              .withColumn(BATCH_COLUMN, F.substring(F.sha1(F.input_file_name()), 1, 16)))

    def write_batch(batch: DataFrame, epoch: int) -> None:
        # Each landing file owns its (day, batch) partition: a late file for
        # an old day never replaces rows that another file brought.
        cleaned = first_stage([batch], taxonomy, addresses, extra=(BATCH_COLUMN,))
        publish(cleaned, out_path, parts=[*DAY_PARTS, BATCH_COLUMN])

    known = sha1(f"{landing_path} {out_path}".encode()).hexdigest()[:16]
    writer = (stream.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint or scratch_path(spark, f"increment-{known}-checkpoint"))
              .trigger(availableNow=True))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()
