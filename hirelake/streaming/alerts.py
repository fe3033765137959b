"""Operational events -> alert rows.

The transforms are stateless projections, so the same function runs on a
batch DataFrame and on a streaming one (``readStream``); no state store,
no watermark is needed because no aggregation crosses events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import hms

# --- FIXED VALUES: event types, job states and alert texts ------------------
OBJECT_CREATED = "Object Created"
OBJECT_DELETED = "Object Deleted"
OBJECT_TYPES = [OBJECT_CREATED, OBJECT_DELETED]
CREATED_TEXT = "A new object has been created in S3"
DELETED_TEXT = "An object has been deleted from S3"
UNKNOWN_TEXT = "Unknown S3 operation"
JOB_STATES = ["SUCCEEDED", "FAILED", "TIMEOUT", "STOPPED"]
JOB_TEXT = {
    "SUCCEEDED": "Glue Job %s has succeeded!",
    "FAILED": "Glue Job %s has failed.",
    "TIMEOUT": "Glue Job %s has timed out.",
    "STOPPED": "Glue Job %s has been stopped.",
}
# -----------------------------------------------------------------------------


def events_in(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """Keep events whose field is in a literal list (event rule)."""
    return df.where(F.col(col).isin(values))


def object_rule(df: DataFrame, buckets: list[str] | None = None) -> DataFrame:
    """The object event rule: listed detail types (and buckets, if given)."""
    out = events_in(df, "detail_type", OBJECT_TYPES)
    return events_in(out, "bucket_name", buckets) if buckets else out


def object_alerts(df: DataFrame) -> DataFrame:
    """Message text and attachment per object event.

    Input columns: detail_type, bucket_name, object_key, object_size.
    Unknown detail types give the 'unknown' text and no attachment.
    """
    t = F.col("detail_type")
    bucket = F.concat(F.lit("Bucket Name: "), F.col("bucket_name"), F.lit("\nObject Key: "), F.col("object_key"))
    text = (F.when(t == OBJECT_CREATED, F.lit(CREATED_TEXT))
            .when(t == OBJECT_DELETED, F.lit(DELETED_TEXT))
            .otherwise(F.lit(UNKNOWN_TEXT)))
    attachment = (F.when(t == OBJECT_CREATED, F.concat(bucket, F.lit("\nObject Size: "),
                                                      F.col("object_size").cast("string"), F.lit(" bytes")))
                  .when(t == OBJECT_DELETED, bucket))
    return df.withColumns({"text": text, "attachment": attachment})


def job_rule(df: DataFrame, job_names: list[str] | None = None) -> DataFrame:
    """The job-state event rule: listed states and (if given) job names."""
    out = events_in(df, "state", JOB_STATES)
    return events_in(out, "job_name", job_names) if job_names else out


def _job_text(state: Column, name: Column) -> Column:
    expr = None
    for s, fmt in JOB_TEXT.items():
        branch = F.format_string(fmt, name)
        expr = F.when(state == s, branch) if expr is None else expr.when(state == s, branch)
    return expr.otherwise(F.lit(""))


def job_state_alerts(df: DataFrame) -> DataFrame:
    """Message per job-state event; success adds the run time as h/m/s.

    Input columns: job_name, job_run_id, state, execution_time (seconds).
    """
    state = F.col("state")
    attachment = F.when(state == "SUCCEEDED",
                        F.concat(F.lit("Execution Time: "), hms("execution_time"), F.lit(".")))
    return df.withColumns({"text": _job_text(state, F.col("job_name")), "attachment": attachment})


def alert_stream(spark, events_path: str, schema, out_path: str, kind: str = "object",
                 allowed: list[str] | None = None, checkpoint: str | None = None,
                 trigger: dict | None = None, fmt: str = "parquet"):
    """J1/J2 as a Structured Streaming job: new event files under
    ``events_path`` -> rule filter -> alert rows appended to ``out_path``.

    The transform is stateless, so no watermark or state store is needed;
    the file sink is exactly-once (its commit log and the source offsets
    live in ``checkpoint``, by default under the shared checkpoint folder).
    ``trigger`` defaults to ``availableNow`` (process what is there, stop);
    pass e.g. ``{"processingTime": "1 minute"}`` for a continuous job.
    Returns the StreamingQuery.
    """
    from ..session import scratch_path

    events = spark.readStream.schema(schema).format(fmt).load(events_path)
    if kind == "object":
        rows = object_alerts(object_rule(events, allowed))
    elif kind == "job":
        rows = job_state_alerts(job_rule(events, allowed))
    else:
        raise ValueError(f"unknown alert kind {kind!r}")
    writer = (rows.writeStream.format("parquet").outputMode("append")
              .option("path", out_path)
              .option("checkpointLocation", checkpoint or scratch_path(spark, f"alerts-{kind}-checkpoint"))
              .trigger(**(trigger or {"availableNow": True})))
    return writer.start()
