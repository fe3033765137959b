"""Small plan helpers shared by the operators."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def drop_if_present(df: DataFrame, cols: list[str]) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.drop(*present) if present else df


def lookup_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, null_safe: bool = False) -> DataFrame:
    """Join with a table that was aggregated on the join keys.

    With a plain equality the join would sit on the aggregation's own
    partitioning, and AQE splits a hot key only where both sides come straight
    from an exchange. Here the table's keys are read through an expression that
    the planner does not see through, so both sides get a fresh exchange and a
    hot key is split. Unless ``null_safe``, NULL keys match nothing."""
    named = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.array_max(F.array(F.col(f"__{k}")))) for k in keys]
    on = reduce(lambda a, b: a & b, same if null_safe else same + [F.col(k).isNotNull() for k in keys])
    return left.join(named, on, how).drop(*[f"__{k}" for k in keys])


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes up to which the session broadcasts a table; none if not positive."""
    size = re.match(r"(-?\d+)([kmgtp]?)i?b?\Z", spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower())
    return int(size[1]) << 10 * " kmgtp".index(size[2] or " ")


def _sql_literal(value, sql_type: str) -> str:
    if value is None:
        return f"CAST(NULL AS {sql_type})"
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"CAST('{escaped}' AS {sql_type})"
    if isinstance(value, float):
        return f"CAST({value!r} AS {sql_type})"
    return f"CAST({value} AS {sql_type})"


def literal_table(spark, rows: list[tuple], columns: list[tuple[str, str]]):
    """A fixed table of literal rows as an inline ``VALUES`` relation.

    Unlike ``createDataFrame`` over a Python list (an RDD scan), this is a
    ``LocalRelation``: Catalyst knows its exact size, folds projections over
    it and broadcasts it without running a job.
    """
    names = ", ".join(n for n, _ in columns)
    body = ", ".join("(" + ", ".join(_sql_literal(v, t) for v, (_, t) in zip(r, columns)) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")
