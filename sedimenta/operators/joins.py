"""Look-up joins that broadcast only what is known to be small, and a join that salts hot keys for callers that ask for it."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw bytes of a side that may be broadcast; the hash table on each executor takes a
# few times as much.
BROADCAST_BYTES = 64 * 1024 * 1024

PACKED = 10  # a row in memory against the same row in a file
_NARROWING = {"Relation", "Project", "Filter", "Aggregate", "Deduplicate"}


def _q(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _width(f: T.StructField) -> int:
    return 0 if isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType)) else 16


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows of `df`, by one aggregation over the columns it has."""
    fixed = 32 + sum(_width(f) for f in df.schema.fields)
    variable = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            variable = variable + 16 + F.coalesce(F.octet_length(_q(f.name)), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            if not isinstance(f.dataType.elementType, T.NumericType):
                variable = variable + F.octet_length(F.coalesce(F.to_json(_q(f.name)), F.lit("")))
            else:
                variable = variable + 16 + 8 * F.coalesce(F.size(_q(f.name)), F.lit(0))
        elif isinstance(f.dataType, (T.StructType, T.MapType)):
            variable = variable + F.octet_length(F.coalesce(F.to_json(_q(f.name)), F.lit("")))
    total = df.agg(F.sum(variable + fixed)).first()[0]
    return int(total or 0)


def planned_bytes(df: DataFrame) -> int | None:
    """An upper bound for the size of a frame that the planner has without a job: that of the files it reads.

    None where a step may add rows or widen them.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    steps = set(re.findall(r"^[\s:+\-]*(\w+)", plan.toString(), re.M))
    return int(str(plan.stats().sizeInBytes())) if steps <= _NARROWING else None


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= max_bytes


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join a large table with a look-up side (inner, left, left_semi or left_anti).

    A look-up side that the planner knows to be small, or else one that a single job has measured, is broadcast and the
    large side is not moved at all. Otherwise it is a plain join, whose skewed partitions Spark splits.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    known = planned_bytes(right)
    small = known is not None and known * PACKED <= max_bytes
    if small or fits_broadcast(right, max_bytes):
        return left.join(F.broadcast(right), list(on), how)
    return left.join(right, list(on), how)
