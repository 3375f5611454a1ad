"""Surrogate keys 1..n without a single-task window over large data."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.session import stage, stage_counted
from sedimenta.sources.landing import column

TASK_ROWS = 250_000  # rows that one task numbers
RANGE_ROWS = 10_000  # rows of a file of which ranges are read
_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def surrogate_key(
    df: DataFrame, name: str, natural: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Dense numbers from 1 in the order of `natural` (then of the whole row), written once."""
    return number_rows(df, name, natural, partitions)[0]


def number_rows(
    df: DataFrame, name: str, natural: Sequence[str], partitions: int | None = None, reserved: Sequence[object] = ()
) -> tuple[DataFrame, int | None]:
    """`surrogate_key`, and the number of rows if `natural` is unique (and none of its values reserved).

    The rows are written as they come and counted on the way, then written once more in ranges of about `TASK_ROWS`,
    sorted, with their position. The number is a projection over that table: readers find no window and no join.
    """
    rows, n = stage_counted(df, "rows")
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = partitions or max(1, min(most, -(-n // TASK_ROWS)))
    numbered = _numbered_in_parts(rows, name, natural, parts)
    keys = numbered.groupBy(*[column(c) for c in natural]).agg(F.count(F.lit(1)).alias("__rows"))
    taken = F.lit(False) if not reserved else F.max(F.coalesce(column(natural[0]).isin(*reserved), F.lit(False)))
    most_rows, clash = keys.agg(F.max("__rows"), taken).first()
    return numbered, None if (most_rows or 0) > 1 or clash else n


def row_ranges(df: DataFrame, natural: Sequence[str]) -> tuple[Callable[[int, int], DataFrame], int]:
    """The rows in the order of `surrogate_key`, written once: the rows from one number to another, and how many there are.

    A range is a filter over the stored position, so a reader skips the files and row groups of the other rows.
    """
    rows, n = stage_counted(df, "rows")
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed, before = _placed_in_parts(rows, natural, max(1, min(most, -(-n // RANGE_ROWS))))

    def position(number: int) -> int:
        part = bisect_right(before, number - 1) - 1
        return (part << _ROW_BITS) + number - 1 - before[part]

    def between(first: int, last: int) -> DataFrame:
        return placed.where(F.col("__at").between(position(first), position(last))).drop("__at")

    return between, n


def _numbered_in_parts(df: DataFrame, name: str, natural: Sequence[str], n: int) -> DataFrame:
    """The rows with their number: the position plus the rows of the partitions before, one small number per partition."""
    placed, before = _placed_in_parts(df, natural, n)
    row = F.col("__at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    start = F.get(F.lit(before).cast("array<bigint>"), F.shiftright(F.col("__at"), _ROW_BITS).cast("int"))
    return placed.withColumn(name, row + start + 1).drop("__at")


def _placed_in_parts(df: DataFrame, natural: Sequence[str], n: int) -> tuple[DataFrame, list[int]]:
    """Range-partition, sort inside the partitions, write once with the position `__at`; and the number of rows before each
    partition.

    A key with many rows is still split, as the hash of the row is part of the order.
    """
    order = [column(c) for c in natural]
    rest = [column(c) for c in df.columns if c not in natural]
    if rest:
        order.append(F.xxhash64(*rest))
    ranges = df.coalesce(1) if n == 1 else df.repartitionByRange(n, *order)
    placed = stage(ranges.sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), "keys")
    part = F.shiftright(F.col("__at"), _ROW_BITS)
    counts = {r["part"]: r["count"] for r in placed.groupBy(part.alias("part")).count().collect()}
    return placed, [0, *accumulate(counts.get(i, 0) for i in range(max(counts, default=0)))]
