"""Valid-id filter, duplicate removal, and what they reject."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sedimenta.functions.casts import to_long, valid_id
from sedimenta.sources.landing import column


def keep_valid_ids(df: DataFrame, name: str = "id") -> DataFrame:
    """Rows whose id is a whole number above zero; the id becomes a bigint."""
    data_type = df.schema[name].dataType
    return df.where(valid_id(column(name), data_type)).withColumn(name, to_long(column(name), data_type))


def keep_first(df: DataFrame, key: Sequence[str] | None, order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by `order`, then by all other columns. Null keys are equal.

    Spark puts a group limit of one row in front of the shuffle, so every task sends at
    most one row per key and a hot key does not gather its rows anywhere.
    """
    if not key:
        return df.dropDuplicates()
    rest = [c for c in df.columns if c not in key and c not in order]
    ranking = [column(c) for c in (*order, *rest)] or [F.lit(0)]
    w = W.partitionBy(*[column(c) for c in key]).orderBy(*ranking)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def reject_report(df: DataFrame, id_column: str | None, key: Sequence[str] | None) -> DataFrame:
    """How many rows the id filter and the dedupe remove: (reason, rows).

    Works on counts per key, which are combined on the map side; only the key columns are read.
    """
    ok = valid_id(column(id_column), df.schema[id_column].dataType) if id_column else F.lit(True)
    names = list(key) if key else list(df.columns)
    counts = (
        df.select(*[column(c) for c in names], ok.alias("__ok"))
        .groupBy(*[column(c) for c in names], "__ok")
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    totals = counts.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("read"),
        F.coalesce(F.sum(F.when(~F.col("__ok"), F.col("__n"))), F.lit(0)).alias("invalid_id"),
        F.coalesce(F.sum(F.when(F.col("__ok"), F.col("__n") - 1)), F.lit(0)).alias("duplicate"),
        F.coalesce(F.sum(F.when(F.col("__ok"), 1)), F.lit(0)).alias("kept"),
    )
    return as_rows(totals, ["read", "invalid_id", "duplicate", "kept"], "reason", "rows")


def as_rows(one: DataFrame, names: Sequence[str], label: str, value: str) -> DataFrame:
    """Turn the columns of a one-row frame into (label, value) rows."""
    pairs = F.array(
        *[F.struct(F.lit(n).alias(label), column(n).cast("bigint").alias(value)) for n in names]
    )
    return one.select(F.explode(pairs).alias("p")).select("p.*")
