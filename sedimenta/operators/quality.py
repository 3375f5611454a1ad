"""Profiles, counts and key and null checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.sources.landing import column

KEY_ROWS = 500_000  # rows whose keys one task compares


def profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """Per column: type, share of nulls in percent, distinct values, an example (the least).

    Exact: one grouped count per column. Each reads only its own column, so together they
    read the table once, and counts are combined before the shuffle; counting all columns
    distinctly in one aggregation would multiply every row by the number of columns.
    Approximate: a single pass with sketches.
    """
    fields = df.schema.fields
    if not approx:
        return reduce(DataFrame.unionByName, [_profile_column(df, f) for f in fields])
    one = df.agg(
        *[
            _profile_row(
                f,
                F.count(F.lit(1)),
                F.count(column(f.name)),
                F.approx_count_distinct(column(f.name)),
                F.min(column(f.name)),
            ).alias(f"c{i}")
            for i, f in enumerate(fields)
        ]
    )
    return one.select(F.explode(F.array(*one.columns)).alias("p")).select("p.*")


def _profile_row(f: T.StructField, rows, present, distinct, example):
    return F.struct(
        F.lit(f.name).alias("coluna"),
        F.lit(f.dataType.simpleString()).alias("tipo"),
        F.round(F.try_divide((rows - present) * 100, rows), 2).alias("nulos_pct"),
        distinct.cast("bigint").alias("valores_unicos"),
        example.cast("string").alias("exemplo"),
    )


def _profile_column(df: DataFrame, f: T.StructField) -> DataFrame:
    counts = df.groupBy(column(f.name).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    present = F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("n"))), F.lit(0))
    return counts.agg(
        _profile_row(f, F.sum("n"), present, F.count("v"), F.min("v")).alias("p")
    ).select("p.*")


_SKETCHED = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)  # others are counted by their text


def profile_sketch(df: DataFrame) -> DataFrame:
    """What a load adds to the profile of its table: per column rows, values and a sketch of the distinct ones.

    One pass, and a few kilobytes a column. Store it with the load; `merge_profiles` adds up loads without their rows.
    """
    fields = df.schema.fields

    def one(f: T.StructField):
        value = column(f.name) if isinstance(f.dataType, _SKETCHED) else column(f.name).cast("string")
        return F.struct(
            F.lit(f.name).alias("coluna"),
            F.lit(f.dataType.simpleString()).alias("tipo"),
            F.count(F.lit(1)).alias("linhas"),
            F.count(column(f.name)).alias("presentes"),
            F.hll_sketch_agg(value).alias("distintos"),
        )

    sketched = df.agg(*[one(f).alias(f"c{i}") for i, f in enumerate(fields)])
    return sketched.select(F.explode(F.array(*sketched.columns)).alias("p")).select("p.*")


def merge_profiles(loads: DataFrame) -> DataFrame:
    """The profile over all loads: type, rows, share of nulls in percent, and about how many distinct values (the
    sketch's standard error is 1.6 %). A column that some loads do not have counts as null there."""
    added = loads.groupBy("coluna").agg(
        F.max("tipo").alias("tipo"),
        F.sum("presentes").alias("presentes"),
        F.hll_sketch_estimate(F.hll_union_agg("distintos")).alias("valores_unicos"),
    )
    # Every load has its number of rows in each of its columns; the column with the most has been in all loads.
    rows = loads.groupBy("coluna").agg(F.sum("linhas").alias("linhas")).agg(F.max("linhas").alias("linhas"))
    share = F.round(F.try_divide((F.col("linhas") - F.col("presentes")) * 100, F.col("linhas")), 2)
    return added.join(F.broadcast(rows)).select("coluna", "tipo", "linhas", share.alias("nulos_pct"), "valores_unicos")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, with a note if a table is empty."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("tabela"),
            F.col("n").alias("linhas"),
            (F.col("n") == 0).alias("vazia"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def require(tables: Mapping[str, DataFrame | None], needed: Sequence[str]) -> list[str]:
    """Check the inputs of a job: a missing one is an error, the names of empty ones return."""
    missing = [n for n in needed if tables.get(n) is None]
    if missing:
        raise LookupError(f"missing input tables: {', '.join(missing)}")
    return [n for n in needed if tables[n].isEmpty()]


def pk_violations(df: DataFrame, key: Sequence[str], rows: int | None = None) -> DataFrame:
    """Keys that occur more than once, with their count.

    Nearly all keys of a sound table occur once, so counting them before the shuffle only fills memory. With the number of
    rows (about) they are dealt first, `KEY_ROWS` to a task whatever the size of the table.
    """
    if rows is not None:
        df = df.repartition(max(1, -(-rows // KEY_ROWS)), *[column(k) for k in key])
    return (
        df.groupBy(*[column(k) for k in key]).agg(F.count(F.lit(1)).alias("linhas")).where("linhas > 1")
    )


def null_violations(df: DataFrame, required: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, in one pass."""
    names = list(required or df.columns)
    one = df.agg(
        *[
            F.struct(
                F.lit(c).alias("coluna"),
                (F.count(F.lit(1)) - F.count(column(c))).alias("nulos"),
            ).alias(f"c{i}")
            for i, c in enumerate(names)
        ]
    )
    return one.select(F.explode(F.array(*one.columns)).alias("r")).select("r.*")
