"""From landed JSON records to flat tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.operators.joins import lookup_join


def quoted(name: str) -> str:
    """Column name that may hold dots, as Spark's resolver wants it."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def read_landed(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, payload: str | None = "dados"
) -> DataFrame:
    """Landed response files; `payload` names the array that holds the records.

    The schema is declared, as inferring it would read the whole landing zone once more.
    """
    if payload is None:
        return spark.read.schema(schema).json(path)
    envelope = T.StructType([T.StructField(payload, T.ArrayType(schema))])
    raw = spark.read.schema(envelope).option("multiLine", True).json(path)
    return raw.select(F.explode(column(payload)).alias("r")).select("r.*")


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested records become columns named by their path; arrays and maps stay."""

    def leaves(data_type: T.StructType, source: list[str], name: list[str]):
        for f in data_type.fields:
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, [*source, f.name], [*name, f.name])
            else:
                path = ".".join(quoted(p) for p in [*source, f.name])
                yield F.col(path).alias(sep.join([*name, f.name]))

    return df.select(*leaves(df.schema, [], []))


def jsonify_complex(df: DataFrame) -> DataFrame:
    """Arrays, records and maps that are left in a column become JSON text."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(
        *[
            F.to_json(column(f.name), {"ignoreNullFields": "false"}).alias(f.name)
            if isinstance(f.dataType, nested)
            else column(f.name)
            for f in df.schema.fields
        ]
    )


def stamp_capture(df: DataFrame, at: dt.datetime, name: str = "data_captura") -> DataFrame:
    """One capture time for the whole run, as text like the rest of the landing zone."""
    return df.withColumn(name, F.lit(at.strftime("%Y-%m-%d %H:%M:%S")))


def evolve_schema(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Both tables under the union of their columns; columns new to the first are text."""
    known = {f.name: f.dataType for f in existing.schema.fields}
    aligned = incoming.select(
        *[column(c).cast(known.get(c, T.StringType())).alias(c) for c in incoming.columns]
    )
    return existing.unionByName(aligned, allowMissingColumns=True)


def explode_children(
    df: DataFrame, items: str, parent: str, parent_as: str
) -> DataFrame:
    """One row per element of an array of records, with the id of its parent.

    A narrow operation: nothing is shuffled, and a parent with many children only
    makes its own task longer by the size of its own row.
    """
    return df.select(column(parent).alias(parent_as), F.explode(column(items)).alias("item")).select(
        "item.*", column(parent_as)
    )


def stamp_parent_from_path(df: DataFrame, pattern: str, name: str) -> DataFrame:
    """For landings with one file per parent: the parent id is taken from the file path."""
    return df.withColumn(name, F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))


def expand_details(summary: DataFrame, detail: DataFrame, key: str) -> DataFrame:
    """Detail rows of the listed items; items without a detail fall out."""
    wanted = summary.select(column(key)).distinct()
    return lookup_join(detail, wanted, [key], "left_semi")


def lookback(df: DataFrame, date: str, anchor: dt.date, days: int = 30) -> DataFrame:
    """Rows since `days` before the anchor. The bound is a literal, so it reaches the scan."""
    since = anchor - dt.timedelta(days=days)
    data_type = df.schema[date].dataType
    return df.where(column(date) >= F.lit(since).cast(data_type))


def this_year(df: DataFrame, date: str, anchor: dt.date) -> DataFrame:
    """Rows dated in the anchor's calendar year."""
    data_type = df.schema[date].dataType
    first, after = dt.date(anchor.year, 1, 1), dt.date(anchor.year + 1, 1, 1)
    return df.where(
        (column(date) >= F.lit(first).cast(data_type))
        & (column(date) < F.lit(after).cast(data_type))
    )


def sample_head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first rows by a key, for a trial run; each task keeps at most n rows."""
    return df.orderBy(*[column(c) for c in order]).limit(n)


def latest_parents(children: DataFrame, parents: DataFrame, key: str, parent: str, n: int = 2) -> DataFrame:
    """Children of the n newest parents; the n ids are broadcast."""
    newest = parents.select(column(key).alias(parent)).distinct().orderBy(F.desc(quoted(parent))).limit(n)
    return children.join(F.broadcast(newest), parent, "left_semi")
