"""One landed table -> one conformed table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.casts import convert, strip_hyphen
from sedimenta.functions.text import blank_to_null, standardise
from sedimenta.operators.dedupe import keep_first, keep_valid_ids, reject_report
from sedimenta.sources.landing import column
from sedimenta.spec import TableSpec


def _typed(df: DataFrame, spec: TableSpec) -> list:
    out = []
    for f in df.schema.fields:
        source = column(f.name)
        if spec.strips(f.name) and isinstance(f.dataType, T.StringType):
            source = strip_hyphen(source)
        out.append(convert(source, spec.kind(f.name), f.dataType, spec.formats).alias(f.name))
    return out


def cast_table(df: DataFrame, spec: TableSpec) -> DataFrame:
    """All columns to the kinds of the specification."""
    return df.select(*_typed(df, spec))


def standardise_text(df: DataFrame, keep_case: tuple[str, ...] = ()) -> DataFrame:
    """Repair, compose and upper-case every text column, except those listed."""
    return df.select(
        *[
            standardise(column(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType) and f.name not in keep_case
            else column(f.name)
            for f in df.schema.fields
        ]
    )


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Empty text becomes null in every text column."""
    return df.select(
        *[
            blank_to_null(column(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else column(f.name)
            for f in df.schema.fields
        ]
    )


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Cast, standardise text, drop bad ids, keep one row per key, empty text to null.

    The dedupe is the only shuffle. Under a key, only the text that the key and the order of the specification read is
    standardised before it; the rest is for the rows that stay, so ties beyond that order go by the text as it was landed.
    """
    out = cast_table(df, spec)
    if spec.valid_id and spec.valid_id in out.columns:
        out = keep_valid_ids(out, spec.valid_id)  # before the text step, so that it reaches the scan
    late = tuple(c for c in out.columns if spec.key and c not in (*spec.key, *spec.order))
    out = keep_first(standardise_text(out, (*spec.keep_case, *late)), spec.key, spec.order)
    early = tuple(c for c in out.columns if c not in late)
    return blanks_to_null(standardise_text(out, (*spec.keep_case, *early)))


def load_report(landed: Mapping[str, DataFrame], specs: Mapping[str, TableSpec]) -> DataFrame:
    """One row per landed table: rows read, with an invalid id, repeated and kept, and values that no cast took.

    An empty table shows as such; one that is missing has no row."""

    def one(name: str) -> DataFrame:
        df, spec = landed[name], specs[name]
        key = [k for k in spec.key or () if k in df.columns]
        valid = spec.valid_id if spec.valid_id in df.columns else None
        counts = reject_report(df, valid, key).groupBy().pivot("reason", ["read", "invalid_id", "duplicate", "kept"])
        rejected = cast_report(df, spec).agg(F.sum("n_rejected").alias("rejected_values"))
        return counts.sum("rows").join(rejected).select(F.lit(name).alias("table_name"), "*")  # one row each

    return reduce(DataFrame.unionByName, [one(n) for n in landed])


def cast_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Per column: values read, values kept by the cast, values rejected. One pass."""
    typed = _typed(df, spec)
    counts = df.agg(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(spec.kind(f.name)).alias("kind"),
                F.count(column(f.name)).alias("n_in"),
                F.count(typed[i]).alias("n_out"),
                (F.count(column(f.name)) - F.count(typed[i])).alias("n_rejected"),
            ).alias(f"c{i}")
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return counts.select(F.explode(F.array(*counts.columns)).alias("r")).select("r.*")
