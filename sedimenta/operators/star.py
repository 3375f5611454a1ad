"""Dimensions with "unknown" members, facts by key look-up, the date dimension."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.dates import date_key
from sedimenta.operators.joins import BROADCAST_BYTES, fits_broadcast, lookup_join
from sedimenta.operators.keys import number_rows
from sedimenta.sources.landing import column
from sedimenta.spec import VOCABULARY, DimSpec, FactSpec, Vocabulary

_KEY_ROW_BYTES = 64  # one (natural key, surrogate key) pair in a hash table
_KEY_ROWS = 2_000_000  # such pairs that one task may hold; more are sorted

# Rows of the frames that `build_dim` returned and found to have one row per natural key.
# Kept per frame: whatever is made from such a frame is measured again.
_unique_rows: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()


def fill(df: DataFrame, vocabulary: Vocabulary = VOCABULARY, **kinds: str) -> DataFrame:
    """Replace nulls by the sentinel of a kind: text, code, unknown_id, not_applicable_id,
    year, date or amount. `kinds` maps column name to kind; other columns stay."""
    return df.select(
        *[
            filled(column(c), kinds[c], vocabulary).alias(c) if c in kinds else column(c)
            for c in df.columns
        ]
    )


def filled(col: Column, kind: str, vocabulary: Vocabulary = VOCABULARY) -> Column:
    return F.coalesce(col, F.lit(getattr(vocabulary, kind)))


def members(spec: DimSpec, dim: DataFrame, vocabulary: Vocabulary = VOCABULARY) -> DataFrame:
    """The rows -1 (unknown) and -3 (not applicable) of a dimension, as literals."""
    rows = []
    for i, unknown in enumerate((True, False)):
        row = []
        for f in dim.schema.fields:
            if f.name in spec.members:
                value = spec.members[f.name][i]
            else:
                value = vocabulary.member(f.dataType, unknown, f.name in spec.codes)
            row.append(F.lit(value).cast(f.dataType).alias(f.name))
        rows.append(F.struct(*row))
    return dim.sparkSession.range(1, numPartitions=1).select(F.inline(F.array(*rows)))


def build_dim(df: DataFrame, spec: DimSpec, vocabulary: Vocabulary = VOCABULARY) -> DataFrame:
    """Distinct rows under the target names, numbered, with the two members in front.

    Load stamps are added afterwards (`stamp_load`), so they cannot make rows distinct.
    """
    renamed = df.select(*[column(src).alias(dst) for dst, src in spec.columns.items()]).distinct()
    ids = (vocabulary.unknown_id, vocabulary.not_applicable_id)
    numbered, rows = number_rows(renamed, spec.key, [spec.natural], reserved=ids)
    numbered = numbered.select(spec.key, *spec.columns)
    dim = members(spec, numbered, vocabulary).unionByName(numbered)
    if rows is not None:
        _unique_rows[dim] = rows + 2
    return dim


def stamp_load(
    df: DataFrame,
    at: dt.datetime,
    validity: bool = False,
    name: str = "dh_ingestao",
    vocabulary: Vocabulary = VOCABULARY,
) -> DataFrame:
    """Load time and, for a dimension, the open validity range. One value per run."""
    if validity:
        df = df.withColumn("dt_inicio_vigencia", F.lit(at.date())).withColumn(
            "dt_fim_vigencia", F.lit(vocabulary.date)
        )
    return df.withColumn(name, F.lit(at).cast("timestamp_ntz"))


def _measure(keys: Mapping[str, DataFrame]) -> dict[str, int]:
    """Rows of each key table (natural key, surrogate key), all in one job.

    Fails if a natural key has more than one row, as the fact would fan out.
    """
    if not keys:
        return {}
    parts = [
        k.groupBy(column(k.columns[0]).alias("k"))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.lit(name).alias("name"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.max("n"), F.lit(0)).alias("most"),
        )
        for name, k in keys.items()
    ]
    found = reduce(DataFrame.unionByName, parts).collect()  # one row per dimension
    twice = [r["name"] for r in found if r["most"] > 1]
    if twice:
        raise ValueError(f"more than one row per natural key in {', '.join(sorted(twice))}")
    return {r["name"]: r["rows"] for r in found}


def _look_up(
    fact: DataFrame, keys: DataFrame, rows: int, optional: bool, max_bytes: int
) -> DataFrame:
    """Attach a surrogate key by a broadcast of known size, or by a shuffled join, whose skew Spark splits.

    Unless a task would get too many keys, they make its hash table and the fact only passes by: it is neither sorted nor
    held, so a key that very many rows share (that of an unknown member) costs no memory.
    """
    natural, how = keys.columns[0], "left" if optional else "inner"
    if not isinstance(keys.schema[natural].dataType, (T.IntegerType, T.LongType)):
        return lookup_join(fact, keys, [natural], how, max_bytes)
    if rows * _KEY_ROW_BYTES <= max_bytes:
        return fact.join(F.broadcast(keys), natural, how)
    tasks = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return fact.join(keys.hint("shuffle_hash") if rows <= tasks * _KEY_ROWS else keys, natural, how)


def build_fact(
    df: DataFrame,
    spec: FactSpec,
    dims: Mapping[str, DataFrame],
    vocabulary: Vocabulary = VOCABULARY,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Star join: natural keys -> surrogate keys, dates -> date keys, measures.

    Only (natural key, surrogate key) of a dimension take part: two numbers per row bound
    its hash table, and the row count decides between broadcast and a shuffle.
    Missing rows of an optional dimension get the unknown key; rows without a required
    dimension drop out.
    """
    wanted = {
        **{f"__d{i}": column(r.source) for i, r in enumerate(spec.dims)},
        **{f"__t_{k}": date_key(column(src)) for k, src in spec.dates.items()},
        **{f"__c_{k}": column(src) for k, src in spec.columns.items()},
    }
    out = df.select(*[c.alias(n) for n, c in wanted.items()])
    keys = {
        f"{i}:{r.dim}": dims[r.dim].select(
            column(r.natural).alias(f"__d{i}"), column(r.key).alias(f"__k{i}")
        )
        for i, r in enumerate(spec.dims)
    }
    known = {n: _unique_rows.get(dims[r.dim]) for n, r in zip(keys, spec.dims)}
    open_ = {n: k for n, k in keys.items() if known[n] is None}
    rows = {**known, **_measure(open_)}
    for (name, k), r in zip(keys.items(), spec.dims):
        out = _look_up(out, k, rows[name], r.optional, max_bytes).drop(k.columns[0])
    names = []
    for i, r in enumerate(spec.dims):
        key = F.col(f"__k{i}")
        if r.optional:
            key = F.coalesce(key, F.lit(vocabulary.unknown_id).cast("bigint"))
        names.append(key.alias(r.key))
    fact = out.select(
        *names,
        *[F.col(f"__t_{k}").alias(k) for k in spec.dates],
        *[F.col(f"__c_{k}").alias(k) for k in spec.columns],
        *[F.lit(v).alias(k) for k, v in spec.constants.items()],
    )
    return fact.select(*spec.layout) if spec.layout else fact


def by_date(fact: DataFrame, spec: FactSpec) -> DataFrame:
    """A fact in ranges of its first date key, for storing it: a window of days then skips most files and row groups.

    The other keys take part in the ranges, so a day with many rows is spread as well.
    """
    dates = [column(c) for c in spec.dates]
    rest = F.xxhash64(*[column(r.key) for r in spec.dims])
    return fact.repartitionByRange(dates[0], rest).sortWithinPartitions(dates[0]) if dates else fact


def roll_up(
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    by: Sequence[str],
    sums: Mapping[str, str],
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Additive measures of a fact by attributes of its dimensions.

    `dims` maps the key column of the fact to a dimension with that key and the attributes.
    If a dimension is too large to broadcast, the measures are first added up by the keys,
    so what is joined is one row per combination of keys.
    """
    inner = [F.sum(column(src)).alias(dst) for dst, src in sums.items()]
    outer = [F.sum(column(dst)).alias(dst) for dst in sums]
    used = {
        k: d.select(column(k), *[column(c) for c in d.columns if c in by and c != k])
        for k, d in dims.items()
    }
    if not all(fits_broadcast(d, max_bytes) for d in used.values()):
        own = [c for c in fact.columns if c in by and c not in used]
        fact = fact.groupBy(*[column(c) for c in (*used, *own)]).agg(*inner)
        inner = outer
    for key, dim in used.items():
        fact = lookup_join(fact, dim, [key], "inner", max_bytes)
    return fact.groupBy(*[column(c) for c in by]).agg(*inner)


def dim_date(df: DataFrame, date: str) -> DataFrame:
    """One row per day from the first to the last date found, with the usual parts."""
    span = df.agg(F.min(column(date)).cast("date").alias("a"), F.max(column(date)).cast("date").alias("b"))
    days = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("dt_data"))
    return days.select(
        date_key(F.col("dt_data")).alias("sk_data"),
        "dt_data",
        F.year("dt_data").alias("nr_ano"),
        F.quarter("dt_data").alias("nr_trimestre"),
        F.month("dt_data").alias("nr_mes"),
        F.dayofmonth("dt_data").alias("nr_dia"),
        F.weekday("dt_data").alias("nr_dia_semana"),
    )
