"""Upsert, back-fill and the audit copy."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.dedupe import keep_first
from sedimenta.operators.joins import BROADCAST_BYTES, fits_broadcast, lookup_join
from sedimenta.session import stage
from sedimenta.sources.landing import column


def upsert(
    target: DataFrame, updates: DataFrame, key: Sequence[str], max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Insert new keys, and overwrite the columns that the updates have.

    Columns that the updates do not have keep their value. The updates are computed once, and a
    key that they hold twice is an error (reduce them with `latest_update` first). A small set of
    updates is broadcast and the target is not moved: one pass joins it, another over its key
    alone finds the keys that are new. Otherwise one full outer join on the key. Rows without
    a key match nothing: they stay, and are added, as they are, outside the join.
    """
    key = list(key)
    extra = [c for c in updates.columns if c not in target.columns]
    if extra:
        raise ValueError(f"columns {extra} are not in the target")
    changed = [c for c in updates.columns if c not in key]
    updates = stage(updates, "updates")
    whole = reduce(and_, [column(k).isNotNull() for k in key])
    keyed, loose = updates.where(whole), updates.where(~whole)
    if keyed.groupBy(*[column(k) for k in key]).count().where("count > 1").head(1):
        raise ValueError(f"the updates hold a value of {key} more than once")
    marked = keyed.select(
        *[column(k) for k in key], *[column(c).alias(f"__u_{c}") for c in changed], F.lit(True).alias("__hit")
    )

    def chosen(df: DataFrame) -> DataFrame:
        return df.select(
            *[
                F.when(F.col("__hit"), column(f"__u_{c}")).otherwise(column(c)).alias(c)
                if c in changed
                else column(c)
                for c in target.columns
            ]
        )

    if fits_broadcast(updates, max_bytes):
        merged = chosen(target.join(F.broadcast(marked), key, "left"))
        # the known keys are a subset of the update keys, so they fit as well
        known = (
            target.select(*[column(k) for k in key])
            .join(F.broadcast(keyed.select(*[column(k) for k in key])), key, "left_semi")
            .distinct()
        )
        fresh = updates.join(F.broadcast(known), key, "left_anti")
    else:
        merged = chosen(target.where(whole).join(marked, key, "full_outer")).unionByName(target.where(~whole))
        fresh = loose
    return merged.unionByName(fresh, allowMissingColumns=True).select(*target.columns)


def latest_update(updates: DataFrame, key: Sequence[str], newest_first: str) -> DataFrame:
    """One update per key, the newest one."""
    ordered = updates.withColumn("__age", -column(newest_first).cast("double"))
    return keep_first(ordered, list(key), ["__age"]).drop("__age")


def audit_copy(df: DataFrame, name: str) -> DataFrame:
    """Keep the present values under `<name>_original`, unless that was done before."""
    copy = f"{name}_original"
    return df if copy in df.columns else df.withColumn(copy, column(name))


def backfill(target: DataFrame, found: DataFrame, key: str, name: str) -> DataFrame:
    """Fill the rows in which `name` is null, where a value was found.

    Only those rows take part in the join; the others go straight through. Running it
    again changes nothing.
    """
    values = found.where(column(name).isNotNull()).select(column(key), column(name).alias("__found"))
    gaps = target.where(column(name).isNull())
    filled = lookup_join(gaps, values, [key], "left").withColumn(name, F.col("__found"))
    return target.where(column(name).isNotNull()).unionByName(filled.select(*target.columns))
