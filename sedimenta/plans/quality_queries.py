"""Profiles, counts and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.operators import quality
from sedimenta.operators.joins import lookup_join
from sedimenta.operators.star import build_fact
from sedimenta.plans.registry import SCHEMAS, query, table
from sedimenta.plans.star_queries import FT_ORDERS, dims_of, order_rows
from sedimenta.session import new_path

_LINE_TYPES = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}


def _profile_sql(table_name, types):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS coluna, '{t}' AS tipo, round((count(*) - count({c})) * 100 / count(*), 2) AS nulos_pct, "
        f"count(DISTINCT {c}) AS valores_unicos, min({c})::VARCHAR AS exemplo FROM {table_name}"
        for c, t in types.items()
    )


@query(_profile_sql("lineitem", _LINE_TYPES))
def profile(spark, sf):
    return quality.profile(table(spark, sf, "lineitem"))


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS coluna, '{t}' AS tipo, count(*) AS linhas, round((count(*) - count({c})) * 100 / count(*), 2) "
        f"AS nulos_pct, true AS perto FROM lineitem"
        for c, t in _LINE_TYPES.items()
    )
)
def profile_sketch(spark, sf):
    """The profile of two loads from their stored sketches alone; its distinct counts lie within 6 % of the exact ones."""
    lines, path = table(spark, sf, "lineitem"), new_path(spark, "profiles")
    for load in ("l_orderkey % 2 = 0", "l_orderkey % 2 = 1"):
        quality.profile_sketch(lines.where(load)).write.mode("append").parquet(path)
    merged = quality.merge_profiles(spark.read.parquet(path))
    exact = quality.profile(lines).select("coluna", F.col("valores_unicos").alias("exact"))
    near = F.col("valores_unicos").between(F.col("exact") * 0.94, F.col("exact") * 1.06)
    return merged.join(exact, "coluna").select("coluna", "tipo", "linhas", "nulos_pct", near.alias("perto"))


@query(
    _profile_sql(
        "(SELECT documents.doc_id, lang, quality, toxic FROM documents LEFT JOIN labels "
        "ON documents.doc_id = labels.doc_id)",
        {"doc_id": "bigint", "lang": "string", "quality": "int", "toxic": "int"},
    )
)
def profile_nulls(spark, sf):
    """A profile of a joined table, most of whose rows have gaps."""
    documents = table(spark, sf, "documents").select("doc_id", "lang")
    return quality.profile(lookup_join(documents, table(spark, sf, "labels"), ["doc_id"], "left"))


@query(
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS tabela, count(*) AS linhas, count(*) = 0 AS vazia FROM {t}" for t in SCHEMAS
    )
    + ")"
)
def row_counts(spark, sf):
    tables = {t: table(spark, sf, t) for t in SCHEMAS}
    quality.require(tables, ["orders", "lineitem"])
    return quality.row_counts(tables)


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS linhas FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def pk_violations(spark, sf):
    return quality.pk_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT unnest(['doc_id', 'lang', 'quality', 'toxic']) AS coluna,
       unnest([count(*) - count(documents.doc_id), count(*) - count(lang), count(*) - count(quality),
               count(*) - count(toxic)]) AS nulos
FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id""")
def null_violations(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang")
    joined = lookup_join(documents, table(spark, sf, "labels"), ["doc_id"], "left")
    return quality.null_violations(joined)


@query("SELECT 0::BIGINT AS sem_cliente, 0::BIGINT AS sem_pedido, count(*) AS linhas FROM orders")
def fact_keys_resolve(spark, sf):
    """Every key of a loaded fact exists in its dimension."""
    dims = dims_of(spark, sf, FT_ORDERS)
    customer, orders = dims["dim_customer"], dims["dim_order"]
    fact = build_fact(order_rows(spark, sf), FT_ORDERS, dims)
    checked = lookup_join(
        fact, customer.select("sk_customer", F.lit(1).alias("c")), ["sk_customer"], "left"
    )
    checked = lookup_join(checked, orders.select("sk_order", F.lit(1).alias("o")), ["sk_order"], "left")
    return checked.agg(
        (F.count(F.lit(1)) - F.count("c")).alias("sem_cliente"),
        (F.count(F.lit(1)) - F.count("o")).alias("sem_pedido"),
        F.count(F.lit(1)).alias("linhas"),
    )
