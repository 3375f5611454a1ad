"""Landing: nested records, child tables, schema evolution, look-back, exports."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import functions as F

from sedimenta.functions.text import first_item_label
from sedimenta.functions.vectors import from_text, to_text
from sedimenta.operators.conform import blanks_to_null
from sedimenta.operators.enrich import plan_batches
from sedimenta.operators.joins import lookup_join
from sedimenta.plans.registry import query, table, text
from sedimenta.session import new_path, together
from sedimenta.sources import landing
from sedimenta.sources.tables import Layer, import_csv, read_batches, write_batches
from sedimenta.sources.tables import export_csv as write_csv

RUN_TIME = dt.datetime(2024, 1, 31, 6, 0, 0)


@query("""
SELECT o_orderkey AS id, o_custkey AS cliente_id, o_orderstatus AS situacao_sigla,
       o_orderpriority AS situacao_prioridade_nome FROM orders""")
def flatten_json(spark, sf):
    """Orders as nested records, flattened again."""
    nested = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_custkey").alias("id")).alias("cliente"),
        F.struct(
            F.col("o_orderstatus").alias("sigla"),
            F.struct(F.col("o_orderpriority").alias("nome")).alias("prioridade"),
        ).alias("situacao"),
    )
    return landing.flatten(nested, sep="_")


@query("""
SELECT o_orderkey AS id,
       '{"sigla":"' || o_orderstatus || '","cliente":'
         || CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE o_custkey::VARCHAR END || '}' AS situacao,
       '["' || o_orderpriority || '","' || o_orderstatus || '"]' AS palavras FROM orders""")
def jsonify_complex(spark, sf):
    nested = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.struct(
            F.col("o_orderstatus").alias("sigla"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("cliente"),
        ).alias("situacao"),
        F.array("o_orderpriority", "o_orderstatus").alias("palavras"),
    )
    return landing.jsonify_complex(nested)


@query("SELECT *, '2024-01-31 06:00:00' AS data_captura FROM customer")
def stamp_capture(spark, sf):
    return landing.stamp_capture(table(spark, sf, "customer"), RUN_TIME)


@query("""
SELECT c_custkey AS id, c_name AS nome, c_nationkey AS nation, c_mktsegment AS segment, NULL AS saldo
FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, NULL, s_acctbal::VARCHAR FROM supplier""")
def evolve_schema(spark, sf):
    existing = table(spark, sf, "customer").selectExpr(
        "c_custkey AS id", "c_name AS nome", "c_nationkey AS nation", "c_mktsegment AS segment"
    )
    incoming = table(spark, sf, "supplier").selectExpr(
        "s_acctbal AS saldo", "s_suppkey AS id", "s_name AS nome", "s_nationkey AS nation"
    )
    return landing.evolve_schema(existing, incoming)


@query("""
SELECT i AS ordem, md5(linhas[i + 1]) AS hash, length(linhas[i + 1]) AS tamanho, doc_id AS "idDocumento"
FROM (SELECT doc_id, string_split(text, chr(10)) AS linhas FROM documents), unnest(range(len(linhas))) t(i)""")
def explode_children(spark, sf):
    """Documents with a nested list of lines -> one row per line with the document's id."""
    lines = F.split(F.col("text"), "\n")
    nested = table(spark, sf, "documents").select(
        "doc_id",
        F.transform(
            lines,
            lambda x, i: F.struct(
                i.cast("bigint").alias("ordem"),
                F.md5(x).alias("hash"),
                F.length(x).cast("bigint").alias("tamanho"),
            ),
        ).alias("linhas"),
    )
    return landing.explode_children(nested, "linhas", "doc_id", "idDocumento")


@query("SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def expand_details(spark, sf):
    detail = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return landing.expand_details(table(spark, sf, "labels"), detail, "doc_id")


@query("""
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS dia FROM orders
WHERE o_orderdate >= DATE '2001-08-01' - INTERVAL 30 DAY""")
def lookback(spark, sf):
    recent = landing.lookback(table(spark, sf, "orders"), "o_orderdate", dt.date(2001, 8, 1))
    return recent.select("o_orderkey", "o_custkey", text(F.to_date("o_orderdate")).alias("dia"))


@query("""
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE year(l_shipdate) = 2001""")
def current_year(spark, sf):
    """The calendar-year window of the expenses."""
    rows = landing.this_year(table(spark, sf, "lineitem"), "l_shipdate", dt.date(2001, 8, 1))
    return rows.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 20")
def sample_head(spark, sf):
    return landing.sample_head(table(spark, sf, "orders"), 20, "o_orderkey").select(
        "o_orderkey", "o_custkey", "o_orderstatus"
    )


@query("""
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 2)""")
def latest_parents(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return landing.latest_parents(lines, table(spark, sf, "orders"), "o_orderkey", "l_orderkey", 2)


@query("""
SELECT c_custkey, c_name, nullif(replace(c_mktsegment, 'BUILDING', ''), '') AS c_mktsegment FROM customer""")
def blank_to_null(spark, sf):
    landed = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.replace("c_mktsegment", F.lit("BUILDING"), F.lit("")).alias("c_mktsegment")
    )
    return blanks_to_null(landed)


@query("""
SELECT event_id,
       coalesce(json_extract_string(props, '$.sigla') || ' ' || json_extract_string(props, '$.k') || '/'
                  || year(ts),
                event_type || ' ' || json_extract_string(props, '$.k') || '/' || year(ts)) AS rotulo
FROM events""")
def json_fallback(spark, sf):
    """Label of the first element of the first list, of the second list if the first is empty."""
    number = F.get_json_object("props", "$.k")
    kind = F.get_json_object("props", "$.sigla")

    def item(sigla):
        return F.struct(
            sigla.alias("siglaTipo"), number.alias("numero"), F.year("ts").alias("ano")
        )

    empty = F.filter(F.array(item(kind)), lambda x: x["siglaTipo"].isNotNull())
    return table(spark, sf, "events").select(
        "event_id", first_item_label(empty, F.array(item(F.col("event_type")))).alias("rotulo")
    )


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def replace_table(spark, sf):
    """Replace twice, the second time by nothing: the table keeps its rows."""
    layer = Layer(spark, new_path(spark, "replace"))
    rows = table(spark, sf, "supplier")
    layer.replace("supplier", rows)
    layer.replace("supplier", rows.where("s_suppkey IS NULL"))
    return layer.read("supplier")


@query("""
SELECT 'customer' AS tabela, count(*) AS linhas, 2 AS tabelas, sum(hash_key)::BIGINT AS soma
FROM (SELECT c_custkey AS hash_key FROM customer)
UNION ALL SELECT 'labels_ia', count(*), 2, sum(doc_id)::BIGINT FROM labels""")
def publish_layer(spark, sf):
    """Publish a layer twice; the enrichment table of the first run is carried over, the
    table that the second run does not have is gone."""
    layer = Layer(spark, new_path(spark, "layer"))
    layer.refresh({"supplier": table(spark, sf, "supplier"), "labels_ia": table(spark, sf, "labels")})
    layer.refresh({"customer": table(spark, sf, "customer")})
    n = len(layer.names())

    def summary(name, key):
        return layer.read(name).agg(
            F.lit(name).alias("tabela"),
            F.count(F.lit(1)).alias("linhas"),
            F.lit(n).alias("tabelas"),
            F.sum(key).alias("soma"),
        )

    return summary("customer", "c_custkey").unionByName(summary("labels_ia", "doc_id"))


@query("""
SELECT vec_id, label, ((row_number() OVER (ORDER BY vec_id) - 1) // 100 + 1)::BIGINT AS batch_id,
       md5(array_to_string([format('{:.8f}', x) FOR x IN embedding], ',')) AS hash FROM embeddings""")
def batch_roundtrip(spark, sf):
    """Scored items in batches on disk, vectors as text, read back batch by batch."""
    path = new_path(spark, "batches")
    items = plan_batches(table(spark, sf, "embeddings"), "vec_id", 100).withColumn(
        "embedding", to_text(F.col("embedding"))
    )
    write_batches(items, path)
    back = read_batches(spark, path, items.schema)
    inner = F.btrim(to_text(from_text(F.col("embedding"))), F.lit("[]"))
    return back.select("vec_id", "label", "batch_id", F.md5(inner).alias("hash"))


@query("SELECT doc_id, lang, source, md5(text) AS hash, n_chars FROM documents")
def export_csv(spark, sf):
    """CSV with line breaks and quotes inside the text, read back."""
    rows = table(spark, sf, "documents")
    path = write_csv(rows, new_path(spark, "csv"), "stg_documents_bruto", RUN_TIME)
    back = import_csv(spark, path, rows.schema)
    return back.select("doc_id", "lang", "source", F.md5("text").alias("hash"), "n_chars")


@query("""
SELECT o_orderkey, l_linenumber, l_partkey, o_orderpriority, l_quantity
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def orders_lines(spark, sf):
    """Inner equi join of two tables."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_quantity"
    )
    return lookup_join(lines, orders, ["o_orderkey"])


@query('SELECT c_custkey, c_nationkey::VARCHAR AS "idPai" FROM customer')
def parent_from_path(spark, sf):
    """Children landed in one folder per parent; the parent's id is read off the path."""
    path = new_path(spark, "landed")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    customers.write.partitionBy("c_nationkey").parquet(path)
    landed = spark.read.schema("c_custkey long").parquet(path)
    return landing.stamp_parent_from_path(landed, r"c_nationkey=(\d+)/", "idPai").select("c_custkey", "idPai")


@query("SELECT 'a' AS tabela, n_nationkey AS chave FROM nation UNION ALL SELECT 'b', r_regionkey FROM region")
def publish_concurrent(spark, sf):
    """Two writers publish to one layer at once: both tables are there afterwards."""
    layer = Layer(spark, new_path(spark, "layer"))
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("chave"))
    region = table(spark, sf, "region").select(F.col("r_regionkey").alias("chave"))
    together({"a": partial(layer.replace, "a", nation), "b": partial(layer.replace, "b", region)})
    read = [layer.read(n).select(F.lit(n).alias("tabela"), "chave") for n in layer.names()]
    return read[0].unionAll(read[1])
