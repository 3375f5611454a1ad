"""Dimensions, facts, marts, the weekly ranking and its digest over the driver's tables."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions.dates import key_date, percent
from sedimenta.functions.text import filled as filled_text
from sedimenta.operators.joins import lookup_join
from sedimenta.operators.keys import surrogate_key
from sedimenta.operators.report import Window, digest as make_digest, html_card, ranked, top_of_window
from sedimenta.operators.star import build_dim, build_fact, by_date, dim_date as make_dim_date, roll_up
from sedimenta.plans.registry import money, query, table, text
from sedimenta.session import new_path, together
from sedimenta.sources.tables import Layer
from sedimenta.spec import DimRef, DimSpec, FactSpec

DIM_CUSTOMER = DimSpec(
    "dim_customer",
    key="sk_customer",
    natural="id_customer",
    columns={
        "id_customer": "c_custkey",
        "nm_customer": "c_name",
        "sg_segment": "c_mktsegment",
        "nm_nation": "n_name",
        "nm_region": "r_name",
    },
    codes=frozenset({"sg_segment"}),
)
DIM_SUPPLIER = DimSpec(
    "dim_supplier",
    key="sk_supplier",
    natural="id_supplier",
    columns={"id_supplier": "s_suppkey", "nm_supplier": "s_name", "nm_nation": "n_name"},
)
DIM_ORDER = DimSpec(
    "dim_order",
    key="sk_order",
    natural="id_order",
    columns={"id_order": "o_orderkey", "sg_status": "o_orderstatus", "ds_priority": "o_orderpriority"},
    codes=frozenset({"sg_status"}),
)
DIM_PART = DimSpec(
    "dim_part",
    key="sk_part",
    natural="id_part",
    columns={"id_part": "p_partkey", "nm_part": "p_name", "ds_brand": "p_brand", "ds_type": "p_type"},
)
DIM_DOCUMENT = DimSpec(
    "dim_document",
    key="sk_document",
    natural="id_document",
    columns={
        "id_document": "doc_id",
        "sg_lang": "lang",
        "nm_source": "source",
        "ds_quality": "ds_quality",
        "nr_toxic": "nr_toxic",
        "hash_text": "hash_text",
    },
    codes=frozenset({"sg_lang"}),
    members={"ds_quality": ("NÃO CLASSIFICADO", "NÃO CLASSIFICADO"), "nr_toxic": (0, 0)},
)

FT_ORDERS = FactSpec(
    "ft_orders",
    dims=(
        DimRef("dim_customer", "id_customer", "id_customer", "sk_customer"),
        DimRef("dim_order", "o_orderkey", "id_order", "sk_order"),
    ),
    dates={"sk_data_order": "o_orderdate"},
    columns={"id_order": "o_orderkey", "vl_total": "vl_total"},
    constants={"qtd_order": 1},
)
FT_LINEITEM = FactSpec(
    "ft_lineitem",
    dims=(
        DimRef("dim_supplier", "l_suppkey", "id_supplier", "sk_supplier"),
        DimRef("dim_part", "l_partkey", "id_part", "sk_part"),
        DimRef("dim_order", "l_orderkey", "id_order", "sk_order"),
    ),
    dates={"sk_data_ship": "l_shipdate"},
    columns={
        "nr_line": "l_linenumber",
        "sg_flag": "l_returnflag",
        "sg_line_status": "l_linestatus",
        "vl_gross": "vl_gross",
        "vl_net": "vl_net",
        "vl_tax": "vl_tax",
    },
    constants={"qtd_line": 1},
)
FT_VOTE = FactSpec(
    "ft_vote",
    dims=(
        DimRef("dim_order", "l_orderkey", "id_order", "sk_order"),
        DimRef("dim_supplier", "l_suppkey", "id_supplier", "sk_supplier"),
        DimRef("dim_customer", "id_customer", "id_customer", "sk_customer"),
        DimRef("dim_part", "l_partkey", "id_part", "sk_part", optional=True),
    ),
    dates={"sk_data_vote": "l_shipdate"},
    columns={"tp_vote": "tp_vote"},
    constants={"qtd_vote": 1},
)


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customer, nation and region: an inner join chain. The planner knows the sizes of
    plain tables, so it picks the kind of join by itself."""
    nation = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return table(spark, sf, "customer").join(nation, "c_nationkey").join(region, "n_regionkey")


def customer_dim(spark: SparkSession, sf: str) -> DataFrame:
    return build_dim(customers(spark, sf), DIM_CUSTOMER)


def supplier_dim(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    return build_dim(table(spark, sf, "supplier").join(nation, "s_nationkey"), DIM_SUPPLIER)


def order_dim(spark: SparkSession, sf: str) -> DataFrame:
    return build_dim(table(spark, sf, "orders"), DIM_ORDER)


def part_dim(spark: SparkSession, sf: str, largest: int | None = None) -> DataFrame:
    part = table(spark, sf, "part")
    return build_dim(part if largest is None else part.where(F.col("p_size") <= largest), DIM_PART)


_DIMS = {
    "dim_customer": customer_dim,
    "dim_supplier": supplier_dim,
    "dim_order": order_dim,
    "dim_part": part_dim,
}


def dims_of(spark: SparkSession, sf: str, spec: FactSpec, **given) -> dict[str, DataFrame]:
    """The dimensions of a fact, built side by side."""
    builders = {r.dim: partial(_DIMS[r.dim], spark, sf) for r in spec.dims}
    return together({**builders, **given})


def order_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with amounts as decimals; every 50th customer is unknown (-1)."""
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_custkey") % 50 == 0, F.lit(-1)).otherwise(F.col("o_custkey")).alias("id_customer"),
        "o_orderdate",
        money("o_totalprice").alias("vl_total"),
    )


def line_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts as decimals of at most 18 digits, which Spark computes as long integers."""
    gross = F.col("l_extendedprice").cast("decimal(12,2)")
    discount, tax = (F.col(c).cast("decimal(4,2)") for c in ("l_discount", "l_tax"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
        money(gross).alias("vl_gross"),
        money(gross * (1 - discount)).alias("vl_net"),
        money(gross * tax).alias("vl_tax"),
    )


_CUSTOMER_SQL = """
dim_customer AS (
  SELECT -1::BIGINT AS sk_customer, -1::BIGINT AS id_customer, 'NÃO INFORMADO' AS nm_customer,
         'N/I' AS sg_segment, 'NÃO INFORMADO' AS nm_nation, 'NÃO INFORMADO' AS nm_region
  UNION ALL SELECT -3, -3, 'NÃO SE APLICA', 'N/A', 'NÃO SE APLICA', 'NÃO SE APLICA'
  UNION ALL
  SELECT row_number() OVER (ORDER BY c_custkey), * FROM (
    SELECT DISTINCT c_custkey, c_name, c_mktsegment, n_name, r_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey))"""
_SUPPLIER_SQL = """
dim_supplier AS (
  SELECT -1::BIGINT AS sk_supplier, -1::BIGINT AS id_supplier, 'NÃO INFORMADO' AS nm_supplier,
         'NÃO INFORMADO' AS nm_nation
  UNION ALL SELECT -3, -3, 'NÃO SE APLICA', 'NÃO SE APLICA'
  UNION ALL
  SELECT row_number() OVER (ORDER BY s_suppkey), * FROM (
    SELECT DISTINCT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey))"""
_ORDER_SQL = """
dim_order AS (
  SELECT -1::BIGINT AS sk_order, -1::BIGINT AS id_order, 'N/I' AS sg_status, 'NÃO INFORMADO' AS ds_priority
  UNION ALL SELECT -3, -3, 'N/A', 'NÃO SE APLICA'
  UNION ALL
  SELECT row_number() OVER (ORDER BY o_orderkey), * FROM (
    SELECT DISTINCT o_orderkey, o_orderstatus, o_orderpriority FROM orders))"""
_PART_SQL = """
dim_part AS (
  SELECT -1::BIGINT AS sk_part, -1::BIGINT AS id_part, 'NÃO INFORMADO' AS nm_part,
         'NÃO INFORMADO' AS ds_brand, 'NÃO INFORMADO' AS ds_type
  UNION ALL SELECT -3, -3, 'NÃO SE APLICA', 'NÃO SE APLICA', 'NÃO SE APLICA'
  UNION ALL
  SELECT row_number() OVER (ORDER BY p_partkey), * FROM (
    SELECT DISTINCT p_partkey, p_name, p_brand, p_type FROM part {where}))"""
_FT_ORDERS_SQL = """
ft_orders AS (
  SELECT sk_customer, sk_order, strftime(o_orderdate, '%Y%m%d')::INTEGER AS sk_data_order,
         o_orderkey AS id_order, o_totalprice::DECIMAL(18,2) AS vl_total, 1 AS qtd_order
  FROM orders
  JOIN dim_customer ON id_customer = CASE WHEN o_custkey % 50 = 0 THEN -1 ELSE o_custkey END
  JOIN dim_order ON dim_order.id_order = o_orderkey)"""
_LINE_SQL = """
lines AS (
  SELECT *, l_extendedprice::DECIMAL(18,2) AS vl_gross,
         (l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(18,2)))::DECIMAL(18,2) AS vl_net,
         (l_extendedprice::DECIMAL(18,2) * l_tax::DECIMAL(18,2))::DECIMAL(18,2) AS vl_tax
  FROM lineitem)"""


@query(f"WITH {_CUSTOMER_SQL} SELECT * FROM dim_customer")
def dim_customer(spark, sf):
    return customer_dim(spark, sf)


@query(f"WITH {_SUPPLIER_SQL} SELECT * FROM dim_supplier")
def dim_supplier(spark, sf):
    return supplier_dim(spark, sf)


@query(f"WITH {_ORDER_SQL} SELECT * FROM dim_order")
def dim_order(spark, sf):
    return order_dim(spark, sf)


@query(f"WITH {_PART_SQL.format(where='')} SELECT * FROM dim_part")
def dim_part(spark, sf):
    return part_dim(spark, sf)


@query("""
WITH d AS (
  SELECT DISTINCT documents.doc_id, lang, source,
         coalesce(nullif(upper(trim(CASE quality WHEN 1 THEN ' alta ' WHEN 0 THEN '  ' END)), ''),
                  'NÃO CLASSIFICADO') AS ds_quality,
         coalesce(toxic, 0) AS nr_toxic, md5(text) AS hash_text
  FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id)
SELECT -1::BIGINT AS sk_document, -1::BIGINT AS id_document, 'N/I' AS sg_lang, 'NÃO INFORMADO' AS nm_source,
       'NÃO CLASSIFICADO' AS ds_quality, 0 AS nr_toxic, 'NÃO INFORMADO' AS hash_text
UNION ALL SELECT -3, -3, 'N/A', 'NÃO SE APLICA', 'NÃO CLASSIFICADO', 0, 'NÃO SE APLICA'
UNION ALL
SELECT row_number() OVER (ORDER BY doc_id), * FROM d""")
def dim_document(spark, sf):
    """Optional enrichment joined from the left, blank-aware defaults. The text itself is
    reduced to its hash before anything is shuffled."""
    documents = table(spark, sf, "documents").select(
        "doc_id", "lang", "source", F.md5("text").alias("hash_text")
    )
    label = F.when(F.col("quality") == 1, " alta ").when(F.col("quality") == 0, "  ")
    joined = lookup_join(documents, table(spark, sf, "labels"), ["doc_id"], "left")
    return build_dim(
        joined.withColumn("ds_quality", filled_text(label, "NÃO CLASSIFICADO")).withColumn(
            "nr_toxic", F.coalesce("toxic", F.lit(0))
        ),
        DIM_DOCUMENT,
    )


@query(
    f"WITH {_CUSTOMER_SQL}, {_ORDER_SQL}, {_FT_ORDERS_SQL} "
    "SELECT * REPLACE (vl_total::DOUBLE AS vl_total) FROM ft_orders"
)
def ft_orders(spark, sf):
    fact = build_fact(order_rows(spark, sf), FT_ORDERS, dims_of(spark, sf, FT_ORDERS))
    return fact.withColumn("vl_total", F.col("vl_total").cast("double"))


_FT_LINE_SQL = f"""
WITH {_SUPPLIER_SQL}, {_PART_SQL.format(where="")}, {_ORDER_SQL}, {_LINE_SQL}
SELECT sk_supplier, sk_part, sk_order, strftime(l_shipdate, '%Y%m%d')::INTEGER AS sk_data_ship,
       l_linenumber AS nr_line, l_returnflag AS sg_flag, l_linestatus AS sg_line_status,
       vl_gross::DOUBLE AS vl_gross, vl_net::DOUBLE AS vl_net, vl_tax::DOUBLE AS vl_tax, 1 AS qtd_line
FROM lines JOIN dim_supplier ON l_suppkey = id_supplier JOIN dim_part ON l_partkey = id_part
JOIN dim_order ON l_orderkey = id_order"""


def _line_fact(spark, sf, **options):
    fact = build_fact(line_rows(spark, sf), FT_LINEITEM, dims_of(spark, sf, FT_LINEITEM), **options)
    return fact.withColumns({c: F.col(c).cast("double") for c in ("vl_gross", "vl_net", "vl_tax")})


@query(_FT_LINE_SQL)
def ft_lineitem(spark, sf):
    return _line_fact(spark, sf)


@query(_FT_LINE_SQL)
def ft_lineitem_large(spark, sf):
    """The same with dimensions that are too large to broadcast."""
    return _line_fact(spark, sf, max_bytes=0)


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS sk FROM (SELECT DISTINCT o_orderkey FROM orders)")
def dim_order_large(spark, sf):
    """Keys numbered in eight ranges."""
    keys = table(spark, sf, "orders").select("o_orderkey").distinct()
    return surrogate_key(keys, "sk", ["o_orderkey"], partitions=8)


@query(f"""
WITH {_SUPPLIER_SQL}, {_PART_SQL.format(where="WHERE p_size <= 25")}, {_ORDER_SQL}, {_CUSTOMER_SQL}
SELECT sk_order, sk_supplier, sk_customer, coalesce(sk_part, -1) AS sk_part,
       strftime(l_shipdate, '%Y%m%d')::INTEGER AS sk_data_vote,
       coalesce(nullif(l_returnflag, 'N'), 'NÃO INFORMADO') AS tp_vote, 1 AS qtd_vote
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN dim_order ON l_orderkey = id_order JOIN dim_supplier ON l_suppkey = id_supplier
JOIN dim_customer ON id_customer = CASE WHEN o_custkey % 50 = 0 THEN -1 ELSE o_custkey END
LEFT JOIN dim_part ON l_partkey = id_part""")
def ft_vote(spark, sf):
    """Four dimensions, one of them optional: it holds only some of the parts."""
    owner = order_rows(spark, sf).select(F.col("o_orderkey").alias("l_orderkey"), "id_customer")
    votes = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_suppkey",
        "l_partkey",
        "l_shipdate",
        F.coalesce(F.nullif("l_returnflag", F.lit("N")), F.lit("NÃO INFORMADO")).alias("tp_vote"),
    )
    dims = dims_of(spark, sf, FT_VOTE, dim_part=partial(part_dim, spark, sf, largest=25))
    return build_fact(lookup_join(votes, owner, ["l_orderkey"]), FT_VOTE, dims)


@query(f"""
WITH {_CUSTOMER_SQL}, {_ORDER_SQL}, {_FT_ORDERS_SQL}
SELECT nm_nation, nm_region, sum(vl_total)::DOUBLE AS vl_total, sum(qtd_order)::BIGINT AS qtd_order
FROM ft_orders JOIN dim_customer USING (sk_customer) GROUP BY ALL""")
def mart_orders_by_nation(spark, sf):
    dims = dims_of(spark, sf, FT_ORDERS)
    fact = build_fact(order_rows(spark, sf), FT_ORDERS, dims)
    mart = roll_up(
        fact,
        {"sk_customer": dims["dim_customer"]},
        ["nm_nation", "nm_region"],
        {"vl_total": "vl_total", "qtd_order": "qtd_order"},
    )
    return mart.withColumn("vl_total", F.col("vl_total").cast("double"))


@query(f"""
WITH {_LINE_SQL}
SELECT l_returnflag AS sg_flag, l_linestatus AS sg_line_status, sum(vl_gross)::DOUBLE AS vl_gross,
       sum(vl_net)::DOUBLE AS vl_net, sum(vl_tax)::DOUBLE AS vl_tax, count(*) AS qtd_line
FROM lines JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""")
def mart_lineitem_by_flag(spark, sf):
    """Grouped by columns of the line items alone: their dimensions only have to have a row, so none is built."""
    lines = line_rows(spark, sf).withColumnsRenamed({"l_returnflag": "sg_flag", "l_linestatus": "sg_line_status"})
    for name, natural, key in (
        ("supplier", "s_suppkey", "l_suppkey"),
        ("part", "p_partkey", "l_partkey"),
        ("orders", "o_orderkey", "l_orderkey"),
    ):
        known = table(spark, sf, name).select(F.col(natural).alias(key))
        lines = lookup_join(lines, known, [key], "left_semi")
    measures = ("vl_gross", "vl_net", "vl_tax", "qtd_line")
    lines = lines.withColumn("qtd_line", F.lit(1))
    mart = roll_up(lines, {}, ["sg_flag", "sg_line_status"], {m: m for m in measures})
    return mart.withColumns({m: F.col(m).cast("double") for m in measures[:3]})


@query("""
SELECT strftime(d, '%Y%m%d')::INTEGER AS sk_data, strftime(d, '%Y-%m-%d') AS dt_data,
       year(d)::INTEGER AS nr_ano, quarter(d)::INTEGER AS nr_trimestre, month(d)::INTEGER AS nr_mes,
       day(d)::INTEGER AS nr_dia, (isodow(d) - 1)::INTEGER AS nr_dia_semana
FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)""")
def dim_date(spark, sf):
    return make_dim_date(table(spark, sf, "orders"), "o_orderdate").withColumn("dt_data", text("dt_data"))


REFERENCE_DAY = dt.date(2001, 8, 1)


def top_order():
    return [F.desc("vl_total"), F.desc("sk_data_order"), F.asc("id_order")]


def _top_of(fact: DataFrame, dims, window: Window) -> DataFrame:
    return top_of_window(
        fact,
        {"sk_customer": dims["dim_customer"], "sk_order": dims["dim_order"].drop("id_order")},
        "sk_data_order",
        window,
        top_order(),
        k=5,
        where=F.col("ds_priority").isin("1-URGENT", "2-HIGH") & (F.col("nm_nation") != "NÃO INFORMADO"),
    )


def top_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: dimension build, star join, window, two kinds, top five.

    The fact is built in place, so the window is also a range of the source's dates, which the scan skips by."""
    window = Window(REFERENCE_DAY)
    dims = dims_of(spark, sf, FT_ORDERS)
    orders = order_rows(spark, sf).where(window.of_source(F.col("o_orderdate")))
    return _top_of(build_fact(orders, FT_ORDERS, dims), dims, window)


def published_orders(spark: SparkSession, sf: str) -> Layer:
    """The fact of the orders and its dimensions as a published layer."""
    dims = dims_of(spark, sf, FT_ORDERS)
    layer = Layer(spark, new_path(spark, "gold"))
    layer.refresh({**dims, "ft_orders": by_date(build_fact(order_rows(spark, sf), FT_ORDERS, dims), FT_ORDERS)})
    return layer


_WEEKLY_SQL = f"""
WITH {_CUSTOMER_SQL}, {_ORDER_SQL}, {_FT_ORDERS_SQL}
SELECT f.id_order, ds_priority, sg_status, nm_customer, sg_segment, nm_nation,
       vl_total::DOUBLE AS vl_total,
       round((vl_total / 1000000 * 100)::DECIMAL(18,4), 1)::DOUBLE AS score_pct,
       strftime(strptime(sk_data_order::VARCHAR, '%Y%m%d'), '%Y-%m-%d') AS dt_order, qtd_order
FROM ft_orders f JOIN dim_customer USING (sk_customer) JOIN dim_order USING (sk_order)
WHERE strptime(sk_data_order::VARCHAR, '%Y%m%d') >= DATE '2001-08-01' - INTERVAL 23 DAY
  AND strptime(sk_data_order::VARCHAR, '%Y%m%d') < DATE '2001-08-01' - INTERVAL 16 DAY
  AND ds_priority IN ('1-URGENT', '2-HIGH') AND nm_nation <> 'NÃO INFORMADO'
ORDER BY vl_total DESC, sk_data_order DESC, f.id_order LIMIT 5"""


def _weekly(top: DataFrame) -> DataFrame:
    return top.select(
        "id_order",
        "ds_priority",
        "sg_status",
        "nm_customer",
        "sg_segment",
        "nm_nation",
        F.col("vl_total").cast("double").alias("vl_total"),
        percent(F.col("vl_total") / 1_000_000).cast("double").alias("score_pct"),
        text(key_date(F.col("sk_data_order"))).alias("dt_order"),
        "qtd_order",
    )


@query(_WEEKLY_SQL)
def weekly_top(spark, sf):
    return _weekly(top_orders(spark, sf))


@query(_WEEKLY_SQL)
def weekly_published(spark, sf):
    """The same from a published layer, whose fact lies in the order of its date key."""
    layer = published_orders(spark, sf)
    dims = {n: layer.read(n) for n in ("dim_customer", "dim_order")}
    return _weekly(_top_of(layer.read("ft_orders"), dims, Window(REFERENCE_DAY)))


@query(f"""
SELECT count(*) AS itens,
       string_agg('<div class="card"><h2>' || posicao || '. ' || ds_priority || ' ' || id_order || '</h2>'
         || '<p><b>Autor:</b> ' || nm_customer || ' (' || sg_segment || '/' || nm_nation || ')</p>'
         || '<p><b>Apresentada em:</b> ' || dt_order || '</p></div>', '' ORDER BY posicao) AS html
FROM (SELECT *, row_number() OVER (ORDER BY vl_total DESC, dt_order DESC, id_order) AS posicao
      FROM ({_WEEKLY_SQL}))""")
def digest(spark, sf):
    top = ranked(top_orders(spark, sf), top_order()).withColumn(
        "dt_order", text(key_date(F.col("sk_data_order")))
    )
    card = html_card(
        [F.col("posicao"), F.lit(". "), F.col("ds_priority"), F.lit(" "), F.col("id_order")],
        [
            (
                "Autor:",
                F.concat("nm_customer", F.lit(" ("), "sg_segment", F.lit("/"), "nm_nation", F.lit(")")),
            ),
            ("Apresentada em:", F.col("dt_order")),
        ],
    )
    return make_digest(top, "posicao", ["id_order", "nm_customer"], card).select("itens", "html")
