"""Conforming: tolerant casts, text repair, ids, dedupe, sentinels, cleaned join keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.functions import casts
from sedimenta.functions import text as tx
from sedimenta.operators.conform import cast_report as make_cast_report
from sedimenta.operators.dedupe import keep_first, keep_valid_ids
from sedimenta.operators.dedupe import reject_report as make_reject_report
from sedimenta.operators.joins import lookup_join
from sedimenta.operators.star import fill
from sedimenta.plans.parliament import RESULTS
from sedimenta.plans.registry import money, query, table, text
from sedimenta.spec import TableSpec


@query("""
SELECT doc_id, md5(upper(replace(nfc_normalize(text), 'ß', 'ss'))) AS hash FROM documents""")
def text_repair(spark, sf):
    """Texts damaged by reading their UTF-8 bytes as latin-1, then repaired and upper-cased."""
    damaged = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return table(spark, sf, "documents").select("doc_id", F.md5(tx.standardise(damaged)).alias("hash"))


@query("SELECT doc_id, md5(nfc_normalize(text)) AS hash FROM documents")
def text_nfc(spark, sf):
    """Texts taken apart into base letters and accents, then composed."""
    apart = F.java_method(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"), F.col("text"), F.lit(False)
    )
    return (
        table(spark, sf, "documents")
        .withColumn("apart", apart)
        .select("doc_id", F.md5(tx.nfc(F.col("apart"))).alias("hash"))
    )


@query("""
SELECT page_id, regexp_extract(u, '[^/]+$') AS tail, try_cast(
         CASE WHEN regexp_matches(regexp_extract(u, '[^/]+$'), '^[0-9]+$')
              THEN regexp_extract(u, '[^/]+$') END AS BIGINT) AS tail_id,
       coalesce(try_cast(CASE WHEN regexp_matches(regexp_extract(u, '[^/]+$'), '^[0-9]+$')
              THEN regexp_extract(u, '[^/]+$') END AS BIGINT), -1) AS id
FROM (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS u FROM pages)""")
def uri_tail(spark, sf):
    path = F.regexp_replace("url", "[?#].*$", "")
    return table(spark, sf, "pages").select(
        "page_id",
        F.coalesce(casts.uri_tail(path), F.lit("")).alias("tail"),
        casts.uri_id(path).alias("tail_id"),
        F.coalesce(casts.uri_id(path), F.lit(-1)).alias("id"),
    )


# Line numbers stand for kinds of damage, so every row of the table takes part.
_DAMAGED_ID = """CASE l_linenumber WHEN 1 THEN l_orderkey::VARCHAR WHEN 2 THEN '-' || l_orderkey
  WHEN 3 THEN l_orderkey || '.5' WHEN 4 THEN l_orderkey || '.0'
  WHEN 5 THEN CASE l_orderkey % 6 WHEN 0 THEN l_orderkey || 'd' WHEN 1 THEN l_orderkey || 'f' WHEN 2 THEN '1e300'
    WHEN 3 THEN '99999999999999999999' WHEN 4 THEN 'NaN' ELSE 'x' || l_orderkey END
  WHEN 6 THEN NULL ELSE '0' || l_orderkey END"""
_VALID = "coalesce(try_cast(id AS DOUBLE) % 1 = 0 AND try_cast(id AS DOUBLE) BETWEEN 1 AND 9e18, false)"


def damaged_ids(spark, sf):
    key = text("l_orderkey")
    n, rest = F.col("l_linenumber"), F.col("l_orderkey") % 6
    odd = (
        F.when(rest == 0, F.concat(key, F.lit("d")))
        .when(rest == 1, F.concat(key, F.lit("f")))
        .when(rest == 2, "1e300")
        .when(rest == 3, "99999999999999999999")
        .when(rest == 4, "NaN")
        .otherwise(F.concat(F.lit("x"), key))
    )
    damaged = (
        F.when(n == 1, key)
        .when(n == 2, F.concat(F.lit("-"), key))
        .when(n == 3, F.concat(key, F.lit(".5")))
        .when(n == 4, F.concat(key, F.lit(".0")))
        .when(n == 5, odd)
        .when(n == 6, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("0"), key))
    )
    return table(spark, sf, "lineitem").select(
        damaged.alias("id"), "l_orderkey", "l_linenumber", "l_partkey"
    )


@query(f"""
SELECT try_cast(try_cast(id AS DOUBLE) AS BIGINT) AS id, l_linenumber, l_partkey
FROM (SELECT {_DAMAGED_ID} AS id, l_linenumber, l_partkey FROM lineitem) WHERE {_VALID}""")
def valid_ids(spark, sf):
    return keep_valid_ids(damaged_ids(spark, sf)).select("id", "l_linenumber", "l_partkey")


@query(f"""
WITH t AS (SELECT {_DAMAGED_ID} AS id, l_orderkey, l_linenumber FROM lineitem),
k AS (SELECT id, {_VALID} AS ok, count(*) AS n FROM t GROUP BY ALL)
SELECT unnest(['read', 'invalid_id', 'duplicate', 'kept']) AS reason,
       unnest([sum(n), sum(n) FILTER (NOT ok), sum(n - 1) FILTER (ok), count(*) FILTER (ok)])::BIGINT AS rows
FROM k""")
def reject_report(spark, sf):
    return make_reject_report(damaged_ids(spark, sf), "id", ["id"])


@query("""
SELECT replace(l_orderkey || '-' || l_linenumber, '-', '')::BIGINT AS id,
       count(DISTINCT l_orderkey || '-' || l_linenumber) AS composite_ids
FROM lineitem GROUP BY ALL""")
def strip_hyphen(spark, sf):
    """Composite ids without hyphens, with the number of ids that became one."""
    composite = F.concat(text("l_orderkey"), F.lit("-"), text("l_linenumber"))
    return (
        table(spark, sf, "lineitem")
        .select(composite.alias("c"))
        .distinct()
        .groupBy(casts.strip_hyphen(F.col("c")).cast("bigint").alias("id"))
        .agg(F.count(F.lit(1)).alias("composite_ids"))
    )


@query(f"""
SELECT l_orderkey, l_linenumber, coalesce(try_cast(
         CASE WHEN regexp_matches(id, '^[0-9]+$') THEN id END AS BIGINT), -1) AS id
FROM (SELECT {_DAMAGED_ID} AS id, l_orderkey, l_linenumber FROM lineitem)""")
def guarded_id(spark, sf):
    return damaged_ids(spark, sf).select(
        "l_orderkey", "l_linenumber", F.coalesce(casts.digits_id(F.col("id")), F.lit(-1)).alias("id")
    )


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, o_orderpriority
FROM (SELECT {_DAMAGED_ID} AS id, * FROM lineitem) v
JOIN (SELECT CASE WHEN o_orderstatus = 'P' THEN 'x' || o_orderkey ELSE o_orderkey::VARCHAR END AS id, *
      FROM orders) o
ON CASE WHEN regexp_matches(v.id, '^[0-9]+$') THEN try_cast(v.id AS BIGINT) ELSE -1 END
 = CASE WHEN regexp_matches(o.id, '^[0-9]+$') THEN o.id::BIGINT ELSE -2 END""")
def guarded_join(spark, sf):
    """Join on cleaned ids: a damaged id becomes null, which matches nothing on either side."""
    votes = damaged_ids(spark, sf).select(
        casts.digits_id(F.col("id")).alias("k"), "l_orderkey", "l_linenumber", "l_partkey"
    )
    ballots = table(spark, sf, "orders").select(
        casts.digits_id(
            F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("x"), text("o_orderkey"))).otherwise(
                text("o_orderkey")
            )
        ).alias("k"),
        "o_orderpriority",
    )
    return lookup_join(votes, ballots.where("k IS NOT NULL"), ["k"]).drop("k")


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
                 l_linestatus, l_shipdate) AS rn FROM lineitem) WHERE rn = 1""")
def dedupe_keyed(spark, sf):
    kept = keep_first(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return kept.withColumn("l_shipdate", text(F.to_date("l_shipdate")))


@query("SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, year(l_shipdate)::INTEGER AS ano FROM lineitem")
def distinct_votes(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .select("l_suppkey", "l_returnflag", "l_linestatus", F.year("l_shipdate").alias("ano"))
        .distinct()
    )


# Values of the events as text, with a different damage per event type.
_EVENT_TEXT = """
SELECT event_id,
  CASE event_type WHEN 'click' THEN event_id::VARCHAR WHEN 'view' THEN ' ' || event_id || ' '
    WHEN 'error' THEN 'E' || event_id WHEN 'purchase' THEN event_id || '.0' ELSE event_id || '.5' END AS inteiro,
  CASE event_type WHEN 'error' THEN 'n/d' WHEN 'signup' THEN '1e3' WHEN 'view' THEN '12d'
    ELSE printf('%.2f', value) END AS real,
  CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN 'view' THEN strftime(ts, '%Y-%m-%d')
    WHEN 'error' THEN 'ontem' WHEN 'purchase' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '-03:00'
    ELSE strftime(ts, '%d/%m/%Y %H:%M') END AS quando,
  CASE event_type WHEN 'click' THEN '1' WHEN 'view' THEN 'False' WHEN 'error' THEN 'TRUE'
    WHEN 'purchase' THEN 'true' ELSE NULL END AS logico
FROM events"""
_EVENT_SPEC = TableSpec(
    "events",
    kinds={"event_id": "long", "inteiro": "long", "real": "double", "quando": "timestamp", "logico": "bool"},
    key=("event_id",),
    formats=("dd/MM/yyyy HH:mm",),
)


def event_texts(spark, sf):
    kind, key = F.col("event_type"), text("event_id")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")

    def cases(error, click, view, purchase, signup):
        return (
            F.when(kind == "click", click)
            .when(kind == "view", view)
            .when(kind == "error", error)
            .when(kind == "purchase", purchase)
            .otherwise(signup)
        )

    shown = F.format_string("%.2f", "value")
    return table(spark, sf, "events").select(
        "event_id",
        cases(
            F.concat(F.lit("E"), key),
            key,
            F.concat(F.lit(" "), key, F.lit(" ")),
            F.concat(key, F.lit(".0")),
            F.concat(key, F.lit(".5")),
        ).alias("inteiro"),
        cases(F.lit("n/d"), shown, F.lit("12d"), shown, F.lit("1e3")).alias("real"),
        cases(
            F.lit("ontem"),
            iso,
            F.date_format("ts", "yyyy-MM-dd"),
            F.concat(iso, F.lit("-03:00")),
            F.date_format("ts", "dd/MM/yyyy HH:mm"),
        ).alias("quando"),
        cases(F.lit("TRUE"), F.lit("1"), F.lit("False"), F.lit("true"), F.lit(None).cast("string")).alias(
            "logico"
        ),
    )


_INT_SQL = "CASE WHEN regexp_matches(inteiro, '^\\s*[0-9]+(\\.0)?\\s*$') THEN try_cast(trim(inteiro) AS DOUBLE)::BIGINT END"
_REAL_SQL = "CASE WHEN regexp_matches(real, '^[0-9.e]+$') THEN try_cast(real AS DOUBLE) END"
_TIME_SQL = """CASE WHEN quando LIKE '%-03:00' THEN strptime(left(quando, 19), '%Y-%m-%dT%H:%M:%S') + INTERVAL 3 HOUR
  ELSE coalesce(try_strptime(quando, '%Y-%m-%dT%H:%M:%S'), try_strptime(quando, '%Y-%m-%d'),
                try_strptime(quando, '%d/%m/%Y %H:%M')) END"""
_BOOL_SQL = "CASE WHEN logico IN ('1', 'true', 'True') THEN true WHEN logico IN ('0', 'false', 'False') THEN false END"


@query(f"SELECT event_id, {_INT_SQL} AS inteiro FROM ({_EVENT_TEXT})")
def cast_int(spark, sf):
    return event_texts(spark, sf).select("event_id", casts.to_long(F.col("inteiro")).alias("inteiro"))


@query(f"SELECT event_id, {_REAL_SQL} AS real FROM ({_EVENT_TEXT})")
def cast_double(spark, sf):
    return event_texts(spark, sf).select("event_id", casts.to_double(F.col("real")).alias("real"))


@query(f"SELECT event_id, strftime({_TIME_SQL}, '%Y-%m-%d %H:%M:%S') AS quando FROM ({_EVENT_TEXT})")
def cast_ts(spark, sf):
    at = casts.to_timestamp(F.col("quando"), formats=_EVENT_SPEC.formats)
    return event_texts(spark, sf).select(
        "event_id", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("quando")
    )


@query(f"SELECT event_id, {_BOOL_SQL} AS logico FROM ({_EVENT_TEXT})")
def cast_bool(spark, sf):
    return event_texts(spark, sf).select("event_id", casts.to_bool(F.col("logico")).alias("logico"))


@query(f"""
WITH t AS ({_EVENT_TEXT}),
r AS (SELECT 'event_id' AS column_name, 'long' AS kind, count(event_id) AS n_in, count(event_id) AS n_out FROM t
  UNION ALL SELECT 'inteiro', 'long', count(inteiro), count({_INT_SQL}) FROM t
  UNION ALL SELECT 'real', 'double', count(real), count({_REAL_SQL}) FROM t
  UNION ALL SELECT 'quando', 'timestamp', count(quando), count({_TIME_SQL}) FROM t
  UNION ALL SELECT 'logico', 'bool', count(logico), count({_BOOL_SQL}) FROM t)
SELECT *, n_in - n_out AS n_rejected FROM r""")
def cast_report(spark, sf):
    return make_cast_report(event_texts(spark, sf), _EVENT_SPEC)


@query("""
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'N/I') AS segment,
       coalesce(CASE WHEN c_acctbal >= 0 THEN c_name END, 'NÃO INFORMADO') AS nome,
       coalesce(nullif(c_nationkey, 0), -1) AS id_nation, coalesce(nullif(c_nationkey, 1), -3) AS id_other,
       coalesce(nullif(c_nationkey, 2), 9999) AS ano,
       coalesce(CASE WHEN c_acctbal >= 0 THEN c_acctbal::DECIMAL(18,2) END, 0)::DOUBLE AS saldo,
       coalesce(CASE WHEN c_acctbal >= 0 THEN '2001-08-01' END, '9999-12-31') AS dia
FROM customer""")
def sentinel_fill(spark, sf):
    good = F.col("c_acctbal") >= 0
    gaps = table(spark, sf, "customer").select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.when(good, F.col("c_name")).alias("nome"),
        F.nullif("c_nationkey", F.lit(0)).alias("id_nation"),
        F.nullif("c_nationkey", F.lit(1)).alias("id_other"),
        F.nullif("c_nationkey", F.lit(2)).alias("ano"),
        F.when(good, money("c_acctbal")).alias("saldo"),
        F.when(good, F.to_date(F.lit("2001-08-01"))).alias("dia"),
    )
    full = fill(
        gaps,
        segment="code",
        nome="text",
        id_nation="unknown_id",
        id_other="not_applicable_id",
        ano="year",
        saldo="amount",
        dia="date",
    )
    return full.withColumn("saldo", F.col("saldo").cast("double")).withColumn("dia", text("dia"))


@query("""
SELECT documents.doc_id, CASE WHEN toxic = 1 THEN 'Aprovado' WHEN toxic = 0 THEN 'Rejeitado'
       ELSE 'NÃO INFORMADO' END AS resultado
FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id""")
def tri_state(spark, sf):
    joined = lookup_join(
        table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), ["doc_id"], "left"
    )
    return joined.select("doc_id", tx.three_way(casts.to_bool(text("toxic")), **RESULTS).alias("resultado"))


@query("""
SELECT c_custkey, CASE WHEN n_regionkey < 4 AND n_regionkey + 1 = c_custkey THEN 'Sim' ELSE 'Não' END AS lider
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def leader_flag(spark, sf):
    """The group's leader URI ends in the member's own id; some groups have no leader."""
    uri = F.when(
        F.col("n_regionkey") < 4, F.concat(F.lit("https://example.org/deputados/"), F.col("n_regionkey") + 1)
    )
    groups = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), uri.alias("uri"))
    members = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return members.join(groups, "c_nationkey").select(
        "c_custkey", tx.two_way(casts.uri_id(F.col("uri")) == F.col("c_custkey")).alias("lider")
    )


@query("""
SELECT c_custkey, n_name, n_regionkey FROM customer JOIN nation
ON trim(' NATION_' || c_nationkey) = trim(n_name || '  ')""")
def trim_join(spark, sf):
    """Join on names with stray blanks; the trimmed key is projected first, so it is an equi join."""
    nations = table(spark, sf, "nation").select(
        F.trim(F.concat("n_name", F.lit("  "))).alias("k"), "n_name", "n_regionkey"
    )
    members = table(spark, sf, "customer").select(
        "c_custkey", F.trim(F.concat(F.lit(" NATION_"), text("c_nationkey"))).alias("k")
    )
    return members.join(nations, "k").drop("k")
