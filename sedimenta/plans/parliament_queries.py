"""The parliamentary jobs over records derived from the driver's tables.

Customers play the deputies, suppliers the bodies, parts the events, orders the bills and
votes, line items the ballots and expenses. `records` turns them into landed text tables
with the usual defects (blank texts, missing values, damaged ids, duplicates); the SQL of
each query starts from the same records.
"""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from sedimenta.operators.conform import conform
from sedimenta.operators.conform import load_report as make_load_report
from sedimenta.operators.quality import pk_violations
from sedimenta.operators.report import Window, digest, ranked
from sedimenta.operators.similarity import collect_labels
from sedimenta.plans import parliament as pl
from sedimenta.plans.registry import money, query, table, text
from sedimenta.session import new_path, stage, stage_counted, together
from sedimenta.sources.tables import Layer

_URI = "https://example.org/api/"


def _uri(kind: str, key):
    return F.concat(F.lit(f"{_URI}{kind}/"), key.cast("string"))


def _legislaturas(spark, sf):
    return table(spark, sf, "region").select(
        text(F.col("r_regionkey") + 1).alias("id"),
        F.concat(text(F.col("r_regionkey") * 4 + 1979), F.lit("-02-01")).alias("dataInicio"),
        F.when(
            F.col("r_regionkey") < 4, F.concat(text(F.col("r_regionkey") * 4 + 1983), F.lit("-01-31"))
        ).alias("dataFim"),
    )


def _partidos(spark, sf):
    return table(spark, sf, "nation").select(
        text(F.col("n_nationkey") + 1).alias("id"),
        F.concat(F.lit("p"), "n_nationkey", F.lit(" ")).alias("sigla"),
        F.when(F.col("n_regionkey") < 4, _uri("deputados", F.col("n_nationkey") * 7 + 1)).alias(
            "status.lider.uri"
        ),
    )


def _deputados(spark, sf):
    known = F.col("c_acctbal") >= 0
    return table(spark, sf, "customer").select(
        text("c_custkey").alias("id"),
        F.when(known, F.col("c_name")).alias("ultimoStatus.nome"),
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.left("c_mktsegment", F.lit(1))).alias(
            "sexo"
        ),
        F.when(
            known, text(F.date_add(F.lit(dt.date(1950, 1, 1)), (F.col("c_custkey") % 9000).cast("int")))
        ).alias("dataNascimento"),
        F.left("c_mktsegment", F.lit(2)).alias("ultimoStatus.siglaUf"),
        F.replace("c_mktsegment", F.lit("BUILDING"), F.lit("")).alias("escolaridade"),
        F.concat(F.lit(" P"), "c_nationkey").alias("ultimoStatus.siglaPartido"),
        text(F.col("c_nationkey") % 6 + 1).alias("ultimoStatus.idLegislatura"),
        F.lit("Exercício").alias("ultimoStatus.situacao"),
        F.when(F.col("c_nationkey") > 3, "Titular").alias("ultimoStatus.condicaoEleitoral"),
    )


def _orgaos(spark, sf):
    return table(spark, sf, "supplier").select(
        text("s_suppkey").alias("id"),
        F.concat(F.lit("org"), "s_suppkey").alias("sigla"),
        F.col("s_name").alias("nome"),
        F.when(F.col("s_nationkey") > 5, F.col("s_name")).otherwise("").alias("apelido"),
        F.when(F.col("s_nationkey") > 9, "Comissão").alias("tipoOrgao"),
    )


def _eventos(spark, sf):
    return table(spark, sf, "part").select(
        text("p_partkey").alias("id"),
        F.col("p_type").alias("descricaoTipo"),
        F.when(F.col("p_size") > 5, F.col("p_brand")).alias("situacao"),
        F.date_format(
            F.date_add(F.lit(dt.date(2000, 1, 1)), F.col("p_size")).cast("timestamp_ntz"),
            "yyyy-MM-dd'T'HH:mm",
        ).alias("dataHoraInicio"),
        F.lit(None).cast("string").alias("dataHoraFim"),
    )


def _eventos_orgaos(spark, sf):
    return table(spark, sf, "lineitem").select(
        text("l_suppkey").alias("id"), text("l_partkey").alias("idEventoContexto")
    )


def _proposicoes(spark, sf):
    kind = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "PL")
        .when(F.col("o_orderpriority") == "2-HIGH", "PEC")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "PLP")
        .when(F.col("o_orderpriority") == "5-LOW", "Req")
    )
    return table(spark, sf, "orders").select(
        text("o_orderkey").alias("id"),
        kind.alias("siglaTipo"),
        F.col("o_orderpriority").alias("descricaoTipo"),
        F.when(F.col("o_orderstatus") != "F", text(F.year("o_orderdate"))).alias("ano"),
        F.concat(F.lit("dispõe sobre "), "o_orderkey").alias("ementa"),
        F.when(F.col("o_orderstatus") != "P", _uri("orgaos", F.floor(F.col("o_custkey") / 15))).alias(
            "statusProposicao.uriOrgao"
        ),
        F.col("o_orderstatus").alias("statusProposicao.descricaoSituacao"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dataApresentacao"),
    )


def _autores(spark, sf):
    orders = table(spark, sf, "orders")
    first = orders.select(
        text("o_orderkey").alias("idProposicaoContexto"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(_URI + "deputados/"))
        .otherwise(_uri("deputados", F.col("o_custkey")))
        .alias("uri"),
    )
    second = orders.select(
        text("o_orderkey"),
        F.when(F.col("o_orderpriority") == "1-URGENT", _uri("deputados", F.floor(F.col("o_custkey") / 2)))
        .otherwise(_uri("deputados", F.col("o_custkey"))),
    )
    return first.union(second)


def _votacoes(spark, sf):
    return table(spark, sf, "orders").select(
        F.concat(text("o_orderkey"), F.lit("-1")).alias("id"),
        _uri("orgaos", F.floor(F.col("o_custkey") / 15)).alias("uriOrgao"),
        _uri("eventos", F.col("o_custkey") * 2).alias("uriEvento"),
        F.when(F.col("o_orderstatus") != "P", _uri("proposicoes", F.col("o_orderkey"))).alias(
            "uriProposicaoObjeto"
        ),
        F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "O", "0").alias("aprovacao"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("votação "), "o_orderpriority")).alias(
            "descricao"
        ),
    )


def _votos(spark, sf):
    line = F.col("l_linenumber")
    return table(spark, sf, "lineitem").select(
        F.concat(F.when(line == 7, "x").otherwise(""), text("l_orderkey"), F.lit("-1")).alias(
            "idVotacaoContexto"
        ),
        F.when(line != 6, text("l_partkey")).alias("deputado_.id"),
        F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_returnflag")).alias("tipoVoto"),
        F.when(
            F.col("l_returnflag") != "A", F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")
        ).alias("dataRegistroVoto"),
    )


def _despesas(spark, sf):
    def shown(c):
        return text(money(c))

    return table(spark, sf, "lineitem").select(
        text("l_partkey").alias("idDeputado"),
        F.concat_ws("/", "l_orderkey", "l_linenumber").alias("codDocumento"),
        F.when(F.col("l_returnflag") != "N", F.concat(F.lit("combustível "), "l_returnflag")).alias(
            "tipoDespesa"
        ),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("dataDocumento"),
        shown(F.col("l_extendedprice")).alias("valorDocumento"),
        F.when(F.col("l_linestatus") == "O", shown(F.col("l_extendedprice"))).alias("valorLiquido"),
        F.lit("n/d").alias("valorGlosa"),
        text("l_linenumber").alias("parcela"),
    )


RECORDS = {
    "legislaturas": _legislaturas,
    "partidos": _partidos,
    "deputados": _deputados,
    "orgaos": _orgaos,
    "eventos": _eventos,
    "eventos_orgaos": _eventos_orgaos,
    "proposicoes": _proposicoes,
    "proposicoes_autores": _autores,
    "votacoes": _votacoes,
    "votos": _votos,
    "despesas": _despesas,
}


def enrichment(spark: SparkSession, sf: str) -> DataFrame:
    """Results for the bills that are not pending; some have no theme, some no summary."""
    theme = F.when(F.col("o_orderpriority") == "1-URGENT", " saúde ").when(
        F.col("o_orderpriority") == "2-HIGH", "Tributário"
    )
    return (
        table(spark, sf, "orders")
        .where("o_orderstatus <> 'P'")
        .select(
            F.col("o_orderkey").alias("proposicao_id"),
            theme.otherwise("  ").alias("tema_classificado"),
            ((F.col("o_orderkey") % 10000) / 10000).alias("score_similaridade"),
            F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("resumo "), "o_orderkey")).alias(
                "resumo_executivo"
            ),
        )
    )


def bronze(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    """Conformed tables, written before they are joined, as in the layered job."""

    def conformed(name):
        return stage(conform(RECORDS[name](spark, sf), pl.STAGING[name]), name)

    return together({n: partial(conformed, n) for n in names})


def silver(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    inputs = bronze(spark, sf, *{n: 0 for name in names for n in pl.SILVER[name][1]})
    return {name: pl.SILVER[name][0](inputs) for name in names}


def staged_silver(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    """Silver tables that several gold jobs read, written once."""
    return together({n: partial(stage, df, n) for n, df in silver(spark, sf, *names).items()})


def _shown(df: DataFrame) -> DataFrame:
    """Dates as text and amounts as doubles, for the comparison."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.select(
        *[
            text(c).alias(c) if k == "date" else F.col(c).cast("double").alias(c) if k.startswith("decimal") else c
            for c, k in kinds.items()
        ]
    )


# SQL: the same records after conforming, then silver, then gold.
_U = "'HTTPS://EXAMPLE.ORG/API/'"
_SILVER_SQL = {
    "deputado": """
deputado AS (
  SELECT c_custkey AS "idDeputado",
    CASE WHEN c_acctbal >= 0 THEN upper(c_name) ELSE 'NÃO INFORMADO' END AS nome,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'N/I' ELSE left(c_mktsegment, 1) END AS sexo,
    CASE WHEN c_acctbal >= 0 THEN strftime(DATE '1950-01-01' + (c_custkey % 9000)::INTEGER, '%Y-%m-%d')
         ELSE '9999-12-31' END AS "dataNascimento",
    left(c_mktsegment, 2) AS "siglaUF",
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'NÃO INFORMADO' ELSE c_mktsegment END AS escolaridade,
    ' P' || c_nationkey AS "siglaPartido",
    CASE WHEN n_regionkey < 4 AND n_nationkey * 7 + 1 = c_custkey THEN 'Sim' ELSE 'Não' END AS "LiderPartido",
    'EXERCÍCIO' AS situacao,
    CASE WHEN c_nationkey > 3 THEN 'TITULAR' ELSE 'NÃO INFORMADO' END AS "condicaoEleitoral",
    r_regionkey::BIGINT + 1 AS legislatura,
    (r_regionkey * 4 + 1979) || '-02-01' AS "dataInicioLegislatura",
    CASE WHEN r_regionkey < 4 THEN (r_regionkey * 4 + 1983) || '-01-31' ELSE '9999-12-31' END
      AS "dataFimLegislatura"
  FROM customer JOIN region ON c_nationkey % 6 = r_regionkey JOIN nation ON c_nationkey = n_nationkey
  WHERE c_custkey > 0)""",
    "orgao": """
orgao AS (
  SELECT s_suppkey AS "idOrgao", 'ORG' || s_suppkey AS siglaorgao, upper(s_name) AS nome,
    CASE WHEN s_nationkey > 5 THEN upper(s_name) ELSE 'NÃO INFORMADO' END AS apelido,
    CASE WHEN s_nationkey > 9 THEN 'COMISSÃO' ELSE 'NÃO INFORMADO' END AS "tipoOrgao"
  FROM supplier WHERE s_suppkey > 0)""",
    "evento": """
evento AS (
  SELECT p_partkey AS "idEvento", upper(p_type) AS "descricaoTipo",
    CASE WHEN p_size > 5 THEN upper(p_brand) ELSE 'NÃO INFORMADO' END AS situacao,
    strftime(DATE '2000-01-01' + p_size, '%Y-%m-%d') AS "dataHoraInicio", '9999-12-31' AS "dataHoraFim"
  FROM part WHERE p_partkey > 0 AND p_partkey IN (SELECT l_partkey FROM lineitem))""",
    "proposicao": """
proposicao AS (
  SELECT DISTINCT o_orderkey AS "idProposicao", autor AS "idDeputado",
    CASE WHEN o_orderstatus <> 'P' THEN o_custkey // 15 ELSE -1 END AS "idOrgao",
    CASE o_orderpriority WHEN '1-URGENT' THEN 'PL' WHEN '2-HIGH' THEN 'PEC' WHEN '3-MEDIUM' THEN 'PLP'
      WHEN '5-LOW' THEN 'REQ' ELSE 'N/I' END AS "siglaTipoProposicao",
    o_orderpriority AS "descricaoTipoProposicao",
    CASE WHEN o_orderstatus <> 'F' THEN year(o_orderdate) ELSE 9999 END AS ano,
    'DISPÕE SOBRE ' || o_orderkey AS ementa, o_orderstatus AS "statusProposicao",
    strftime(o_orderdate, '%Y-%m-%d') AS "dataApresentacao"
  FROM orders JOIN (
    SELECT o_orderkey AS k, CASE WHEN o_orderpriority = '5-LOW' THEN -1 ELSE o_custkey END AS autor FROM orders
    UNION ALL
    SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey // 2 ELSE o_custkey END FROM orders)
  ON o_orderkey = k WHERE o_orderkey > 0)""",
    "despesa": """
despesa AS (
  SELECT l_partkey AS "idDeputado", l_orderkey || '/' || l_linenumber AS "codDespesa",
    CASE WHEN l_returnflag <> 'N' THEN 'COMBUSTÍVEL ' || l_returnflag ELSE 'NÃO INFORMADO' END AS "tipoDespesa",
    strftime(l_shipdate, '%Y-%m-%d') AS "dataDespesa", l_extendedprice::DECIMAL(18,2) AS "valorBruto",
    CASE WHEN l_linestatus = 'O' THEN l_extendedprice ELSE 0 END::DECIMAL(18,2) AS "valorLiquido",
    0::DECIMAL(18,2) AS "valorGlosa", l_linenumber::BIGINT AS parcela
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey,
    nullif(l_returnflag, 'N') NULLS FIRST, l_shipdate, l_extendedprice,
    CASE WHEN l_linestatus = 'O' THEN l_extendedprice END NULLS FIRST) = 1)""",
    "votacao": """
votacao AS (
  SELECT DISTINCT o_orderkey * 10 + 1 AS "idVotacao", o_custkey // 15 AS "idOrgao", o_custkey * 2 AS "idEvento",
    CASE WHEN l_linenumber <> 6 THEN l_partkey ELSE -1 END AS "idDeputado",
    CASE WHEN o_orderstatus <> 'P' THEN o_orderkey ELSE -3 END AS "idProposicao",
    CASE WHEN l_returnflag = 'N' THEN 'NÃO INFORMADO' ELSE l_returnflag END AS "tipoVoto",
    CASE WHEN l_returnflag <> 'A' THEN strftime(l_shipdate, '%Y-%m-%d') ELSE '9999-12-31' END AS "dataVoto",
    CASE WHEN o_orderpriority <> '5-LOW' THEN 'VOTAÇÃO ' || o_orderpriority ELSE 'NÃO INFORMADO' END
      AS "descricaoVotacao",
    CASE o_orderstatus WHEN 'F' THEN 'Aprovado' WHEN 'O' THEN 'Rejeitado' ELSE 'NÃO INFORMADO' END
      AS "resultadoVotacao"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber <> 7)""",
}
_IA_SQL = """
ia AS (
  SELECT o_orderkey AS proposicao_id, CASE o_orderpriority WHEN '1-URGENT' THEN ' saúde '
      WHEN '2-HIGH' THEN 'Tributário' ELSE '  ' END AS tema_classificado,
    (o_orderkey % 10000) / 10000 AS score_similaridade,
    CASE WHEN o_orderstatus = 'O' THEN 'resumo ' || o_orderkey END AS resumo_executivo
  FROM orders WHERE o_orderstatus <> 'P')"""


def _dim_sql(name, columns, unknown, not_applicable, rows):
    key = name.replace("dim_", "sk_")
    natural = columns[0]
    return f"""
{name} AS (
  SELECT -1::BIGINT AS {key}, {", ".join(f"{v} AS {c}" for c, v in zip(columns, unknown))}
  UNION ALL SELECT -3, {", ".join(not_applicable)}
  UNION ALL SELECT row_number() OVER (ORDER BY {natural}), * FROM (SELECT DISTINCT {rows}))"""


_T, _X = "'NÃO INFORMADO'", "'NÃO SE APLICA'"
_D = "'9999-12-31'"
_GOLD_SQL = {
    "dim_deputado": _dim_sql(
        "dim_deputado",
        "id_deputado nm_deputado sg_sexo dt_nascimento sg_uf ds_escolaridade sg_partido ds_lider_partido "
        "ds_situacao ds_condicao_eleitoral cd_legislatura dt_inicio_legislatura dt_fim_legislatura".split(),
        ["-1::BIGINT", _T, "'N/I'", _D, "'N/I'", _T, "'N/I'", _T, _T, _T, "-1::BIGINT", _D, _D],
        ["-3", _X, "'N/A'", _D, "'N/A'", _X, "'N/A'", _X, _X, _X, "-3", _D, _D],
        '"idDeputado" AS id_deputado, nome, sexo, "dataNascimento", "siglaUF", escolaridade, "siglaPartido", '
        '"LiderPartido", situacao, "condicaoEleitoral", legislatura, "dataInicioLegislatura", '
        '"dataFimLegislatura" FROM deputado',
    ),
    "dim_orgao": _dim_sql(
        "dim_orgao",
        "id_orgao sg_orgao nm_orgao ds_apelido_orgao ds_tipo_orgao".split(),
        ["-1::BIGINT", "'N/I'", _T, _T, _T],
        ["-3", "'N/A'", _X, _X, _X],
        '"idOrgao" AS id_orgao, siglaorgao, nome, apelido, "tipoOrgao" FROM orgao',
    ),
    "dim_evento": _dim_sql(
        "dim_evento",
        "id_evento ds_tipo_evento ds_situacao".split(),
        ["-1::BIGINT", _T, _T],
        ["-3", _X, _X],
        '"idEvento" AS id_evento, "descricaoTipo", situacao FROM evento',
    ),
    "dim_proposicao": _dim_sql(
        "dim_proposicao",
        "id_proposicao sg_tipo_proposicao ds_tipo_proposicao ds_situacao ds_tema_classificado "
        "nr_score_similaridade ds_resumo_executivo".split(),
        ["-1::BIGINT", _T, _T, _T, "'NÃO CLASSIFICADO'", "0::DOUBLE", _T],
        ["-3", _X, _X, _X, "'NÃO CLASSIFICADO'", "0", _T],
        '"idProposicao" AS id_proposicao, "siglaTipoProposicao", "descricaoTipoProposicao", "statusProposicao", '
        "coalesce(nullif(upper(trim(tema_classificado)), ''), 'NÃO CLASSIFICADO'), "
        "coalesce(score_similaridade, 0), "
        "coalesce(nullif(upper(trim(resumo_executivo)), ''), 'SEM RESUMO EXECUTIVO GERADO') "
        'FROM proposicao LEFT JOIN ia ON "idProposicao" = proposicao_id',
    ),
    "dim_votacao": _dim_sql(
        "dim_votacao",
        "id_votacao ds_votacao ds_resultado".split(),
        ["-1::BIGINT", _T, _T],
        ["-3", _X, _X],
        '"idVotacao" AS id_votacao, "descricaoVotacao", "resultadoVotacao" FROM votacao',
    ),
    "ft_proposicao": """
ft_proposicao AS (
  SELECT sk_deputado, sk_orgao, sk_proposicao,
    replace("dataApresentacao", '-', '')::INTEGER AS sk_data_proposicao, 1 AS qtd_proposicao
  FROM proposicao JOIN dim_proposicao ON "idProposicao" = id_proposicao
  JOIN dim_deputado ON "idDeputado" = id_deputado JOIN dim_orgao ON "idOrgao" = id_orgao)""",
    "ft_despesa": """
ft_despesa AS (
  SELECT sk_deputado, replace("dataDespesa", '-', '')::INTEGER AS sk_data_despesa,
    "codDespesa" AS sk_cod_despesa, "tipoDespesa" AS tp_despesa, "valorBruto"::DOUBLE AS vl_bruto,
    "valorLiquido"::DOUBLE AS vl_liquido, "valorGlosa"::DOUBLE AS vl_glosa, parcela AS nr_parcela
  FROM despesa JOIN dim_deputado ON "idDeputado" = id_deputado)""",
    "ft_voto": """
ft_voto AS (
  SELECT sk_votacao, sk_deputado, sk_orgao, coalesce(sk_evento, -1) AS sk_evento,
    replace("dataVoto", '-', '')::INTEGER AS sk_data_voto, sk_proposicao, "tipoVoto" AS tp_voto, 1 AS qtd_voto
  FROM votacao JOIN dim_votacao ON "idVotacao" = id_votacao JOIN dim_deputado ON "idDeputado" = id_deputado
  JOIN dim_orgao ON "idOrgao" = id_orgao LEFT JOIN dim_evento ON "idEvento" = id_evento
  JOIN dim_proposicao ON "idProposicao" = id_proposicao)""",
}


def _sql(final: str, silver_names: str, gold_names: str = "") -> str:
    parts = [_SILVER_SQL[n] for n in silver_names.split()] + [_IA_SQL]
    parts += [_GOLD_SQL[n] for n in gold_names.split()]
    return f"WITH {', '.join(parts)} {final}"


def _register_silver(name: str) -> None:
    def run(spark, sf):
        return _shown(silver(spark, sf, name)[name])

    run.__doc__ = pl.SILVER[name][0].__doc__
    amounts = (
        'SELECT * REPLACE ("valorBruto"::DOUBLE AS "valorBruto", "valorLiquido"::DOUBLE AS "valorLiquido", '
        '"valorGlosa"::DOUBLE AS "valorGlosa") FROM despesa'
    )
    final = amounts if name == "despesa" else f"SELECT * FROM {name}"
    query(_sql(final, name), name=f"silver_{name}")(run)


for _name in pl.SILVER:
    _register_silver(_name)


def _with_ia(spark, sf, tables):
    return {**tables, "proposicoes_ia": enrichment(spark, sf)}


def _register_dim(name: str) -> None:
    source = pl.DIMS[name][1]

    def run(spark, sf):
        return _shown(pl.gold_dim(name, _with_ia(spark, sf, silver(spark, sf, source))))

    query(_sql(f"SELECT * FROM {name}", source, name), name=f"gold_{name}")(run)


for _name in pl.DIMS:
    _register_dim(_name)


def _loaded(spark, sf, fact: str):
    """(fact, dimensions) of one fact load."""
    spec, source = pl.FACTS[fact]
    dims = {r.dim: pl.DIMS[r.dim][1] for r in spec.dims}
    tables = _with_ia(spark, sf, staged_silver(spark, sf, *{source: 0, **dict.fromkeys(dims.values())}))
    built = together({d: partial(pl.gold_dim, d, tables) for d in dims})
    return pl.gold_fact(fact, tables, built), built


_PROPOSICAO = ("proposicao deputado orgao", "dim_proposicao dim_deputado dim_orgao ft_proposicao")


@query(_sql("SELECT * FROM ft_proposicao", *_PROPOSICAO))
def gold_ft_proposicao(spark, sf):
    return _shown(_loaded(spark, sf, "ft_proposicao")[0])


@query(_sql("SELECT * FROM ft_despesa", "despesa deputado", "dim_deputado ft_despesa"))
def gold_ft_despesa(spark, sf):
    return _shown(_loaded(spark, sf, "ft_despesa")[0])


_VOTO = (
    "votacao deputado orgao evento proposicao",
    "dim_votacao dim_deputado dim_orgao dim_evento dim_proposicao ft_voto",
)


@query(_sql("SELECT * FROM ft_voto", *_VOTO))
def gold_ft_voto(spark, sf):
    return _shown(_loaded(spark, sf, "ft_voto")[0])


def _register_pk(fact: str, silver_names: str, gold_names: str) -> None:
    """The primary key of a loaded fact in which half of the people's rows stand twice."""
    key = ", ".join(pl.KEYS[fact])
    again = f"SELECT * FROM {fact} UNION ALL SELECT * FROM {fact} WHERE sk_deputado % 2 = 0"

    def run(spark, sf):
        loaded, rows = stage_counted(_loaded(spark, sf, fact)[0], fact)
        return pk_violations(loaded.unionAll(loaded.where("sk_deputado % 2 = 0")), pl.KEYS[fact], 2 * rows)

    sql = f"SELECT {key}, count(*) AS linhas FROM ({again}) GROUP BY ALL HAVING count(*) > 1"
    query(_sql(sql, silver_names, gold_names), name=f"gold_pk_{fact.removeprefix('ft_')}")(run)


_register_pk("ft_proposicao", *_PROPOSICAO)
_register_pk("ft_despesa", "despesa deputado", "dim_deputado ft_despesa")
_register_pk("ft_voto", *_VOTO)


@query("""
SELECT 'despesas' AS table_name, count(*) AS "read", 0::BIGINT AS invalid_id,
  count(*) - count(DISTINCT l_orderkey || '/' || l_linenumber) AS duplicate,
  count(DISTINCT l_orderkey || '/' || l_linenumber) AS kept, count(*) AS rejected_values FROM lineitem""")
def load_report(spark, sf):
    """What a load takes out of the expenses: repeated documents, and amounts that are no numbers."""
    return make_load_report({"despesas": _despesas(spark, sf)}, pl.STAGING)


_WINDOW = Window(dt.date(2001, 8, 1))
_BILLS_SQL = """
SELECT id_proposicao, sg_tipo_proposicao, ds_tipo_proposicao, dim_proposicao.ds_situacao, ds_tema_classificado,
  round((nr_score_similaridade * 100)::DECIMAL(18,4), 1)::DOUBLE AS score_pct, ds_resumo_executivo,
  strftime(strptime(sk_data_proposicao::VARCHAR, '%Y%m%d'), '%Y-%m-%d') AS dt_apresentacao,
  nm_deputado, sg_partido, sg_uf, qtd_proposicao, row_number() OVER (ORDER BY nr_score_similaridade DESC,
    sk_data_proposicao DESC, id_proposicao, sk_deputado) AS posicao
FROM ft_proposicao JOIN dim_proposicao USING (sk_proposicao) JOIN dim_deputado USING (sk_deputado)
WHERE strptime(sk_data_proposicao::VARCHAR, '%Y%m%d') >= DATE '2001-08-01' - INTERVAL {back} DAY
  AND strptime(sk_data_proposicao::VARCHAR, '%Y%m%d') < DATE '2001-08-01' - INTERVAL {until} DAY
  AND sg_tipo_proposicao IN ('PL', 'PEC', 'PLP') AND ds_tema_classificado <> 'NÃO CLASSIFICADO'
ORDER BY posicao LIMIT 5"""


def _top_bills(spark, sf, window):
    fact, dims = _loaded(spark, sf, "ft_proposicao")
    return pl.weekly_bills({**dims, "ft_proposicao": fact}, window)


@query(
    _sql("SELECT * EXCLUDE (posicao) FROM (" + _BILLS_SQL.format(back=23, until=16) + ")", *_PROPOSICAO)
)
def weekly_bills(spark, sf):
    """The weekly report on the bills with its usual window."""
    top = _top_bills(spark, sf, _WINDOW).drop("nr_score_similaridade", "sk_data_proposicao", "sk_deputado")
    return _shown(top)


_YEARS = Window(dt.date(2001, 8, 1), back=3650, until=0)


@query(
    _sql(
        """SELECT count(*) AS itens, string_agg('<div class="card"><h2>' || posicao || '. ' || sg_tipo_proposicao
  || ' ' || id_proposicao || '</h2><p><b>Tema:</b> ' || ds_tema_classificado || '</p><p><b>Confiança:</b> '
  || printf('%.1f', score_pct) || '%</p><p><b>Autor:</b> ' || nm_deputado || ' (' || sg_partido || '/' || sg_uf
  || ')</p><p><b>Situação:</b> ' || ds_situacao || '</p><p><b>Apresentada em:</b> '
  || strftime(strptime(dt_apresentacao, '%Y-%m-%d'), '%d/%m/%Y') || '</p><p><b>Resumo:</b> '
  || ds_resumo_executivo || '</p></div>', '' ORDER BY posicao) AS html FROM ("""
        + _BILLS_SQL.format(back=3650, until=0)
        + ")",
        *_PROPOSICAO,
    )
)
def bills_digest(spark, sf):
    """Ten years of bills as one digest."""
    top = ranked(_top_bills(spark, sf, _YEARS), pl._bill_order())
    return digest(top, "posicao", ["id_proposicao"], pl.bill_card("posicao")).select("itens", "html")


_LINE_SPEC = pl.STAGING["despesas"]


@query("""
SELECT l_partkey AS "idDeputado", l_orderkey || '/' || l_linenumber AS "codDocumento",
  CASE WHEN l_returnflag <> 'N' THEN 'COMBUSTÍVEL ' || l_returnflag END AS "tipoDespesa",
  strftime(l_shipdate, '%Y-%m-%d') AS "dataDocumento", l_extendedprice AS "valorDocumento",
  CASE WHEN l_linestatus = 'O' THEN l_extendedprice END AS "valorLiquido", NULL::DOUBLE AS "valorGlosa",
  l_linenumber::BIGINT AS parcela, 'AB-' || l_orderkey AS "idExterno", 'DEZ REAIS' AS "valorPorExtenso",
  l_linenumber::BIGINT AS quantidade
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey,
  nullif(l_returnflag, 'N') NULLS FIRST, l_shipdate, l_extendedprice,
  CASE WHEN l_linestatus = 'O' THEN l_extendedprice END NULLS FIRST) = 1""")
def conform_table(spark, sf):
    """A whole landed table conformed: cast, text, dedupe, blanks."""
    undeclared = {
        "idExterno": F.concat(F.lit("ab-"), F.split_part("codDocumento", F.lit("/"), F.lit(1))),
        "valorPorExtenso": F.lit("dez reais"),
        "quantidade": F.col("parcela").cast("bigint"),
    }
    out = conform(_despesas(spark, sf).withColumns(undeclared), _LINE_SPEC)
    return out.withColumn("dataDocumento", text(F.to_date("dataDocumento")))


@query(r"""
SELECT coalesce(doc_id, id) AS proposicao_id, tema AS tema_classificado, resumo_executivo FROM
  (SELECT doc_id, CASE quality WHEN 1 THEN 'Saúde' ELSE 'Trabalho' END AS tema FROM labels)
  FULL JOIN (SELECT doc_id AS id, length('Ementa: ' || regexp_replace(text, '^\s+|\s+$', '', 'g')
      || CASE WHEN lang = 'en' THEN chr(10) || chr(10) || 'Texto completo: ' || source ELSE '' END
      || chr(10) || chr(10) || 'Resuma em até 3 frases para um executivo:')::VARCHAR AS resumo_executivo
    FROM documents WHERE trim(text) <> '') ON doc_id = id""")
def enrichment_texts(spark, sf):
    """An enrichment run that computes summaries only, for items that have themes already."""
    layer = Layer(spark, new_path(spark, "silver"))
    themes = table(spark, sf, "labels").select(
        F.col("doc_id").alias("proposicao_id"),
        F.when(F.col("quality") == 1, "Saúde").otherwise("Trabalho").alias("tema_classificado"),
        F.lit(None).cast("string").alias("resumo_executivo"),
        F.lit(None).cast("timestamp_ntz").alias("processado_em"),
    )
    layer.replace("proposicoes_ia", themes)
    landed = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("ementa"),
        F.when(F.col("lang") == "en", F.col("source")).alias("ementaDetalhada"),
    )

    def load():
        import pandas as pd

        def summarise(frame):
            return pd.DataFrame(
                {"proposicao_id": frame["id"], "resumo_executivo": frame["prompt"].str.len().astype(str)}
            )

        return summarise

    out = pl.enrichment_run(
        layer, landed, new_path(spark, "work"), dt.datetime(2024, 2, 1), summarise=load, reprocess=True
    )
    return out.select("proposicao_id", "tema_classificado", "resumo_executivo")


@query("""
WITH p AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS n FROM documents WHERE trim(text) <> ''),
     b AS (SELECT (n - 1) // 100 AS lote FROM p WHERE doc_id >= (SELECT max(doc_id) // 2 FROM documents) ORDER BY n LIMIT 1)
SELECT doc_id AS proposicao_id, CASE WHEN (n - 1) // 100 < (SELECT lote FROM b) THEN 'primeira' ELSE 'segunda' END AS resumo_executivo
FROM p""")
def enrichment_resume(spark, sf):
    """An enrichment run whose model breaks down half-way: the lots before are kept, and not scored again by the next run."""
    layer, work = Layer(spark, new_path(spark, "silver")), new_path(spark, "work")
    documents = table(spark, sf, "documents")
    landed = documents.select(
        F.col("doc_id").alias("id"), F.col("text").alias("ementa"), F.lit(None).cast("string").alias("ementaDetalhada")
    )
    half = documents.agg(F.max("doc_id")).first()[0] // 2

    def model(answer, until=None):
        def load():
            import pandas as pd

            def summarise(frame):
                if until is not None and (frame["id"] >= until).any():
                    raise RuntimeError("out of memory")
                return pd.DataFrame({"proposicao_id": frame["id"], "resumo_executivo": answer})

            return summarise

        return load

    when = dt.datetime(2024, 2, 1)
    try:
        pl.enrichment_run(layer, landed, work, when, summarise=model("primeira", half), lot=100)
    except PythonException as e:
        if "out of memory" not in str(e):
            raise
    out = pl.enrichment_run(layer, landed, work, when, summarise=model("segunda"), lot=100)
    return out.select("proposicao_id", "resumo_executivo")


_LABEL = (
    "coalesce(json_extract_string(props, '$.sigla') || ' ' || json_extract_string(props, '$.k') || '/' || year(ts), "
    "event_type || ' ' || json_extract_string(props, '$.k') || '/' || year(ts))"
)


@query(f"""
SELECT event_id AS id, CASE WHEN event_id % 3 = 0 THEN event_type WHEN event_id % 2 = 0 THEN {_LABEL} END
         AS "proposicaoObjeto",
       CASE WHEN event_id % 3 = 0 THEN event_type END AS "proposicaoObjeto_original" FROM events""")
def backfill_vote_subject(spark, sf):
    """Votes without a subject, filled from the detail records that exist."""
    events = table(spark, sf, "events")

    def item(kind):
        number = F.get_json_object("props", "$.k")
        return F.struct(kind.alias("siglaTipo"), number.alias("numero"), F.year("ts").alias("ano"))

    votes = events.select(
        F.col("event_id").alias("id"), F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("proposicaoObjeto")
    )
    first = F.filter(F.array(item(F.get_json_object("props", "$.sigla"))), lambda x: x["siglaTipo"].isNotNull())
    details = events.where("event_id % 2 = 0").select(
        F.col("event_id").alias("id"),
        first.alias("proposicoesAfetadas"),
        F.array(item(F.col("event_type"))).alias("objetosPossiveis"),
    )
    return pl.backfill_vote_subject(votes, details)


@query("""
SELECT vec_id AS proposicao_id, 'tema_' || l AS tema_classificado, round(s, 4) AS score_similaridade FROM (
  SELECT e.vec_id, t.vec_id AS l, list_dot_product(e.embedding::DOUBLE[], t.embedding::DOUBLE[]) AS s
  FROM embeddings e, (SELECT * FROM embeddings WHERE vec_id < 10) t)
JOIN documents ON doc_id = vec_id WHERE trim(text) <> ''
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, l) = 1""")
def enrichment_vectors(spark, sf):
    """An enrichment run that computes vectors and themes; bills are landed twice, and those without a vector stay pending."""
    landed = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("ementa"), F.lit(None).cast("string").alias("ementaDetalhada")
    )
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("proposicao_id"), "embedding")
    themes = table(spark, sf, "embeddings").where("vec_id < 10").withColumn("nome", F.concat(F.lit("tema_"), "vec_id"))
    out = pl.enrichment_run(
        Layer(spark, new_path(spark, "silver")),
        landed.union(landed),
        new_path(spark, "work"),
        dt.datetime(2024, 2, 1),
        encode=lambda df, _: df.join(vectors, "proposicao_id", "left"),
        labels=collect_labels(themes, "nome", "embedding", "vec_id"),
    )
    return out.select("proposicao_id", "tema_classificado", "score_similaridade")
