"""The parliamentary configuration: landed tables, six silver tables, eight gold tables.

Names of columns and tables are those of the public records and of the data model.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.casts import amount, digits_id, uri_id
from sedimenta.functions.dates import key_date, percent
from sedimenta.functions.text import filled as filled_text
from sedimenta.functions.text import first_item_label, prompt, query_text, three_way, two_way
from sedimenta.operators.conform import conform, load_report
from sedimenta.operators.dedupe import keep_first
from sedimenta.operators.enrich import enrich_batches, merge_partials, pending, score_in_lots, unfinished
from sedimenta.operators.joins import lookup_join
from sedimenta.operators.merge import audit_copy, backfill, upsert
from sedimenta.operators.quality import null_violations, pk_violations, require
from sedimenta.operators.report import Window, html_card, top_of_window
from sedimenta.operators.similarity import classify_top1
from sedimenta.operators.star import build_dim, build_fact, by_date, dim_date, filled, stamp_load
from sedimenta.session import stage, together
from sedimenta.sources.landing import column, explode_children, flatten, jsonify_complex, stamp_capture
from sedimenta.sources.tables import Layer, read_table
from sedimenta.spec import VOCABULARY, DimRef, DimSpec, FactSpec, TableSpec

_log = logging.getLogger(__name__)

# The ten themes and their descriptions, in the order that breaks ties.
THEMES = {
    "Saúde": "saúde pública, sistema único de saúde, medicamentos, hospitais, vigilância sanitária, planos de saúde",
    "Tributário": "impostos, tributos, arrecadação fiscal, receita federal, ICMS, reforma tributária, isenção fiscal",
    "Trabalho": "emprego, trabalhadores, CLT, sindicatos, salário mínimo, reforma trabalhista, previdência social",
    "Tecnologia": "tecnologia da informação, inteligência artificial, regulação digital, startups, telecomunicações, internet",
    "Meio Ambiente": "meio ambiente, sustentabilidade, desmatamento, carbono, clima, recursos naturais, saneamento básico",
    "Educação": "educação, ensino, escolas, universidades, bolsas de estudo, MEC, alfabetização",
    "Segurança Pública": "segurança pública, polícia, crime, violência, presídios, legislação penal, drogas",
    "Infraestrutura": "infraestrutura, obras públicas, rodovias, ferrovias, portos, aeroportos, energia elétrica",
    "Economia": "economia, mercado financeiro, crédito, bancos, investimentos, câmbio, política econômica",
    "Direitos Sociais": "direitos humanos, assistência social, igualdade, minorias, habitação, programas sociais",
}

# The parts of a request for a summary, and the labels of a vote's result.
PROMPT = {
    "short_title": "Ementa: ",
    "long_title": "Texto completo: ",
    "instruction": "Resuma em até 3 frases para um executivo:",
}
RESULTS = {"true": "Aprovado", "false": "Rejeitado", "unknown": "NÃO INFORMADO"}

# --- landed tables -------------------------------------------------------------------

# The types of the public records' fields that are not free text, and of codes that must
# stay text though they may arrive as numbers. A field that is not listed keeps the type it arrives with.
TYPES = {
    "deputados": {
        "id": "long",
        "cpf": "string",
        "dataNascimento": "timestamp",
        "dataFalecimento": "timestamp",
        "ultimoStatus.id": "long",
        "ultimoStatus.idLegislatura": "long",
        "ultimoStatus.data": "timestamp",
        "ultimoStatus.gabinete.sala": "string",
        "ultimoStatus.gabinete.andar": "long",
        "ultimoStatus.gabinete.telefone": "string",
    },
    "despesas": {
        "ano": "long",
        "mes": "long",
        "codDocumento": "string",
        "codTipoDocumento": "long",
        "dataDocumento": "timestamp",
        "numDocumento": "string",
        "valorDocumento": "double",
        "cnpjCpfFornecedor": "string",
        "valorLiquido": "double",
        "valorGlosa": "double",
        "numRessarcimento": "string",
        "codLote": "long",
        "parcela": "long",
        "idDeputado": "long",
    },
    "eventos": {
        "id": "long",
        "dataHoraInicio": "timestamp",
        "dataHoraFim": "timestamp",
        "localCamara.sala": "string",
        "localCamara.andar": "long",
    },
    "eventos_orgaos": {"id": "long", "codTipoOrgao": "long", "idEventoContexto": "long"},
    "frentes": {"id": "long", "idLegislatura": "long"},
    "legislaturas": {"id": "long", "dataInicio": "timestamp", "dataFim": "timestamp"},
    "liderancas": {
        "dataInicio": "timestamp",
        "dataFim": "timestamp",
        "idLegislaturaContexto": "long",
        "parlamentar.id": "long",
        "parlamentar.idLegislatura": "long",
    },
    "orgaos": {"id": "long", "codTipoOrgao": "long"},
    "partidos": {
        "id": "long",
        "numeroEleitoral": "long",
        "status.data": "timestamp",
        "status.idLegislatura": "long",
        "status.totalPosse": "long",
        "status.totalMembros": "long",
        "status.lider.idLegislatura": "long",
    },
    "proposicoes_autores": {
        "codTipo": "long",
        "ordemAssinatura": "long",
        "proponente": "bool",
        "idProposicaoContexto": "long",
    },
    "proposicoes": {
        "id": "long",
        "codTipo": "long",
        "numero": "long",
        "ano": "long",
        "dataApresentacao": "timestamp",
        "statusProposicao.dataHora": "timestamp",
        "statusProposicao.sequencia": "long",
        "statusProposicao.codTipoTramitacao": "long",
        "statusProposicao.codSituacao": "long",
    },
    "votacoes": {"id": "string", "data": "timestamp", "dataHoraRegistro": "timestamp", "aprovacao": "bool"},
    "votos": {
        "dataRegistroVoto": "timestamp",
        "idVotacaoContexto": "string",
        "deputado_.id": "long",
        "deputado_.idLegislatura": "long",
    },
}
CAPTURED = {"data_captura": "timestamp"}
# Ids of votes are composite (`1228863-64`) and stay text until their hyphens are gone.
_VOTE_ID = ("id", "idVotacaoContexto")


def _landed(name: str, key: str | None) -> TableSpec:
    return TableSpec(
        f"stg_{name}_bruto",
        kinds=TYPES[name] | CAPTURED,
        key=(key,) if key else None,
        valid_id="id" if key == "id" else None,
        strip_hyphen=_VOTE_ID if name in ("votacoes", "votos") else (),
        strip_kinds=("long",),
    )


# Name of a table -> column that identifies a row (None: the whole row does).
_KEYS = {
    "deputados": "id",
    "despesas": "codDocumento",
    "eventos": "id",
    "eventos_orgaos": "idEventoContexto",
    "frentes": "id",
    "legislaturas": "id",
    "liderancas": None,
    "orgaos": "id",
    "partidos": "id",
    "proposicoes_autores": None,
    "proposicoes": "id",
    "votacoes": "id",
    "votos": None,
}
STAGING = {n: _landed(n, k) for n, k in _KEYS.items()}


def land(records: DataFrame, at: dt.datetime) -> DataFrame:
    """Nested records -> flat landed table."""
    return stamp_capture(jsonify_complex(flatten(records)), at)


def land_event_bodies(events: DataFrame, at: dt.datetime) -> DataFrame:
    """The bodies listed in the events, one row each."""
    return land(explode_children(events, "orgaos", "id", "idEventoContexto"), at)


def backfill_vote_subject(votes: DataFrame, details: DataFrame) -> DataFrame:
    """Fill the missing subject of a vote from its detail record."""
    found = details.select(
        "id",
        first_item_label(F.col("proposicoesAfetadas"), F.col("objetosPossiveis")).alias("proposicaoObjeto"),
    )
    return backfill(audit_copy(votes, "proposicaoObjeto"), found, "id", "proposicaoObjeto")


# --- silver --------------------------------------------------------------------------


def _text(name: str) -> Column:
    return filled(column(name), "text")


def _code(name: str) -> Column:
    return filled(column(name), "code")


def _day(name: str) -> Column:
    return filled(column(name).cast("date"), "date")


def silver_deputado(b: Mapping[str, DataFrame]) -> DataFrame:
    """Deputies with their legislature and party; without either, a deputy is left out."""
    terms = b["legislaturas"].select(
        F.col("id").alias("__leg"),
        _day("dataInicio").alias("dataInicioLegislatura"),
        _day("dataFim").alias("dataFimLegislatura"),
    )
    parties = b["partidos"].select(
        F.trim("sigla").alias("__sigla"), uri_id(column("status.lider.uri")).alias("__lider")
    )
    people = (
        b["deputados"]
        .withColumn("__leg", column("ultimoStatus.idLegislatura"))
        .withColumn("__sigla", F.trim(column("ultimoStatus.siglaPartido")))
    )
    joined = lookup_join(lookup_join(people, terms, ["__leg"]), parties, ["__sigla"])
    return joined.select(
        F.col("id").alias("idDeputado"),
        _text("ultimoStatus.nome").alias("nome"),
        _code("sexo").alias("sexo"),
        _day("dataNascimento").alias("dataNascimento"),
        _code("ultimoStatus.siglaUf").alias("siglaUF"),
        _text("escolaridade").alias("escolaridade"),
        _code("ultimoStatus.siglaPartido").alias("siglaPartido"),
        two_way(F.col("__lider") == F.col("id")).alias("LiderPartido"),
        _text("ultimoStatus.situacao").alias("situacao"),
        _text("ultimoStatus.condicaoEleitoral").alias("condicaoEleitoral"),
        F.col("__leg").alias("legislatura"),
        "dataInicioLegislatura",
        "dataFimLegislatura",
    )


def silver_orgao(b: Mapping[str, DataFrame]) -> DataFrame:
    return b["orgaos"].select(
        F.col("id").alias("idOrgao"),
        _code("sigla").alias("siglaorgao"),
        _text("nome").alias("nome"),
        _text("apelido").alias("apelido"),
        _text("tipoOrgao").alias("tipoOrgao"),
    )


def silver_evento(b: Mapping[str, DataFrame]) -> DataFrame:
    """Events that have a body. The bodies hold one row per event, so nothing fans out."""
    bodies = b["eventos_orgaos"].select(F.col("idEventoContexto").alias("id"))
    return lookup_join(b["eventos"], bodies, ["id"]).select(
        F.col("id").alias("idEvento"),
        _text("descricaoTipo").alias("descricaoTipo"),
        _text("situacao").alias("situacao"),
        _day("dataHoraInicio").alias("dataHoraInicio"),
        _day("dataHoraFim").alias("dataHoraFim"),
    )


def silver_proposicao(b: Mapping[str, DataFrame]) -> DataFrame:
    """One row per bill and author."""
    bills = b["proposicoes"].select(
        F.col("id").alias("idProposicao"),
        filled(uri_id(column("statusProposicao.uriOrgao")), "unknown_id").alias("idOrgao"),
        _code("siglaTipo").alias("siglaTipoProposicao"),
        _text("descricaoTipo").alias("descricaoTipoProposicao"),
        filled(F.col("ano"), "year").alias("ano"),
        _text("ementa").alias("ementa"),
        _text("statusProposicao.descricaoSituacao").alias("statusProposicao"),
        _day("dataApresentacao").alias("dataApresentacao"),
    )
    # distinct on the two ids, so the texts of the bills are not part of the comparison
    authors = (
        b["proposicoes_autores"]
        .select(
            F.col("idProposicaoContexto").alias("idProposicao"),
            filled(uri_id(F.col("uri")), "unknown_id").alias("idDeputado"),
        )
        .distinct()
    )
    return lookup_join(authors, bills, ["idProposicao"]).select(
        "idProposicao",
        "idDeputado",
        "idOrgao",
        "siglaTipoProposicao",
        "descricaoTipoProposicao",
        "ano",
        "ementa",
        "statusProposicao",
        "dataApresentacao",
    )


def silver_despesa(b: Mapping[str, DataFrame]) -> DataFrame:
    return b["despesas"].select(
        filled(F.col("idDeputado"), "unknown_id").alias("idDeputado"),
        _text("codDocumento").alias("codDespesa"),
        _text("tipoDespesa").alias("tipoDespesa"),
        _day("dataDocumento").alias("dataDespesa"),
        amount(F.col("valorDocumento")).alias("valorBruto"),
        amount(F.col("valorLiquido")).alias("valorLiquido"),
        amount(F.col("valorGlosa")).alias("valorGlosa"),
        filled(F.col("parcela"), "amount").alias("parcela"),
    )


def silver_votacao(b: Mapping[str, DataFrame]) -> DataFrame:
    """One row per ballot, with what the vote was about. Damaged vote ids never meet."""
    votes = b["votacoes"].select(
        F.col("id").cast("bigint").alias("idVotacao"),
        filled(uri_id(F.col("uriOrgao")), "unknown_id").alias("idOrgao"),
        filled(uri_id(F.col("uriEvento")), "unknown_id").alias("idEvento"),
        filled(uri_id(F.col("uriProposicaoObjeto")), "not_applicable_id").alias("idProposicao"),
        _text("descricao").alias("descricaoVotacao"),
        three_way(F.col("aprovacao"), **RESULTS).alias("resultadoVotacao"),
    )
    ballots = (
        b["votos"]
        .select(
            digits_id(F.col("idVotacaoContexto")).alias("idVotacao"),
            filled(column("deputado_.id"), "unknown_id").alias("idDeputado"),
            _text("tipoVoto").alias("tipoVoto"),
            _day("dataRegistroVoto").alias("dataVoto"),
        )
        .where(F.col("idVotacao").isNotNull())
        .distinct()
    )
    return lookup_join(ballots, votes, ["idVotacao"]).select(
        "idVotacao",
        "idOrgao",
        "idEvento",
        "idDeputado",
        "idProposicao",
        "tipoVoto",
        "dataVoto",
        "descricaoVotacao",
        "resultadoVotacao",
    )


# Silver table -> its job and the conformed tables it reads.
SILVER = {
    "deputado": (silver_deputado, ("deputados", "legislaturas", "partidos")),
    "orgao": (silver_orgao, ("orgaos",)),
    "evento": (silver_evento, ("eventos", "eventos_orgaos")),
    "proposicao": (silver_proposicao, ("proposicoes", "proposicoes_autores")),
    "despesa": (silver_despesa, ("despesas",)),
    "votacao": (silver_votacao, ("votos", "votacoes")),
}

# --- gold ----------------------------------------------------------------------------

DIM_DEPUTADO = DimSpec(
    "dim_deputado",
    key="sk_deputado",
    natural="id_deputado",
    columns={
        "id_deputado": "idDeputado",
        "nm_deputado": "nome",
        "sg_sexo": "sexo",
        "dt_nascimento": "dataNascimento",
        "sg_uf": "siglaUF",
        "ds_escolaridade": "escolaridade",
        "sg_partido": "siglaPartido",
        "ds_lider_partido": "LiderPartido",
        "ds_situacao": "situacao",
        "ds_condicao_eleitoral": "condicaoEleitoral",
        "cd_legislatura": "legislatura",
        "dt_inicio_legislatura": "dataInicioLegislatura",
        "dt_fim_legislatura": "dataFimLegislatura",
    },
    codes=frozenset({"sg_sexo", "sg_uf", "sg_partido"}),
)
DIM_ORGAO = DimSpec(
    "dim_orgao",
    key="sk_orgao",
    natural="id_orgao",
    columns={
        "id_orgao": "idOrgao",
        "sg_orgao": "siglaorgao",
        "nm_orgao": "nome",
        "ds_apelido_orgao": "apelido",
        "ds_tipo_orgao": "tipoOrgao",
    },
    codes=frozenset({"sg_orgao"}),
)
DIM_EVENTO = DimSpec(
    "dim_evento",
    key="sk_evento",
    natural="id_evento",
    columns={"id_evento": "idEvento", "ds_tipo_evento": "descricaoTipo", "ds_situacao": "situacao"},
)
# Labels of bills without a theme and without a summary.
UNCLASSIFIED = "NÃO CLASSIFICADO"
NO_SUMMARY = "SEM RESUMO EXECUTIVO GERADO"
DIM_PROPOSICAO = DimSpec(
    "dim_proposicao",
    key="sk_proposicao",
    natural="id_proposicao",
    columns={
        "id_proposicao": "idProposicao",
        "sg_tipo_proposicao": "siglaTipoProposicao",
        "ds_tipo_proposicao": "descricaoTipoProposicao",
        "ds_situacao": "statusProposicao",
        "ds_tema_classificado": "tema",
        "nr_score_similaridade": "score",
        "ds_resumo_executivo": "resumo",
    },
    members={
        "ds_tema_classificado": (UNCLASSIFIED, UNCLASSIFIED),
        "nr_score_similaridade": (0.0, 0.0),
        "ds_resumo_executivo": ("NÃO INFORMADO", "NÃO INFORMADO"),
    },
)
DIM_VOTACAO = DimSpec(
    "dim_votacao",
    key="sk_votacao",
    natural="id_votacao",
    columns={"id_votacao": "idVotacao", "ds_votacao": "descricaoVotacao", "ds_resultado": "resultadoVotacao"},
)

_DEPUTADO = DimRef("dim_deputado", "idDeputado", "id_deputado", "sk_deputado")
_ORGAO = DimRef("dim_orgao", "idOrgao", "id_orgao", "sk_orgao")
_PROPOSICAO = DimRef("dim_proposicao", "idProposicao", "id_proposicao", "sk_proposicao")

FT_PROPOSICAO = FactSpec(
    "ft_proposicao",
    dims=(_DEPUTADO, _ORGAO, _PROPOSICAO),
    dates={"sk_data_proposicao": "dataApresentacao"},
    constants={"qtd_proposicao": 1},
)
FT_DESPESA = FactSpec(
    "ft_despesa",
    dims=(_DEPUTADO,),
    dates={"sk_data_despesa": "dataDespesa"},
    columns={
        "sk_cod_despesa": "codDespesa",
        "tp_despesa": "tipoDespesa",
        "vl_bruto": "valorBruto",
        "vl_liquido": "valorLiquido",
        "vl_glosa": "valorGlosa",
        "nr_parcela": "parcela",
    },
)
FT_VOTO = FactSpec(
    "ft_voto",
    dims=(
        DimRef("dim_votacao", "idVotacao", "id_votacao", "sk_votacao"),
        _DEPUTADO,
        _ORGAO,
        DimRef("dim_evento", "idEvento", "id_evento", "sk_evento", optional=True),
        _PROPOSICAO,
    ),
    dates={"sk_data_voto": "dataVoto"},
    columns={"tp_voto": "tipoVoto"},
    constants={"qtd_voto": 1},
    layout=(
        "sk_votacao",
        "sk_deputado",
        "sk_orgao",
        "sk_evento",
        "sk_data_voto",
        "sk_proposicao",
        "tp_voto",
        "qtd_voto",
    ),
)


# Dimension or fact -> silver table it is built from.
DIMS = {
    "dim_deputado": (DIM_DEPUTADO, "deputado"),
    "dim_orgao": (DIM_ORGAO, "orgao"),
    "dim_evento": (DIM_EVENTO, "evento"),
    "dim_proposicao": (DIM_PROPOSICAO, "proposicao"),
    "dim_votacao": (DIM_VOTACAO, "votacao"),
}
FACTS = {
    "ft_proposicao": (FT_PROPOSICAO, "proposicao"),
    "ft_despesa": (FT_DESPESA, "despesa"),
    "ft_voto": (FT_VOTO, "votacao"),
}


def enriched_bills(bills: DataFrame, ia: DataFrame | None) -> DataFrame:
    """Bills with theme, score and summary; a bill without enrichment gets the defaults."""
    ids = bills.select(
        "idProposicao", "siglaTipoProposicao", "descricaoTipoProposicao", "statusProposicao"
    ).distinct()
    if ia is None:
        tema, score, resumo = F.lit(None).cast("string"), F.lit(None), F.lit(None).cast("string")
        joined = ids
    else:
        results = ia.select(
            F.col("proposicao_id").cast("bigint").alias("idProposicao"),
            "tema_classificado",
            "score_similaridade",
            "resumo_executivo",
        )
        joined = lookup_join(ids, results, ["idProposicao"], "left")
        tema, score, resumo = (
            F.col(c) for c in ("tema_classificado", "score_similaridade", "resumo_executivo")
        )
    return joined.select(
        *ids.columns,
        filled_text(tema, UNCLASSIFIED).alias("tema"),
        F.coalesce(score.cast("double"), F.lit(0.0)).alias("score"),
        filled_text(resumo, NO_SUMMARY).alias("resumo"),
    )


def gold_dim(name: str, silver: Mapping[str, DataFrame]) -> DataFrame:
    spec, source = DIMS[name]
    rows = silver[source]
    if name == "dim_proposicao":
        rows = enriched_bills(rows, silver.get("proposicoes_ia"))
    return build_dim(rows, spec)


def gold_fact(name: str, silver: Mapping[str, DataFrame], dims: Mapping[str, DataFrame]) -> DataFrame:
    spec, source = FACTS[name]
    return build_fact(silver[source], spec, dims)


# --- the jobs in order ---------------------------------------------------------------


# Primary keys, for the uniqueness check after a load.
KEYS = {
    "ft_proposicao": ("sk_deputado", "sk_orgao", "sk_proposicao", "sk_data_proposicao"),
    "ft_voto": (
        "sk_votacao",
        "sk_deputado",
        "sk_orgao",
        "sk_evento",
        "sk_data_voto",
        "sk_proposicao",
        "tp_voto",
    ),
    "ft_despesa": ("sk_deputado", "sk_data_despesa", "sk_cod_despesa", "tp_despesa"),
}


REPORT = "relatorio_carga"


def check_gold(tables: Mapping[str, DataFrame]) -> None:
    """Stop a load that has a fact row twice, or a null in the key of a fact."""
    wrong = []
    for name, key in KEYS.items():
        if name in tables:
            wrong += [f"{name}: a key occurs more than once"] * bool(pk_violations(tables[name], key).head(1))
            wrong += [f"{name}.{r.coluna} is null" for r in null_violations(tables[name], key).where("nulos > 0").collect()]
    if wrong:
        raise ValueError("; ".join(wrong))


DIM_DATE = "dim_data"


def dates_of(silver: Mapping[str, DataFrame]) -> DataFrame:
    """The date dimension: every day from the first to the last date of a fact; the mark of an unknown date is none."""
    ends = []
    for spec, source in FACTS.values():
        for c in spec.dates.values():
            day = F.nullif(F.col(c).cast("date"), F.lit(VOCABULARY.date))
            span = silver[source].agg(F.min(day).alias("a"), F.max(day).alias("b"))
            ends += [span.select(F.col("a").alias("dia")), span.select(F.col("b").alias("dia"))]
    return dim_date(reduce(DataFrame.unionByName, ends), "dia")


def full_refresh(
    spark: SparkSession, staging: Mapping[str, DataFrame], root: str, at: dt.datetime
) -> dict[str, Layer]:
    """Conform, build and publish all layers. Every layer is written before the next reads it.

    Staging tables that are missing count as empty only where no job needs them. The bronze layer gets
    a load report, and a gold layer that fails `check_gold` is not published. The
    enrichment tables (`*_ia`) of the silver layer survive the refresh.
    """
    layers = {n: Layer(spark, f"{root.rstrip('/')}/{n}") for n in ("bronze", "silver", "gold")}
    empty = {name for _, inputs in SILVER.values() for name in require(staging, inputs)}
    if empty:
        _log.warning("empty inputs: %s", ", ".join(sorted(empty)))
    report = load_report(staging, STAGING)  # what the casts, the id filter and the dedupe take out
    report = report.withColumn("empty_input", F.col("table_name").isin(*empty) if empty else F.lit(False))
    layers["bronze"].refresh({**{n: conform(df, STAGING[n]) for n, df in staging.items()}, REPORT: report})
    bronze = {n: layers["bronze"].read(n) for n in staging}
    day = F.lit(at.date())
    layers["silver"].refresh(
        {n: job(bronze).withColumn("dataIngestao", day) for n, (job, _) in SILVER.items()}
    )
    silver = {n: layers["silver"].read(n) for n in layers["silver"].names()}
    dims = together({n: partial(gold_dim, n, silver) for n in DIMS})
    facts = {n: by_date(stamp_load(gold_fact(n, silver, dims), at), FACTS[n][0]) for n in FACTS}
    dated = {n: stamp_load(d, at, validity=True) for n, d in dims.items()}
    layers["gold"].refresh({**dated, **facts, DIM_DATE: dates_of(silver)}, check=check_gold)
    return layers


# --- enrichment of the bills ---------------------------------------------------------

IA_SCHEMA = T.StructType(
    [
        T.StructField("proposicao_id", T.LongType()),
        T.StructField("tema_classificado", T.StringType()),
        T.StructField("score_similaridade", T.DoubleType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("resumo_executivo", T.StringType()),
        T.StructField("processado_em", T.TimestampNTZType()),
    ]
)


def score_bills(
    bills: DataFrame,
    encode: Callable[[DataFrame, str], DataFrame] | None = None,
    labels: Sequence[tuple[str, Sequence[float]]] = (),
    summarise: Callable[[], Callable] | None = None,
    chunk: int = 32,
) -> DataFrame:
    """Theme and vector, summary, or both: only what was computed is in the result.

    `bills` has id, ementa and ementaDetalhada as they were landed. `encode` adds a vector
    column `embedding` for a text column; `summarise` loads a function over frames with id
    and prompt that returns proposicao_id, resumo_executivo.
    """
    ids = bills.select(F.col("id").cast("bigint").alias("proposicao_id"))
    parts = []
    if encode is not None:
        texts = bills.select(
            F.col("id").cast("bigint").alias("proposicao_id"), query_text(F.col("ementa")).alias("texto")
        )
        scored = classify_top1(encode(texts, "texto"), labels)
        parts.append(
            scored.select("proposicao_id", "tema_classificado", "score_similaridade", "embedding")
        )
    if summarise is not None:
        prompts = bills.select(
            F.col("id").cast("bigint").alias("id"),
            prompt(F.col("ementa"), F.col("ementaDetalhada"), **PROMPT).alias("prompt"),
        )
        parts.append(
            enrich_batches(prompts, summarise, "proposicao_id long, resumo_executivo string", chunk)
        )
    if len(parts) == 1:
        return parts[0]
    return merge_partials(ids, [stage(p, "part") for p in parts], "proposicao_id")


# What a run may compute: columns that one scorer fills together, the first of which tells whether it has.
THEME_COLUMNS = ("tema_classificado", "score_similaridade", "embedding")
SUMMARY_COLUMNS = ("resumo_executivo",)
LOT = 10_000
_RESULTS = T.StructType([f for f in IA_SCHEMA if f.name != "processado_em"])


def enrichment_run(
    silver: Layer,
    landed: DataFrame,
    work: str,
    at: dt.datetime,
    encode: Callable[[DataFrame, str], DataFrame] | None = None,
    labels: Sequence[tuple[str, Sequence[float]]] = (),
    summarise: Callable[[], Callable] | None = None,
    limit: int | None = None,
    reprocess: bool = False,
    lot: int = LOT,
) -> DataFrame:
    """Score the bills that have no result yet and merge the results into `proposicoes_ia`.

    Themes with vectors, and summaries, are two scorers with pending items of their own: an item that one of them failed on
    is asked for that one again. Results are appended to the folder `work` lot by lot, `lot` items at a time in
    the order of their ids, each lot by its own commit. A run that was interrupted is taken up by item: what is in
    `work` already is not scored again, only merged. Take a new folder for the next run. Columns that this run does
    not compute keep their values.
    """
    spark = landed.sparkSession
    done = silver.read("proposicoes_ia") if "proposicoes_ia" in silver.names() else None
    items = landed.select(F.col("id").cast("bigint").alias("id"), "ementa", "ementaDetalhada")
    items = keep_first(items, ["id"])  # an item may be landed more than once
    scorers = []
    if encode is not None:
        scorers.append((THEME_COLUMNS, lambda bills: score_bills(bills, encode, labels)))
    if summarise is not None:
        scorers.append((SUMMARY_COLUMNS, lambda bills: score_bills(bills, summarise=summarise)))
    for columns, score in scorers:
        mark = columns[0]
        has = done is not None and mark in done.columns
        known = done.where(F.col(mark).isNotNull()).select(F.col("proposicao_id").alias("id")) if has else None
        todo = pending(items, known, "id", "ementa", reprocess, limit, ordered=False)
        stored = read_table(spark, work, _RESULTS, optional=True).where(F.col(mark).isNotNull())
        todo = unfinished(todo, stored.select(F.col("proposicao_id").alias("id")), "id")

        def scored(bills: DataFrame, columns=columns, score=score) -> DataFrame:
            fresh = score(bills).select("proposicao_id", *[F.col(c).cast(_RESULTS[c].dataType) for c in columns])
            return fresh.where(F.col(columns[0]).isNotNull())  # a failed item stays pending

        score_in_lots(todo, "id", lot, scored, work)
    return merge_results(silver, work, at)


def merge_results(silver: Layer, work: str, at: dt.datetime) -> DataFrame:
    """Merge what is in the folder `work` into `proposicoes_ia`, without scoring anything.

    Each scorer's results go in by themselves, so an item that one of them failed on keeps what it had there.
    """
    spark = silver.spark
    stored = read_table(spark, work, _RESULTS, optional=True)
    merged = silver.read("proposicoes_ia") if "proposicoes_ia" in silver.names() else spark.createDataFrame([], IA_SCHEMA)
    for columns in (THEME_COLUMNS, SUMMARY_COLUMNS):
        columns = [c for c in columns if c in merged.columns]
        found = stored.where(F.col(columns[0]).isNotNull()) if columns else stored.limit(0)
        if found.head(1):
            results = keep_first(found.select("proposicao_id", *columns), ["proposicao_id"])
            results = results.withColumn("processado_em", F.lit(at).cast("timestamp_ntz"))
            merged = upsert(merged, results, ["proposicao_id"])
    silver.replace("proposicoes_ia", merged)
    return silver.read("proposicoes_ia")


# --- the weekly report ---------------------------------------------------------------

# The kinds of bills in the weekly report.
KINDS_OF_BILL = ("PL", "PEC", "PLP")


def _bill_order() -> list[Column]:
    return [
        F.desc("nr_score_similaridade"),
        F.desc("sk_data_proposicao"),
        F.asc("id_proposicao"),
        F.asc("sk_deputado"),
    ]


def weekly_bills(gold: Mapping[str, DataFrame], window: Window, k: int = 5) -> DataFrame:
    """The k bills of the window with the clearest theme."""
    bills = gold["dim_proposicao"].where(
        F.col("sg_tipo_proposicao").isin(*KINDS_OF_BILL) & (F.col("ds_tema_classificado") != UNCLASSIFIED)
    )
    people = gold["dim_deputado"].select("sk_deputado", "nm_deputado", "sg_partido", "sg_uf")
    top = top_of_window(
        gold["ft_proposicao"],
        {"sk_proposicao": bills, "sk_deputado": people},
        "sk_data_proposicao",
        window,
        _bill_order(),
        k,
    )
    return top.select(
        "id_proposicao",
        "sg_tipo_proposicao",
        "ds_tipo_proposicao",
        "ds_situacao",
        "ds_tema_classificado",
        percent(F.col("nr_score_similaridade")).alias("score_pct"),
        "ds_resumo_executivo",
        key_date(F.col("sk_data_proposicao")).alias("dt_apresentacao"),
        "nm_deputado",
        "sg_partido",
        "sg_uf",
        "qtd_proposicao",
        "nr_score_similaridade",
        "sk_data_proposicao",
        "sk_deputado",
    )


def bill_card(rank: str) -> Column:
    """One entry of the weekly digest."""
    author = F.concat("nm_deputado", F.lit(" ("), "sg_partido", F.lit("/"), "sg_uf", F.lit(")"))
    return html_card(
        [column(rank), F.lit(". "), F.col("sg_tipo_proposicao"), F.lit(" "), F.col("id_proposicao")],
        [
            ("Tema:", F.col("ds_tema_classificado")),
            ("Confiança:", F.concat(F.col("score_pct").cast("string"), F.lit("%"))),
            ("Autor:", author),
            ("Situação:", F.col("ds_situacao")),
            ("Apresentada em:", F.date_format("dt_apresentacao", "dd/MM/yyyy")),
            ("Resumo:", F.col("ds_resumo_executivo")),
        ],
    )
