"""The whole parliamentary job over a small hand-made set of records."""

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sedimenta.operators.conform import conform
from sedimenta.operators.quality import null_violations, pk_violations
from sedimenta.operators.report import Window
from sedimenta.plans import parliament as pl
from sedimenta.sources.landing import read_landed
from sedimenta.sources.tables import Layer, export_csv, import_csv
from sedimenta.spec import TableSpec
from tests.conftest import values

AT = dt.datetime(2024, 2, 1, 6, 0, 0)
NONE = dt.date(9999, 12, 31)

RECORDS = {
    "legislaturas": (
        "id int, dataInicio string, dataFim string",
        [(57, "2023-02-01", "2027-01-31"), (56, "2019-02-01", None)],
    ),
    "partidos": (
        "id int, sigla string, status struct<lider: struct<uri: string>>",
        [(1, "PT ", (("https://x/deputados/101",),)), (2, "PL", ((None,),))],
    ),
    "deputados": (
        "id int, sexo string, dataNascimento string, escolaridade string, ultimoStatus struct<nome: string, "
        "siglaPartido: string, siglaUf: string, idLegislatura: int, situacao: string, condicaoEleitoral: string>",
        [
            (101, "F", "1970-05-01", "", ("JosÃ© da ConceiÃ§Ã£o", "PT", "SP", 57, "Exercício", "Titular")),
            (102, None, None, "Superior", ("Bia", " PL", None, 56, None, None)),
            (103, "M", "1980-01-01", "Médio", ("Caio", "XX", "RJ", 57, "Exercício", "Titular")),
            (0, "M", None, None, ("Zero", "PT", "RJ", 57, None, None)),
        ],
    ),
    "orgaos": (
        "id int, sigla string, nome string, apelido string, tipoOrgao string",
        [(180, "PLEN", "Plenário", "Plenário", "Plenário"), (2003, "CCJC", "Comissão", "", None)],
    ),
    "eventos": (
        "id int, descricaoTipo string, situacao string, dataHoraInicio string, dataHoraFim string, "
        "orgaos array<struct<id: int, sigla: string>>",
        [
            (1, "Sessão", "Encerrada", "2024-01-10T09:00", None, [(180, "PLEN"), (2003, "CCJC")]),
            (2, "Reunião", None, "2024-01-11T10:00", "2024-01-11T12:00", [(2003, "CCJC")]),
            (3, "Sem órgão", None, None, None, []),
        ],
    ),
    "proposicoes": (
        "id int, siglaTipo string, descricaoTipo string, ano int, ementa string, dataApresentacao string, "
        "statusProposicao struct<uriOrgao: string, descricaoSituacao: string>",
        [
            (900, "PL", "Projeto de Lei", 2024, "Saúde", "2024-01-12T10:00", ("https://x/orgaos/180", "Em análise")),
            (901, "PEC", "Emenda", 2024, None, "2024-01-13T10:00", (None, None)),
            (902, "REQ", "Requerimento", None, "x", None, ("https://x/orgaos/2003", "Arquivada")),
        ],
    ),
    "proposicoes_autores": (
        "uri string, nome string, idProposicaoContexto int",
        [
            ("https://x/deputados/101", "José", 900),
            ("https://x/deputados/102", "Bia", 900),
            ("https://x/orgaos/comissao", "Comissão", 901),
            ("https://x/deputados/101", "José", 902),
            ("https://x/deputados/101", "José", 902),
        ],
    ),
    "votacoes": (
        "id string, uriOrgao string, uriEvento string, uriProposicaoObjeto string, descricao string, aprovacao int, "
        "proposicaoObjeto string",
        [
            ("1228863-64", "https://x/orgaos/180", "https://x/eventos/1", "https://x/proposicoes/900", "ok", 1, None),
            ("1228863-65", "https://x/orgaos/2003", "https://x/eventos/77", None, None, None, "PL 1/2020"),
        ],
    ),
    "votos": (
        "tipoVoto string, dataRegistroVoto string, idVotacaoContexto string, deputado_ struct<id: int>",
        [
            ("Sim", "2024-01-15T20:00:00", "1228863-64", (101,)),
            ("Não", None, "1228863-64", (102,)),
            ("Sim", "2024-01-15T20:00:00", "12288x3-64", (101,)),
            (None, "2024-01-16T20:00:00", "1228863-65", (None,)),
        ],
    ),
    "despesas": (
        "idDeputado int, codDocumento string, tipoDespesa string, dataDocumento string, valorDocumento double, "
        "valorLiquido double, valorGlosa double, parcela int",
        [
            (101, "D1", "Combustível", "2024-01-03", 10.55, 10.0, 0.55, 0),
            (101, "D1", "Combustível", "2024-01-03", 10.55, 10.0, 0.55, 0),
            (102, "D2", None, None, None, None, None, None),
            (555, "D3", "Correio", "2024-01-04", 1.0, 1.0, 0.0, 1),
        ],
    ),
}


@pytest.fixture(scope="module")
def staging(spark):
    raw = {n: spark.createDataFrame(rows, ddl) for n, (ddl, rows) in RECORDS.items()}
    tables = {n: pl.land(df, AT) for n, df in raw.items()}
    tables["eventos_orgaos"] = pl.land_event_bodies(raw["eventos"], AT)
    return tables


@pytest.fixture(scope="module")
def layers(spark, staging, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("layers"))
    first = pl.full_refresh(spark, staging, root, AT)
    ia = spark.createDataFrame(
        [(900, " saúde ", 0.9125, None)],
        "proposicao_id int, tema_classificado string, score_similaridade double, resumo_executivo string",
    )
    first["silver"].replace("proposicoes_ia", ia)
    return pl.full_refresh(spark, staging, root, AT)


def test_declared_types_and_undeclared_columns(spark):
    despesas = pl.STAGING["despesas"]
    assert [despesas.kind(c) for c in ("parcela", "valorGlosa", "dataDocumento", "codDocumento", "data_captura")] == [
        "long",
        "double",
        "timestamp",
        "string",
        "timestamp",
    ]
    assert pl.STAGING["votacoes"].kind("id") == "string" and pl.STAGING["votos"].kind("deputado_.id") == "long"
    landed = spark.createDataFrame(
        [("1", 7, "dez mil reais", "AB-12", 5)],
        "codDocumento string, numDocumento int, valorPorExtenso string, idExterno string, total bigint",
    )
    row = conform(landed, despesas).first()
    assert tuple(row) == ("1", "7", "DEZ MIL REAIS", "AB-12", 5)


def test_conform_is_idempotent(staging):
    once = conform(staging["deputados"], pl.STAGING["deputados"])
    assert values(once, "id") == [(101,), (102,), (103,)]
    assert once.where("id = 101").first()["ultimoStatus.nome"] == "JOSÉ DA CONCEIÇÃO"
    assert once.where("id = 101").first()["escolaridade"] is None
    assert values(conform(once, pl.STAGING["deputados"])) == values(once)


def test_silver(layers):
    silver = layers["silver"]
    people = silver.read("deputado")
    assert values(people, "idDeputado", "nome", "sexo", "dataNascimento", "siglaUF", "escolaridade", "LiderPartido") == [
        (101, "JOSÉ DA CONCEIÇÃO", "F", dt.date(1970, 5, 1), "SP", "NÃO INFORMADO", "Sim"),
        (102, "BIA", "N/I", NONE, "N/I", "SUPERIOR", "Não"),
    ]
    assert values(people, "legislatura", "dataFimLegislatura") == [(56, NONE), (57, dt.date(2027, 1, 31))]
    assert values(silver.read("orgao"), "idOrgao", "apelido", "tipoOrgao") == [
        (180, "PLENÁRIO", "PLENÁRIO"),
        (2003, "NÃO INFORMADO", "NÃO INFORMADO"),
    ]
    assert values(silver.read("evento"), "idEvento", "situacao", "dataHoraInicio", "dataHoraFim") == [
        (1, "ENCERRADA", dt.date(2024, 1, 10), NONE),
        (2, "NÃO INFORMADO", dt.date(2024, 1, 11), dt.date(2024, 1, 11)),
    ]
    assert values(silver.read("proposicao"), "idProposicao", "idDeputado", "idOrgao", "ano", "ementa") == [
        (900, 101, 180, 2024, "SAÚDE"),
        (900, 102, 180, 2024, "SAÚDE"),
        (901, -1, -1, 2024, "NÃO INFORMADO"),
        (902, 101, 2003, 9999, "X"),
    ]
    assert values(silver.read("votacao").drop("dataIngestao", "descricaoVotacao")) == [
        (122886364, 180, 1, 101, 900, "SIM", dt.date(2024, 1, 15), "Aprovado"),
        (122886364, 180, 1, 102, 900, "NÃO", NONE, "Aprovado"),
        (122886365, 2003, 77, -1, -3, "NÃO INFORMADO", dt.date(2024, 1, 16), "NÃO INFORMADO"),
    ]
    assert values(silver.read("despesa"), "codDespesa", "valorBruto", "parcela") == [
        ("D1", Decimal("10.55"), 0),
        ("D2", Decimal("0.00"), 0),
        ("D3", Decimal("1.00"), 1),
    ]


def test_enrichment_survives_and_is_optional(layers):
    assert "proposicoes_ia" in layers["silver"].names()
    dim = layers["gold"].read("dim_proposicao")
    assert values(dim, "id_proposicao", "ds_tema_classificado", "nr_score_similaridade", "ds_resumo_executivo") == sorted(
        [
            (-1, "NÃO CLASSIFICADO", 0.0, "NÃO INFORMADO"),
            (-3, "NÃO CLASSIFICADO", 0.0, "NÃO INFORMADO"),
            (900, "SAÚDE", 0.9125, "SEM RESUMO EXECUTIVO GERADO"),
            (901, "NÃO CLASSIFICADO", 0.0, "SEM RESUMO EXECUTIVO GERADO"),
            (902, "NÃO CLASSIFICADO", 0.0, "SEM RESUMO EXECUTIVO GERADO"),
        ],
        key=repr,
    )


def test_gold_facts(layers):
    gold = layers["gold"]
    key = {
        d: {r[0]: r[1] for r in gold.read(d).select(spec.natural, spec.key).collect()}
        for d, (spec, _) in pl.DIMS.items()
    }
    person, body, bill = key["dim_deputado"], key["dim_orgao"], key["dim_proposicao"]
    assert values(gold.read("ft_proposicao").drop("dh_ingestao")) == sorted(
        [
            (person[101], body[180], bill[900], 20240112, 1),
            (person[102], body[180], bill[900], 20240112, 1),
            (-1, -1, bill[901], 20240113, 1),
            (person[101], body[2003], bill[902], 99991231, 1),
        ],
        key=repr,
    )
    vote, event = key["dim_votacao"], key["dim_evento"]
    assert values(gold.read("ft_voto").drop("dh_ingestao")) == sorted(
        [
            (vote[122886364], person[101], body[180], event[1], 20240115, bill[900], "SIM", 1),
            (vote[122886364], person[102], body[180], event[1], 99991231, bill[900], "NÃO", 1),
            (vote[122886365], -1, body[2003], -1, 20240116, -3, "NÃO INFORMADO", 1),
        ],
        key=repr,
    )
    assert values(gold.read("ft_despesa"), "sk_deputado", "sk_cod_despesa", "vl_bruto") == [
        (person[101], "D1", Decimal("10.55")),
        (person[102], "D2", Decimal("0.00")),
    ]
    for name, columns in pl.KEYS.items():
        assert pk_violations(gold.read(name), columns).count() == 0
    for name in gold.names():
        assert null_violations(gold.read(name)).where("nulos > 0").count() == 0, name
    assert values(gold.read("dim_orgao"), "dt_fim_vigencia") == [(NONE,)] * 4


def test_dates_of_the_facts_are_in_the_gold_layer(layers):
    gold = layers["gold"]
    days = {r.sk_data for r in gold.read("dim_data").select("sk_data").collect()}
    assert days and max(days) < 99991231
    for fact, column in (("ft_proposicao", "sk_data_proposicao"), ("ft_despesa", "sk_data_despesa"), ("ft_voto", "sk_data_voto")):
        found = {r[0] for r in gold.read(fact).select(column).collect()}
        assert found - {99991231} <= days


def test_empty_inputs_stand_in_the_load_report(layers):
    report = layers["bronze"].read(pl.REPORT).select("table_name", "read", "empty_input").collect()
    assert all(r.empty_input == (r.read == 0) for r in report if r.empty_input) and len(report) > 3


def test_weekly_report(layers):
    gold = {n: layers["gold"].read(n) for n in layers["gold"].names()}
    top = pl.weekly_bills(gold, Window(dt.date(2024, 2, 3))).collect()
    assert [(r["id_proposicao"], r["nm_deputado"], r["score_pct"]) for r in top] == [
        (900, "JOSÉ DA CONCEIÇÃO", Decimal("91.3")),
        (900, "BIA", Decimal("91.3")),
    ]
    assert pl.weekly_bills(gold, Window(dt.date(2024, 3, 3))).count() == 0


def test_missing_input_is_an_error(spark, staging, folder):
    with pytest.raises(LookupError, match="votos"):
        pl.full_refresh(spark, {n: t for n, t in staging.items() if n != "votos"}, folder, AT)


def test_backfill_of_the_vote_subject(spark, staging):
    item = "array<struct<siglaTipo: string, numero: int, ano: int>>"
    details = spark.createDataFrame(
        [("1228863-64", [("PEC", 32, 2015)], None), ("1228863-65", [("PL", 9, 2021)], [])],
        f"id string, proposicoesAfetadas {item}, objetosPossiveis {item}",
    )
    out = pl.backfill_vote_subject(staging["votacoes"], details)
    assert values(out, "id", "proposicaoObjeto", "proposicaoObjeto_original") == [
        ("1228863-64", "PEC 32/2015", None),
        ("1228863-65", "PL 1/2020", "PL 1/2020"),
    ]
    assert values(pl.backfill_vote_subject(out, details)) == values(out)


def test_landing_from_json_files(spark, folder):
    body = {"dados": [{"id": 1, "ultimoStatus": {"nome": "Ana", "gabinete": {"andar": "3"}}, "redeSocial": ["a"]}]}
    os.makedirs(folder + "/land")
    with open(folder + "/land/1.json", "w") as f:
        json.dump(body, f, indent=1)
    records = spark.createDataFrame(
        [], "id int, ultimoStatus struct<nome: string, gabinete: struct<andar: string>>, redeSocial array<string>"
    )
    landed = pl.land(read_landed(spark, folder + "/land", records.schema), AT)
    assert landed.columns == ["id", "ultimoStatus.nome", "ultimoStatus.gabinete.andar", "redeSocial", "data_captura"]
    out = conform(landed, pl.STAGING["deputados"]).first()
    assert (out["ultimoStatus.gabinete.andar"], out["redeSocial"]) == (3, '["A"]')
    assert out["data_captura"] == AT


def test_exported_and_read_again_conforms_alike(spark, staging, folder):
    """A landed table that went through a CSV export conforms to the same rows."""
    for name in ("legislaturas", "partidos"):
        path = export_csv(staging[name], folder, f"stg_{name}_bruto", AT)
        again = conform(import_csv(spark, path), pl.STAGING[name])
        assert values(again) == values(conform(staging[name], pl.STAGING[name]))


def _encoder(frame, text):
    """A vector per text: how often each of three letters occurs, scaled to length one."""
    counts = F.array(*[F.regexp_count(F.lower(text), F.lit(c)).cast("float") for c in "abc"])
    size = F.sqrt(F.aggregate(counts, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    return frame.withColumn("embedding", F.transform(counts, lambda x: (x / size).cast("float")))


def _summaries(fail=()):
    def load():
        import pandas as pd

        def run(frame):
            if set(frame["id"]) & set(fail):
                raise RuntimeError("interrupted")
            return pd.DataFrame(
                {"proposicao_id": frame["id"], "resumo_executivo": frame["prompt"].str.len().astype(str)}
            )

        return run

    return load


def test_enrichment_runs(spark, folder):
    landed = spark.createDataFrame(
        [("1", "aaab", None), ("2", "bbb", "longo"), ("3", " ", None), ("4", "cca", None)],
        "id string, ementa string, ementaDetalhada string",
    )
    silver = Layer(spark, folder + "/silver")
    labels = [("A", [1.0, 0.0, 0.0]), ("B", [0.0, 1.0, 0.0]), ("C", [0.0, 0.0, 1.0])]
    show = ("proposicao_id", "tema_classificado", "resumo_executivo")
    out = pl.enrichment_run(silver, landed, folder + "/w1", AT, encode=_encoder, labels=labels, limit=2)
    assert values(out, *show) == [(1, "A", None), (2, "B", None)]
    out = pl.enrichment_run(silver, landed, folder + "/w2", AT, encode=_encoder, labels=labels)
    assert values(out, *show) == [(1, "A", None), (2, "B", None), (4, "C", None)]
    # only texts, for all items: the themes stay
    out = pl.enrichment_run(silver, landed, folder + "/w3", AT, summarise=_summaries(), reprocess=True)
    got = {r[0]: r for r in values(out, *show)}
    assert [got[i][1] for i in (1, 2, 4)] == ["A", "B", "C"]
    assert all(int(got[i][2]) > 20 for i in (1, 2, 4)) and int(got[2][2]) > int(got[1][2])
    # nothing is pending: nothing changes
    again = pl.enrichment_run(silver, landed, folder + "/w4", AT, encode=_encoder, labels=labels)
    assert values(again, *show) == values(out, *show)


def test_enrichment_resumes_by_item(spark, folder):
    landed = spark.createDataFrame([(i, f"a{i}", None) for i in range(1, 9)], "id int, ementa string, ementaDetalhada string")
    silver, work = Layer(spark, folder + "/silver"), folder + "/work"
    with pytest.raises(Exception, match="interrupted"):
        pl.enrichment_run(silver, landed, work, AT, summarise=_summaries(fail=[5]))
    assert "proposicoes_ia" not in silver.names()
    # what an earlier part of the run wrote is not scored again, but merged
    done = spark.createDataFrame([(1, "old"), (5, "old")], "proposicao_id long, resumo_executivo string")
    done.write.mode("append").parquet(work)
    out = pl.enrichment_run(silver, landed, work, AT, summarise=_summaries(fail=[5]))
    got = dict(values(out, "proposicao_id", "resumo_executivo"))
    assert sorted(got) == list(range(1, 9)) and (got[1], got[5]) == ("old", "old") and got[2] != "old"


def test_finished_lots_are_kept_and_not_scored_again(spark, folder):
    landed = spark.createDataFrame([(i, f"a{i}", None) for i in range(1, 41)], "id int, ementa string, ementaDetalhada string")
    silver, work = Layer(spark, folder + "/silver"), folder + "/work"
    scored = spark.sparkContext.accumulator(0)

    def counting(fail=()):
        def load():
            import pandas as pd

            def run(frame):
                if set(frame["id"]) & set(fail):
                    raise RuntimeError("interrupted")
                scored.add(len(frame))
                return pd.DataFrame({"proposicao_id": frame["id"], "resumo_executivo": "s"})

            return run

        return load

    with pytest.raises(Exception, match="interrupted"):
        pl.enrichment_run(silver, landed, work, AT, summarise=counting([35]), lot=10)
    assert sorted(r[0] for r in spark.read.parquet(work).select("proposicao_id").collect()) == list(range(1, 31))
    before = scored.value
    # an upload alone publishes what is there and scores nothing
    assert pl.merge_results(silver, work, AT).count() == 30 and scored.value == before
    out = pl.enrichment_run(silver, landed, work, AT, summarise=counting(), lot=10)
    assert out.count() == 40 and scored.value == before + 10


def test_a_failed_part_is_asked_again_by_itself(spark, folder):
    """A bill with a theme and without a summary is pending for the summary only, and keeps its theme."""
    landed = spark.createDataFrame([(1, "aab", None), (2, "bb", None)], "id int, ementa string, ementaDetalhada string")
    silver, labels = Layer(spark, folder + "/silver"), [("A", [1.0, 0.0, 0.0]), ("B", [0.0, 1.0, 0.0])]

    def some(which, text):
        def load():
            import pandas as pd

            def run(frame):
                made = [text if i in which else None for i in frame["id"]]
                return pd.DataFrame({"proposicao_id": frame["id"], "resumo_executivo": pd.Series(made, dtype=object)})

            return run

        return load

    show = ("proposicao_id", "tema_classificado", "resumo_executivo")
    out = pl.enrichment_run(silver, landed, folder + "/w1", AT, encode=_encoder, labels=labels, summarise=some([1], "first"))
    assert values(out, *show) == [(1, "A", "first"), (2, "B", None)]
    out = pl.enrichment_run(silver, landed, folder + "/w2", AT, encode=_encoder, labels=labels, summarise=some([1, 2], "second"))
    assert values(out, *show) == [(1, "A", "first"), (2, "B", "second")]
    # all over again, with a model that fails on 1: what it had stays
    again = some([2], "third")
    out = pl.enrichment_run(silver, landed, folder + "/w3", AT, encode=_encoder, labels=labels, summarise=again, reprocess=True)
    assert values(out, *show) == [(1, "A", "first"), (2, "B", "third")]


def test_both_results_of_one_run(spark):
    bills = spark.createDataFrame([(1, "aab", None), (2, "bb", None)], "id int, ementa string, ementaDetalhada string")
    labels = [("A", [1.0, 0.0, 0.0]), ("B", [0.0, 1.0, 0.0])]
    out = pl.score_bills(bills, _encoder, labels, _summaries())
    assert out.columns == ["proposicao_id", "tema_classificado", "score_similaridade", "embedding", "resumo_executivo"]
    assert values(out, "proposicao_id", "tema_classificado", "score_similaridade") == [(1, "A", 0.8944), (2, "B", 1.0)]


def test_ties_go_by_the_text_as_landed_and_keys_by_the_repaired_one(spark):
    spec = TableSpec("t", {"n": "long"}, key=("k",), order=("n",))
    rows = [("é", "1", "b"), ("É", "1", "A"), ("É", "2", "0"), ("x", None, ""), ("x", None, None)]
    got = conform(spark.createDataFrame(rows, "k string, n string, v string"), spec)
    assert sorted(tuple(r) for r in got.collect()) == [("X", None, None), ("É", 1, "A")]
    whole = TableSpec("t", {}, key=None)
    both = conform(spark.createDataFrame([("a",), ("A",)], "v string"), whole)
    assert [tuple(r) for r in both.collect()] == [("A",)]  # whole rows are compared after the repair
