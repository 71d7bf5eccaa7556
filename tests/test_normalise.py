"""Normalisers on hand-made documents with the irregular shapes the sources have."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hemicycle.functions.variants import parse
from hemicycle.plans.categories import CATEGORIES
from hemicycle.plans.normalise import normalise


@pytest.fixture
def table(spark):
    def rows(category, name, *docs):
        data = [("17", f"17/{category}.json", json.dumps(d)) for d in docs]
        df = spark.createDataFrame(data, "_legislatura string, _source_file string, t string")
        df = df.withColumn("v", parse(F.col("t"))).drop("t")
        return [r.asDict() for r in normalise(CATEGORIES[category], df, [name])[name].collect()]

    return rows


def test_initiative_event_dates(table):
    events = [{"DataFase": "2024-05-01"}, {"DataFase": ""}, {"DataFase": "2023-01-09"}, None, 5, {"Fase": "x"}]
    (row,) = table("iniciativas", "iniciativas", {"IniId": 1, "IniEventos": events, "IniAutorOutros": {"nome": "Gov"}})
    assert row["IniId"] == "1"
    assert row["data_entrada"] == datetime(2023, 1, 9)
    assert row["data_ultimo_evento"] == datetime(2024, 5, 1)
    assert row["outros_nome"] == "Gov"
    assert row["legislatura_ingest"] == "17"
    assert row["Links_json"] is None


@pytest.mark.parametrize("shape", [None, [], {}, {"nome": "x"}, "texto", 3, [None, 4]])
def test_lists_of_another_shape_give_no_rows(table, shape):
    assert table("iniciativas", "iniciativa_autores_deputados", {"IniId": "a", "IniAutorDeputados": shape}, {"IniId": "b"}) == []


def test_numbering_keeps_the_gaps(table):
    doc = {"Id": "q", "Destinatarios": [None, {"nomeEntidade": "A"}, "x", {"respostas": [3, {"entidade": "E"}]}]}
    assert [r["destinatario_idx"] for r in table("perguntas_e_requerimentos", "pergunta_destinatarios", doc)] == [1, 3]
    (answer,) = table("perguntas_e_requerimentos", "pergunta_respostas", doc)
    assert (answer["destinatario_idx"], answer["resposta_idx"], answer["entidade"]) == (3, 1, "E")


def test_lists_of_plain_values(table):
    got = table("peticoes", "peticao_iniciativas_conjuntas", {"PetId": 9, "IniciativasConjuntas": ["a", None, 12]})
    assert [(r["PetId"], r["IniId"]) for r in got] == [("9", "a"), ("9", "12")]


def test_first_elements(table):
    doc = {
        "Id": "i",
        "Deputados": {"idCadastro": 5},
        "Publicacao": [{"pubdt": "2024-01-02", "pag": ["7", "8"]}, {"pubdt": "2025-01-01"}],
        "DadosAudiovisual": {"url": "not in a list"},
    }
    full, bare = table("intervencoes", "intervencoes", doc, {"Id": "j"})
    assert (full["dep_idCadastro"], full["pub_pag"], full["pub_dt"]) == ("5", "7", datetime(2024, 1, 2))
    assert full["av_url"] is None and bare["av_all_json"] == "[]" and bare["pub_all_json"] == "[]"


def test_json_columns_keep_empty_containers(table):
    (row,) = table("orcamento_do_estado", "orcamento_do_estado", {"Item": [{"ID": 1, "Artigos": [], "IniciativasMapas": None}]})
    assert (row["Artigos_json"], row["IniciativasMapas_json"]) == ("[]", None)


def test_one_field_of_another_shape_leaves_the_rest(table):
    doc = {"Id": 4, "Title": {"nested": [1]}, "AllDayEvent": ["x"], "Theme": True, "ThemeId": 2.5, "Local": "Sala"}
    (row,) = table("agenda_parlamentar", "agenda_parlamentar", doc)
    assert (row["Id"], row["Title"], row["AllDayEvent"], row["Theme"], row["ThemeId"], row["Local"]) == (
        "4", '{"nested":[1]}', None, "true", "2.5", "Sala",
    )


def test_activity_counters(table):
    block = {"Ini": [1, 2], "Req": {}, "Intev": None, "Gpa": "x"}
    rows = table(
        "atividade_dos_deputados",
        "deputado_atividade_contadores",
        {"Deputado": {"DepCadId": 1}, "AtividadeDeputadoList": [block]},
        {"Deputado": {"DepCadId": 2}, "AtividadeDeputadoList": []},
    )
    assert [(r["n_Ini"], r["n_Req"], r["n_Intev"], r["n_Gpa"], r["n_Rel"]) for r in rows] == [(2, 1, 0, 0, 0), (0, 0, 0, 0, 0)]


def test_one_term_row_per_file(table):
    rows = table("informacao_base", "informacao_base_detalhe", {"DetalheLegislatura": {"id": 1, "dtini": "01/02/2024"}}, {})
    assert [(r["id"], r["dtini"]) for r in rows] == [("1", datetime(2024, 2, 1)), (None, None)]


def test_activities_copy_every_key(table):
    doc = {"Debates": [{"DebateId": 1, "Assunto": "a", "Data": "", "DataDebate": "05/02/2024", "Extra": 3, "Tipo": ["t"]}]}
    (row,) = table("atividades", "atividades_debates", doc)
    assert row["Extra_json"] == "3" and row["Tipo_json"] == '["t"]' and row["DebateId"] == "1"
    assert row["_data"] == datetime(2024, 2, 5)


def test_organ_ids_and_presidents(table):
    doc = {
        "Comissoes": [{"DetalheOrgao": {"Id": 4, "sigla": "C"}, "HistoricoComposicao": [{"depNome": "A"}, 7]}],
        "MesaAR": {"DetalheOrgao": {"oId": 0, "cargoId": 8}, "HistoricoComposicao": [{"depNome": "B", "DataInicio": "01/02/2024"}]},
        "ConferenciaPresidentesComissoes": {"DetalheOrgao": {"id": "x"}, "HistoricoComposicaoCPC": [{"depNome": "P"}]},
        "Plenario": [{"DetalheOrgao": {"id": "a list where one object is expected"}}],
    }
    members = {(r["tipo_orgao"], r["orgao_id"], r["depNome"]) for r in table("composicao_de_orgaos", "orgaos_historico_composicao", doc)}
    assert members == {("Comissao", "4", "A"), ("MesaAR", "8", "B"), ("ConferenciaPresidentesComissoes.CPC", "x", "P")}
    kinds = [r["tipo_orgao"] for r in table("composicao_de_orgaos", "orgaos_detalhe", doc)]
    assert sorted(kinds) == ["Comissao", "ConferenciaPresidentesComissoes", "MesaAR"]


def test_keys_that_differ_in_case_share_a_column(table):
    doc = {"MesaAR": {"DetalheOrgao": {"id": 1}, "HistoricoComposicao": [{"depCadId": 5}, {"DepCadId": 6}]}}
    rows = table("composicao_de_orgaos", "orgaos_historico_composicao", doc)
    assert sorted(r["DepCadId"] for r in rows) == ["5", "6"]


def test_participants_keep_both_ids(table):
    doc = {"Id": 10, "Participantes": [{"Id": 3, "Nome": "N"}], "DataCriacao": "03/02/2024"}
    (row,) = table("delegacoes_eventuais", "delegacao_eventual_participantes", doc)
    assert (row["Id"], row["participante_id"]) == ("10", "3")
    (fact,) = table("delegacoes_eventuais", "delegacoes_eventuais", doc)
    assert fact["data_inicio"] == datetime(2024, 2, 3)


def test_every_category_is_declared():
    assert len(CATEGORIES) == 16
    names = [t.name for c in CATEGORIES.values() for t in c.tables] + [n for c in CATEGORIES.values() for n in c.dynamic]
    assert len(names) == len(set(names)) == 54
