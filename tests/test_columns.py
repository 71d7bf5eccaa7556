"""Columns of the declared tables, written out here and not taken from the declarations."""

from __future__ import annotations

import pytest

from hemicycle.plans.categories import CATEGORIES

# Columns of each table in their order of reading, without lineage.
COLUMNS = {
    "iniciativas": """legislatura_ingest IniId data_entrada data_ultimo_evento IniLeg IniNr IniSel IniTipo IniDescTipo IniTitulo
        IniEpigrafe IniObs IniTextoSubst IniTextoSubstCampo IniLinkTexto DataInicioleg DataFimleg outros_nome outros_sigla
        outros_iniAutorComissao IniciativasOrigem_json IniciativasOriginadas_json IniciativasEuropeias_json
        PropostasAlteracao_json Links_json""",
    "iniciativa_autores_deputados": "IniId idCadastro nome GP",
    "iniciativa_autores_gp": "IniId GP",
    "iniciativa_eventos": """IniId EvtId OevId OevTextId ActId CodigoFase Fase DataFase ObsFase TextosAprovados AnexosFase_json
        Comissao_json PublicacaoFase_json Votacao_json Intervencoesdebates_json IniciativasConjuntas_json PeticoesConjuntas_json
        ActividadesConjuntas_json PcpublicasConjuntas_json RecursoDeputados_json RecursoGP_json Links_json""",
    "iniciativa_anexos": "IniId anexoNome anexoFich",
    "iniciativa_peticoes": "IniId peticao_id numero legislatura sessao tipo descTipo assunto dcl",
    "intervencoes": """legislatura_ingest Id IdDebate ActividadeId Legislatura Sessao FaseSessao FaseDebate DataReuniaoPlenaria
        TipoDebate TipoIntervencao Debate Sumario Sumario2 Resumo Qualidade dep_idCadastro dep_nome dep_GP conv_nome conv_cargo
        conv_pais conv_honra gov_nome gov_cargo gov_governo actRel_id actRel_tipo actRel_autoresDeputados_json
        actRel_autoresGP_json av_tipoIntervencao av_assunto av_duracao av_url av_all_json pub_dt pub_leg pub_tipo pub_tp pub_nr
        pub_SL pub_pag pub_URLDiario pub_all_json iniciativas_json intervencoesRelacionadas_json""",
    "perguntas_e_requerimentos": """Id Nr Tipo ReqTipo Sessao Legislatura Assunto DataEnvio DtEntrada Ficheiro Fundamentacao_json
        Observacoes_json Publicacao_json RespostasSPerguntas_json""",
    "pergunta_autores": "Id idCadastro nome GP",
    "pergunta_destinatarios": """Id destinatario_idx nomeEntidade dataEnvio dataReenvio reenviado prorrogado dataProrrogacao
        prazoProrrogacao devolvido retirado""",
    "pergunta_respostas": """Id destinatario_idx resposta_idx entidade dataResposta ficheiro ficheiroComTipo_json publicacao_json
        docRemetida_json""",
    "peticoes": """PetId PetNr PetLeg PetSel PetActividadeId PetAssunto PetAutor PetDataEntrada PetNrAssinaturas
        PetNrAssinaturasInicial PetSituacao PetUrlTexto PetObs DataDebate Intervencoes_json PedidosEsclarecimento_json
        PublicacaoDebate_json PublicacaoPeticao_json""",
    "peticao_documentos": "PetId doc_idx TipoDocumento TituloDocumento DataDocumento Descricao URL",
    "peticao_links": "PetId doc_idx TipoDocumento TituloDocumento DataDocumento Descricao URL",
    "peticao_iniciativas_conjuntas": "PetId IniId",
    "peticao_iniciativas_originadas": "PetId IniId",
    "peticao_associadas": "PetId OutraPetId",
    "peticao_dados_comissao": """PetId comissao_idx IdComissao Nome Numero Sessao Legislatura Codigo Situacao Transitada
        DataAdmissibilidade DataBaixaComissao DataEnvioPAR DataReaberta DataArquivo Admissibilidade_json NotasAdmissibilidade_json
        Audiencias_json AudienciasOutros_json DadosPedidosInformacao_json DadosRelatorioFinal_json RelatorioFinal_json
        Publicacao_json DocumentosPeticao_json""",
    "peticao_relatores": "PetId comissao_idx relator_idx id nome gp dataNomeacao dataCessacao motivoCessacao",
    "peticao_audicoes": "PetId comissao_idx audicao_idx id data tipo titulo entidades_json",
    "diplomas_aprovados": """Id Tipo Tp Numero Numero2 AnoCivil Sessao Legislatura Titulo LinkTexto Versao Observacoes_json
        Actividades_json Anexos_json""",
    "diploma_iniciativas": "Id IniId IniNr IniTipo IniLinkTexto",
    "diploma_publicacao": """Id publicacao_idx pubLeg pubSL pubNr pubTp pubTipo pubdt idPag URLDiario pag_first pag_all_json supl obs
        pagFinalDiarioSupl""",
    "diploma_orcam_contas_gerencia": """Id ocg_idx ocg_id leg SL ano tipo tp titulo dtAgendamento dtAprovacaoCA votacao_json
        anexos_json textosAprovados_json obs""",
    "agenda_parlamentar": """Id LegDes Section SectionId Theme ThemeId Title Subtitle Local Link OrderValue ParlamentGroup OrgDes
        ReuNumero SelNumero AllDayEvent PostPlenary EventStartDate EventStartTime EventEndDate EventEndTime data_inicio data_fim
        InternetText AnexosPlenario_json AnexosComissaoPermanente_json""",
    "deputados": """legislatura_ingest DepId DepCadId DepNomeCompleto DepNomeParlamentar DepCargo DepCPId DepCPDes LegDes DepGP_json
        DepSituacao_json atividade_json""",
    "informacao_base_deputados": """DepId DepCadId DepNomeCompleto DepNomeParlamentar DepCargo DepCPId DepCPDes LegDes DepGP_json
        DepSituacao_json Videos_json""",
    "informacao_base_grupos": "nome sigla",
    "informacao_base_circulos": "cpId cpDes legDes",
    "informacao_base_sessoes": "numSessao dataInicio dataFim",
    "informacao_base_detalhe": "id sigla siglaAntiga dtini dtfim",
    "orcamento_do_estado": """ID ID_Pai Tipo Numero Titulo Texto Estado Artigos_json DiplomasaModificar_json IniciativasMapas_json
        PropostasDeAlteracao_json RequerimentosDeAvocacao_json""",
    "grupo_amizade_composicao": "Id composicao_idx Nome Gp Cargo DataInicio DataFim IdDeputado",
}
ENTITY = """Id Nome Legislatura Sessao Local DataInicio DataFim DataCriacao DataEleicao Tipo Promotor data_inicio data_fim Reunioes_json
    Visitas_json Composicao_json Comissoes_json Atividades_json Programas_json Data"""
PARTICIPANT = "Id participante_idx participante_id Nome Gp Tipo Leg"
for _entity, _people in {
    "delegacoes_eventuais": "delegacao_eventual_participantes",
    "delegacoes_permanentes": "delegacao_permanente_participantes",
    "grupos_parlamentares_de_amizade": "grupo_amizade_participantes",
    "reunioes_e_visitas": "reuniao_visita_participantes",
    "cooperacao_parlamentar": "cooperacao_parlamentar_participantes",
}.items():
    COLUMNS |= {_entity: ENTITY, _people: PARTICIPANT}

TABLES = {t.name: t for c in CATEGORIES.values() for t in c.tables}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(name):
    table = TABLES[name]
    declared = [*(k.name for k in table.keys), *table.ordinals, *(f.name for f in table.columns)]
    assert sorted(declared) == sorted(COLUMNS[name].split())


def test_every_declared_table_is_written_out():
    # the counters have one column for each activity
    assert set(TABLES) - set(COLUMNS) == {"deputado_atividade_contadores"}
    counters = [f.name for f in TABLES["deputado_atividade_contadores"].columns]
    assert counters[:2] == ["DepCadId", "DepNomeParlamentar"] and all(c.startswith("n_") for c in counters[2:])
