"""The sixteen categories of raw documents and the tables each yields."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.functions.dates import day_first_timestamp, day_first_with_time
from hemicycle.functions.variants import (
    elements,
    entry_count,
    field,
    first_truthy,
    is_object,
    json_text,
    members,
    node,
)
from hemicycle.plans.dynamic import discover, layout, same_name, spread
from hemicycle.plans.normalise import (
    ORIGIN,
    Category,
    Table,
    at,
    computed,
    dates,
    days_first,
    flags,
    jsons,
    texts,
    under,
)
from hemicycle.session import written

LEGISLATURE_COPY = computed("legislatura_ingest", lambda v: F.col("_legislatura"))

# The field names below are those of the published source files, in source order.


def _event_dates(v: Column) -> Column:
    """Non-empty phase dates among the events of an initiative, as text."""
    found = F.transform(elements(v, "IniEventos"), lambda e: field(e, "DataFase"))
    return F.filter(found, lambda d: d != "")


INITIATIVE_ID = at("IniId", "IniId")
INITIATIVES = Category(
    "iniciativas",
    "list",
    (
        Table(
            "iniciativas",
            (
                *LEGISLATURE_COPY,
                *texts("IniId"),
                *computed("data_entrada", lambda v: F.array_min(_event_dates(v)).try_cast("timestamp_ntz")),
                *computed("data_ultimo_evento", lambda v: F.array_max(_event_dates(v)).try_cast("timestamp_ntz")),
                *texts("IniLeg IniNr IniSel IniTipo IniDescTipo IniTitulo IniEpigrafe IniObs"),
                *texts("IniTextoSubst IniTextoSubstCampo IniLinkTexto"),
                *dates("DataInicioleg DataFimleg"),
                *under("outros", ("IniAutorOutros",), "nome sigla"),
                *at("outros_iniAutorComissao", "IniAutorOutros", "iniAutorComissao", kind="json"),
                *jsons("IniciativasOrigem IniciativasOriginadas IniciativasEuropeias PropostasAlteracao Links"),
            ),
        ),
        Table(
            "iniciativa_autores_deputados",
            texts("idCadastro nome GP"),
            lists=(("IniAutorDeputados",),),
            keys=INITIATIVE_ID,
        ),
        Table("iniciativa_autores_gp", texts("GP"), lists=(("IniAutorGruposParlamentares",),), keys=INITIATIVE_ID),
        Table(
            "iniciativa_eventos",
            (
                *texts("EvtId OevId OevTextId ActId CodigoFase Fase"),
                *dates("DataFase"),
                *texts("ObsFase TextosAprovados"),
                *jsons("AnexosFase Comissao PublicacaoFase Votacao Intervencoesdebates IniciativasConjuntas"),
                *jsons("PeticoesConjuntas ActividadesConjuntas PcpublicasConjuntas RecursoDeputados RecursoGP Links"),
            ),
            lists=(("IniEventos",),),
            keys=INITIATIVE_ID,
        ),
        Table("iniciativa_anexos", texts("anexoNome anexoFich"), lists=(("IniAnexos",),), keys=INITIATIVE_ID),
        Table(
            "iniciativa_peticoes",
            (*at("peticao_id", "id"), *texts("numero legislatura sessao tipo descTipo assunto dcl")),
            lists=(("Peticoes",),),
            keys=INITIATIVE_ID,
        ),
    ),
)


def _list_or_empty(key: str) -> Callable[[Column], Column]:
    """JSON text of a list; `[]` where there is none."""
    return lambda v: F.coalesce(json_text(v, key), F.lit("[]"))


INTERVENTIONS = Category(
    "intervencoes",
    "list",
    (
        Table(
            "intervencoes",
            (
                *LEGISLATURE_COPY,
                *texts("Id IdDebate ActividadeId Legislatura Sessao FaseSessao FaseDebate"),
                *dates("DataReuniaoPlenaria"),
                *texts("TipoDebate TipoIntervencao Debate Sumario Sumario2 Resumo Qualidade"),
                *under("dep", ("Deputados",), "idCadastro nome GP"),
                *under("conv", ("Convidados",), "nome cargo pais honra"),
                *under("gov", ("MembrosGoverno",), "nome cargo governo"),
                *under("actRel", ("ActividadesRelacionadas",), "id tipo"),
                *at("actRel_autoresDeputados_json", "ActividadesRelacionadas", "autoresDeputados", kind="json"),
                *at("actRel_autoresGP_json", "ActividadesRelacionadas", "autoresGP", kind="json"),
                *under("av", ("DadosAudiovisual", 0), "tipoIntervencao assunto duracao url"),
                *computed("av_all_json", _list_or_empty("DadosAudiovisual")),
                *at("pub_dt", "Publicacao", 0, "pubdt", kind="date"),
                *at("pub_leg", "Publicacao", 0, "pubLeg"),
                *at("pub_tipo", "Publicacao", 0, "pubTipo"),
                *at("pub_tp", "Publicacao", 0, "pubTp"),
                *at("pub_nr", "Publicacao", 0, "pubNr"),
                *at("pub_SL", "Publicacao", 0, "pubSL"),
                *at("pub_pag", "Publicacao", 0, "pag", 0),
                *at("pub_URLDiario", "Publicacao", 0, "URLDiario"),
                *computed("pub_all_json", _list_or_empty("Publicacao")),
                *at("iniciativas_json", "Iniciativas", kind="json"),
                *at("intervencoesRelacionadas_json", "IntervencoesRelacionadas", kind="json"),
            ),
        ),
    ),
)

QUESTION_ID = at("Id", "Id")
QUESTIONS = Category(
    "perguntas_e_requerimentos",
    "list",
    (
        Table(
            "perguntas_e_requerimentos",
            (
                *texts("Id Nr Tipo ReqTipo Sessao Legislatura Assunto"),
                *dates("DataEnvio DtEntrada"),
                *texts("Ficheiro"),
                *jsons("Fundamentacao Observacoes Publicacao RespostasSPerguntas"),
            ),
        ),
        Table("pergunta_autores", texts("idCadastro nome GP"), lists=(("Autores",),), keys=QUESTION_ID),
        Table(
            "pergunta_destinatarios",
            (
                *texts("nomeEntidade"),
                *dates("dataEnvio dataReenvio"),
                *texts("reenviado prorrogado"),
                *dates("dataProrrogacao"),
                *texts("prazoProrrogacao devolvido retirado"),
            ),
            lists=(("Destinatarios",),),
            ordinals=("destinatario_idx",),
            keys=QUESTION_ID,
        ),
        Table(
            "pergunta_respostas",
            (
                *texts("entidade"),
                *dates("dataResposta"),
                *texts("ficheiro"),
                *jsons("ficheiroComTipo publicacao docRemetida"),
            ),
            lists=(("Destinatarios",), ("respostas",)),
            ordinals=("destinatario_idx", "resposta_idx"),
            keys=QUESTION_ID,
        ),
    ),
)

PETITION_ID = at("PetId", "PetId")
PETITION_FILES = Table(
    "peticao_documentos",
    (*texts("TipoDocumento TituloDocumento"), *dates("DataDocumento"), *texts("Descricao URL")),
    lists=(("Documentos",),),
    ordinals=("doc_idx",),
    keys=PETITION_ID,
)


def _petition_ids(name: str, key: str, column: str) -> Table:
    return Table(name, texts(column), lists=((key,),), keys=PETITION_ID, scalars=True)


PETITIONS = Category(
    "peticoes",
    "list",
    (
        Table(
            "peticoes",
            (
                *texts("PetId PetNr PetLeg PetSel PetActividadeId PetAssunto PetAutor"),
                *dates("PetDataEntrada"),
                *texts("PetNrAssinaturas PetNrAssinaturasInicial PetSituacao PetUrlTexto PetObs DataDebate"),
                *jsons("Intervencoes PedidosEsclarecimento PublicacaoDebate PublicacaoPeticao"),
            ),
        ),
        PETITION_FILES,
        Table("peticao_links", PETITION_FILES.columns, (("Links",),), ("doc_idx",), PETITION_ID),
        _petition_ids("peticao_iniciativas_conjuntas", "IniciativasConjuntas", "IniId"),
        _petition_ids("peticao_iniciativas_originadas", "Iniciativasoriginadas", "IniId"),
        _petition_ids("peticao_associadas", "PeticoesAssociadas", "OutraPetId"),
        Table(
            "peticao_dados_comissao",
            (
                *texts("IdComissao Nome Numero Sessao Legislatura Codigo Situacao Transitada"),
                *dates("DataAdmissibilidade DataBaixaComissao DataEnvioPAR DataReaberta DataArquivo"),
                *jsons("Admissibilidade NotasAdmissibilidade Audiencias AudienciasOutros DadosPedidosInformacao"),
                *jsons("DadosRelatorioFinal RelatorioFinal Publicacao DocumentosPeticao"),
            ),
            lists=(("DadosComissao",),),
            ordinals=("comissao_idx",),
            keys=PETITION_ID,
        ),
        Table(
            "peticao_relatores",
            (*texts("id nome gp"), *dates("dataNomeacao dataCessacao"), *texts("motivoCessacao")),
            lists=(("DadosComissao",), ("Relatores",)),
            ordinals=("comissao_idx", "relator_idx"),
            keys=PETITION_ID,
        ),
        Table(
            "peticao_audicoes",
            (*texts("id"), *dates("data"), *texts("tipo titulo"), *jsons("entidades")),
            lists=(("DadosComissao",), ("Audicoes",)),
            ordinals=("comissao_idx", "audicao_idx"),
            keys=PETITION_ID,
        ),
    ),
)

ACT_ID = at("Id", "Id")
APPROVED_ACTS = Category(
    "diplomas_aprovados",
    "list",
    (
        Table(
            "diplomas_aprovados",
            (
                *texts("Id Tipo Tp Numero Numero2 AnoCivil Sessao Legislatura Titulo LinkTexto Versao"),
                *jsons("Observacoes Actividades Anexos"),
            ),
        ),
        Table("diploma_iniciativas", texts("IniId IniNr IniTipo IniLinkTexto"), lists=(("Iniciativas",),), keys=ACT_ID),
        Table(
            "diploma_publicacao",
            (
                *texts("pubLeg pubSL pubNr pubTp pubTipo"),
                *dates("pubdt"),
                *texts("idPag URLDiario"),
                *at("pag_first", "pag", 0),
                *at("pag_all_json", "pag", kind="json"),
                *texts("supl obs pagFinalDiarioSupl"),
            ),
            lists=(("Publicacao",),),
            ordinals=("publicacao_idx",),
            keys=ACT_ID,
        ),
        Table(
            "diploma_orcam_contas_gerencia",
            (
                *at("ocg_id", "id"),
                *texts("leg SL ano tipo tp titulo"),
                *dates("dtAgendamento dtAprovacaoCA"),
                *jsons("votacao anexos textosAprovados"),
                *texts("obs"),
            ),
            lists=(("OrcamContasGerencia",),),
            ordinals=("ocg_idx",),
            keys=ACT_ID,
        ),
    ),
)

AGENDA = Category(
    "agenda_parlamentar",
    "list",
    (
        Table(
            "agenda_parlamentar",
            (
                *texts("Id LegDes Section SectionId Theme ThemeId Title Subtitle Local Link OrderValue"),
                *texts("ParlamentGroup OrgDes ReuNumero SelNumero"),
                *flags("AllDayEvent PostPlenary"),
                *texts("EventStartDate EventStartTime EventEndDate EventEndTime"),
                *computed(
                    "data_inicio", lambda v: day_first_with_time(field(v, "EventStartDate"), field(v, "EventStartTime"))
                ),
                *computed("data_fim", lambda v: day_first_with_time(field(v, "EventEndDate"), field(v, "EventEndTime"))),
                *texts("InternetText"),
                *jsons("AnexosPlenario AnexosComissaoPermanente"),
            ),
        ),
    ),
)

# The activity lists kept per deputy.
DEPUTY_ACTIVITIES = (
    "ActP Audicoes Audiencias Cms DadosLegisDeputado Deslocacoes DlE DlP Eventos Gpa Ini Intev ParlamentoJovens Rel Req Scgt"
).split()


def _activity_json(v: Column) -> Column:
    """The first activity block as JSON text, null when it is empty."""
    block = node(v, "AtividadeDeputadoList", 0)
    return F.when(F.coalesce(F.size(members(block)), F.lit(1)) > 0, F.to_json(block))


def _activity_count(key: str) -> Callable[[Column], Column]:
    return lambda v: entry_count(v, "AtividadeDeputadoList", 0, key)


def _deputy(names: str):
    return tuple(f for n in names.split() for f in at(n, "Deputado", n))


DEPUTIES = Category(
    "atividade_dos_deputados",
    "list",
    (
        Table(
            "deputados",
            (
                *LEGISLATURE_COPY,
                *_deputy("DepId DepCadId DepNomeCompleto DepNomeParlamentar DepCargo DepCPId DepCPDes LegDes"),
                *at("DepGP_json", "Deputado", "DepGP", kind="json"),
                *at("DepSituacao_json", "Deputado", "DepSituacao", kind="json"),
                *computed("atividade_json", _activity_json),
            ),
        ),
        Table(
            "deputado_atividade_contadores",
            (
                *_deputy("DepCadId DepNomeParlamentar"),
                *[f for key in DEPUTY_ACTIVITIES for f in computed(f"n_{key}", _activity_count(key))],
            ),
        ),
    ),
)

BASE_INFORMATION = Category(
    "informacao_base",
    "object",
    (
        Table(
            "informacao_base_deputados",
            (
                *texts("DepId DepCadId DepNomeCompleto DepNomeParlamentar DepCargo DepCPId DepCPDes LegDes"),
                *jsons("DepGP DepSituacao Videos"),
            ),
            lists=(("Deputados",),),
        ),
        Table("informacao_base_grupos", texts("nome sigla"), lists=(("GruposParlamentares",),)),
        Table("informacao_base_circulos", texts("cpId cpDes legDes"), lists=(("CirculosEleitorais",),)),
        Table(
            "informacao_base_sessoes",
            (*texts("numSessao"), *days_first("dataInicio dataFim")),
            lists=(("SessoesLegislativas",),),
        ),
        Table(
            "informacao_base_detalhe",
            (
                *[f for n in ("id", "sigla", "siglaAntiga") for f in at(n, "DetalheLegislatura", n)],
                *[f for n in ("dtini", "dtfim") for f in at(n, "DetalheLegislatura", n, kind="day_first")],
            ),
        ),
    ),
)

BUDGET = Category(
    "orcamento_do_estado",
    "object",
    (
        Table(
            "orcamento_do_estado",
            (
                *texts("ID ID_Pai Tipo Numero Titulo Texto Estado"),
                *jsons("Artigos DiplomasaModificar IniciativasMapas PropostasDeAlteracao RequerimentosDeAvocacao"),
            ),
            lists=(("Item",),),
        ),
    ),
)

ENTITY_ID = at("Id", "Id")


def _start(v: Column) -> Column:
    return day_first_timestamp(first_truthy(v, ("DataInicio",), ("DataCriacao",), ("DataEleicao",)))


def _delegation(category: str, satellite: str, *extra: Table) -> Category:
    """Categories that share one shape: the entity and the people who took part.

    The satellite keeps the id of its parent as `Id` and the person's own id as `participante_id`.
    """
    return Category(
        category,
        "list",
        (
            Table(
                category,
                (
                    *texts("Id Nome Legislatura Sessao Local DataInicio DataFim DataCriacao DataEleicao Tipo Promotor"),
                    *computed("data_inicio", _start),
                    *computed("data_fim", lambda v: day_first_timestamp(field(v, "DataFim"))),
                    *jsons("Reunioes Visitas Composicao Comissoes Atividades Programas"),
                    *texts("Data"),
                ),
            ),
            Table(
                satellite,
                (*at("participante_id", "Id"), *texts("Nome Gp Tipo Leg")),
                lists=(("Participantes",),),
                ordinals=("participante_idx",),
                keys=ENTITY_ID,
            ),
            *extra,
        ),
    )


GROUP_MEMBERS = Table(
    "grupo_amizade_composicao",
    (*texts("Nome Gp Cargo"), *days_first("DataInicio DataFim"), *at("IdDeputado", "Id")),
    lists=(("Composicao",),),
    ordinals=("composicao_idx",),
    keys=ENTITY_ID,
)
DELEGATIONS = (
    _delegation("delegacoes_eventuais", "delegacao_eventual_participantes"),
    _delegation("delegacoes_permanentes", "delegacao_permanente_participantes"),
    _delegation("grupos_parlamentares_de_amizade", "grupo_amizade_participantes", GROUP_MEMBERS),
    _delegation("reunioes_e_visitas", "reuniao_visita_participantes"),
    _delegation("cooperacao_parlamentar", "cooperacao_parlamentar_participantes"),
)

# Activity fields that keep their own name while they are plain values.
ACTIVITY_FIELDS = set(
    (
        "Id IDAudicao IDAudiencia IDEvento IDDeslocacao DebateId Legislatura SessaoLegislativa Sessao NumeroAudicao "
        "NumeroAudiencia Assunto Concedida Data DataDebate DataEntrada DataIni DataFim LocalEvento Designacao Tipo "
        "TipoEvento Artigo Observacoes"
    ).split()
)
ACTIVITY_DATES = ("Data", "DataDebate", "DataIni", "DataEntrada")
ACTIVITY_LISTS = {
    "atividades_audicoes": ("Audicoes",),
    "atividades_audiencias": ("Audiencias",),
    "atividades_debates": ("Debates",),
    "atividades_deslocacoes": ("Deslocacoes",),
    "atividades_eventos": ("Eventos",),
    "atividades_ocg": ("OrcamentoContasGerencia",),
    "atividades_gerais": ("AtividadesGerais", "Atividades"),
    "atividades_relatorios": ("AtividadesGerais", "Relatorios"),
}


def _activity_rows(path: tuple[str, ...]) -> Callable[[DataFrame], DataFrame]:
    """Every key of every item; `_data` is the first date that is filled in."""

    def build(docs: DataFrame) -> DataFrame:
        items = docs.select(*ORIGIN, F.explode(elements(F.col("v"), *path)).alias("item"))
        items = written(items.filter(is_object(F.col("item"))))
        columns = layout(discover(items), same_name, plain_key=ACTIVITY_FIELDS.__contains__)
        wide = spread(items, ORIGIN, columns)
        first_date = first_truthy(F.col("item"), *[(k,) for k in ACTIVITY_DATES])
        return wide.select(*columns, day_first_timestamp(first_date).alias("_data"), *ORIGIN)

    return build


ACTIVITIES = Category(
    "atividades",
    "object",
    dynamic={name: _activity_rows(path) for name, path in ACTIVITY_LISTS.items()},
    dynamic_lists=tuple(ACTIVITY_LISTS.values()),
)

# Organ collections of the source file and the kind each one is filed under.
ORGAN_LISTS = {"Comissoes": "Comissao", "SubComissoes": "SubComissao", "GruposTrabalho": "GrupoTrabalho"}
SINGLE_ORGANS = (
    "ComissaoPermanente ConferenciaLideres ConferenciaPresidentesComissoes ConselhoAdministracao MesaAR Plenario"
).split()
MEMBER_DATES = ("DataInicio", "DataFim", "DataInicioGP", "DataFimGP")


def organs(docs: DataFrame) -> DataFrame:
    """All organs of the file in one frame, whether it holds them in lists or singly."""
    v = F.col("v")

    def tagged(kind: str) -> Callable[[Column], Column]:
        return lambda organ: F.struct(F.lit(kind).alias("kind"), organ.alias("organ"))

    kinds = [F.transform(elements(v, key), tagged(kind)) for key, kind in ORGAN_LISTS.items()]
    kinds += [F.array(tagged(key)(node(v, key))) for key in SINGLE_ORGANS]
    every = F.flatten(F.array_compact(F.array(*kinds)))
    found = docs.select(*ORIGIN, F.explode(every).alias("o"))
    return found.select(*ORIGIN, F.col("o.kind").alias("tipo_orgao"), F.col("o.organ").alias("organ")).filter(
        is_object(F.col("organ"))
    )


def _organ_details(docs: DataFrame) -> DataFrame:
    items = written(organs(docs).select(*ORIGIN, "tipo_orgao", node(F.col("organ"), "DetalheOrgao").alias("item")))
    columns = layout(discover(items), same_name, taken=["tipo_orgao"])
    return spread(items, (*ORIGIN, "tipo_orgao"), columns).select("tipo_orgao", *columns, *ORIGIN)


def _organ_members(docs: DataFrame) -> DataFrame:
    organ = F.col("organ")
    own_id = first_truthy(organ, *[("DetalheOrgao", k) for k in ("oId", "Id", "id", "cargoId")])

    def history(key: str, suffix: str) -> Column:
        kind = F.concat(F.col("tipo_orgao"), F.lit(suffix))
        return F.transform(elements(organ, key), lambda m: F.struct(kind.alias("kind"), m.alias("item")))

    every = F.array_compact(F.array(history("HistoricoComposicao", ""), history("HistoricoComposicaoCPC", ".CPC")))
    members_of = organs(docs).select(*ORIGIN, own_id.alias("orgao_id"), F.explode(F.flatten(every)).alias("m"))
    items = members_of.select(*ORIGIN, F.col("m.kind").alias("tipo_orgao"), "orgao_id", F.col("m.item").alias("item"))
    items = written(items.filter(is_object(F.col("item"))))
    kept = (*ORIGIN, "tipo_orgao", "orgao_id")
    columns = layout(discover(items), same_name, taken=["tipo_orgao", "orgao_id"])
    stamps = [day_first_timestamp(F.col(c)).alias(f"{c}_ts") for c in MEMBER_DATES if c in columns]
    return spread(items, kept, columns).select("tipo_orgao", "orgao_id", *columns, *stamps, *ORIGIN)


ORGANS = Category(
    "composicao_de_orgaos",
    "object",
    dynamic={"orgaos_detalhe": _organ_details, "orgaos_historico_composicao": _organ_members},
    dynamic_lists=tuple((key,) for key in ORGAN_LISTS),
)

CATEGORIES: dict[str, Category] = {
    c.name: c
    for c in (
        INITIATIVES,
        INTERVENTIONS,
        QUESTIONS,
        PETITIONS,
        APPROVED_ACTS,
        AGENDA,
        DEPUTIES,
        BASE_INFORMATION,
        BUDGET,
        ACTIVITIES,
        ORGANS,
        *DELEGATIONS,
    )
}
