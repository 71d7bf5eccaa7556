"""Register pages: activities, organs, delegations, the budget, deputies and table export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemicycle.functions.dates import as_date
from hemicycle.functions.text import person_label
from hemicycle.operators.aggregates import distinct_counts, monthly
from hemicycle.operators.filters import conjunction, in_legislature, keep, one_of, options, search, visible
from hemicycle.operators.joins import having
from hemicycle.operators.ordering import down, number_up, top, up
from hemicycle.operators.reshape import timeline, unpivot_counters

Tables = Mapping[str, DataFrame]
Values = Sequence[str]


# Activities ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class ActivityView:
    """How one activities table is filtered: its session, kind and extra columns and its texts."""

    table: str
    session: str = "Sessao"
    kind: str | None = None
    texts: tuple[str, ...] = ("Assunto",)
    extra: str | None = None
    tie_break: tuple[str, ...] = ()


# Tables, columns and searched texts of each view.
ACTIVITY_VIEWS = {
    "hearings": ActivityView("atividades_audicoes", "SessaoLegislativa"),
    "audiences": ActivityView("atividades_audiencias", "SessaoLegislativa", extra="Concedida"),
    "debates": ActivityView("atividades_debates", texts=("Assunto", "Artigo")),
    "trips": ActivityView("atividades_deslocacoes", "SessaoLegislativa", "Tipo", ("Designacao", "LocalEvento")),
    "events": ActivityView("atividades_eventos", "SessaoLegislativa", "TipoEvento", ("Designacao", "LocalEvento")),
    "general": ActivityView("atividades_gerais", kind="Tipo"),
    "reports": ActivityView("atividades_relatorios", kind="Tipo"),
}


def activity_kinds(tables: Tables, view: ActivityView, legislature: str, sessions: Values = ()) -> DataFrame:
    rows = keep(tables[view.table], in_legislature(legislature), one_of(view.session, sessions))
    return options(rows, view.kind)


def activities(
    tables: Tables,
    view: ActivityView,
    legislature: str,
    *,
    sessions: Values = (),
    kinds: Values = (),
    extras: Values = (),
    text: str | None = None,
    limit: int | None = 1000,
) -> DataFrame:
    """Rows of one activities table, newest first, with all their columns."""
    rows = keep(
        tables[view.table],
        in_legislature(legislature),
        one_of(view.session, sessions),
        one_of(view.kind, kinds) if view.kind else None,
        one_of(view.extra, extras) if view.extra else None,
        search(view.texts, text, null_safe=True),
    )
    return rows if limit is None else top(rows, [down("_data")], limit, view.tie_break)


def activities_series(rows: DataFrame) -> DataFrame:
    return monthly(rows, "_data")


# Organs -------------------------------------------------------------------------------------


def organ_sessions(tables: Tables, legislature: str, kinds: Values = ()) -> DataFrame:
    rows = keep(tables["orgaos_historico_composicao"], in_legislature(legislature), one_of("tipo_orgao", kinds))
    return options(rows, "legDes")


def organ_parties(tables: Tables, legislature: str, kinds: Values = (), sessions: Values = ()) -> DataFrame:
    return options(organ_members(tables, legislature, kinds=kinds, sessions=sessions, limit=None), "depGP")


def organs(
    tables: Tables,
    legislature: str,
    *,
    kinds: Values = (),
    sessions: Values = (),
    parties: Values = (),
    text: str | None = None,
) -> DataFrame:
    """Organs, kept only when their history has a member of the chosen sessions and parties."""
    rows = keep(
        tables["orgaos_detalhe"],
        in_legislature(legislature),
        one_of("tipo_orgao", kinds),
        search(["oDes", "cargoDes"], text, null_safe=True),
    )
    if sessions or parties:
        member = conjunction([in_legislature(legislature), one_of("legDes", sessions), one_of("depGP", parties)])
        rows = having(rows, tables["orgaos_historico_composicao"], [("oId", "orgao_id")], member)
    return visible(rows.orderBy(up("tipo_orgao"), up("oId")))


def organ_members(
    tables: Tables,
    legislature: str,
    *,
    kinds: Values = (),
    sessions: Values = (),
    parties: Values = (),
    limit: int | None = 2000,
    tie_break: Values = ("orgao_id", "depCadId"),
) -> DataFrame:
    rows = keep(
        tables["orgaos_historico_composicao"],
        in_legislature(legislature),
        one_of("tipo_orgao", kinds),
        one_of("legDes", sessions),
        one_of("depGP", parties),
    )
    return visible(rows if limit is None else top(rows, [up("tipo_orgao")], limit, tie_break))


def organs_kpis(rows: DataFrame) -> DataFrame:
    return distinct_counts(rows, ["tipo_orgao"])


# Delegations --------------------------------------------------------------------------------


def children_of(child: DataFrame, legislature: str, key: str, value) -> DataFrame:
    """Rows of a satellite that belong to one parent."""
    return child.filter(conjunction([in_legislature(legislature), F.col(key) == F.lit(value)]))


def children_of_all(child: DataFrame, parents: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of a satellite that belong to any of a set of parents."""
    return having(child, parents, on)


def occasional_delegations(
    tables: Tables, legislature: str, *, sessions: Values = (), places: Values = (), text: str | None = None
) -> DataFrame:
    rows = keep(
        tables["delegacoes_eventuais"],
        in_legislature(legislature),
        one_of("Sessao", sessions),
        one_of("Local", places),
        search(["Nome"], text),
    )
    columns = ["Id", "Nome", "Local", "data_inicio", "data_fim", "Sessao"]
    return rows.select(*columns).orderBy(down("data_inicio"), up("Id"))


def delegation_places(tables: Tables, legislature: str, sessions: Values = ()) -> DataFrame:
    return options(keep(tables["delegacoes_eventuais"], in_legislature(legislature), one_of("Sessao", sessions)), "Local")


def participants(tables: Tables, legislature: str, delegation) -> DataFrame:
    rows = children_of(tables["delegacao_eventual_participantes"], legislature, "Id", delegation)
    return rows.select("Nome", "Gp", "Tipo")


def _named_groups(rows: DataFrame, date_name: str, legislature: str, sessions: Values, text: str | None) -> DataFrame:
    rows = keep(rows, in_legislature(legislature), one_of("Sessao", sessions), search(["Nome"], text))
    columns = ["Id", "Nome", F.col("data_inicio").alias(date_name), "Sessao"]
    return rows.select(*columns).orderBy(up("Nome"), up("Id"))


def standing_delegations(
    tables: Tables, legislature: str, *, sessions: Values = (), text: str | None = None
) -> DataFrame:
    return _named_groups(tables["delegacoes_permanentes"], "data_eleicao", legislature, sessions, text)


def friendship_groups(tables: Tables, legislature: str, *, sessions: Values = (), text: str | None = None) -> DataFrame:
    return _named_groups(tables["grupos_parlamentares_de_amizade"], "data_criacao", legislature, sessions, text)


def group_members(tables: Tables, legislature: str, group) -> DataFrame:
    rows = children_of(tables["grupo_amizade_composicao"], legislature, "Id", group)
    return rows.select("Nome", "Gp", "Cargo", "DataInicio", "DataFim").orderBy(up("Cargo"), up("Nome"))


def meetings_and_visits(
    tables: Tables, legislature: str, *, kinds: Values = (), places: Values = (), text: str | None = None
) -> DataFrame:
    rows = keep(
        tables["reunioes_e_visitas"],
        in_legislature(legislature),
        one_of("Tipo", kinds),
        one_of("Local", places),
        search(["Nome", "Promotor"], text, null_safe=True),
    )
    columns = ["Id", "Nome", "Tipo", "Local", "Promotor", "data_inicio", "data_fim"]
    return rows.select(*columns).orderBy(down("data_inicio"), up("Id"))


def meeting_places(tables: Tables, legislature: str, kinds: Values = ()) -> DataFrame:
    return options(keep(tables["reunioes_e_visitas"], in_legislature(legislature), one_of("Tipo", kinds)), "Local")


# Budget -------------------------------------------------------------------------------------


def budget_states(tables: Tables, legislature: str, kinds: Values = ()) -> DataFrame:
    return options(keep(tables["orcamento_do_estado"], in_legislature(legislature), one_of("Tipo", kinds)), "Estado")


def budget_items(
    tables: Tables,
    legislature: str,
    *,
    kinds: Values = (),
    states: Values = (),
    text: str | None = None,
    limit: int | None = 1000,
) -> DataFrame:
    """Budget items in the numeric order of their id."""
    rows = keep(
        tables["orcamento_do_estado"],
        in_legislature(legislature),
        one_of("Tipo", kinds),
        one_of("Estado", states),
        search(["Titulo", "Texto"], text),
    ).select("ID", "ID_Pai", "Tipo", "Numero", "Titulo", "Estado", "Texto")
    return rows if limit is None else top(rows, [number_up("ID")], limit, ["ID"])


def budget_kpis(page: DataFrame) -> DataFrame:
    return distinct_counts(page, ["Tipo", "Estado"])


# Deputies -----------------------------------------------------------------------------------


def deputy_labels(tables: Tables, legislature: str) -> DataFrame:
    rows = keep(tables["deputados"], in_legislature(legislature))
    label = person_label(F.col("DepNomeParlamentar"), F.col("DepNomeCompleto"), F.col("DepCPDes"))
    return rows.select("DepCadId", label.alias("label"), "DepNomeParlamentar").orderBy(
        up("DepNomeParlamentar"), up("DepCadId")
    ).select("DepCadId", "label")


def _of_deputy(rows: DataFrame, column: str, deputy) -> DataFrame:
    """Rows of one deputy. The id is spelled as the column stores it, text or number, so the scan can use it."""
    kind = rows.schema[column].dataType
    spelled = str(int(deputy)) if isinstance(kind, T.StringType) else float(deputy)
    return rows.filter(F.col(column) == F.lit(spelled).cast(kind))


def deputy_biography(tables: Tables, legislature: str, deputy) -> DataFrame:
    return _of_deputy(keep(tables["deputados"], in_legislature(legislature)), "DepCadId", deputy)


def deputy_counts(tables: Tables, legislature: str, deputy) -> DataFrame:
    """One row: initiatives signed, interventions made and questions signed by one deputy."""
    in_term = in_legislature(legislature)
    signed = _of_deputy(tables["iniciativa_autores_deputados"], "idCadastro", deputy)
    signed = having(signed, tables["iniciativas"], ["IniId"], in_term)
    spoken = _of_deputy(keep(tables["intervencoes"], in_term), "dep_idCadastro", deputy)
    asked = _of_deputy(keep(tables["pergunta_autores"], in_term), "idCadastro", deputy)
    counts = {
        "n_ini": signed.agg(F.count_distinct("IniId").alias("n")),
        "n_int": spoken.agg(F.count("*").alias("n")),
        "n_perg": asked.agg(F.count_distinct("Id").alias("n")),
    }
    tagged = reduce(DataFrame.unionByName, (df.select(F.lit(name).alias("kind"), "n") for name, df in counts.items()))
    return tagged.agg(*[F.max(F.when(F.col("kind") == name, F.col("n"))).alias(name) for name in counts])


def deputy_initiatives(tables: Tables, legislature: str, deputy) -> DataFrame:
    rows = keep(tables["iniciativas"], in_legislature(legislature))
    signed = _of_deputy(tables["iniciativa_autores_deputados"], "idCadastro", deputy).select("IniId")
    return rows.join(signed, "IniId").orderBy(down("data_entrada"), up("IniId")).select(
        F.col("IniNr").alias("nr"),
        F.col("IniDescTipo").alias("tipo"),
        F.col("IniTitulo").alias("titulo"),
        F.col("data_entrada").alias("data_ini"),
        F.col("IniLinkTexto").alias("texto"),
    )


def deputy_interventions(tables: Tables, legislature: str, deputy) -> DataFrame:
    rows = _of_deputy(keep(tables["intervencoes"], in_legislature(legislature)), "dep_idCadastro", deputy)
    return rows.orderBy(down("DataReuniaoPlenaria"), up("Id")).select(
        F.col("DataReuniaoPlenaria").alias("data_reu"),
        F.col("TipoIntervencao").alias("tipo"),
        F.col("Sumario").alias("sumario"),
        F.col("pub_URLDiario").alias("dar"),
        F.col("av_url").alias("video"),
    )


def deputy_questions(tables: Tables, legislature: str, deputy) -> DataFrame:
    rows = keep(tables["perguntas_e_requerimentos"], in_legislature(legislature))
    signed = _of_deputy(tables["pergunta_autores"], "idCadastro", deputy).select("Id")
    return rows.join(signed, "Id").orderBy(down("DataEnvio"), up("Id")).select(
        F.col("Nr").alias("nr"),
        F.col("Tipo").alias("tipo"),
        F.col("ReqTipo").alias("req_tipo"),
        F.col("Assunto").alias("assunto"),
        as_date(F.col("DataEnvio")).alias("data_envio"),
        F.col("Ficheiro").alias("texto"),
    )


def deputy_hearings(tables: Tables, legislature: str, deputy, table: str = "deputados_atividade_audiencias") -> DataFrame:
    """Audiences, or hearings with `table="deputados_atividade_audicoes"`."""
    rows = _of_deputy(keep(tables[table], in_legislature(legislature)), "DepCadId", deputy)
    return rows.filter(F.col("ActAs").isNotNull()).orderBy(down("ActDtent"), up("ActAs")).select(
        F.col("ActAs").alias("assunto"),
        as_date(F.col("ActDtent")).alias("data_entrada"),
        F.col("ActLoc").alias("local"),
        F.col("ActTpdesc").alias("tipo_desc"),
        F.col("ActSl").alias("sessao"),
    )


def deputy_party_timeline(tables: Tables, legislature: str, deputy, today: date | None = None) -> DataFrame:
    rows = _of_deputy(keep(tables["deputados_dep_gp"], in_legislature(legislature)), "DepCadId", deputy)
    spans = rows.filter(F.col("GpSigla").isNotNull()).select(
        F.col("GpSigla").alias("gp"), F.col("GpDtInicio").alias("data_inicio"), F.col("GpDtFim").alias("data_fim")
    )
    return timeline(spans, "data_inicio", "data_fim", today)


def deputy_activity(tables: Tables, legislature: str, deputy) -> DataFrame:
    rows = _of_deputy(keep(tables["deputado_atividade_contadores"], in_legislature(legislature)), "DepCadId", deputy)
    return unpivot_counters(rows, ["DepCadId"]).drop("DepCadId")


# Export -------------------------------------------------------------------------------------


def export_selection(df: DataFrame, legislatures: Values = ()) -> DataFrame:
    """A whole table, or the chosen legislatures of it."""
    return keep(df, one_of("_legislatura", legislatures) if "_legislatura" in df.columns else None)


def preview(df: DataFrame, n: int = 100, tie_break: Values = ()) -> DataFrame:
    return top(df, [], n, tie_break) if tie_break else df.limit(n)
