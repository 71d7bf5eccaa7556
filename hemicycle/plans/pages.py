"""Analytic queries over the civic tables, one function per page.

A page takes the tables as a mapping from name to DataFrame, the legislature and its optional
filters, and returns at most `limit` rows in page order. `limit=None` returns every match, which
is the frame to summarise when figures should cover all matches and not just the page.

Filters and the limit come first; joins that only decorate rows come after, so they touch the
rows on the page instead of whole tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.functions.dates import as_date
from hemicycle.functions.numbers import try_int
from hemicycle.functions.text import plain_text
from hemicycle.operators.aggregates import (
    count_by,
    daily,
    distinct_by,
    distinct_counts,
    monthly,
    ordered_text_list,
    text_lists,
    outcome_rates,
    sum_and_median,
)
from hemicycle.operators.filters import (
    LEGISLATURE,
    Facet,
    at_least,
    conjunction,
    facet_options,
    flagged,
    in_legislature,
    keep,
    one_of,
    options,
    search,
    within_or_null,
)
from hemicycle.operators.joins import among, attach, having, page_ids
from hemicycle.operators.ordering import down, latest, number_down, top, up

Tables = Mapping[str, DataFrame]
Dates = tuple[date, date] | None
Values = Sequence[str]


@dataclass(frozen=True)
class _Page:
    """The rows a page shows: the ids of the first `limit` matches, or all matches without a limit.

    `rows` and `satellite` cut a table down to those ids, so decorating joins see the page only.
    """

    keys: list[str]
    order: list[Column]
    limit: int | None
    ids: DataFrame | None

    @staticmethod
    def of(matches: DataFrame, keys: list[str], order: list[Column], limit: int | None) -> _Page:
        return _Page(keys, order, limit, None if limit is None else page_ids(matches, keys, order, limit))

    def rows(self, base: DataFrame, matches: DataFrame) -> DataFrame:
        """Page rows, from the table before its semi joins where the ids already stand for those."""
        return matches if self.ids is None else among(base, self.ids, self.keys)

    def satellite(self, table: DataFrame) -> DataFrame:
        return table if self.ids is None else among(table, self.ids, self.keys)

    def with_text_list(self, rows: DataFrame, table: DataFrame, expression: str, name: str) -> DataFrame:
        """Adds the distinct texts of a satellite, joined; without a limit the lists of hot keys are built in segments."""
        if self.ids is None:
            return rows.join(text_lists(table, self.keys, expression, name), self.keys, "left")
        return attach(rows, self.satellite(table), self.keys, [ordered_text_list(expression).alias(name)])

    def sorted(self, rows: DataFrame) -> DataFrame:
        """Page order after the joins; stating the limit again merges sorted heads instead of a full sort."""
        return rows if self.limit is None else top(rows, self.order, self.limit, self.keys)


def _first(rows: DataFrame, order: Sequence[Column], limit: int | None, tie_break: Sequence[str]) -> DataFrame:
    return rows if limit is None else top(rows, order, limit, tie_break)


def _ranked(orders: dict[str, list[Column]], name: str) -> list[Column]:
    if name not in orders:
        raise ValueError(f"unknown order {name!r}; one of {sorted(orders)}")
    return orders[name]


# Summary ------------------------------------------------------------------------------------


def summary_counts(tables: Tables, legislature: str) -> DataFrame:
    """Rows of the four main tables, one row per table."""
    names = ("iniciativas", "intervencoes", "deputados", "iniciativa_eventos")
    counts = [
        keep(tables[n], in_legislature(legislature)).agg(F.count("*").alias("n")).select(F.lit(n).alias("tabela"), "n")
        for n in names
    ]
    total = counts[0]
    for frame in counts[1:]:
        total = total.unionByName(frame)
    return total


def initiatives_by_party(tables: Tables, legislature: str) -> DataFrame:
    rows = keep(tables["iniciativas"], in_legislature(legislature)).select("IniId")
    return distinct_by(rows.join(tables["iniciativa_autores_gp"].select("IniId", "GP"), "IniId"), "GP", "IniId")


def interventions_by_party(tables: Tables, legislature: str) -> DataFrame:
    rows = keep(tables["intervencoes"], in_legislature(legislature))
    return count_by(rows.withColumnRenamed("dep_GP", "GP"), "GP")


def initiatives_by_kind(tables: Tables, legislature: str) -> DataFrame:
    rows = keep(tables["iniciativas"], in_legislature(legislature))
    return count_by(rows.withColumnRenamed("IniDescTipo", "Tipo"), "Tipo", "Total")


# Initiatives --------------------------------------------------------------------------------


def _by_author_party(tables: Tables) -> Facet:
    return Facet("GP", lambda df, parties: having(df, tables["iniciativa_autores_gp"], ["IniId"], one_of("GP", parties)))


def initiative_kinds(tables: Tables, legislature: str, parties: Values = ()) -> DataFrame:
    """Kinds on offer once parties are chosen."""
    rows = keep(tables["iniciativas"], in_legislature(legislature))
    return facet_options(rows, [_by_author_party(tables), Facet.on("IniDescTipo")], 1, [parties])


def initiative_authors(tables: Tables, legislature: str, parties: Values = (), kinds: Values = ()) -> DataFrame:
    """Author names on offer once parties and kinds are chosen."""
    initiatives = conjunction([in_legislature(legislature), one_of("IniDescTipo", kinds)])
    authors = keep(tables["iniciativa_autores_deputados"], one_of("GP", parties), F.col("nome").isNotNull())
    return options(having(authors, tables["iniciativas"], ["IniId"], initiatives), "nome")


def initiatives(
    tables: Tables,
    legislature: str,
    *,
    dates: Dates = None,
    parties: Values = (),
    authors: Values = (),
    kinds: Values = (),
    text: str | None = None,
    results: Values = (),
    order: str = "date_desc",
    limit: int | None = 200,
    vote_tie_break: Values = (),
    same_legislature: bool = False,
) -> DataFrame:
    """Initiatives with the outcome of their latest vote.

    Author and result tests match on the initiative id alone; `same_legislature` adds the
    legislature to the key.
    """
    key = ["IniId", LEGISLATURE] if same_legislature else ["IniId"]
    rows = tables["iniciativas"]
    base = matches = keep(
        rows,
        in_legislature(legislature),
        within_or_null(rows, "data_entrada", dates),
        one_of("IniDescTipo", kinds),
        search(["IniTitulo"], text),
    )
    for table, column, values in (
        ("iniciativa_autores_gp", "GP", parties),
        ("iniciativa_autores_deputados", "nome", authors),
        ("iniciativa_eventos_votacao", "resultado", results),
    ):
        if values:
            matches = having(matches, tables[table], key, one_of(column, values))
    ranking = _ranked(
        {
            "date_desc": [down("data_entrada")],
            "date_asc": [up("data_entrada")],
            "kind": [up("IniDescTipo"), down("data_entrada")],
            "number": [up("IniNr")],
        },
        order,
    )
    page = _Page.of(matches, ["IniId"], ranking, limit)
    votes = page.satellite(keep(tables["iniciativa_eventos_votacao"], in_legislature(legislature)))
    last = latest(
        votes.select("IniId", "resultado", "unanime", "data", "_json_idx", *vote_tie_break),
        ["IniId"],
        [as_date(F.col("data")).desc_nulls_last(), down("_json_idx"), *[down(c) for c in vote_tie_break]],
    )
    joined = page.rows(base, matches).join(last.select("IniId", "resultado", "unanime"), "IniId", "left")
    return page.sorted(joined).select(
        F.col("IniNr").alias("nr"),
        F.col("IniDescTipo").alias("tipo"),
        F.col("IniTitulo").alias("titulo"),
        F.col("data_entrada").alias("data_ini"),
        "resultado",
        "unanime",
        F.col("IniLinkTexto").alias("texto"),
    )


def initiatives_kpis(page: DataFrame) -> DataFrame:
    return page.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("resultado") == "Aprovado").alias("n_aprovadas"),
        F.count_if(F.col("resultado") == "Rejeitado").alias("n_rejeitadas"),
        F.count_distinct("tipo").alias("distinct_tipo"),
    )


def initiatives_series(page: DataFrame) -> DataFrame:
    return monthly(page, "data_ini")


# Votes --------------------------------------------------------------------------------------


def vote_kinds(tables: Tables, legislature: str) -> DataFrame:
    """Kinds of the initiatives that were put to a vote."""
    voted = keep(tables["iniciativa_eventos_votacao"], in_legislature(legislature))
    return options(having(tables["iniciativas"], voted, ["IniId", LEGISLATURE]), "IniDescTipo")


def vote_results(tables: Tables, legislature: str, kinds: Values = ()) -> DataFrame:
    votes = keep(tables["iniciativa_eventos_votacao"], in_legislature(legislature))
    if kinds:
        votes = having(votes, tables["iniciativas"], ["IniId", LEGISLATURE], one_of("IniDescTipo", kinds))
    return options(votes, "resultado")


def votes(
    tables: Tables,
    legislature: str,
    *,
    dates: Dates = None,
    kinds: Values = (),
    results: Values = (),
    meetings: Values = (),
    unanimous: str = "all",
    text: str | None = None,
    limit: int | None = 500,
    tie_break: Values = ("IniId", "_json_idx"),
) -> DataFrame:
    """Vote events, newest first, with the initiative each belongs to."""
    rows = tables["iniciativa_eventos_votacao"]
    rows = keep(
        rows,
        in_legislature(legislature),
        within_or_null(rows, "data", dates),
        one_of("resultado", results),
        one_of("tipoReuniao", meetings),
        flagged("unanime", unanimous, "unanime"),
    ).withColumn("data_vot", as_date(F.col("data")))
    details = tables["iniciativas"].select("IniId", LEGISLATURE, "IniNr", "IniDescTipo", "IniTitulo", "IniLinkTexto")
    on = ["IniId", LEGISLATURE]
    ranking = [down("data_vot")]
    if kinds or text:
        matching = keep(details, one_of("IniDescTipo", kinds), search(["IniTitulo"], text))
        if limit is not None:
            # Keys and date find the page; the texts of a vote are read for the page only.
            keys = list(dict.fromkeys([*tie_break, *on]))
            found = having(rows.select(*keys, "data_vot"), matching, on)
            rows = among(rows, page_ids(found, keys, ranking, limit), keys)
        page = rows.join(matching, on)
    else:
        page = _first(rows, ranking, limit, tie_break).join(details, on, "left")
    return _first(page, ranking, limit, tie_break).select(
        F.col("IniId").alias("ini_id"),
        F.col("IniNr").alias("nr"),
        F.col("IniDescTipo").alias("tipo"),
        F.col("IniTitulo").alias("titulo"),
        "data_vot",
        "resultado",
        "unanime",
        F.col("tipoReuniao").alias("tipo_reuniao"),
        "reuniao",
        "descricao",
        plain_text(F.col("detalhe")).alias("detalhe"),
        F.col("IniLinkTexto").alias("texto"),
    )


def votes_kpis(page: DataFrame) -> DataFrame:
    return outcome_rates(
        page,
        {
            "aprovadas": F.col("resultado") == "Aprovado",
            "rejeitadas": F.col("resultado") == "Rejeitado",
            "unanimes": F.col("unanime") == "unanime",
        },
    )


def votes_series(page: DataFrame) -> DataFrame:
    return monthly(page, "data_vot", "resultado")


# Interventions ------------------------------------------------------------------------------

INTERVENTION_FACETS = [Facet.on(c) for c in ("dep_GP", "TipoIntervencao", "dep_nome", "Qualidade")]


def intervention_options(tables: Tables, legislature: str, k: int, chosen: Sequence[Values]) -> DataFrame:
    rows = keep(tables["intervencoes"], in_legislature(legislature))
    return facet_options(rows, INTERVENTION_FACETS, k, chosen)


def interventions(
    tables: Tables,
    legislature: str,
    *,
    dates: Dates = None,
    parties: Values = (),
    kinds: Values = (),
    deputies: Values = (),
    qualities: Values = (),
    text: str | None = None,
    order: str = "date_desc",
    limit: int | None = 300,
) -> DataFrame:
    rows = tables["intervencoes"]
    rows = keep(
        rows,
        in_legislature(legislature),
        within_or_null(rows, "DataReuniaoPlenaria", dates),
        one_of("dep_GP", parties),
        one_of("TipoIntervencao", kinds),
        one_of("dep_nome", deputies),
        one_of("Qualidade", qualities),
        search(["Sumario", "Resumo"], text),
    )
    ranking = _ranked(
        {
            "date_desc": [down("DataReuniaoPlenaria")],
            "date_asc": [up("DataReuniaoPlenaria")],
            "deputy": [up("dep_nome"), down("DataReuniaoPlenaria")],
            "party": [up("dep_GP"), down("DataReuniaoPlenaria")],
        },
        order,
    )
    return _first(rows, ranking, limit, ["Id"]).select(
        F.col("DataReuniaoPlenaria").alias("data_reu"),
        F.col("dep_GP").alias("gp"),
        F.col("dep_nome").alias("deputado"),
        F.col("Qualidade").alias("qualidade"),
        F.col("TipoIntervencao").alias("tipo"),
        F.col("Sumario").alias("sumario"),
        F.col("pub_URLDiario").alias("dar"),
        F.col("av_url").alias("video"),
    )


def interventions_kpis(page: DataFrame) -> DataFrame:
    return distinct_counts(page, ["deputado", "gp", "tipo"])


def interventions_series(page: DataFrame) -> DataFrame:
    return daily(page, "data_reu", "gp")


# Questions ----------------------------------------------------------------------------------


def _question_filter(
    tables: Tables, rows: DataFrame, parties: Values, kinds: Values, request_kinds: Values, recipients: Values = ()
) -> DataFrame:
    rows = keep(rows, one_of("Tipo", kinds), one_of("ReqTipo", request_kinds))
    if parties:
        rows = having(rows, tables["pergunta_autores"], ["Id"], one_of("GP", parties))
    if recipients:
        rows = having(rows, tables["pergunta_destinatarios"], ["Id"], one_of("nomeEntidade", recipients))
    return rows


def question_kinds(tables: Tables, legislature: str, parties: Values = ()) -> DataFrame:
    rows = keep(tables["perguntas_e_requerimentos"], in_legislature(legislature))
    return options(_question_filter(tables, rows, parties, (), ()), "Tipo")


def question_request_kinds(tables: Tables, legislature: str, parties: Values = (), kinds: Values = ()) -> DataFrame:
    rows = keep(tables["perguntas_e_requerimentos"], in_legislature(legislature))
    return options(_question_filter(tables, rows, parties, kinds, ()), "ReqTipo")


def question_recipients(
    tables: Tables, legislature: str, parties: Values = (), kinds: Values = (), request_kinds: Values = ()
) -> DataFrame:
    """Recipients of the questions left by the filters: a semi join on a semi join."""
    rows = keep(tables["pergunta_destinatarios"], in_legislature(legislature))
    if parties or kinds or request_kinds:
        asked = _question_filter(tables, tables["perguntas_e_requerimentos"], parties, kinds, request_kinds)
        rows = having(rows, asked, ["Id"])
    return options(rows, "nomeEntidade")


def question_authors(
    tables: Tables,
    legislature: str,
    parties: Values = (),
    kinds: Values = (),
    request_kinds: Values = (),
    recipients: Values = (),
) -> DataFrame:
    rows = keep(tables["pergunta_autores"], in_legislature(legislature), one_of("GP", parties))
    if kinds or request_kinds:
        asked = _question_filter(tables, tables["perguntas_e_requerimentos"], (), kinds, request_kinds)
        rows = having(rows, asked, ["Id"])
    if recipients:
        rows = having(rows, tables["pergunta_destinatarios"], ["Id"], one_of("nomeEntidade", recipients))
    return options(rows, "nome")


def questions(
    tables: Tables,
    legislature: str,
    *,
    dates: Dates = None,
    parties: Values = (),
    kinds: Values = (),
    request_kinds: Values = (),
    recipients: Values = (),
    authors: Values = (),
    text: str | None = None,
    order: str = "date_desc",
    limit: int | None = 300,
) -> DataFrame:
    """Questions and requests with the parties that signed and the bodies addressed."""
    rows = tables["perguntas_e_requerimentos"]
    base = keep(
        rows,
        in_legislature(legislature),
        within_or_null(rows, "DataEnvio", dates),
        search(["Assunto"], text),
        one_of("Tipo", kinds),
        one_of("ReqTipo", request_kinds),
    )
    matches = _question_filter(tables, base, parties, (), (), recipients)
    if authors:
        matches = having(matches, tables["pergunta_autores"], ["Id"], one_of("nome", authors))
    ranking = _ranked(
        {
            "date_desc": [down("DataEnvio")],
            "date_asc": [up("DataEnvio")],
            "kind": [up("Tipo"), down("DataEnvio")],
        },
        order,
    )
    page = _Page.of(matches, ["Id"], ranking, limit)
    full = page.rows(base, matches)
    full = page.with_text_list(full, tables["pergunta_autores"], "GP", "gps")
    full = page.with_text_list(full, tables["pergunta_destinatarios"], "nomeEntidade", "destinatarios")
    return page.sorted(full).select(
        F.col("Id").alias("id_p"),
        F.col("Nr").alias("nr"),
        F.col("Tipo").alias("tipo"),
        F.col("ReqTipo").alias("reqtipo"),
        F.col("Assunto").alias("assunto"),
        F.col("DataEnvio").alias("data_envio"),
        F.col("Ficheiro").alias("ficheiro"),
        "gps",
        "destinatarios",
    )


def questions_kpis(page: DataFrame) -> DataFrame:
    return distinct_counts(page, ["tipo", "reqtipo"])


def questions_series(page: DataFrame) -> DataFrame:
    return monthly(page, "data_envio")


# Petitions ----------------------------------------------------------------------------------


def petition_committees(tables: Tables, legislature: str, statuses: Values = ()) -> DataFrame:
    rows = keep(tables["peticao_dados_comissao"], in_legislature(legislature))
    if statuses:
        rows = having(rows, tables["peticoes"], ["PetId"], one_of("PetSituacao", statuses))
    return options(rows, "Nome")


def petitions(
    tables: Tables,
    legislature: str,
    *,
    dates: Dates = None,
    statuses: Values = (),
    committees: Values = (),
    min_signatures: int = 0,
    text: str | None = None,
    order: str = "date_desc",
    limit: int | None = 200,
) -> DataFrame:
    """Petitions with their signatures as a number and the committees that handled them."""
    rows = tables["peticoes"]
    base = matches = keep(
        rows,
        in_legislature(legislature),
        within_or_null(rows, "PetDataEntrada", dates),
        one_of("PetSituacao", statuses),
        at_least("PetNrAssinaturas", min_signatures),
        search(["PetAssunto", "PetAutor"], text),
    )
    if committees:
        matches = having(matches, tables["peticao_dados_comissao"], ["PetId"], one_of("Nome", committees))
    ranking = _ranked(
        {
            "date_desc": [down("PetDataEntrada")],
            "signatures_desc": [number_down("PetNrAssinaturas")],
            "status": [up("PetSituacao"), down("PetDataEntrada")],
        },
        order,
    )
    page = _Page.of(matches, ["PetId"], ranking, limit)
    full = page.with_text_list(page.rows(base, matches), tables["peticao_dados_comissao"], "Nome", "comissoes")
    return page.sorted(full).select(
        F.col("PetNr").alias("nr"),
        F.col("PetDataEntrada").alias("data_ent"),
        F.col("PetAutor").alias("autor"),
        F.col("PetAssunto").alias("assunto"),
        F.col("PetSituacao").alias("situacao"),
        try_int(F.col("PetNrAssinaturas")).alias("assinaturas"),
        F.col("PetUrlTexto").alias("texto"),
        "comissoes",
    )


def petitions_kpis(page: DataFrame) -> DataFrame:
    return sum_and_median(page, "assinaturas")


def petitions_series(page: DataFrame) -> DataFrame:
    return monthly(page, "data_ent")


# Approved acts ------------------------------------------------------------------------------

ACT_FACETS = [Facet.on(c) for c in ("Tipo", "AnoCivil", "Sessao")]


def act_options(tables: Tables, legislature: str, k: int, chosen: Sequence[Values]) -> DataFrame:
    return facet_options(keep(tables["diplomas_aprovados"], in_legislature(legislature)), ACT_FACETS, k, chosen)


def first_publication() -> list[Column]:
    """First publication date and the link of the earliest publication that has one."""
    dated_link = F.min(F.when(F.col("URLDiario").isNotNull(), F.struct("pubdt", "URLDiario")))
    return [F.min("pubdt").alias("data_pub"), dated_link["URLDiario"].alias("dar")]


def approved_acts(
    tables: Tables,
    legislature: str,
    *,
    kinds: Values = (),
    years: Values = (),
    sessions: Values = (),
    text: str | None = None,
    order: str = "published_desc",
    limit: int | None = 200,
) -> DataFrame:
    """Approved acts with their first publication and the initiatives they came from."""
    base = matches = keep(
        tables["diplomas_aprovados"],
        in_legislature(legislature),
        one_of("Tipo", kinds),
        one_of("AnoCivil", years),
        one_of("Sessao", sessions),
        search(["Titulo"], text),
    )
    published = tables["diploma_publicacao"]
    ranking = _ranked(
        {
            "published_desc": [down("data_pub")],
            "number": [number_down("Numero")],
            "kind": [up("Tipo"), up("Numero")],
        },
        order,
    )
    if order == "published_desc":
        # This order needs the publication date of every match, and only that.
        matches = attach(base, having(published, base, ["Id"]), ["Id"], first_publication()[:1])
    page = _Page.of(matches, ["Id"], ranking, limit)
    full = attach(page.rows(base, base), page.satellite(published), ["Id"], first_publication())
    full = page.with_text_list(full, tables["diploma_iniciativas"], "IniTipo || ' ' || IniNr", "iniciativas_origem")
    return page.sorted(full).select(
        F.col("Tipo").alias("tipo"),
        F.col("Numero").alias("numero"),
        F.col("AnoCivil").alias("ano"),
        F.col("Titulo").alias("titulo"),
        F.col("LinkTexto").alias("texto"),
        "data_pub",
        "dar",
        "iniciativas_origem",
    )


def approved_acts_kpis(page: DataFrame) -> DataFrame:
    return distinct_counts(page, ["tipo", "ano"])


def approved_acts_series(page: DataFrame) -> DataFrame:
    return monthly(page, "data_pub", "tipo")


# Agenda -------------------------------------------------------------------------------------

AGENDA_FACETS = [Facet.on(c) for c in ("Section", "Theme", "Local")]


def agenda_options(tables: Tables, legislature: str, k: int, chosen: Sequence[Values]) -> DataFrame:
    return facet_options(keep(tables["agenda_parlamentar"], in_legislature(legislature)), AGENDA_FACETS, k, chosen)


def agenda(
    tables: Tables,
    legislature: str,
    *,
    dates: Dates = None,
    sections: Values = (),
    themes: Values = (),
    places: Values = (),
    text: str | None = None,
    order: str = "date_desc",
    limit: int | None = 200,
) -> DataFrame:
    rows = tables["agenda_parlamentar"]
    rows = keep(
        rows,
        in_legislature(legislature),
        within_or_null(rows, "data_inicio", dates),
        one_of("Section", sections),
        one_of("Theme", themes),
        one_of("Local", places),
        search(["Title", "Subtitle"], text),
    )
    ranking = _ranked({"date_desc": [down("data_inicio")], "date_asc": [up("data_inicio")]}, order)
    return _first(rows, ranking, limit, ["Id"]).select(
        F.col("data_inicio").alias("inicio"),
        F.col("data_fim").alias("fim"),
        F.col("Section").alias("seccao"),
        F.col("Theme").alias("tema"),
        F.col("Title").alias("titulo"),
        F.col("Subtitle").alias("subtitulo"),
        F.col("Local").alias("local"),
        F.col("Link").alias("link"),
    )


def agenda_kpis(page: DataFrame) -> DataFrame:
    return distinct_counts(page, ["seccao", "tema"])


def agenda_series(page: DataFrame) -> DataFrame:
    return daily(page, "inicio", "seccao")
