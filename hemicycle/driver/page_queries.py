"""Page queries, their option lists and their summaries."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.driver.registry import add_civic
from hemicycle.operators.filters import options
from hemicycle.operators.joins import attach
from hemicycle.plans import pages, registers


def add_scopes(name: str, query: Callable[..., DataFrame], check: str) -> None:
    """A query over the rows of a page, and the same over all matches."""
    add_civic(name, query, check)
    add_civic(f"{name}_all_matches", lambda t: query(t, limit=None), re.sub(r" LIMIT \d+", "", check))


TERM = "1997"
YEARS = (date(1996, 6, 1), date(1997, 10, 15))
DAYS = (date(2024, 1, 3), date(2024, 1, 12))
_BETWEEN_YEARS = "BETWEEN DATE '1996-06-01' AND DATE '1997-10-15'"
_BETWEEN_DAYS = "BETWEEN DATE '2024-01-03' AND DATE '2024-01-12'"
PARTIES = ["NATION_2", "NATION_5", "NATION_16", "NATION_20"]
_PARTIES = "('NATION_2', 'NATION_5', 'NATION_16', 'NATION_20')"


def _option_list(select: str) -> str:
    return f"SELECT DISTINCT option FROM ({select}) WHERE option IS NOT NULL ORDER BY 1"


# Summary
add_civic(
    "summary_counts",
    lambda t: pages.summary_counts(t, TERM),
    """SELECT 'iniciativas' AS tabela, count(*) AS n FROM iniciativas WHERE _legislatura = '1997'
    UNION ALL SELECT 'intervencoes', count(*) FROM intervencoes WHERE _legislatura = '1997'
    UNION ALL SELECT 'deputados', count(*) FROM deputados WHERE _legislatura = '1997'
    UNION ALL SELECT 'iniciativa_eventos', count(*) FROM iniciativa_eventos WHERE _legislatura = '1997'""",
)
add_civic(
    "summary_initiatives_by_party",
    lambda t: pages.initiatives_by_party(t, TERM),
    """SELECT g.GP, count(DISTINCT i.IniId) AS n FROM iniciativas i JOIN iniciativa_autores_gp g USING (IniId)
    WHERE i._legislatura = '1997' GROUP BY 1""",
)
add_civic(
    "summary_interventions_by_party",
    lambda t: pages.interventions_by_party(t, "17"),
    """SELECT dep_GP AS GP, count(*) AS n FROM intervencoes
    WHERE _legislatura = '17' AND dep_GP IS NOT NULL GROUP BY 1""",
)
add_civic(
    "summary_initiatives_by_kind",
    lambda t: pages.initiatives_by_kind(t, TERM),
    """SELECT IniDescTipo AS Tipo, count(*) AS Total FROM iniciativas
    WHERE _legislatura = '1997' AND IniDescTipo IS NOT NULL GROUP BY 1""",
)

# Initiatives
_LATEST_VOTE = """ult AS (SELECT IniId, resultado, unanime, row_number() OVER (PARTITION BY IniId
      ORDER BY TRY_CAST(data AS DATE) DESC NULLS LAST, _json_idx DESC, id DESC) AS rn
      FROM iniciativa_eventos_votacao WHERE _legislatura = '1997')"""
_INITIATIVE_ROWS = f"""WITH {_LATEST_VOTE},
    page AS (SELECT i.IniId, i.IniNr AS nr, i.IniDescTipo AS tipo, i.IniTitulo AS titulo,
        CAST(i.data_entrada AS VARCHAR) AS data_ini, i.data_entrada AS d, u.resultado, u.unanime, i.IniLinkTexto AS texto
      FROM iniciativas i LEFT JOIN ult u ON u.IniId = i.IniId AND u.rn = 1
      WHERE i._legislatura = '1997'
        AND (i.data_entrada IS NULL OR CAST(i.data_entrada AS DATE) {_BETWEEN_YEARS})
        AND EXISTS (SELECT 1 FROM iniciativa_autores_gp g WHERE g.IniId = i.IniId AND g.GP IN {_PARTIES})
        AND i.IniDescTipo IN ('1-URGENT', '2-HIGH', '5-LOW') AND i.IniTitulo ILIKE '%AÇÃO%'
        AND EXISTS (SELECT 1 FROM iniciativa_eventos_votacao v WHERE v.IniId = i.IniId
          AND v.resultado IN ('Aprovado', 'Rejeitado')))"""
_INITIATIVES = dict(
    dates=YEARS,
    parties=PARTIES,
    kinds=["1-URGENT", "2-HIGH", "5-LOW"],
    text="AÇÃO",
    results=["Aprovado", "Rejeitado"],
    vote_tie_break=["id"],
)
add_civic(
    "initiatives_page",
    lambda t: pages.initiatives(t, TERM, **_INITIATIVES),
    f"""{_INITIATIVE_ROWS} SELECT nr, tipo, titulo, data_ini, resultado, unanime, texto FROM page
    ORDER BY d DESC NULLS LAST, IniId LIMIT 200""",
)
for _order, _sql in {
    "date_asc": "d ASC NULLS LAST",
    "kind": "tipo NULLS LAST, d DESC NULLS LAST",
    "number": "nr NULLS LAST",
}.items():
    add_civic(
        f"initiatives_page_by_{_order}",
        lambda t, o=_order: pages.initiatives(t, TERM, order=o, limit=150, **_INITIATIVES),
        f"""{_INITIATIVE_ROWS} SELECT nr, tipo, titulo, data_ini, resultado, unanime, texto FROM page
        ORDER BY {_sql}, IniId LIMIT 150""",
    )
add_civic(
    "initiatives_page_by_author",
    lambda t: pages.initiatives(
        t, TERM, authors=["Supplier#000000003", "Supplier#000000007"], vote_tie_break=["id"], same_legislature=True
    ),
    f"""WITH {_LATEST_VOTE} SELECT i.IniNr AS nr, i.IniDescTipo AS tipo, i.IniTitulo AS titulo,
      CAST(i.data_entrada AS VARCHAR) AS data_ini, u.resultado, u.unanime, i.IniLinkTexto AS texto
    FROM iniciativas i LEFT JOIN ult u ON u.IniId = i.IniId AND u.rn = 1
    WHERE i._legislatura = '1997' AND EXISTS (SELECT 1 FROM iniciativa_autores_deputados a WHERE a.IniId = i.IniId
      AND a._legislatura = i._legislatura AND a.nome IN ('Supplier#000000003', 'Supplier#000000007'))
    ORDER BY i.data_entrada DESC NULLS LAST, i.IniId LIMIT 200""",
)
add_civic(
    "initiatives_all_matches",
    lambda t: pages.initiatives(t, TERM, limit=None, vote_tie_break=["id"]),
    f"""WITH {_LATEST_VOTE} SELECT i.IniNr AS nr, i.IniDescTipo AS tipo, i.IniTitulo AS titulo,
      CAST(i.data_entrada AS VARCHAR) AS data_ini, u.resultado, u.unanime, i.IniLinkTexto AS texto
    FROM iniciativas i LEFT JOIN ult u ON u.IniId = i.IniId AND u.rn = 1 WHERE i._legislatura = '1997'""",
)
_INITIATIVES_PAGE = f"{_INITIATIVE_ROWS}, top AS (SELECT * FROM page ORDER BY d DESC NULLS LAST, IniId LIMIT 200)"
add_scopes(
    "initiatives_kpis",
    lambda t, **scope: pages.initiatives_kpis(pages.initiatives(t, TERM, **(_INITIATIVES | scope))),
    f"""{_INITIATIVES_PAGE} SELECT count(*) AS n, count(*) FILTER (WHERE resultado = 'Aprovado') AS n_aprovadas,
      count(*) FILTER (WHERE resultado = 'Rejeitado') AS n_rejeitadas, count(DISTINCT tipo) AS distinct_tipo FROM top""",
)
add_civic(
    "initiatives_series",
    lambda t: pages.initiatives_series(pages.initiatives(t, TERM, **_INITIATIVES)),
    f"""{_INITIATIVES_PAGE} SELECT strftime(d, '%Y-%m') AS mes, count(*) AS n FROM top WHERE d IS NOT NULL GROUP BY 1""",
)
add_civic(
    "initiatives_series_all_matches",
    lambda t: pages.initiatives_series(pages.initiatives(t, TERM, limit=None, **_INITIATIVES)),
    f"""{_INITIATIVE_ROWS} SELECT strftime(d, '%Y-%m') AS mes, count(*) AS n FROM page WHERE d IS NOT NULL GROUP BY 1""",
)
add_civic(
    "initiative_party_options",
    lambda t: options(t["iniciativa_autores_gp"].filter("_legislatura = '1997'"), "GP"),
    _option_list("SELECT GP AS option FROM iniciativa_autores_gp WHERE _legislatura = '1997'"),
)
add_civic(
    "initiative_kind_options",
    lambda t: pages.initiative_kinds(t, TERM, PARTIES),
    _option_list(
        f"""SELECT IniDescTipo AS option FROM iniciativas i WHERE _legislatura = '1997'
        AND EXISTS (SELECT 1 FROM iniciativa_autores_gp g WHERE g.IniId = i.IniId AND g.GP IN {_PARTIES})"""
    ),
)
add_civic(
    "initiative_author_options",
    lambda t: pages.initiative_authors(t, TERM, PARTIES, ["1-URGENT"]),
    _option_list(
        f"""SELECT a.nome AS option FROM iniciativa_autores_deputados a JOIN iniciativas i USING (IniId)
        WHERE i._legislatura = '1997' AND a.GP IN {_PARTIES} AND i.IniDescTipo = '1-URGENT'"""
    ),
)

# Votes
_VOTE_COLUMNS = r"""v.IniId AS ini_id, i.IniNr AS nr, i.IniDescTipo AS tipo, i.IniTitulo AS titulo,
    CAST(TRY_CAST(v.data AS DATE) AS VARCHAR) AS data_vot, v.resultado, v.unanime, v.tipoReuniao AS tipo_reuniao,
    v.reuniao, v.descricao, trim(regexp_replace(regexp_replace(regexp_replace(coalesce(v.detalhe, ''),
      '<BR\s*/?>', ' | ', 'g'), '<[^>]+>', '', 'g'), '\s+', ' ', 'g')) AS detalhe, i.IniLinkTexto AS texto"""
_VOTES_FROM = """FROM iniciativa_eventos_votacao v LEFT JOIN iniciativas i
    ON i.IniId = v.IniId AND i._legislatura = v._legislatura WHERE v._legislatura = '1997'"""
_VOTE_ORDER = "ORDER BY TRY_CAST(v.data AS DATE) DESC NULLS LAST, v.IniId, v._json_idx, v.id"
_VOTE_TIES = ["IniId", "_json_idx", "id"]
_VOTES_WHERE = f"""AND (v.data IS NULL OR TRY_CAST(v.data AS DATE) {_BETWEEN_YEARS})
    AND v.resultado IN ('Aprovado', 'Rejeitado') AND v.tipoReuniao IN ('Plenário')"""
_VOTES = dict(dates=YEARS, results=["Aprovado", "Rejeitado"], meetings=["Plenário"], tie_break=_VOTE_TIES)
add_civic(
    "votes_page",
    lambda t: pages.votes(t, TERM, unanimous="without", **_VOTES),
    f"""SELECT {_VOTE_COLUMNS} {_VOTES_FROM} {_VOTES_WHERE}
    AND (v.unanime IS NULL OR v.unanime <> 'unanime') {_VOTE_ORDER} LIMIT 500""",
)
add_civic(
    "votes_page_of_kind",
    lambda t: pages.votes(t, TERM, kinds=["1-URGENT", "3-MEDIUM"], text="ação 1", unanimous="only", tie_break=_VOTE_TIES),
    f"""SELECT {_VOTE_COLUMNS} {_VOTES_FROM} AND i.IniDescTipo IN ('1-URGENT', '3-MEDIUM')
    AND i.IniTitulo ILIKE '%ação 1%' AND v.unanime = 'unanime' {_VOTE_ORDER} LIMIT 500""",
)
_VOTE_PAGE = f"WITH top AS (SELECT {_VOTE_COLUMNS} {_VOTES_FROM} {_VOTES_WHERE} {_VOTE_ORDER} LIMIT 500)"
add_scopes(
    "votes_kpis",
    lambda t, **scope: pages.votes_kpis(pages.votes(t, TERM, **(_VOTES | scope))),
    f"""{_VOTE_PAGE} SELECT count(*) AS n,
      count(*) FILTER (WHERE resultado = 'Aprovado') AS n_aprovadas,
      round(count(*) FILTER (WHERE resultado = 'Aprovado') / count(*), 2) AS share_aprovadas,
      count(*) FILTER (WHERE resultado = 'Rejeitado') AS n_rejeitadas,
      round(count(*) FILTER (WHERE resultado = 'Rejeitado') / count(*), 2) AS share_rejeitadas,
      count(*) FILTER (WHERE unanime = 'unanime') AS n_unanimes,
      round(count(*) FILTER (WHERE unanime = 'unanime') / count(*), 2) AS share_unanimes FROM top""",
)
add_scopes(
    "votes_series",
    lambda t, **scope: pages.votes_series(pages.votes(t, TERM, **(_VOTES | scope))),
    f"""{_VOTE_PAGE} SELECT left(data_vot, 7) AS mes, resultado, count(*) AS n FROM top
    WHERE data_vot IS NOT NULL GROUP BY 1, 2""",
)
add_civic(
    "vote_kind_options",
    lambda t: pages.vote_kinds(t, TERM),
    _option_list(
        """SELECT i.IniDescTipo AS option FROM iniciativa_eventos_votacao v JOIN iniciativas i
        ON i.IniId = v.IniId AND i._legislatura = v._legislatura WHERE v._legislatura = '1997'"""
    ),
)
add_civic(
    "vote_result_options",
    lambda t: pages.vote_results(t, TERM, ["1-URGENT"]),
    _option_list(
        """SELECT resultado AS option FROM iniciativa_eventos_votacao v WHERE _legislatura = '1997' AND EXISTS
        (SELECT 1 FROM iniciativas i WHERE i.IniId = v.IniId AND i._legislatura = v._legislatura
          AND i.IniDescTipo IN ('1-URGENT'))"""
    ),
)

# Interventions
_INTERVENTIONS_WHERE = f"""WHERE _legislatura = '16'
    AND (DataReuniaoPlenaria IS NULL OR CAST(DataReuniaoPlenaria AS DATE) {_BETWEEN_DAYS})
    AND dep_GP IN ('GP1', 'GP2', 'GP4') AND TipoIntervencao IN ('click', 'view', 'purchase')
    AND (Sumario ILIKE '%SUMÁRIO%k": 1%' OR Resumo ILIKE '%SUMÁRIO%k": 1%')"""
_INTERVENTION_COLUMNS = """CAST(DataReuniaoPlenaria AS VARCHAR) AS data_reu, dep_GP AS gp, dep_nome AS deputado,
    Qualidade AS qualidade, TipoIntervencao AS tipo, Sumario AS sumario, pub_URLDiario AS dar, av_url AS video"""
_INTERVENTIONS = dict(
    dates=DAYS, parties=["GP1", "GP2", "GP4"], kinds=["click", "view", "purchase"], text='SUMÁRIO%k": 1'
)
for _order, _sql in {
    "date_desc": "DataReuniaoPlenaria DESC NULLS LAST",
    "date_asc": "DataReuniaoPlenaria ASC NULLS LAST",
    "deputy": "dep_nome NULLS LAST, DataReuniaoPlenaria DESC NULLS LAST",
    "party": "dep_GP NULLS LAST, DataReuniaoPlenaria DESC NULLS LAST",
}.items():
    add_civic(
        "interventions_page" if _order == "date_desc" else f"interventions_page_by_{_order}",
        lambda t, o=_order: pages.interventions(t, "16", order=o, limit=60, **_INTERVENTIONS),
        f"SELECT {_INTERVENTION_COLUMNS} FROM intervencoes {_INTERVENTIONS_WHERE} ORDER BY {_sql}, Id LIMIT 60",
    )
_INTERVENTION_PAGE = f"""WITH top AS (SELECT {_INTERVENTION_COLUMNS}, DataReuniaoPlenaria AS d FROM intervencoes
    {_INTERVENTIONS_WHERE} ORDER BY DataReuniaoPlenaria DESC NULLS LAST, Id LIMIT 300)"""
add_scopes(
    "interventions_kpis",
    lambda t, **scope: pages.interventions_kpis(pages.interventions(t, "16", **(_INTERVENTIONS | scope))),
    f"""{_INTERVENTION_PAGE} SELECT count(*) AS n, count(DISTINCT deputado) AS distinct_deputado,
      count(DISTINCT gp) AS distinct_gp, count(DISTINCT tipo) AS distinct_tipo FROM top""",
)
add_scopes(
    "interventions_series",
    lambda t, **scope: pages.interventions_series(pages.interventions(t, "16", **(_INTERVENTIONS | scope))),
    f"""{_INTERVENTION_PAGE} SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS dia, gp, count(*) AS n FROM top
    WHERE d IS NOT NULL AND gp IS NOT NULL GROUP BY 1, 2""",
)
for _k, (_name, _column) in enumerate(
    [("party", "dep_GP"), ("kind", "TipoIntervencao"), ("deputy", "dep_nome"), ("quality", "Qualidade")]
):
    _chosen = [["GP1", "GP2"], ["click", "error"], ["Dep 1", "Dep 7", "Dep 8", "Dep 13"]]
    _conditions = [
        "dep_GP IN ('GP1', 'GP2')",
        "TipoIntervencao IN ('click', 'error')",
        "dep_nome IN ('Dep 1', 'Dep 7', 'Dep 8', 'Dep 13')",
    ]
    add_civic(
        f"intervention_{_name}_options",
        lambda t, k=_k, c=_chosen: pages.intervention_options(t, "17", k, c),
        _option_list(
            f"SELECT {_column} AS option FROM intervencoes WHERE "
            + " AND ".join(["_legislatura = '17'", *_conditions[:_k]])
        ),
    )

# Questions
_QUESTION_COLUMNS = """p.Id AS id_p, p.Nr AS nr, p.Tipo AS tipo, p.ReqTipo AS reqtipo, p.Assunto AS assunto,
    CAST(p.DataEnvio AS VARCHAR) AS data_envio, p.Ficheiro AS ficheiro,
    (SELECT string_agg(DISTINCT a.GP, ', ' ORDER BY a.GP) FROM pergunta_autores a WHERE a.Id = p.Id) AS gps,
    (SELECT string_agg(DISTINCT d.nomeEntidade, ', ' ORDER BY d.nomeEntidade) FROM pergunta_destinatarios d
      WHERE d.Id = p.Id) AS destinatarios"""
_QUESTIONS_WHERE = f"""WHERE p._legislatura = '1997' AND (p.DataEnvio IS NULL OR CAST(p.DataEnvio AS DATE) {_BETWEEN_YEARS})
    AND EXISTS (SELECT 1 FROM pergunta_autores a WHERE a.Id = p.Id AND a.GP IN {_PARTIES})
    AND EXISTS (SELECT 1 FROM pergunta_destinatarios d WHERE d.Id = p.Id
      AND d.nomeEntidade IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#11'))
    AND p.Tipo IN ('Pergunta', 'Requerimento') AND p.ReqTipo IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
    AND p.Assunto ILIKE '%assunto%'"""
_QUESTIONS = dict(
    dates=YEARS,
    parties=PARTIES,
    recipients=["Brand#1", "Brand#2", "Brand#3", "Brand#11"],
    kinds=["Pergunta", "Requerimento"],
    request_kinds=["1-URGENT", "2-HIGH", "3-MEDIUM"],
    text="assunto",
)
for _order, _sql in {
    "date_desc": "p.DataEnvio DESC NULLS LAST",
    "date_asc": "p.DataEnvio ASC NULLS LAST",
    "kind": "p.Tipo NULLS LAST, p.DataEnvio DESC NULLS LAST",
}.items():
    add_civic(
        "questions_page" if _order == "date_desc" else f"questions_page_by_{_order}",
        lambda t, o=_order: pages.questions(t, TERM, order=o, **_QUESTIONS),
        f"""SELECT {_QUESTION_COLUMNS} FROM perguntas_e_requerimentos p {_QUESTIONS_WHERE}
        ORDER BY {_sql}, p.Id LIMIT 300""",
    )
add_civic(
    "questions_all_matches",
    lambda t: pages.questions(t, TERM, limit=None),
    f"SELECT {_QUESTION_COLUMNS} FROM perguntas_e_requerimentos p WHERE p._legislatura = '1997'",
)
add_civic(
    "questions_by_author",
    lambda t: pages.questions(t, TERM, authors=["Supplier#000000002", "Supplier#000000004"]),
    f"""SELECT {_QUESTION_COLUMNS} FROM perguntas_e_requerimentos p WHERE p._legislatura = '1997' AND EXISTS
    (SELECT 1 FROM pergunta_autores a WHERE a.Id = p.Id AND a.nome IN ('Supplier#000000002', 'Supplier#000000004'))
    ORDER BY p.DataEnvio DESC NULLS LAST, p.Id LIMIT 300""",
)
_QUESTION_PAGE = f"""WITH top AS (SELECT {_QUESTION_COLUMNS} FROM perguntas_e_requerimentos p {_QUESTIONS_WHERE}
    ORDER BY p.DataEnvio DESC NULLS LAST, p.Id LIMIT 300)"""
add_scopes(
    "questions_kpis",
    lambda t, **scope: pages.questions_kpis(pages.questions(t, TERM, **(_QUESTIONS | scope))),
    f"""{_QUESTION_PAGE} SELECT count(*) AS n, count(DISTINCT tipo) AS distinct_tipo,
    count(DISTINCT reqtipo) AS distinct_reqtipo FROM top""",
)
add_scopes(
    "questions_series",
    lambda t, **scope: pages.questions_series(pages.questions(t, TERM, **(_QUESTIONS | scope))),
    f"{_QUESTION_PAGE} SELECT left(data_envio, 7) AS mes, count(*) AS n FROM top WHERE data_envio IS NOT NULL GROUP BY 1",
)
_BY_PARTY = f"EXISTS (SELECT 1 FROM pergunta_autores a WHERE a.Id = p.Id AND a.GP IN {_PARTIES})"
add_civic(
    "question_kind_options",
    lambda t: pages.question_kinds(t, TERM, PARTIES),
    _option_list(f"SELECT p.Tipo AS option FROM perguntas_e_requerimentos p WHERE p._legislatura = '1997' AND {_BY_PARTY}"),
)
add_civic(
    "question_request_kind_options",
    lambda t: pages.question_request_kinds(t, TERM, PARTIES, ["Pergunta"]),
    _option_list(
        f"""SELECT p.ReqTipo AS option FROM perguntas_e_requerimentos p WHERE p._legislatura = '1997' AND {_BY_PARTY}
        AND p.Tipo IN ('Pergunta')"""
    ),
)
add_civic(
    "question_recipient_options",
    lambda t: pages.question_recipients(t, TERM, PARTIES, ["Pergunta"], ["1-URGENT"]),
    _option_list(
        f"""SELECT d.nomeEntidade AS option FROM pergunta_destinatarios d WHERE d._legislatura = '1997' AND EXISTS
        (SELECT 1 FROM perguntas_e_requerimentos p WHERE p.Id = d.Id AND {_BY_PARTY} AND p.Tipo IN ('Pergunta')
          AND p.ReqTipo IN ('1-URGENT'))"""
    ),
)
add_civic(
    "question_author_options",
    lambda t: pages.question_authors(t, TERM, PARTIES, ["Pergunta"], ["1-URGENT"], ["Brand#1", "Brand#2"]),
    _option_list(
        f"""SELECT a.nome AS option FROM pergunta_autores a WHERE a._legislatura = '1997' AND a.GP IN {_PARTIES}
        AND EXISTS (SELECT 1 FROM perguntas_e_requerimentos p WHERE p.Id = a.Id AND p.Tipo IN ('Pergunta')
          AND p.ReqTipo IN ('1-URGENT'))
        AND EXISTS (SELECT 1 FROM pergunta_destinatarios d WHERE d.Id = a.Id AND d.nomeEntidade IN ('Brand#1', 'Brand#2'))"""
    ),
)

# Petitions
_SIGNATURES = "TRY_CAST(p.PetNrAssinaturas AS INTEGER)"
_PETITION_COLUMNS = f"""p.PetNr AS nr, CAST(p.PetDataEntrada AS VARCHAR) AS data_ent, p.PetAutor AS autor,
    p.PetAssunto AS assunto, p.PetSituacao AS situacao, CAST({_SIGNATURES} AS BIGINT) AS assinaturas,
    p.PetUrlTexto AS texto, (SELECT string_agg(DISTINCT c.Nome, ', ' ORDER BY c.Nome) FROM peticao_dados_comissao c
      WHERE c.PetId = p.PetId) AS comissoes"""
_PETITIONS_WHERE = f"""WHERE p._legislatura = '1997'
    AND (p.PetDataEntrada IS NULL OR CAST(p.PetDataEntrada AS DATE) {_BETWEEN_YEARS})
    AND p.PetSituacao IN ('Concluída', 'Admitida') AND {_SIGNATURES} >= 200
    AND (p.PetAssunto ILIKE '%PETIÇÃO%' OR p.PetAutor ILIKE '%PETIÇÃO%')"""
_PETITIONS = dict(dates=YEARS, statuses=["Concluída", "Admitida"], min_signatures=200, text="PETIÇÃO")
for _order, _sql in {
    "date_desc": "p.PetDataEntrada DESC NULLS LAST",
    "signatures_desc": f"{_SIGNATURES} DESC NULLS LAST",
    "status": "p.PetSituacao NULLS LAST, p.PetDataEntrada DESC NULLS LAST",
}.items():
    add_civic(
        "petitions_page" if _order == "date_desc" else f"petitions_page_by_{_order}",
        lambda t, o=_order: pages.petitions(t, TERM, order=o, **_PETITIONS),
        f"SELECT {_PETITION_COLUMNS} FROM peticoes p {_PETITIONS_WHERE} ORDER BY {_sql}, p.PetId LIMIT 200",
    )
add_civic(
    "petitions_of_committee",
    lambda t: pages.petitions(t, TERM, committees=["ECONOMY Brand#1", "SMALL Brand#4", "PROMO Brand#9"]),
    f"""SELECT {_PETITION_COLUMNS} FROM peticoes p WHERE p._legislatura = '1997' AND EXISTS
    (SELECT 1 FROM peticao_dados_comissao c WHERE c.PetId = p.PetId
      AND c.Nome IN ('ECONOMY Brand#1', 'SMALL Brand#4', 'PROMO Brand#9'))
    ORDER BY p.PetDataEntrada DESC NULLS LAST, p.PetId LIMIT 200""",
)
add_scopes(
    "petitions_kpis",
    lambda t, **scope: pages.petitions_kpis(pages.petitions(t, TERM, **(_PETITIONS | scope))),
    f"""WITH top AS (SELECT {_PETITION_COLUMNS} FROM peticoes p {_PETITIONS_WHERE}
      ORDER BY p.PetDataEntrada DESC NULLS LAST, p.PetId LIMIT 200)
    SELECT CAST(sum(assinaturas) AS BIGINT) AS total, CAST(trunc(median(assinaturas)) AS BIGINT) AS median FROM top""",
)
add_scopes(
    "petitions_series",
    lambda t, **scope: pages.petitions_series(pages.petitions(t, TERM, **(_PETITIONS | scope))),
    f"""WITH top AS (SELECT {_PETITION_COLUMNS} FROM peticoes p {_PETITIONS_WHERE}
      ORDER BY p.PetDataEntrada DESC NULLS LAST, p.PetId LIMIT 200)
    SELECT left(data_ent, 7) AS mes, count(*) AS n FROM top WHERE data_ent IS NOT NULL GROUP BY 1""",
)
add_civic(
    "petition_committee_options",
    lambda t: pages.petition_committees(t, TERM, ["Admitida"]),
    _option_list(
        """SELECT c.Nome AS option FROM peticao_dados_comissao c WHERE c._legislatura = '1997' AND EXISTS
        (SELECT 1 FROM peticoes p WHERE p.PetId = c.PetId AND p.PetSituacao IN ('Admitida'))"""
    ),
)

# Approved acts
_ACTS = """FROM (SELECT d.Id, d.Tipo AS tipo, d.Numero AS numero, d.AnoCivil AS ano, d.Titulo AS titulo,
    d.LinkTexto AS texto, CAST(pub.pubdt AS VARCHAR) AS data_pub, pub.dar, (SELECT string_agg(DISTINCT x, ', ' ORDER BY x)
      FROM (SELECT i.IniTipo || ' ' || i.IniNr AS x FROM diploma_iniciativas i WHERE i.Id = d.Id)) AS iniciativas_origem
    FROM diplomas_aprovados d LEFT JOIN (SELECT Id, min(pubdt) AS pubdt,
        arg_min(URLDiario, (pubdt, URLDiario)) FILTER (WHERE URLDiario IS NOT NULL) AS dar
      FROM diploma_publicacao GROUP BY Id) pub USING (Id)
    WHERE d._legislatura = '1997' AND d.Tipo IN ('1-URGENT', '2-HIGH', '4-NOT SPECIFIED') AND d.AnoCivil IN ('1997')
      AND d.Sessao IN ('1', '2', '3') AND d.Titulo ILIKE '%lei%')"""
_ACT_COLUMNS = "tipo, numero, ano, titulo, texto, data_pub, dar, iniciativas_origem"
_ACT_FILTERS = dict(
    kinds=["1-URGENT", "2-HIGH", "4-NOT SPECIFIED"], years=["1997"], sessions=["1", "2", "3"], text="lei"
)
for _order, _sql in {
    "published_desc": "data_pub DESC NULLS LAST",
    "number": "TRY_CAST(numero AS INTEGER) DESC NULLS LAST",
    "kind": "tipo NULLS LAST, numero NULLS LAST",
}.items():
    add_civic(
        "diplomas_page" if _order == "published_desc" else f"diplomas_page_by_{_order}",
        lambda t, o=_order: pages.approved_acts(t, TERM, order=o, **_ACT_FILTERS),
        f"SELECT {_ACT_COLUMNS} {_ACTS} ORDER BY {_sql}, Id LIMIT 200",
    )
_ACT_PAGE = f"WITH top AS (SELECT {_ACT_COLUMNS} {_ACTS} ORDER BY data_pub DESC NULLS LAST, Id LIMIT 200)"
add_scopes(
    "diplomas_kpis",
    lambda t, **scope: pages.approved_acts_kpis(pages.approved_acts(t, TERM, **(_ACT_FILTERS | scope))),
    f"""{_ACT_PAGE} SELECT count(*) AS n, count(DISTINCT tipo) AS distinct_tipo, count(DISTINCT ano) AS distinct_ano
    FROM top""",
)
add_scopes(
    "diplomas_series",
    lambda t, **scope: pages.approved_acts_series(pages.approved_acts(t, TERM, **(_ACT_FILTERS | scope))),
    f"""{_ACT_PAGE} SELECT left(data_pub, 7) AS mes, tipo, count(*) AS n FROM top
    WHERE data_pub IS NOT NULL GROUP BY 1, 2""",
)
for _k, (_name, _column) in enumerate([("kind", "Tipo"), ("year", "AnoCivil"), ("session", "Sessao")]):
    _conditions = ["Tipo IN ('1-URGENT', '2-HIGH')", "AnoCivil IN ('1997')"]
    add_civic(
        f"diploma_{_name}_options",
        lambda t, k=_k: pages.act_options(t, TERM, k, [["1-URGENT", "2-HIGH"], ["1997"]]),
        _option_list(
            f"SELECT {_column} AS option FROM diplomas_aprovados WHERE "
            + " AND ".join(["_legislatura = '1997'", *_conditions[:_k]])
        ),
    )

# Agenda
_AGENDA_COLUMNS = """CAST(data_inicio AS VARCHAR) AS inicio, CAST(data_fim AS VARCHAR) AS fim, Section AS seccao,
    Theme AS tema, Title AS titulo, Subtitle AS subtitulo, Local AS local, Link AS link"""
_AGENDA_WHERE = f"""WHERE _legislatura = '16' AND (data_inicio IS NULL OR CAST(data_inicio AS DATE) {_BETWEEN_DAYS})
    AND Section IN ('view', 'click') AND (Title ILIKE '%REUNIÃO 1%' OR Subtitle ILIKE '%REUNIÃO 1%')"""
_AGENDA = dict(dates=DAYS, sections=["view", "click"], text="REUNIÃO 1")
for _order, _sql in {"date_desc": "DESC", "date_asc": "ASC"}.items():
    add_civic(
        "agenda_page" if _order == "date_desc" else "agenda_page_by_date_asc",
        lambda t, o=_order: pages.agenda(t, "16", order=o, **_AGENDA),
        f"""SELECT {_AGENDA_COLUMNS} FROM agenda_parlamentar {_AGENDA_WHERE}
        ORDER BY data_inicio {_sql} NULLS LAST, Id LIMIT 200""",
    )
_AGENDA_PAGE = f"""WITH top AS (SELECT {_AGENDA_COLUMNS} FROM agenda_parlamentar {_AGENDA_WHERE}
    ORDER BY data_inicio DESC NULLS LAST, Id LIMIT 200)"""
add_scopes(
    "agenda_kpis",
    lambda t, **scope: pages.agenda_kpis(pages.agenda(t, "16", **(_AGENDA | scope))),
    f"""{_AGENDA_PAGE} SELECT count(*) AS n, count(DISTINCT seccao) AS distinct_seccao,
    count(DISTINCT tema) AS distinct_tema FROM top""",
)
add_scopes(
    "agenda_series",
    lambda t, **scope: pages.agenda_series(pages.agenda(t, "16", **(_AGENDA | scope))),
    f"{_AGENDA_PAGE} SELECT left(inicio, 10) AS dia, seccao, count(*) AS n FROM top WHERE inicio IS NOT NULL GROUP BY 1, 2",
)
for _k, (_name, _column) in enumerate([("section", "Section"), ("theme", "Theme"), ("place", "Local")]):
    _conditions = ["Section IN ('view')", "Theme IN ('Tema 1', 'Tema 2')"]
    add_civic(
        f"agenda_{_name}_options",
        lambda t, k=_k: pages.agenda_options(t, "17", k, [["view"], ["Tema 1", "Tema 2"]]),
        _option_list(
            f"SELECT {_column} AS option FROM agenda_parlamentar WHERE "
            + " AND ".join(["_legislatura = '17'", *_conditions[:_k]])
        ),
    )

# Activities
_EVENTS_VIEW = registers.ActivityView(
    "atividades_eventos", "SessaoLegislativa", "TipoEvento", ("Designacao", "LocalEvento"), "Concedida", ("IDEvento",)
)
_ACTIVITY_WHERE = """WHERE _legislatura = '17' AND SessaoLegislativa IN ('1', '2', '3') AND TipoEvento IN ('view', 'click')
    AND Concedida IN ('S') AND (coalesce(Designacao, '') ILIKE '%sala 1%' OR coalesce(LocalEvento, '') ILIKE '%sala 1%')"""
_ACTIVITIES = dict(sessions=["1", "2", "3"], kinds=["view", "click"], extras=["S"], text="sala 1")
add_civic(
    "activity_view",
    lambda t: registers.visible(registers.activities(t, _EVENTS_VIEW, "17", **_ACTIVITIES)),
    f"""SELECT IDEvento, SessaoLegislativa, TipoEvento, Designacao, LocalEvento, Concedida
    FROM atividades_eventos {_ACTIVITY_WHERE} ORDER BY _data DESC NULLS LAST, IDEvento LIMIT 1000""",
)
add_scopes(
    "activity_series",
    lambda t, **scope: registers.activities_series(registers.activities(t, _EVENTS_VIEW, "17", **(_ACTIVITIES | scope))),
    f"""SELECT strftime(_data, '%Y-%m') AS mes, count(*) AS n FROM (SELECT _data FROM atividades_eventos
    {_ACTIVITY_WHERE} ORDER BY _data DESC NULLS LAST, IDEvento LIMIT 1000) WHERE _data IS NOT NULL GROUP BY 1""",
)
add_civic(
    "activity_kind_options",
    lambda t: registers.activity_kinds(t, _EVENTS_VIEW, "17", ["1"]),
    _option_list(
        "SELECT TipoEvento AS option FROM atividades_eventos WHERE _legislatura = '17' AND SessaoLegislativa IN ('1')"
    ),
)

_VIEW_KEYS = {
    "hearings": "IDAudicao", "audiences": "IDAudiencia", "debates": "DebateId", "trips": "IDDeslocacao", "events": "IDEvento",
    "general": "Id", "reports": "Id",
}
for _name, _view in registers.ACTIVITY_VIEWS.items():
    _search = " OR ".join(f"coalesce({c}, '') ILIKE '%sala 1%'" for c in _view.texts)
    _where = f"_legislatura = '17' AND {_view.session} IN ('1', '2', '3') AND ({_search})"
    _where += f" AND {_view.kind} IN ('view', 'click')" if _view.kind else ""
    _where += f" AND {_view.extra} IN ('S')" if _view.extra else ""
    _shown = dict.fromkeys([_VIEW_KEYS[_name], _view.session, *filter(None, [_view.kind, _view.extra]), *_view.texts])
    add_civic(
        f"activity_view_{_name}",
        lambda t, v=replace(_view, tie_break=(_VIEW_KEYS[_name],)), c=list(_shown): registers.activities(
            t, v, "17", sessions=["1", "2", "3"], kinds=["view", "click"], extras=["S"], text="sala 1"
        ).select(*c),
        f"""SELECT {", ".join(_shown)} FROM {_view.table} WHERE {_where}
        ORDER BY _data DESC NULLS LAST, {_VIEW_KEYS[_name]} LIMIT 1000""",
    )
    add_civic(
        f"activity_sessions_{_name}",
        lambda t, v=_view: options(t[v.table].filter("_legislatura = '17'"), v.session),
        _option_list(f"SELECT {_view.session} AS option FROM {_view.table} WHERE _legislatura = '17'"),
    )

# Organs
_ORGANS = """SELECT o.tipo_orgao, o.oId, o.oDes, o.cargoDes FROM orgaos_detalhe o WHERE o._legislatura = '17'
    AND o.tipo_orgao IN ('ECONOMY', 'SMALL', 'PROMO') AND (coalesce(o.oDes, '') ILIKE '%b%' OR coalesce(o.cargoDes, '') ILIKE '%b%')
    AND EXISTS (SELECT 1 FROM orgaos_historico_composicao h WHERE h._legislatura = '17' AND h.orgao_id = o.oId
      AND h.legDes IN ('Sessão O') AND h.depGP IN ('GP1', 'GP2'))"""
_ORGAN_FILTERS = dict(kinds=["ECONOMY", "SMALL", "PROMO"], sessions=["Sessão O"], parties=["GP1", "GP2"])
add_civic("organs_page", lambda t: registers.organs(t, "17", text="b", **_ORGAN_FILTERS), _ORGANS)
add_civic(
    "organs_kpis",
    lambda t: registers.organs_kpis(registers.organs(t, "17", text="b", **_ORGAN_FILTERS)),
    f"SELECT count(*) AS n, count(DISTINCT tipo_orgao) AS distinct_tipo_orgao FROM ({_ORGANS})",
)
add_civic(
    "organ_members",
    lambda t: registers.organ_members(t, "17", tie_break=["orgao_id", "depCadId", "cargoId", "ordem"], **_ORGAN_FILTERS),
    """SELECT tipo_orgao, orgao_id, depCadId, cargoId, CAST(ordem AS BIGINT) AS ordem, legDes, depGP
    FROM orgaos_historico_composicao
    WHERE _legislatura = '17' AND tipo_orgao IN ('ECONOMY', 'SMALL', 'PROMO') AND legDes IN ('Sessão O')
      AND depGP IN ('GP1', 'GP2') ORDER BY tipo_orgao, orgao_id, depCadId, cargoId, ordem LIMIT 2000""",
)
add_civic(
    "organ_session_options",
    lambda t: registers.organ_sessions(t, "17", ["ECONOMY"]),
    _option_list(
        "SELECT legDes AS option FROM orgaos_historico_composicao WHERE _legislatura = '17' AND tipo_orgao IN ('ECONOMY')"
    ),
)
add_civic(
    "organ_party_options",
    lambda t: registers.organ_parties(t, "17", ["ECONOMY"], ["Sessão O"]),
    _option_list(
        """SELECT depGP AS option FROM orgaos_historico_composicao WHERE _legislatura = '17'
        AND tipo_orgao IN ('ECONOMY') AND legDes IN ('Sessão O')"""
    ),
)

# Delegations
add_civic(
    "delegations_page",
    lambda t: registers.occasional_delegations(t, "17", sessions=["BUILDING", "MACHINERY"], text="customer#"),
    """SELECT Id, Nome, Local, CAST(data_inicio AS VARCHAR) AS data_inicio, CAST(data_fim AS VARCHAR) AS data_fim, Sessao
    FROM delegacoes_eventuais WHERE _legislatura = '17' AND Sessao IN ('BUILDING', 'MACHINERY')
      AND Nome ILIKE '%customer#%'""",
)
add_civic(
    "delegation_place_options",
    lambda t: registers.delegation_places(t, "17", ["BUILDING"]),
    _option_list("SELECT Local AS option FROM delegacoes_eventuais WHERE _legislatura = '17' AND Sessao IN ('BUILDING')"),
)
add_civic(
    "delegation_participants",
    lambda t: registers.participants(t, "17", 14),
    """SELECT Nome, Gp, Tipo FROM delegacao_eventual_participantes WHERE _legislatura = '17' AND Id = 14""",
)
add_civic(
    "delegation_participants_of_all",
    lambda t: registers.children_of_all(
        t["delegacao_eventual_participantes"],
        registers.occasional_delegations(t, "17", sessions=["BUILDING"]),
        ["Id"],
    ),
    """SELECT c.* FROM delegacao_eventual_participantes c WHERE EXISTS (SELECT 1 FROM delegacoes_eventuais d
    WHERE d.Id = c.Id AND d._legislatura = '17' AND d.Sessao IN ('BUILDING'))""",
)
add_civic(
    "friendship_groups_page",
    lambda t: registers.friendship_groups(t, "17", sessions=["BUILDING"], text="#00000"),
    """SELECT Id, Nome, CAST(data_inicio AS VARCHAR) AS data_criacao, Sessao FROM grupos_parlamentares_de_amizade
    WHERE _legislatura = '17' AND Sessao IN ('BUILDING') AND Nome ILIKE '%#00000%'""",
)
add_civic(
    "friendship_group_members",
    lambda t: registers.group_members(t, "17", 14),
    """SELECT Nome, Gp, Cargo, CAST(DataInicio AS VARCHAR) AS DataInicio, CAST(DataFim AS VARCHAR) AS DataFim
    FROM grupo_amizade_composicao WHERE _legislatura = '17' AND Id = 14""",
)
add_civic(
    "standing_delegations_page",
    lambda t: registers.standing_delegations(t, "17", sessions=["BUILDING"], text="DELEGAÇÃO%00"),
    """SELECT Id, Nome, CAST(data_inicio AS VARCHAR) AS data_eleicao, Sessao FROM delegacoes_permanentes
    WHERE _legislatura = '17' AND Sessao IN ('BUILDING') AND Nome ILIKE '%DELEGAÇÃO%00%'""",
)
add_civic(
    "meeting_place_options",
    lambda t: registers.meeting_places(t, "17", ["BUILDING"]),
    _option_list("SELECT Local AS option FROM reunioes_e_visitas WHERE _legislatura = '17' AND Tipo IN ('BUILDING')"),
)
add_civic(
    "meetings_page",
    lambda t: registers.meetings_and_visits(t, "17", kinds=["BUILDING", "FURNITURE"], text="nation_1"),
    """SELECT Id, Nome, Tipo, Local, Promotor, CAST(data_inicio AS VARCHAR) AS data_inicio,
      CAST(data_fim AS VARCHAR) AS data_fim FROM reunioes_e_visitas WHERE _legislatura = '17'
      AND Tipo IN ('BUILDING', 'FURNITURE')
      AND (coalesce(Nome, '') ILIKE '%nation_1%' OR coalesce(Promotor, '') ILIKE '%nation_1%')""",
)

# Budget
_BUDGET = """SELECT ID, ID_Pai, Tipo, Numero, Titulo, Estado, Texto FROM orcamento_do_estado
    WHERE _legislatura = '17' AND Tipo IN ('ECONOMY', 'SMALL', 'STANDARD') AND (Titulo ILIKE '%brand#1%' OR Texto ILIKE '%brand#1%')
    ORDER BY TRY_CAST(ID AS INTEGER) NULLS LAST, ID LIMIT 1000"""
_BUDGET_FILTERS = dict(kinds=["ECONOMY", "SMALL", "STANDARD"], text="brand#1")
add_civic("budget_items", lambda t: registers.budget_items(t, "17", **_BUDGET_FILTERS), _BUDGET)
add_scopes(
    "budget_kpis",
    lambda t, **scope: registers.budget_kpis(registers.budget_items(t, "17", **(_BUDGET_FILTERS | scope))),
    f"SELECT count(*) AS n, count(DISTINCT Tipo) AS distinct_Tipo, count(DISTINCT Estado) AS distinct_Estado FROM ({_BUDGET})",
)
add_civic(
    "budget_state_options",
    lambda t: registers.budget_states(t, "17", ["ECONOMY"]),
    _option_list("SELECT Estado AS option FROM orcamento_do_estado WHERE _legislatura = '17' AND Tipo IN ('ECONOMY')"),
)

# Deputies
add_civic(
    "deputy_labels",
    lambda t: registers.deputy_labels(t, "17"),
    """SELECT DepCadId, coalesce(DepNomeParlamentar, DepNomeCompleto, '(s/n)') || ' — ' || coalesce(DepCPDes, '—') AS label
    FROM deputados WHERE _legislatura = '17'""",
)
add_civic(
    "deputy_biography",
    lambda t: registers.deputy_biography(t, "17", 3.0),
    "SELECT * FROM deputados WHERE _legislatura = '17' AND DepCadId = 3.0",
)


def _counted(t):
    """The tables of the counts, with the interventions of term 16 in the term of the other two."""
    term = F.when(F.col("_legislatura") == "16", TERM).otherwise(F.col("_legislatura"))
    names = ("iniciativa_autores_deputados", "iniciativas", "pergunta_autores")
    return {n: t[n] for n in names} | {"intervencoes": t["intervencoes"].withColumn("_legislatura", term)}


add_civic(
    "deputy_profile_counts",
    lambda t: registers.deputy_counts(_counted(t), TERM, 3.0),
    """SELECT (SELECT count(DISTINCT a.IniId) FROM iniciativa_autores_deputados a JOIN iniciativas i USING (IniId)
        WHERE i._legislatura = '1997' AND a.idCadastro = '3') AS n_ini,
      (SELECT count(*) FROM intervencoes WHERE _legislatura = '16' AND dep_idCadastro = '3') AS n_int,
      (SELECT count(DISTINCT Id) FROM pergunta_autores WHERE _legislatura = '1997' AND idCadastro = '3') AS n_perg""",
)
add_civic(
    "deputy_hearings_given",
    lambda t: registers.deputy_hearings(t, "17", 3.0, "deputados_atividade_audicoes"),
    """SELECT ActAs AS assunto, ActDtent AS data_entrada, ActLoc AS local, ActTpdesc AS tipo_desc, ActSl AS sessao
    FROM deputados_atividade_audicoes WHERE DepCadId = 3 AND ActAs IS NOT NULL""",
)
add_civic(
    "deputy_initiatives",
    lambda t: registers.deputy_initiatives(t, TERM, 3.0),
    """SELECT i.IniNr AS nr, i.IniDescTipo AS tipo, i.IniTitulo AS titulo, CAST(i.data_entrada AS VARCHAR) AS data_ini,
      i.IniLinkTexto AS texto FROM iniciativas i JOIN iniciativa_autores_deputados a USING (IniId)
    WHERE i._legislatura = '1997' AND a.idCadastro = '3'""",
)
add_civic(
    "deputy_interventions",
    lambda t: registers.deputy_interventions(t, "16", 3.0),
    """SELECT CAST(DataReuniaoPlenaria AS VARCHAR) AS data_reu, TipoIntervencao AS tipo, Sumario AS sumario,
      pub_URLDiario AS dar, av_url AS video FROM intervencoes WHERE _legislatura = '16' AND dep_idCadastro = '3'""",
)
add_civic(
    "deputy_questions",
    lambda t: registers.deputy_questions(t, TERM, 3.0),
    """SELECT p.Nr AS nr, p.Tipo AS tipo, p.ReqTipo AS req_tipo, p.Assunto AS assunto,
      CAST(CAST(p.DataEnvio AS DATE) AS VARCHAR) AS data_envio, p.Ficheiro AS texto
    FROM perguntas_e_requerimentos p JOIN pergunta_autores a USING (Id)
    WHERE p._legislatura = '1997' AND a.idCadastro = '3'""",
)
add_civic(
    "deputy_hearings",
    lambda t: registers.deputy_hearings(t, "17", 3.0),
    """SELECT ActAs AS assunto, CAST(TRY_CAST(ActDtent AS DATE) AS VARCHAR) AS data_entrada, ActLoc AS local,
      ActTpdesc AS tipo_desc, ActSl AS sessao FROM deputados_atividade_audiencias
    WHERE _legislatura = '17' AND DepCadId = 3.0 AND ActAs IS NOT NULL""",
)
add_civic(
    "membership_timeline",
    lambda t: registers.deputy_party_timeline(t, "17", 3.0, date(2002, 6, 30)),
    """SELECT GpSigla AS gp, CAST(TRY_CAST(GpDtInicio AS DATE) AS VARCHAR) AS data_inicio,
      CAST(coalesce(TRY_CAST(GpDtFim AS DATE), DATE '2002-06-30') AS VARCHAR) AS data_fim
    FROM deputados_dep_gp WHERE _legislatura = '17' AND DepCadId = 3.0 AND GpSigla IS NOT NULL""",
)
add_civic(
    "unpivot_counters",
    lambda t: registers.deputy_activity(t, "17", 3.0),
    """SELECT substr(categoria, 3) AS categoria, n FROM (UNPIVOT (SELECT n_Ini, n_Intev, n_Req, n_Scgt
      FROM deputado_atividade_contadores WHERE _legislatura = '17' AND DepCadId = 3.0)
      ON COLUMNS(*) INTO NAME categoria VALUE n)""",
)

# Export
add_civic(
    "table_export",
    lambda t: registers.export_selection(t["diploma_publicacao"], ["1996", "1998"]),
    """SELECT Id, CAST(publicacao_idx AS BIGINT) AS publicacao_idx, CAST(pubdt AS VARCHAR) AS pubdt, URLDiario, _legislatura
    FROM diploma_publicacao WHERE _legislatura IN ('1996', '1998')""",
)
add_civic(
    "table_preview",
    lambda t: registers.preview(registers.export_selection(t["peticoes"], ["1996", "1998"]), tie_break=["PetId"]),
    """SELECT PetId, PetNr, CAST(PetDataEntrada AS VARCHAR) AS PetDataEntrada, PetAutor, PetAssunto, PetSituacao,
      PetNrAssinaturas, PetUrlTexto, _legislatura FROM peticoes WHERE _legislatura IN ('1996', '1998')
    ORDER BY PetId LIMIT 100""",
)
add_civic(
    "left_to_aggregate",
    lambda t: attach(t["diplomas_aprovados"].select("Id", "Tipo"), t["diploma_publicacao"], ["Id"], pages.first_publication()),
    """SELECT d.Id, d.Tipo, CAST(pub.pubdt AS VARCHAR) AS data_pub, pub.dar FROM diplomas_aprovados d LEFT JOIN
    (SELECT Id, min(pubdt) AS pubdt, arg_min(URLDiario, (pubdt, URLDiario)) FILTER (WHERE URLDiario IS NOT NULL) AS dar
      FROM diploma_publicacao GROUP BY Id) pub USING (Id)""",
)
